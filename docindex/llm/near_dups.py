"""MinHash near-duplicates by an inverted join of signature coordinates.

1. Equal word sequences fold into one *node* first, so copies make no pairs. Nodes
   are numbered as they are written; all later tables have these numbers.
2. A node's set of word shingles gives ``COORDINATES`` MinHash values. Each
   (coordinate, value) is posted; a pair can only be linked if it agrees in at
   least ``matches`` coordinates (chosen so that a pair at the similarity is
   missed with a probability below 1e-6).
3. Prefix: with postings ordered from rare to frequent, two such nodes share one
   of their first ``COORDINATES - matches + 1``. Postings with one node need no
   list, so most nodes leave here.
4. Skip: only prefix lists are merged; the frequent rest is looked up in the
   signatures of pairs met there, and the pair is dropped below ``matches``.
5. What remains is confirmed on the full shingle sets, each read once and sent to the
   leaders it is compared with.

No list is expanded into all its pairs. In a list every node meets one leader, the
node whose postings are shared most (in a family of edited copies: their source,
in all its lists). Afterwards only nodes of *different* components can still be
missing a link, and only among the nodes of a leader that belong to several: there
the nodes outside the largest component meet all others in blocks of ``BLOCK``, by
one matrix product of full sets per pair of blocks, which returns one link per pair
of components. If more than ``BLOCK`` are outside, as in a family of texts that share
a template but are not similar enough, the leader's nodes are first posted once more,
under the rarest shingles of their full sets: two similar sets share one of their
first ``n - ceil(similarity * n) + 1`` in any common order, and texts that merely
share a template have nothing in common there. Only these lists meet in blocks.

A leader's or a list's row that many rows need is sent to them in as many copies as
they fill blocks, or broadcast if its key is among the few with a large share. What
asks for full sets is narrow and broadcast while its counted rows fit, so that sets
are sent once, to where they are compared; beyond that they are dealt by node first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docindex.llm.common import (
    Batches,
    Vocabulary,
    bounded,
    join_uneven,
    mix,
    sequence_hashes,
    slices,
    staged,
    text_key,
    utf8,
)
from docindex.llm.components import components

COORDINATES = 64
MISS = 1e-6
BLOCK = 256  # nodes of a family compared at a time, on average

_rng = np.random.default_rng(7)
_XOR = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)[:, None]
_FACTOR = (_rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1))[:, None]
# A long text's shingles go through the coordinates in blocks.
_BLOCK = 1 << 14


def least_matches(similarity: float) -> int:
    """The most coordinates that a pair at ``similarity`` agrees in but for ``MISS``."""
    tail, k = 0.0, COORDINATES
    for m in range(k + 1):
        tail += math.comb(k, m) * similarity**m * (1 - similarity) ** (k - m)
        if tail > MISS:
            return max(1, m)
    return k


def shingle_sets(numbers: list[np.ndarray], size: int, hashes: np.ndarray) -> Iterator[np.ndarray]:
    """Per word sequence the sorted hashes of its distinct shingles; fewer words
    than ``size`` make one shingle of them all."""
    for words in numbers:
        n = min(size, len(words))
        yield np.unique(sequence_hashes(hashes[words], n) + np.uint64(n)) if n else np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _BLOCK):
        values = (shingles[None, at : at + _BLOCK] ^ _XOR) * _FACTOR
        low = np.minimum(low, values.min(axis=1))
    return (mix(low) >> np.uint64(33)).astype(np.int32)


class Signer:
    """Texts to (digest of the words, number of shingles, signature)."""

    def __init__(self, size: int) -> None:
        self.size = size

    def __call__(self, batches: Batches) -> Batches:
        vocabulary = Vocabulary()
        for batch in (part for whole in batches for part in slices(whole)):
            digests, numbers, counts, signatures = [], [], [], []
            for text in utf8(batch.column("text")):
                words = text.lower().split() if text else []
                digests.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                numbers.append(vocabulary.numbers(words))
            for shingles in shingle_sets(numbers, self.size, vocabulary.hashes()):
                counts.append(len(shingles))
                signatures.append(signature(shingles) if len(shingles) else None)
            vocabulary.trim()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("text_key"),
                    pa.array(digests, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.array(signatures, pa.list_(pa.int32())),
                ],
                ["doc", "text_key", "digest", "n_shingles", "signature"],
            )


class ShingleSets:
    """Texts of nodes to their sorted shingle sets."""

    def __init__(self, size: int) -> None:
        self.size = size

    def __call__(self, batches: Batches) -> Batches:
        vocabulary = Vocabulary()
        for batch in (part for whole in batches for part in slices(whole)):
            numbers = [vocabulary.numbers(text.lower().split()) for text in utf8(batch.column("text"))]
            sets = [s.view(np.int64) for s in shingle_sets(numbers, self.size, vocabulary.hashes())]
            vocabulary.trim()
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"]
            )


class Blocks:
    """Two blocks of shingle sets to the links between their components, one per
    pair of roots."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den

    def __call__(self, block: pa.Table) -> pa.Table:
        asks = block.column("asks").to_numpy()
        names, roots = np.unique(block.column("root").to_numpy(), return_inverse=True)
        sets = block.column("shingles").combine_chunks()
        lengths = np.diff(sets.offsets.to_numpy())
        row = np.repeat(np.arange(len(lengths)), lengths)
        _, column = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        x, y = np.flatnonzero(~asks), np.flatnonzero(asks)
        common = np.zeros((len(y), len(x)), np.float32)
        width = 1 << 14  # shingles at a time
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            part = slice(*np.searchsorted(column, [lo, lo + width]))
            table = np.zeros((len(lengths), width), np.float32)
            table[row[part], column[part] - lo] = 1.0
            common += table[y] @ table[x].T
        union = lengths[y][:, None] + lengths[x][None, :] - common
        linked = (common * self.den >= union * self.num) & (roots[y][:, None] != roots[x][None, :])
        i, j = np.nonzero(linked)
        pairs = np.unique(np.stack([roots[y[i]], roots[x[j]]]), axis=1)
        return pa.table([pa.array(names[at], pa.int64()) for at in pairs], ["a", "b"])


def _agreeing(x: Column, y: Column) -> Column:
    """In how many coordinates two signatures agree."""
    same = F.zip_with(x, y, lambda p, q: (p == q).cast("int"))
    return F.aggregate(same, F.lit(0), lambda n, s: n + s)


def signed(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("text")
    )
    schema = "doc bigint, text_key bigint, digest binary, n_shingles bigint, signature array<int>"
    return staged(rows.mapInArrow(Signer(shingle), schema), "signatures")


def postings(nodes: DataFrame, matches: int) -> DataFrame:
    """``(token, node)`` of every node's prefix; tokens of one node are left out."""
    spread = nodes.select("node", F.posexplode("signature").alias("at", "value"))
    spread = spread.select("node", (F.shiftleft(F.col("at").cast("bigint"), 32) + F.col("value")).alias("token"))
    shared, total = _shared(spread)
    ordered = join_uneven(spread, shared, "token", "df", total).groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens")
    )
    # Tokens of one node come first in the order, and are not in ``tokens``.
    prefix = F.slice("tokens", 1, F.size("tokens") - (matches - 1))
    shares = F.aggregate("tokens", F.lit(0).cast("bigint"), lambda n, t: n + t["df"])
    kept = ordered.filter(F.size("tokens") >= matches)
    return kept.select("node", (-shares).alias("rank"), F.explode(prefix).alias("t")).select("t.token", "node", "rank")


def _shared(spread: DataFrame) -> tuple[DataFrame, int]:
    """``(token, df)`` of the tokens of several nodes, and their postings' number."""
    shared = spread.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = staged(shared, "shared")
    return shared, shared.agg(F.sum("df")).first()[0] or 0


def rarest(sets: DataFrame, num: int, den: int) -> DataFrame:
    """``(token, node)``: nodes under the rarest shingles of their sets that a similar
    set must share one of; shingles of one node are left out."""
    spread = sets.select("node", F.size("shingles").cast("bigint").alias("n"), F.explode("shingles").alias("token"))
    shared, total = _shared(spread.select("token"))
    ordered = join_uneven(spread, shared, "token", "df", total).groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens")
    )
    length = F.col("n") - F.ceil(F.col("n") * num / den) + 1
    # Shingles of one node come first in the order, and are not in ``tokens``.
    left = F.greatest(length - (F.col("n") - F.size("tokens")), F.lit(0)).cast("int")
    return ordered.select("node", F.explode(F.slice("tokens", F.lit(1), left)).alias("t")).select("t.token", "node")


class Join:
    """How to confirm pairs and to find the links between components."""

    def __init__(self, nodes: DataFrame, sets: DataFrame, matches: int, num: int, den: int) -> None:
        self.signatures = nodes.select("node", "n_shingles", "signature")
        self.sets, self.matches, self.num, self.den = sets, matches, num, den

    def compared(self, pairs: DataFrame) -> DataFrame:
        """``(a, b, part, na, nb, agreeing)`` of pairs of leaders with their nodes; a
        leader's pairs fall into parts of about ``BLOCK``, each with its own copy."""
        parts = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts")
        self.leaders = staged(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"), parts), "leaders")
        total = self.leaders.agg(F.sum("n")).first()[0] or 0
        pairs = join_uneven(pairs, self.leaders, "a", "n", total)
        pairs = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
        left = self.copies(self.signatures.toDF("a", "na", "sa"))
        right = self.signatures.toDF("b", "nb", "sb")
        met = pairs.join(right, "b").join(left, ["a", "part"])
        return met.select("a", "b", "part", "na", "nb", _agreeing(F.col("sa"), F.col("sb")).alias("agreeing"))

    def copies(self, rows: DataFrame) -> DataFrame:
        """A row of each leader for each of its parts."""
        every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        return rows.join(self.leaders.select("a", "parts"), "a").select(*rows.columns, every)

    def confirm(self, compared: DataFrame) -> DataFrame:
        """``(a, b)`` of the pairs whose full sets are similar enough."""
        fits = (F.least("na", "nb") * self.den >= F.greatest("na", "nb") * self.num)
        likely = compared.filter((F.col("agreeing") >= self.matches) & fits)
        likely = staged(likely.drop("agreeing"), "likely")
        others = likely.withColumnRenamed("b", "node").withColumn("asks", F.lit(True))
        leaders = likely.groupBy("a", "part").agg(F.first("na").alias("na"))
        leaders = leaders.select(F.col("a").alias("node"), "a", "part", "na", F.col("na").alias("nb"), F.lit(False).alias("asks"))
        wanted = bounded(others.unionByName(leaders), 2 * likely.count())
        # Of a leader's part, its own row comes first.
        own = Window.partitionBy("a", "part").orderBy("asks")
        met = wanted.join(self.sets, "node").withColumn("x", F.first("shingles").over(own))
        common = F.size(F.array_intersect("x", "shingles"))
        union = F.col("na") + F.col("nb") - F.col("common")
        linked = met.filter("asks").select("a", F.col("node").alias("b"), "na", "nb", common.alias("common"))
        linked = linked.filter(F.col("common") * self.den >= union * self.num)
        return staged(linked.select("a", "b"), "near-pairs")

    def across(self, lists: DataFrame, sizes: DataFrame) -> DataFrame:
        """Links ``(a, b)`` between roots of ``lists(token, node, root)``: nodes outside
        the largest component of a list (see ``open_lists``) against all others."""
        total = sizes.agg(F.sum("n")).first()[0] or 0
        blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
        rows = join_uneven(lists, sizes, "token", "n", total).select(
            F.col("token").alias("leader"),
            "node",
            "root",
            (F.col("root") != F.col("head")).alias("outside"),
            blocks("n").alias("blocks"),
            blocks("n_outside").alias("asking"),
        )
        rows = staged(rows, "families")
        own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        x = rows.select(
            "leader", "node", "root", F.lit(False).alias("asks"), own("blocks").alias("i"), every("asking").alias("j")
        )
        y = rows.filter("outside").select(
            "leader", "node", "root", F.lit(True).alias("asks"), every("blocks").alias("i"), own("asking").alias("j")
        )
        n_rows = rows.agg(F.sum(F.col("asking") + F.when(F.col("outside"), F.col("blocks")).otherwise(0))).first()[0]
        blocks = bounded(x.unionByName(y), n_rows or 0).join(self.sets, "node")
        compare = Blocks(self.num, self.den)

        def compare_block(block: pa.Table) -> pa.Table:
            return compare(block)

        found = blocks.groupBy("leader", "i", "j").applyInArrow(compare_block, "a bigint, b bigint")
        return staged(found, "root-pairs")


def link_components(posted: DataFrame, join: Join) -> DataFrame:
    """``(node, root)`` of every node that has a link."""
    leaders = posted.groupBy("token").agg(F.min(F.struct("rank", "node")).alias("first"), F.count(F.lit(1)).alias("n"))
    leaders = staged(leaders.select("token", F.col("first.node").alias("leader"), "n"), "first")
    met = join_uneven(posted, leaders, "token", "n", posted.count())
    met = staged(met.select("leader", "node").distinct(), "met")
    pairs = met.filter("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    roots = staged(components(join.confirm(join.compared(pairs))), "roots")
    placed = met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = staged(placed.withColumnRenamed("leader", "token"), "placed")
    sizes = open_lists(placed)
    found = join.across(placed, sizes.filter(F.col("n_outside") <= BLOCK))
    loose = sizes.filter(F.col("n_outside") > BLOCK)
    total = loose.agg(F.sum("n")).first()[0]
    if total:
        asked = join_uneven(placed, loose, "token", "n", total).select("node", "root").distinct()
        asked = staged(asked, "asked")
        lists = rarest(join.sets.join(asked, "node", "left_semi"), join.num, join.den)
        lists = staged(lists.join(asked, "node"), "lists")
        found = found.unionByName(join.across(lists, open_lists(lists)))
    if found.isEmpty():
        return roots
    stars = roots.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    return staged(components(stars.unionByName(found)), "roots")


def open_lists(lists: DataFrame) -> DataFrame:
    """``(token, n, head, n_outside)`` of the ``lists(token, node, root)`` with several
    components: their size, largest component, and how many nodes are not in it."""
    held = lists.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n"))
    sizes = held.groupBy("token").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("most"), F.count(F.lit(1)).alias("roots")
    )
    outside = (F.col("n") - F.col("most.n")).alias("n_outside")
    sizes = sizes.filter("roots > 1").select("token", "n", F.col("most.root").alias("head"), outside)
    return staged(sizes, "open")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    num: int = 80,
    den: int = 100,
) -> DataFrame:
    """``(doc, text_key, n_shingles, component, component_id)`` per row of ``docs``;
    ``component`` numbers the groups of this run.

    Rows whose sets of ``shingle``-word shingles have a Jaccard similarity of
    ``num / den`` or more are linked; ``component_id`` is the smallest id that can
    be reached, the row's own included. A-Z are lower-cased, words lie between
    ASCII white space.

    A row without words, or with a NULL text, has an empty set and is alone:
    its ``component`` is NULL. NULL ids take part but are never a
    ``component_id`` unless all ids of the component are NULL. Rows that repeat
    an id and a text get equal rows. Extra columns are ignored; an empty table
    gives an empty one.
    """
    matches = least_matches(num / den)
    rows = signed(docs, doc_id, text, shingle)
    nodes = rows.filter("digest is not null").groupBy("digest").agg(
        F.min("doc").alias("first_doc"),
        F.min(F.struct("doc", "text_key")).alias("at"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"),
        F.count(F.lit(1)).alias("copies"),
    )
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    posted = staged(postings(nodes, matches), "postings")

    wanted = nodes.join(posted.select("node").distinct(), "node", "left_semi")
    wanted = staged(wanted.select("node", F.col("at.doc").alias("doc"), F.col("at.text_key").alias("key")), "wanted")
    n_wanted = wanted.count()
    wanted = bounded(wanted, n_wanted).withColumnRenamed("doc", "wanted_doc")
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    texts = texts.join(wanted, (F.col("text_key") == F.col("key")) & F.col("doc").eqNullSafe(F.col("wanted_doc")))
    sets = texts.select("node", "text").mapInArrow(ShingleSets(shingle), "node bigint, shingles array<bigint>")
    sets = staged(sets, "sets")
    if sets.count() > n_wanted:  # an id and a text that repeat
        sets = sets.dropDuplicates(["node"])

    roots = link_components(posted, Join(nodes, sets, matches, num, den))
    placed = nodes.select("node", "digest", "first_doc", "copies").join(roots, "node", "left")
    placed = staged(placed.withColumn("component", F.coalesce("root", "node")), "components")
    smallest = placed.filter("root is not null").groupBy("component").agg(
        F.min("first_doc").alias("component_id"), F.count(F.lit(1)).alias("n")
    )
    smallest = staged(smallest, "smallest")
    total = smallest.agg(F.sum("n")).first()[0] or 0
    columns = ["digest", "component", "component_id", "copies"]
    linked = join_uneven(placed.filter("root is not null"), smallest, "component", "n", total).select(*columns)
    alone = placed.filter("root is null").withColumnRenamed("first_doc", "component_id").select(*columns)
    found = staged(linked.unionByName(alone), "placed-nodes")
    rows = rows.select("doc", "text_key", "digest", "n_shingles")
    n_rows = nodes.agg(F.sum("copies")).first()[0] or 0
    columns = ["doc", "text_key", "n_shingles", "component", "component_id"]
    with_words = join_uneven(rows.filter("digest is not null"), found, "digest", "copies", n_rows).select(*columns)
    no_words = rows.filter("digest is null").withColumn("component", F.lit(None).cast("bigint"))
    return with_words.unionByName(no_words.withColumn("component_id", F.col("doc")).select(*columns))
