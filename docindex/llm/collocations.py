"""Phrases that stand together, counted in depth-truncated suffix subtrees.

1. *Vertical partitioning.* A prefix owns all suffixes that begin with it. One-word
   prefixes are counted; those with more than ``1 / SPLIT`` of the memory budget are
   extended by a word and counted again, up to the depth of the longest phrase.
   What is still too frequent at full depth is a leaf, whose count is known now.
2. *Grouping.* The remaining prefixes fall into so many groups, by hash, that the
   counted load of the largest keeps within the budget.
3. *Subtrees.* Every word position sends its suffix, cut at the longest phrase, to the
   group of its prefix; equal suffixes of a slice travel as one with a count. A group
   sorts its suffixes level by level; the count of a node is the total of its leaves.

Only phrases that are frequent enough leave the groups. They are then scored by joins:
the few parts that many phrases share are broadcast (there are at most ``OFTEN`` for
each length of a part), all others are shared by a bounded share of the phrases.
"""

from __future__ import annotations

import itertools
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docindex.llm.common import BROADCAST_KEYS, VOCABULARY, Batches, Vocabulary, bounded, joined, mix, slices, staged, utf8

SHORTEST, LONGEST, LEAST, TOP = 2, 3, 10, 2000
BUDGET = 1 << 21  # suffixes a group holds at most
SPLIT = 8
OFTEN = 100_000
SALT = 64
CHUNK = 4 << 20  # bytes of text whose suffixes are made at once
NO_LANGUAGE = "und"

# Lower case for A-Z, line feeds for the ends of pieces, spaces for tabs.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else 10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
)
PREFIX = "lang string, prefix string, hash bigint, n bigint"


def _chunks(text: bytes):
    """A text in parts that end at a space."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + CHUNK)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


class Words(Vocabulary):
    """Words as numbers; 0 is the end of a piece and 1 nothing between two spaces."""

    def __init__(self) -> None:
        super().__init__()
        self.numbers([b"\n", b""])
        self._listed = pa.array([b"", b""], pa.binary())

    def trim(self) -> None:
        if len(self) > VOCABULARY:
            self.clear()
            self.__init__()

    def listed(self) -> pa.Array:
        """The word of each number, none for 0."""
        known = len(self._listed)
        if known < len(self):
            new = pa.array(list(itertools.islice(self, known, None)), pa.binary())
            self._listed = pa.concat_arrays([self._listed, new])
        return self._listed


def fold(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of numbers, sorted one column after another, with equal rows as one."""
    if not len(counts):
        return columns, counts
    key, top = columns[0], int(columns[0].max()) + 1
    for column in columns[1:]:
        size = int(column.max()) + 1
        if top * size >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            top = int(key.max()) + 1
        key, top = key * size + column, top * size
    order = np.argsort(key, kind="stable")
    key = key[order]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return [c[order[start]] for c in columns], np.add.reduceat(counts[order], start)


def suffixes_of(texts: list[bytes], words: Words, depth: int):
    """Yields ``(columns, counts)`` for every part of about ``CHUNK`` bytes: the
    numbers of the ``depth`` words of each suffix (0 from the piece's end on)."""
    text = b"\n".join(texts).translate(_PLAIN).replace(b"\n", b" \n ")
    carried = np.zeros(0, np.int64)
    for part in itertools.chain(_chunks(text), [None]):
        if part is None:
            ids, keep = np.concatenate([carried, np.zeros(depth, np.int64)]), len(carried)
        else:
            new = words.numbers(part.split(b" "))
            ids = np.concatenate([carried, new[new != 1]])
            # The last words wait for what follows them.
            keep = max(0, len(ids) - depth + 1)
            carried = ids[keep:]
        first = np.flatnonzero(ids[:keep])
        columns = [ids[first]]
        for d in range(1, depth):
            columns.append(np.where(columns[-1] > 0, ids[first + d], 0))
        if len(first):
            yield fold(columns, np.ones(len(first), np.int64))


def phrases_of(words: pa.Array, columns: list[np.ndarray]) -> pa.Array:
    parts = [words.take(pa.array(c)) for c in columns]
    return parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))


def prefix_hash(lang: str, hashes: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    out = np.full(len(columns[0]), xxhash.xxh64_intdigest(lang.encode()), np.uint64)
    for column in columns:
        out = joined(out, hashes[column])
    return (mix(out) >> np.uint64(1)).astype(np.int64)


class _ByLanguage:
    """Reads batches language by language. ``heavy`` has the heavy prefixes of one,
    two, ... words by language."""

    def __init__(self, depth: int, heavy: list[dict[str, pa.Array]]) -> None:
        self.depth, self.heavy = depth, list(heavy)

    def suffixes(self, batches: Batches, depth: int):
        """Yields ``(language, words, columns, counts)``, suffixes of ``depth`` words."""
        words = Words()
        for batch in (part for whole in batches for part in slices(whole)):
            words.trim()
            found = batch.column("lang").dictionary_encode()
            codes = found.indices.to_numpy(zero_copy_only=False)
            texts = list(utf8(batch.column("text")))
            for code, lang in enumerate(found.dictionary.to_pylist()):
                mine = [texts[i] for i in np.flatnonzero(codes == code).tolist() if texts[i]]
                for columns, counts in suffixes_of(mine, words, depth):
                    yield lang, words, columns, counts

    def is_heavy(self, lang: str, words: Words, columns: list[np.ndarray]) -> np.ndarray:
        """Whether these words of each row are one of the heavy prefixes."""
        known = self.heavy[len(columns) - 1].get(lang)
        if known is None:
            return np.zeros(len(columns[0]), bool)
        return pc.is_in(phrases_of(words.listed(), columns), value_set=known).to_numpy(zero_copy_only=False)


class CountPrefixes(_ByLanguage):
    """``(lang, prefix, hash, n)``: prefixes of one word more than the known heavy
    ones, below those."""

    def __call__(self, batches: Batches) -> Batches:
        length = len(self.heavy) + 1
        for lang, words, columns, counts in self.suffixes(batches, length):
            if length > 1:
                mine = (columns[-1] > 0) & self.is_heavy(lang, words, columns[:-1])
                columns, counts = [c[mine] for c in columns], counts[mine]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(counts), pa.string()),
                    phrases_of(words.listed(), columns).cast(pa.string()),
                    pa.array(prefix_hash(lang, words.hashes(), columns)),
                    pa.array(counts),
                ],
                ["lang", "prefix", "hash", "n"],
            )


class SendSuffixes(_ByLanguage):
    """``(lang, length, group, suffixes, counts)``: the suffixes of a part for each
    group of prefixes of ``length`` words, one in a line."""

    def __init__(self, depth: int, heavy: list[dict[str, pa.Array]], groups: int) -> None:
        super().__init__(depth, heavy)
        self.groups = groups

    def _places(self, lang: str, words: Words, columns: list[np.ndarray]) -> np.ndarray:
        """``length * groups + group`` of each suffix; -1: already counted."""
        place = np.full(len(columns[0]), -1)
        rest = np.arange(len(place))
        for length in range(1, self.depth + 1):
            prefix = [c[rest] for c in columns[:length]]
            heavy = self.is_heavy(lang, words, prefix)
            light = [c[~heavy] for c in prefix]
            place[rest[~heavy]] = length * self.groups + prefix_hash(lang, words.hashes(), light) % self.groups
            rest = rest[heavy]
            if length < self.depth:
                # A heavy prefix that ends its piece has no longer ones.
                rest = rest[columns[length][rest] > 0]
            if not len(rest):
                break
        return place

    def __call__(self, batches: Batches) -> Batches:
        for lang, words, columns, counts in self.suffixes(batches, self.depth):
            place = self._places(lang, words, columns)
            order = np.argsort(place, kind="stable")
            order = order[np.searchsorted(place[order], 0) :]
            place = place[order]
            start = np.flatnonzero(np.diff(place, prepend=-1))
            offsets = np.append(start, len(order)).astype(np.int32)
            lines = phrases_of(words.listed(), [c[order] for c in columns])
            packed = pa.py_buffer(counts[order].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(start), pa.string()),
                    pa.array(place[start] // self.groups, pa.int32()),
                    pa.array(place[start] % self.groups),
                    pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines), pa.scalar(b"\n", pa.binary())),
                    pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(4 * offsets), packed]),
                ],
                ["lang", "length", "group", "suffixes", "counts"],
            )


def subtrees(table: pa.Table, depth: int, least: int) -> pa.Table:
    """The suffixes of a group as trees cut at ``depth``: the phrases of all nodes that
    occur ``least`` times, from the group's prefixes down."""
    lang, length = table.column("lang")[0].as_py(), table.column("length")[0].as_py()
    lines = pc.list_flatten(pc.split_pattern(table.column("suffixes").combine_chunks(), b"\n"))
    words = pc.list_flatten(pc.split_pattern(lines, b" ")).dictionary_encode()
    ids = words.indices.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, depth)
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<u4").astype(np.int64)
    columns, leaves = fold(list(ids.T), counts)
    end = pc.index(words.dictionary, pa.scalar(b"", pa.binary())).as_py()
    phrases, sizes, totals = [], [], []
    new = np.zeros(len(leaves), bool)
    new[0] = True
    for size in range(1, depth + 1):
        # A node begins where its own word or one before it changes; its total is
        # that of its leaves.
        new[1:] |= columns[size - 1][1:] != columns[size - 1][:-1]
        if size < length:
            continue
        start = np.flatnonzero(new)
        total = np.add.reduceat(leaves, start)
        often = (total >= least) & (columns[size - 1][start] != end)
        start = start[often]
        phrases.append(phrases_of(words.dictionary, [c[start] for c in columns[:size]]).cast(pa.string()))
        sizes.append(np.full(len(start), size, np.int32))
        totals.append(total[often])
    n = sum(map(len, sizes))
    return pa.table(
        {
            "lang": pa.array([lang] * n, pa.string()),
            "phrase": pa.concat_arrays(phrases),
            "size": pa.array(np.concatenate(sizes)),
            "f": pa.array(np.concatenate(totals)),
        }
    )


def phrase_counts(texts: DataFrame, depth: int, least: int, budget: int) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, size, f)`` of all phrases of 1 to ``depth`` words that occur
    ``least`` times or more, and ``(lang, n)``, for ``texts(lang, text)``."""
    heavy: list[dict[str, pa.Array]] = []
    leaves: list[DataFrame] = []  # heavy prefixes: their counts are known
    owners: list[DataFrame] = []  # light prefixes: they own suffixes
    totals = None
    for length in range(1, depth + 1):
        found = texts.mapInArrow(CountPrefixes(depth, heavy), PREFIX)
        found = found.groupBy("lang", "prefix", "hash").agg(F.sum("n").alias("n"))
        found = staged(found.withColumn("length", F.lit(length)), "prefixes")
        if totals is None:
            totals = staged(found.groupBy("lang").agg(F.sum("n").alias("n")), "words")
        # Heavy prefixes are listed in every task: the budget grows before the list.
        while found.filter(F.col("n") > budget // SPLIT).count() > BROADCAST_KEYS:
            budget *= 2
        split = F.col("n") > budget // SPLIT
        owners.append(found.filter(~split))
        leaves.append(found.filter(split).select("lang", F.col("prefix").alias("phrase"), F.col("length").alias("size"), F.col("n").alias("f")))
        listed = leaves[-1].select("lang", "phrase").toPandas().groupby("lang")["phrase"]
        heavy.append({lang: pa.array([p.encode() for p in phrases], pa.binary()) for lang, phrases in listed})
        if not heavy[-1]:
            break
    heavy += [{}] * (depth - len(heavy))
    owned = reduce(DataFrame.unionByName, owners)
    groups = max(1, -(-4 * (owned.agg(F.sum("n")).first()[0] or 0) // budget))
    while True:
        load = owned.groupBy("length", F.col("hash") % groups).agg(F.sum("n").alias("n"))
        if (load.agg(F.max("n")).first()[0] or 0) <= budget:
            break
        groups *= 2
    schema = "lang string, length int, group bigint, suffixes binary, counts binary"
    sent = texts.mapInArrow(SendSuffixes(depth, heavy, groups), schema)

    def build(table: pa.Table) -> pa.Table:
        return subtrees(table, depth, least)

    nodes = sent.groupBy("lang", "length", "group").applyInArrow(build, "lang string, phrase string, size int, f bigint")
    known = reduce(DataFrame.unionByName, leaves).filter(F.col("f") >= least)
    return staged(nodes.unionByName(known), "phrases"), totals


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    shortest: int = SHORTEST,
    longest: int = LONGEST,
    least: int = LEAST,
    inside: int = 50,
    budget: int = BUDGET,
) -> DataFrame:
    """``(lang, phrase, words, a, k, l, r, n, score)``: the phrases of ``shortest`` to
    ``longest`` words that occur ``least`` times in a language.

    A-Z count as lower case; ``.,;:!?`` and line ends part pieces, spaces and tabs
    words. ``a`` counts all contiguous occurrences within pieces. Of all cuts in two
    parts with counts ``l`` and ``r`` the one with the lowest ``score``, floor(1000000
    * a * a / (l * r)), counts, the earliest of equal ones, after ``k`` words. ``n`` is
    the number of words of the language. A phrase goes if a longer candidate that
    holds it occurs at least ``inside`` percent as often.

    NULL and empty texts have no words; a NULL language is ``und``, like a language of
    that name; repeated rows count as often as they occur; extra columns are ignored;
    an empty table gives an empty one.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).alias("text"))
    counts, totals = phrase_counts(texts, longest, least, budget)
    candidates = counts.filter(F.col("size") >= shortest).select("lang", "phrase", "size", F.col("f").alias("a"))
    words = F.split("phrase", " ")
    cuts = candidates.select(
        "lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select(
        "*",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    cuts = _looked_up(_looked_up(cuts, counts, totals, "left", "l"), counts, totals, "right", "r")
    wide = lambda name: F.col(name).cast("decimal(38,0)")
    cuts = cuts.withColumn("product", wide("a") * wide("a") * F.lit(1_000_000).cast("decimal(38,0)"))
    cuts = cuts.withColumn("parts", wide("l") * wide("r")).withColumn("score", F.expr("product div parts"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    scored = cuts.groupBy("lang", "phrase").agg(F.first("size").alias("words"), F.first("a").alias("a"), best)
    part = candidates.filter(F.col("size") > shortest).select(
        "lang", "a", "size", words.alias("words"), F.explode(F.sequence(F.lit(shortest), F.col("size") - 1)).alias("m")
    ).select("lang", "a", "words", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("at"))
    part = part.select("lang", F.array_join(F.slice("words", F.col("at"), F.col("m")), " ").alias("phrase"), "a")
    holders = part.groupBy("lang", "phrase").agg(F.max("a").alias("holder"))
    left = scored.join(holders, ["lang", "phrase"], "left").filter(
        F.col("holder").isNull() | (100 * F.col("holder") < inside * F.col("a"))
    )
    return left.join(bounded(totals, totals.count()), "lang").select(
        "lang", "phrase", "words", "a", F.col("best.k").alias("k"), F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n",
        F.col("best.score").alias("score"),
    )


def _looked_up(cuts: DataFrame, counts: DataFrame, totals: DataFrame, part: str, name: str) -> DataFrame:
    """Add the count of a part. A part occurs at least as often as the phrases that
    share it together, over the least count of a phrase; so only parts with a share
    of ``1 / OFTEN`` of all words can be hot, and those are broadcast."""
    share = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // OFTEN
    keys = counts.select(F.col("lang").alias("key_lang"), F.col("phrase").alias("key"), F.col("f").alias(name))
    same = (F.col("lang") == F.col("key_lang")) & (F.col(part) == F.col("key"))
    with_often = staged(cuts.join(F.broadcast(keys.filter(F.col(name) > share)), same, "left").drop("key_lang", "key"), "cuts")
    often = with_often.filter(F.col(name).isNotNull())
    rare = with_often.filter(F.col(name).isNull()).drop(name)
    rare = rare.join(keys.filter(F.col(name) <= share), same).drop("key_lang", "key")
    return often.unionByName(rare)


def top_collocations(phrases: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language by score, then count (both falling),
    then the phrase's bytes, with their ``rank`` from 1. Parts of a language are cut to
    ``top`` first, so that no task ranks a whole language."""
    by = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALT))
    part = phrases.withColumn("rank", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*by)))
    ranked = part.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by)))
    return ranked.filter(F.col("rank") <= top)
