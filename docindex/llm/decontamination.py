"""Benchmark passages in documents, by suffix arrays of the documents.

A shard is a slice of documents that a task holds anyway. Its words become numbers,
its word positions one suffix array (prefix doubling on the still unresolved part).
Every suffix of the benchmark is then searched in it, all of them at once: a binary
search narrows each suffix's interval word by word until the interval is empty, which
gives its longest verbatim match and all places of it.

Words the benchmark does not have cannot be part of a match, so they and the ends of
documents are one separator, and suffixes that begin there are left out of the array.

Documents are never exchanged. The benchmark is sent to the tasks in blocks of a
bounded number of bytes; with more than one block, the blocks' few hits are united
per document afterwards.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docindex.llm.common import Batches, slices, staged, text_key, utf8

WINDOW = 10
BLOCK_BYTES = 32 << 20  # benchmark text that is broadcast at a time

# Lower case for A-Z; everything but letters, digits and non-ASCII is a space.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_PLAIN).split() if text else []


class Benchmark:
    """A block of the benchmark: one sequence of word numbers with a 0 after each
    item, and for every suffix its item, its length and the window it stands for."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        number: dict[bytes, int] = {}
        sequence, item, left = [], [], []
        names = sorted({name for name, _ in items})
        place = {name: i for i, name in enumerate(names)}
        for name, text in items:
            own = [number.setdefault(w, len(number) + 1) for w in words(text.encode())]
            if own:
                sequence += [*own, 0]
                item += [place[name]] * (len(own) + 1)
                left += [*range(len(own), 0, -1), 0]
        self.number, self.names, self.size = number, names, window
        self.sequence = np.array(sequence, np.int64)
        self.item, self.left = np.array(item, np.int64), np.array(left, np.int64)
        first = np.ones(len(sequence), bool)
        first[1:] = self.left[:-1] == 0
        # Suffixes with a whole window; those of shorter items only from their start.
        self.need = np.where(self.left >= window, window, np.where(first, self.left, 0))

    def longest(self) -> int:
        return int(self.left.max(initial=0))


def suffix_array(sequence: np.ndarray, depth: int) -> np.ndarray:
    """Positions with a number above 0, sorted by the numbers that follow, up to the
    next 0, at least ``depth`` deep."""
    order = np.flatnonzero(sequence)
    order = order[np.argsort(sequence[order], kind="stable")]
    rank = np.zeros(len(sequence) + 1, np.int64)
    slots, value, size = np.arange(len(order)), sequence[order], 1
    key = value
    while len(slots):
        # Equal keys share the number of their first slot, from 1 on.
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        group = np.maximum.accumulate(np.where(new, slots, 0))
        rank[order[slots]] = group + 1
        alone = new & np.append(new[1:], True)
        if size >= depth:
            break
        slots = slots[~alone]
        at = order[slots]
        key = rank[at] * (len(order) + 2) + rank[np.minimum(at + size, len(sequence))]
        by = np.argsort(key, kind="stable")
        order[slots], key = at[by], key[by]
        size *= 2
    return order


def _bound(column: np.ndarray, order: np.ndarray, depth: int, low, high, value, right: bool) -> np.ndarray:
    """For each interval of slots, the first whose word at ``depth`` is not below
    ``value`` (``right``: above it)."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        word = column[order[middle] + depth]
        below = word <= value[open_] if right else word < value[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]


class Shard:
    """Documents as one sequence, and its suffix array."""

    def __init__(self, texts: list[bytes | None], bench: Benchmark, depth: int) -> None:
        own = [words(t) for t in texts]
        self.n_words = np.array([len(w) for w in own], np.int64)
        flat = map(bench.number.get, itertools.chain.from_iterable(own), itertools.repeat(0))
        numbers = np.fromiter(flat, np.int64, int(self.n_words.sum()))
        self.first = np.concatenate([[0], np.cumsum(self.n_words + 1)])[:-1]
        # A 0 after every document, and enough of them after the last.
        self.sequence = np.zeros(len(numbers) + len(own) + depth + 2, np.int64)
        self.owner = np.repeat(np.arange(len(own)), self.n_words)
        self.sequence[np.arange(len(numbers)) + self.owner] = numbers
        self.order = suffix_array(self.sequence, depth)

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, positions, "right") - 1

    def search(self, bench: Benchmark, depth: int):
        """Yields ``(depth, suffixes, low, high)``: the suffixes of the benchmark that
        match so many words, and the interval of slots where they do."""
        suffix = np.flatnonzero(bench.left)
        low = np.zeros(len(suffix), np.int64)
        high = np.full(len(suffix), len(self.order))
        for d in range(depth):
            word = bench.sequence[suffix + d]
            low, high = (
                _bound(self.sequence, self.order, d, low, high, word, right=False),
                _bound(self.sequence, self.order, d, low, high, word, right=True),
            )
            found = (low < high) & (word > 0)
            suffix, low, high = suffix[found], low[found], high[found]
            if not len(suffix):
                return
            yield d + 1, suffix, low, high

    def places(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in all intervals, and the interval of each."""
        sizes = high - low
        interval = np.repeat(np.arange(len(low)), sizes)
        at = np.arange(len(interval)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[interval]
        return self.order[at], interval


class FindItems:
    """Per document: words, hit spans, items of the block; only documents that are
    hit, unless ``all_rows``."""

    def __init__(self, bench, all_rows: bool) -> None:
        self.bench, self.all_rows = bench, all_rows

    def hits(self, texts: list[bytes | None], bench: Benchmark):
        """``n_words``, hit flags of the sequence, and sorted (document, item) pairs."""
        depth = int(bench.need.max(initial=0))
        shard = Shard(texts, bench, depth)
        hit = np.zeros(len(shard.sequence) + 1, np.int64)
        pairs = [np.zeros((0, 2), np.int64)]
        for d, suffix, low, high in shard.search(bench, depth):
            whole = bench.need[suffix] == d
            if not whole.any():
                continue
            suffix = suffix[whole]
            # Equal windows have equal intervals: their places are listed once.
            spans, window = np.unique(np.stack([low[whole], high[whole]], 1), axis=0, return_inverse=True)
            at, interval = shard.places(spans[:, 0], spans[:, 1])
            hit += np.bincount(at, minlength=len(hit)) - np.bincount(at + d, minlength=len(hit))
            key = np.unique(interval * len(texts) + shard.document(at))
            met = np.stack([key // len(texts), key % len(texts)], 1)
            asked = np.unique(np.stack([window.ravel(), bench.item[suffix]], 1), axis=0)
            pairs.append(_expand(met, asked))
        pairs = np.unique(np.concatenate(pairs), axis=0)
        return shard, np.cumsum(hit)[:-1] > 0, pairs

    def __call__(self, batches: Batches) -> Batches:
        bench = self.bench.value
        names = np.array(bench.names, object)
        for batch in (part for whole in batches for part in slices(whole)):
            shard, hit, pairs = self.hits(list(utf8(batch.column("text"))), bench)
            edges = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
            start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            owner = shard.document(start)
            rows = np.arange(batch.num_rows + 1)
            spans = pa.StructArray.from_arrays(
                [pa.array(start - shard.first[owner]), pa.array(end - shard.first[owner])], ["start", "end"]
            )
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("text_key"),
                    pa.array(shard.n_words),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, rows), pa.int32()), spans),
                    pa.ListArray.from_arrays(
                        pa.array(np.searchsorted(pairs[:, 0], rows), pa.int32()), pa.array(names[pairs[:, 1]], pa.string())
                    ),
                ],
                ["doc", "text_key", "n_words", "spans", "items"],
            )
            if not self.all_rows:
                out = out.take(pa.array(np.unique(owner)))
            yield out


def _expand(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Join ``(key, x)`` with ``(key, y)``, both sorted by key, to ``(x, y)``."""
    low, high = np.searchsorted(right[:, 0], left[:, 0], "left"), np.searchsorted(right[:, 0], left[:, 0], "right")
    sizes = high - low
    row = np.repeat(np.arange(len(left)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[row]
    return np.stack([left[row, 1], right[at, 1]], 1)


class LongestMatches:
    """Per suffix of the benchmark its longest match within the task, and where."""

    def __init__(self, bench, least: int) -> None:
        self.bench, self.least = bench, least

    def __call__(self, batches: Batches) -> Batches:
        bench = self.bench.value
        first = np.ones(len(bench.left), bool)
        first[1:] = bench.left[:-1] == 0
        word = np.arange(len(first)) - np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        for batch in (part for whole in batches for part in slices(whole)):
            shard = Shard(list(utf8(batch.column("text"))), bench, bench.longest())
            length = np.zeros(len(bench.left), np.int64)
            slot = np.zeros(len(bench.left), np.int64)
            for d, suffix, low, _ in shard.search(bench, bench.longest()):
                length[suffix], slot[suffix] = d, low
            found = np.flatnonzero(length >= np.maximum(np.minimum(self.least, bench.need), 1))
            at = shard.order[slot[found]]
            owner = shard.document(at)
            docs = batch.select(["doc", "text_key"]).take(pa.array(owner))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(bench.names, object)[bench.item[found]], pa.string()),
                    pa.array(word[found]),
                    pa.array(length[found]),
                    docs.column("doc"),
                    docs.column("text_key"),
                    pa.array(at - shard.first[owner]),
                ],
                ["item", "item_start", "length", "doc", "text_key", "doc_start"],
            )


class KeepClean:
    """Whole rows of documents without a hit in the block."""

    def __init__(self, bench) -> None:
        self.find = FindItems(bench, True)

    def __call__(self, batches: Batches) -> Batches:
        bench = self.find.bench.value
        for batch in (part for whole in batches for part in slices(whole)):
            shard, hit, _ = self.find.hits(list(utf8(batch.column("text"))), bench)
            clean = np.ones(batch.num_rows, bool)
            clean[shard.document(np.flatnonzero(hit))] = False
            yield batch.filter(pa.array(clean))


def blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_bytes: int):
    """The benchmark's texts in blocks of about ``block_bytes``, broadcast one by one.
    Items of one id stay together."""
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text")
    ).filter("text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    number = max(1, -(-size // block_bytes))
    spark = benchmark.sparkSession
    for i in range(number):
        mine = items.filter(F.pmod(F.xxhash64("item"), F.lit(number)) == i) if number > 1 else items
        yield number, spark.sparkContext.broadcast(Benchmark([(r.item, r.text) for r in mine.collect()], window))


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("text")
    )


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(doc, text_key, n_words, spans, items)``, one row per row of ``docs``.

    Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case.
    ``spans`` are the words ``[start, end)`` covered by ``window`` consecutive words of
    an item, ``items`` the ids (as strings, sorted) of the items with such words. An
    item of fewer words is one window; NULL, empty or wordless texts have none on
    either side. Rows of ``benchmark`` that share an id are one item, NULL ids are the
    item ``""``. Repeated rows of ``docs`` are judged alike; extra columns are ignored;
    an empty ``docs`` gives an empty table, an empty ``benchmark`` rows without hits.
    """
    texts = _texts(docs, doc_id, text)
    kind = texts.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, text_key bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"
    found = [
        (number, texts.mapInArrow(FindItems(block, number == 1 or i == 0), schema))
        for i, (number, block) in enumerate(blocks(benchmark, item_id, item_text, window, block_bytes))
    ]
    if len(found) == 1:
        return found[0][1]
    # Block 0 lists every document; the others add the few they hit.
    first = found[0][1]
    more = [staged(f, "hits") for _, f in found[1:]]
    united = more[0]
    for m in more[1:]:
        united = united.unionByName(m)
    united = united.dropDuplicates()  # of repeated rows
    keys = F.col("doc").alias("hit_doc"), F.col("text_key").alias("hit_key")
    grouped = united.groupBy(*keys).agg(
        F.flatten(F.collect_list("spans")).alias("more_spans"), F.flatten(F.collect_list("items")).alias("more_items")
    )
    same = F.col("doc").eqNullSafe(F.col("hit_doc")) & F.col("text_key").eqNullSafe(F.col("hit_key"))
    both = first.join(grouped, same, "left")
    return both.select(
        "doc",
        "text_key",
        "n_words",
        F.when(F.col("more_spans").isNull(), F.col("spans")).otherwise(merged(F.concat("spans", "more_spans"))).alias("spans"),
        F.when(F.col("more_items").isNull(), F.col("items"))
        .otherwise(F.array_sort(F.array_distinct(F.concat("items", "more_items"))))
        .alias("items"),
    )


def merged(spans: Column) -> Column:
    """Spans that overlap or touch as one."""
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        apart = (F.size(done) == 0) | (F.try_element_at(done, F.lit(-1))["end"] < span["start"])
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(apart, F.concat(done, F.array(span))).otherwise(
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))
        )

    return F.aggregate(F.array_sort(spans), none, add)


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def longest_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(item, item_start, length, doc, text_key, doc_start)``: for every suffix of an
    item its longest verbatim match in ``docs``, in words, of at least ``window`` words
    (the whole item, if shorter), and one place of it.
    Suffixes without such a match have no row; see :func:`benchmark_hits` for the rest.
    """
    texts = _texts(docs, doc_id, text)
    kind = texts.schema["doc"].dataType.simpleString()
    schema = f"item string, item_start bigint, length bigint, doc {kind}, text_key bigint, doc_start bigint"
    every = None
    for _, block in blocks(benchmark, item_id, item_text, window, block_bytes):
        found = texts.mapInArrow(LongestMatches(block, window), schema)
        every = found if every is None else every.unionByName(found)
    best = F.min(F.struct((-F.col("length")).alias("less"), "doc", "text_key", "doc_start")).alias("best")
    return every.groupBy("item", "item_start").agg(best).select(
        "item",
        "item_start",
        (-F.col("best.less")).alias("length"),
        F.col("best.doc").alias("doc"),
        F.col("best.text_key").alias("text_key"),
        F.col("best.doc_start").alias("doc_start"),
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no window of the benchmark. Rows
    are never exchanged; with several blocks of benchmark, each block's survivors are
    written and read by the next."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    place = docs.columns.index(text)
    names[place] = "text"
    left = docs.toDF(*names)
    for number, block in blocks(benchmark, item_id, item_text, window, block_bytes):
        left = left.mapInArrow(KeepClean(block), left.schema)
        if number > 1:
            left = staged(left, "clean")
    return left.toDF(*docs.columns)
