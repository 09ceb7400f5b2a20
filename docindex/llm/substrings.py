"""Repeated passages of words, found by super-k-mer partitioning.

A *window* is ``size`` consecutive words. Its minimiser is the smallest hash of
its ``ANCHOR``-word sequences; consecutive windows mostly share one, and such a
run (a super-k-mer) travels as one packed string to the minimiser's bucket, where
sorting brings equal windows together. Hashes only arrange the sort: windows of
one hash are compared word by word. Words are hashed where they lie in the text, all
at once; only those of compared windows become objects of their own.

* Of the equal windows in a slice of a task's rows only the first is shipped; the
  task knows by itself that the others are repeats.
* A minimiser that anchors very many windows (a frequent phrase, or a passage that a
  third of all rows share) would still fill one bucket. A first pass counts
  minimisers: each task keeps the frequent ones of all its rows, so that a count is
  short by three ``COUNTED``-ths of all super-k-mers at most, or by less than
  ``REPORTED`` for each task. Windows of those above
  ``HOT`` travel singly, spread by the hash of the whole window, and the task
  remembers them: a later slice ships one again only if it starts earlier than the
  one that was shipped. There are at most ``HOT_SHARE`` such minimisers, so their
  list has a fixed bound.
* The number of buckets follows the counted words, so a bucket fits in memory.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docindex.llm.common import (
    Batches,
    Vocabulary,
    joined,
    mix,
    sequence_hashes,
    slices,
    sliding_min,
    staged,
    text_key,
    utf8,
)

ANCHOR = 3
BUCKET_WORDS = 1_000_000
# A minimiser is hot above HOT super-k-mers and above one HOT_SHARE-th of all.
HOT = 20_000
HOT_SHARE = 50_000
# Minimisers whose counts a task keeps, and the share of its super-k-mers (one
# COUNTED-th, REPORTED at least) below which it does not report one.
COUNTED = 200_000
REPORTED = 4
# Windows of hot minimisers that a task remembers; above it, it forgets them all.
REMEMBERED = 200_000

# Longer words, in bytes, are hashed one by one.
LONG = 64
# Words that are hashed at a time, and how hard packed strings are compressed.
AT_ONCE = 1 << 15
LEVEL = 5

# Stands for a NULL id, which comes before all others.
NO_ID = np.iinfo(np.int64).min

_RUN = np.dtype([("doc", "<i8"), ("key", "<i8"), ("start", "<i4"), ("words", "<i4")])
_SEPARATORS = re.compile(rb"([\x20\x09-\x0D]+)")
# The first 0 to 8 bytes of a little-endian number.
_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class Words:
    """The words of texts, in their order, as places in one string of bytes."""

    def __init__(self, texts: list[bytes | None]) -> None:
        # Eight spaces end the last word, and eight bytes can be read at any place.
        self.data = b"\n".join([*(t or b"" for t in texts), b" " * 8])
        byte = np.frombuffer(self.data, np.uint8)
        space = (byte == 32) | (byte - np.uint8(9) < 5)
        edges = np.flatnonzero(np.concatenate([~space[:1], space[1:] != space[:-1]]))
        self.begin, self.end = edges[::2], edges[1::2]

    def counts(self, texts: list[bytes | None]) -> np.ndarray:
        """The number of words of each text."""
        ends = np.cumsum([len(t or b"") + 1 for t in texts], dtype=np.int64)
        return np.diff(np.searchsorted(self.begin, ends), prepend=0)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, from eight bytes at a time."""
        eight = np.ndarray(len(self.data) - 7, "<u8", self.data, strides=1)
        out = np.empty(len(self.begin), np.uint64)
        for lo in range(0, len(out), AT_ONCE):
            begin, end = self.begin[lo : lo + AT_ONCE], self.end[lo : lo + AT_ONCE]
            left = end - begin
            part = joined(left.astype(np.uint64), eight[begin] & _BYTES[np.minimum(left, 8)])
            more = np.flatnonzero(left > 8)
            for at in range(8, LONG, 8):
                more = more[left[more] > at]
                part[more] = joined(part[more], eight[begin[more] + at] & _BYTES[np.minimum(left[more] - at, 8)])
            for i in more[left[more] > LONG].tolist():
                part[i] = xxhash.xxh64_intdigest(self.data[begin[i] : end[i]])
            out[lo : lo + AT_ONCE] = mix(part)
        return out

    def numbers(self, at: np.ndarray, size: int, vocabulary: Vocabulary) -> np.ndarray:
        """Equal numbers for equal words, of the ``size`` words from each of ``at`` on;
        0 for all others."""
        depth = np.zeros(len(self.begin) + 1, np.int32)
        starts = np.unique(at)
        depth[starts] += 1
        depth[starts + size] -= 1
        met = np.flatnonzero(np.cumsum(depth[:-1]))
        out = np.zeros(len(self.begin), np.int64)
        for lo in range(0, len(met), AT_ONCE):
            part = met[lo : lo + AT_ONCE]
            ends = zip(self.begin[part].tolist(), self.end[part].tolist())
            out[part] = vocabulary.numbers([self.data[i:j] for i, j in ends])
        return out


class _Windows:
    """The windows of a batch of documents, in order of (id, text key, start)."""

    def __init__(self, batch: pa.RecordBatch, size: int, vocabulary: Vocabulary) -> None:
        docs = batch.column("doc").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
        keys = batch.column("text_key").to_numpy(zero_copy_only=False)
        order = np.lexsort((keys, docs))
        texts = list(utf8(batch.column("text")))
        texts = [texts[i] for i in order.tolist()]
        self.size = size
        self.docs = docs[order]
        self.keys = keys[order]
        self.words = Words(texts)
        self.vocabulary = vocabulary
        lengths = self.words.counts(texts)
        hashes = self.words.hashes()
        self.first = np.cumsum(lengths) - lengths  # word of each row
        counts = np.maximum(lengths - size + 1, 0)
        row = np.repeat(np.arange(len(lengths)), counts)
        before = np.cumsum(counts) - counts
        # Positions of the windows among all words.
        self.at = np.arange(len(row)) - before[row] + self.first[row]
        self.window_row = row
        self.anchors = sliding_min(sequence_hashes(hashes, ANCHOR), size - ANCHOR + 1)[self.at]
        self._hashes = hashes

    def hashes(self) -> np.ndarray:
        return sequence_hashes(self._hashes, self.size)[self.at]

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether windows ``a`` have the words of windows ``b``."""
        a, b = self.at[a], self.at[b]
        numbers = self.words.numbers(np.concatenate([a, b]), self.size, self.vocabulary)
        same = np.ones(len(a), bool)
        for i in range(self.size):
            same &= numbers[a + i] == numbers[b + i]
        return same


def _starts(*changed: np.ndarray) -> np.ndarray:
    """Where runs begin: at 0 and wherever one of ``changed`` holds."""
    begin = np.logical_or.reduce(changed)
    return np.flatnonzero(np.concatenate([[True], begin]))


class Frequent:
    """Counts of the frequent of many values, in bounded memory: above ``limit``
    values, all counts fall by what leaves half of them above 0. A count is short by
    at most two ``limit``-ths of all that was added."""

    def __init__(self, limit: int) -> None:
        self.limit, self.total = limit, 0
        self.values, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        self.total += int(counts.sum())
        both, at = np.unique(np.concatenate([self.values, values]), return_inverse=True)
        sums = np.bincount(at, np.concatenate([self.counts, counts]), len(both)).astype(np.int64)
        if len(both) > self.limit:
            sums -= np.partition(sums, len(sums) - self.limit // 2 - 1)[len(sums) - self.limit // 2 - 1]
            both, sums = both[sums > 0], sums[sums > 0]
        self.values, self.counts = both, sums


class AnchorCounts:
    """Super-k-mers per minimiser, as far as a task has many of one; NULL: all."""

    def __init__(self, size: int) -> None:
        self.size = size

    def __call__(self, batches: Batches) -> Batches:
        vocabulary, frequent = Vocabulary(), Frequent(COUNTED)
        for batch in (part for whole in batches for part in slices(whole)):
            w = _Windows(batch, self.size, vocabulary)
            if not len(w.at):
                continue
            runs = _starts(np.diff(w.at) != 1, np.diff(w.anchors) != 0)
            frequent.add(*np.unique(w.anchors[runs], return_counts=True))
        often = (frequent.counts * COUNTED > frequent.total) & (frequent.counts >= REPORTED)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, *frequent.values[often].view(np.int64).tolist()], pa.int64()),
                pa.array([frequent.total, *frequent.counts[often].tolist()], pa.int64()),
            ],
            ["anchor", "n"],
        )


def _pack(runs: np.ndarray, texts: list[bytes]) -> bytes:
    head = np.int64(len(runs)).tobytes()
    return zstandard.compress(head + runs.tobytes() + b"\n".join(texts), LEVEL)


def _unpack(blob: bytes) -> tuple[np.ndarray, bytes]:
    raw = zstandard.decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    end = 8 + n * _RUN.itemsize
    return np.frombuffer(raw, _RUN, n, 8), raw[end:]


class Ship:
    """Documents to packed super-k-mers, one row per bucket and batch; rows that
    are ``known`` hold word ranges already found to be repeats."""

    def __init__(self, size: int, buckets: int, hot: np.ndarray) -> None:
        self.size, self.buckets, self.hot = size, buckets, hot

    def __call__(self, batches: Batches) -> Batches:
        vocabulary = Vocabulary()
        shipped: dict[bytes, tuple[int, int, int]] = {}  # hot windows and their starts
        for batch in (part for whole in batches for part in slices(whole)):
            w = _Windows(batch, self.size, vocabulary)
            if len(w.at):
                yield self._shipped(w, shipped)
            vocabulary.trim()
            if len(shipped) > REMEMBERED:
                shipped.clear()

    def _shipped(self, w: _Windows, shipped: dict[bytes, tuple[int, int, int]]) -> pa.RecordBatch:
        hashes = w.hashes()
        order = np.argsort(hashes)
        begin = _starts(np.diff(hashes[order]) != 0)
        head = np.minimum.reduceat(order, begin)  # first window of the same hash
        head = np.repeat(head, np.diff(np.append(begin, len(order))))
        later = np.flatnonzero(order != head)
        a, b = order[later], head[later]
        same = w.equal(a, b)
        start = w.at - w.first[w.window_row]
        one, other = w.window_row[a], w.window_row[b]
        tied = (w.docs[one] == w.docs[other]) & (w.keys[one] == w.keys[other]) & (start[a] == start[b])
        repeats = a[same & ~tied]

        sent = np.ones(len(w.at), bool)
        sent[repeats] = False
        is_hot = np.isin(w.anchors, self.hot)
        again = []
        for i in np.flatnonzero(sent & is_hot).tolist():
            row = w.window_row[i]
            mine = (int(w.docs[row]), int(w.keys[row]), int(start[i]))
            text = w.words.data[w.words.begin[w.at[i]] : w.words.end[w.at[i] + self.size - 1]]
            words = b" ".join(text.split())
            if shipped.setdefault(words, mine) < mine:
                again.append(i)
            else:
                shipped[words] = mine
        sent[again] = False
        repeats = np.concatenate([repeats, np.array(again, np.int64)])
        sent = np.flatnonzero(sent)
        at, anchors, hot = w.at[sent], w.anchors[sent], is_hot[sent]
        runs = _starts(np.diff(at) != 1, np.diff(anchors) != 0, hot[1:]) if len(sent) else sent
        length = np.diff(np.append(runs, len(sent))) + self.size - 1
        target = np.where(hot[runs], hashes[sent[runs]], mix(anchors[runs])) % np.uint64(self.buckets)
        by_bucket = np.argsort(target, kind="stable")
        runs, length, target = runs[by_bucket], length[by_bucket], target[by_bucket]
        row = w.window_row[sent[runs]]
        table = np.empty(len(runs), _RUN)
        table["doc"], table["key"] = w.docs[row], w.keys[row]
        table["start"], table["words"] = start[sent[runs]], length

        buckets, blobs = [], []
        edges = np.append(_starts(np.diff(target) != 0), len(runs)) if len(runs) else np.zeros(1, np.int64)
        data = w.words.data
        begin, end = w.words.begin[at[runs]].tolist(), w.words.end[at[runs] + length - 1].tolist()
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            texts = [data[i:j] for i, j in zip(begin[lo:hi], end[lo:hi])]
            buckets.append(int(target[lo]))
            blobs.append(_pack(table[lo:hi], texts))
        known = [False] * len(blobs)
        if len(repeats):
            repeats.sort()
            lo = _starts(np.diff(w.at[repeats]) != 1)
            words = np.diff(np.append(lo, len(repeats))) + self.size - 1
            row = w.window_row[repeats[lo]]
            table = np.empty(len(lo), _RUN)
            table["doc"], table["key"] = w.docs[row], w.keys[row]
            table["start"], table["words"] = start[repeats[lo]], words
            buckets.append(int(hashes[0] % np.uint64(self.buckets)))
            blobs.append(_pack(table, []))
            known.append(True)
        return pa.RecordBatch.from_arrays(
            [pa.array(buckets, pa.int32()), pa.array(known, pa.bool_()), pa.array(blobs, pa.binary())],
            ["bucket", "known", "blob"],
        )


def _ranges(found: np.ndarray) -> pa.Table:
    return pa.table(
        {
            "doc": pa.array(found["doc"], pa.int64()),
            "key": pa.array(found["key"], pa.int64()),
            "start": pa.array(found["start"], pa.int32()),
            "words": pa.array(found["words"], pa.int32()),
        }
    )


class Count:
    """A bucket's packed strings to the word ranges of windows that occur earlier."""

    def __init__(self, size: int) -> None:
        self.size = size

    def __call__(self, bucket: pa.Table) -> pa.Table:
        known, sent, texts = [np.empty(0, _RUN)], [np.empty(0, _RUN)], []
        for is_known, blob in zip(bucket.column("known"), bucket.column("blob")):
            runs, text = _unpack(blob.as_py())
            (known if is_known.as_py() else sent).append(runs)
            texts.append(text)
        runs = np.concatenate(sent)
        words = Words(texts)
        del texts
        found = self._repeats(runs, words) if len(runs) else runs
        return _ranges(np.concatenate([*known, found]))

    def _repeats(self, runs: np.ndarray, words: Words) -> np.ndarray:
        counts = runs["words"].astype(np.int64) - self.size + 1
        run = np.repeat(np.arange(len(runs)), counts)
        offset = np.arange(len(run)) - (np.cumsum(counts) - counts)[run]
        words_before = np.cumsum(runs["words"], dtype=np.int64) - runs["words"]
        at = words_before[run] + offset
        hashes = sequence_hashes(words.hashes(), self.size)[at]

        order = np.argsort(hashes)
        equal = np.diff(hashes[order]) == 0
        many = order[np.concatenate([[False], equal]) | np.concatenate([equal, [False]])]
        if not len(many):
            return runs[:0]
        doc, key, start = runs["doc"][run], runs["key"][run], runs["start"][run] + offset
        many = many[np.lexsort((start[many], key[many], doc[many], hashes[many]))]
        _, group = np.unique(hashes[many], return_inverse=True)
        heads = many[_starts(np.diff(group) != 0)][group]
        numbers = words.numbers(at[many], self.size, Vocabulary())
        different = np.zeros(len(many), bool)
        for i in range(self.size):
            different |= numbers[at[many] + i] != numbers[at[heads] + i]
        if different.any():  # one hash for several word sequences
            sequences = numbers[at[many][:, None] + np.arange(self.size)]
            _, group = np.unique(sequences, axis=0, return_inverse=True)
            again = np.lexsort((start[many], key[many], doc[many], group.ravel()))
            many, group = many[again], group.ravel()[again]
            heads = many[_starts(np.diff(group) != 0)][group]
        later = (doc[many] != doc[heads]) | (key[many] != key[heads]) | (start[many] != start[heads])
        repeats = np.sort(many[later])
        if not len(repeats):
            return runs[:0]
        lo = _starts(np.diff(repeats) != 1, np.diff(run[repeats]) != 0)
        out = runs[run[repeats[lo]]].copy()
        out["start"] = start[repeats[lo]]
        out["words"] = np.diff(np.append(lo, len(repeats))) + self.size - 1
        return out


class Cut:
    """Texts and the word ranges to remove from them to what is left; ``carried``
    columns pass by."""

    def __init__(self, carried: list[str]) -> None:
        self.carried = carried

    def __call__(self, batches: Batches) -> Batches:
        for batch in (part for whole in batches for part in slices(whole)):
            totals, removed, kept, cut = [], [], [], []
            for text, ranges in zip(utf8(batch.column("text")), batch.column("ranges").to_pylist()):
                words = text.split() if text else []
                totals.append(len(words))
                if not ranges:
                    removed.append(0)
                    kept.append(b" ".join(words))
                    cut.append(text)
                    continue
                gone = np.zeros(len(words), bool)
                for r in ranges:
                    gone[r["start"] : r["start"] + r["words"]] = True
                removed.append(int(gone.sum()))
                left = np.flatnonzero(~gone).tolist()
                kept.append(b" ".join([words[i] for i in left]))
                # Words at the even places, what separates them at the odd ones.
                parts = _SEPARATORS.split(text)
                shift = 2 if parts[0] == b"" else 0
                line = b"".join(x for i in left for x in parts[max(2 * i + shift - 1, 0) : 2 * i + shift + 1])
                cut.append(line.strip() if left else b"")
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in self.carried],
                    pa.array(totals, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(cut, pa.binary()).cast(pa.string()),
                ],
                [*self.carried, "n_words", "n_removed", "kept", "cut_text"],
            )


def repeated_ranges(texts: DataFrame, size: int) -> DataFrame:
    """``(doc, key, start, words)``: ranges of words covered by windows that also
    start earlier, of ``texts(doc, text_key, text)``. Ranges may overlap."""
    counts = texts.mapInArrow(AnchorCounts(size), "anchor bigint, n bigint")
    counts = staged(counts.groupBy("anchor").agg(F.sum("n").alias("n")), "anchors")
    total = counts.filter("anchor is null").agg(F.sum("n").alias("n")).first().n or 0
    often = counts.filter(F.col("anchor").isNotNull() & (F.col("n") > max(HOT, total / HOT_SHARE)))
    # Less than HOT_SHARE rows: together they have no more than ``total``.
    hot = np.array([r.anchor for r in often.select("anchor").collect()], np.int64).view(np.uint64)
    words = total * (size + 8)
    buckets = max(1, -(-words // BUCKET_WORDS))
    shipped = texts.mapInArrow(Ship(size, buckets, hot), "bucket int, known boolean, blob binary")
    count = Count(size)

    def count_bucket(bucket: pa.Table) -> pa.Table:
        return count(bucket)

    return shipped.groupBy("bucket").applyInArrow(count_bucket, "doc bigint, key bigint, start int, words int")


def _nullable(schema: T.StructType) -> T.StructType:
    """As a Python task may return it: any field can be NULL."""
    kind = lambda t: _nullable(t) if isinstance(t, T.StructType) else t
    return T.StructType([T.StructField(f.name, kind(f.dataType)) for f in schema.fields])


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 20, carry: list[str] | None = None
) -> DataFrame:
    """``(doc, text_key, n_words, n_removed, kept, cut_text)`` per row of ``docs``;
    with ``carry``, also ``row``, a struct of those columns.

    Each word is removed that lies in a window of ``size`` words whose word
    sequence also starts earlier: in a document with a smaller id, or before in
    the same one; judged on the input. ``kept`` joins the words left by single
    spaces, ``cut_text`` leaves the white space between them as it was (the text
    itself where nothing was removed).

    A NULL text has no words (``cut_text`` NULL, ``kept`` empty). A NULL id comes
    before all others. Different texts of one id (or of NULL ids) are different
    documents, in the order of ``text_key``. Rows that repeat an id and a text are
    one document and get equal rows. Extra columns are ignored; an empty table gives an empty one.
    """
    texts = docs.select(
        F.col(doc_id).cast("bigint").alias("doc"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("text")
    )
    ranges = repeated_ranges(texts, size).select(
        F.col("doc").alias("range_doc"), "key", F.struct("start", "words").alias("range")
    )
    ranges = ranges.groupBy("range_doc", "key").agg(F.collect_list("range").alias("ranges"))
    same = (F.coalesce("doc", F.lit(int(NO_ID))) == F.col("range_doc")) & (F.col("text_key") == F.col("key"))
    carried = ["doc", "text_key"]
    if carry:
        carried.append("row")
        row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
        texts = docs.select(
            F.col(doc_id).cast("bigint").alias("doc"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("text"), row
        )
    joined = texts.join(ranges, same, "left").select(*carried, "text", "ranges")
    schema = _nullable(joined.select(*carried).schema)
    for name, kind in (("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept", T.StringType()), ("cut_text", T.StringType())):
        schema = schema.add(name, kind)
    return joined.mapInArrow(Cut(carried), schema)
