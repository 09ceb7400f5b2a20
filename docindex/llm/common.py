"""Helpers the operators share: staged tables, word vocabularies, null-safe keys."""

from __future__ import annotations

import itertools
import os
import sys
import types
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docindex.sources.scratch import scratch_path

# White space of a word pattern [^\x20\x09-\x0D]+, as Java and Python regex.
SPACE = r"[\x20\x09-\x0D]"

# Tables of up to this many keys may be broadcast: at most some 100 MB.
BROADCAST_KEYS = 1_000_000

# Keys of an uneven join that are broadcast: those with one OFTEN-th of the rows, if
# that is more than FEW.
OFTEN = 20_000
FEW = 500

# Words a task remembers at a time; above it, it forgets them all.
VOCABULARY = 1_000_000

M64 = (1 << 64) - 1

Batches = Iterator[pa.RecordBatch]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, and
    a lost executor takes nothing with it."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(keys: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast for a table whose counted rows fit one."""
    return F.broadcast(keys) if rows <= BROADCAST_KEYS else keys


def join_uneven(rows: DataFrame, keys: DataFrame, on: str, weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with narrow, written ``keys``, one row for each value of
    ``on``, where ``weight`` says how many of the ``total`` rows have that value. Values
    with more than one ``OFTEN``-th of all rows, so at most ``OFTEN``, are broadcast;
    the shuffle deals out the others, none of which fills a task."""
    often = F.col(weight) > max(total // OFTEN, FEW)
    hot = keys.filter(often)
    if hot.isEmpty():
        return rows.join(keys, on)
    even = rows.join(F.broadcast(hot.select(on)), on, "left_anti").join(keys.filter(~often), on)
    return rows.join(F.broadcast(hot), on).unionByName(even)


def first_by_hash(rows: DataFrame, n: int, limit: int, *key: str) -> DataFrame:
    """Up to ``limit`` of the ``n`` rows, in the order of a hash of ``key``: a
    bounded sample that does not depend on partitions. Rows that cannot be among
    them are dropped where they lie, so no task sends more than its share."""
    order = F.xxhash64(*key)
    share = 1.2 * limit / max(n, 1)
    if share < 1:
        rows = rows.filter(order < F.lit(int(-(1 << 63) + share * (1 << 64))))
    return rows.orderBy(order, *key).limit(limit)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: Column) -> Column:
    """With the document's id, tells rows apart that repeat an id."""
    return F.xxhash64(text)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


class Vocabulary(defaultdict):
    """Words as numbers, exact within a batch, and a 64-bit hash for each number."""

    def __init__(self) -> None:
        super().__init__(itertools.count().__next__)
        self._hashes = np.zeros(0, np.uint64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def hashes(self) -> np.ndarray:
        """The hash of each number so far. Walks all words: once per batch."""
        known = len(self._hashes)
        if known < len(self):
            new = map(xxhash.xxh64_intdigest, itertools.islice(self, known, None))
            fresh = np.fromiter(new, np.uint64, len(self) - known)
            self._hashes = np.concatenate([self._hashes, fresh])
        return self._hashes

    def trim(self) -> None:
        """Call between batches: bounds the memory."""
        if len(self) > VOCABULARY:
            self.__init__()
            self.clear()


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + b
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def sequence_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` consecutive words, by doubling."""
    length = len(word_hashes) - n + 1
    if length <= 0:
        return np.zeros(0, np.uint64)
    out, done, power, size = None, 0, word_hashes, 1
    while True:
        if n & size:
            piece = power[done : done + length]
            out = piece if out is None else joined(out, piece)
            done += size
        if done == n:
            return mix(out)
        power = joined(power[:-size], power[size:])
        size *= 2


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """The smallest of every ``n`` consecutive values, by doubling."""
    length, size = len(values) - n + 1, 1
    if length <= 0:
        return values[:0]
    while size * 2 <= n:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:length], values[n - size : n - size + length])


def utf8(column: pa.Array) -> Iterator[bytes | None]:
    """The texts of an Arrow column as UTF-8 bytes."""
    for value in column.cast(pa.binary()):
        yield value.as_py()


def frequent(met: np.ndarray) -> np.ndarray:
    """Indexes of what was met most often and more than once, at most a half."""
    half = len(met) // 2
    return np.flatnonzero(met > max(1, np.partition(met, -half)[-half])) if half else np.zeros(0, np.int64)


def runs(values: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that begin there and have these sizes, one after another."""
    return values[np.arange(sizes.sum()) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)]


def parts(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive runs of a vector as binary values."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize
    offsets = pa.py_buffer(ends.astype(np.int64).tobytes())
    data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, offsets, pa.py_buffer(values.tobytes())])
    return data.cast(pa.binary())


def one_thread(path: str) -> Tokenizer:
    """A tokenizer that starts no threads of its own: a task has one core, and each
    thread would keep memory."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def per_process(name: str, make: Callable[[], object]) -> object:
    """An object that a Python worker keeps for its next tasks."""
    kept = sys.modules.setdefault("_docindex_llm_kept", types.ModuleType("_docindex_llm_kept"))
    if name not in kept.__dict__:
        kept.__dict__[name] = make()
    return kept.__dict__[name]


def release(start: str) -> None:
    """Drop what a Python worker keeps under names that start so: tasks of a later
    stage run in the same workers."""
    kept = sys.modules.get("_docindex_llm_kept")
    for name in [n for n in vars(kept) if n.startswith(start)] if kept else []:
        delattr(kept, name)


def slices(batch: pa.RecordBatch, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose texts have about ``limit`` bytes, or one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > limit:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n
    if at < batch.num_rows:
        yield batch.slice(at)
