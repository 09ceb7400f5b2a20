"""Shards of near equal bytes by histogram sort.

Rows are ordered by the key (hash of the text, document id, place in the written
table), so equal texts lie together, a group of copies is cut only where a shard is
full, and rows that repeat an id and a text still have different keys. Only the keys'
histogram decides where: every round counts, over all partitions, the exact bytes
and rows below a few candidate keys per open boundary and puts the next candidates
between the two that enclose it. Counting returns the smallest and largest key of
each interval too, so empty key space is skipped, also inside one text's copies.
Once every boundary is within the tolerance, rows are exchanged once, to their
final interval, whose first slot the histogram already knows.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docindex.llm.common import Batches, staged

OVERHEAD = 16  # bytes of a row beside its text
PROBES = 16  # candidates per open boundary and round, at most
ALL_PROBES = 1 << 16  # candidates of all boundaries in a round, but two for each
TOLERANCE = 0.001  # of a shard's bytes
# Shards above this are cut into several intervals, so a task sorts about so much;
# up to a number of intervals whose candidate keys and counts (some 100 bytes for
# each of ALL_PROBES) the driver holds; beyond it intervals grow, and sorting spills.
INTERVAL_BYTES = 64 << 20
MAX_INTERVALS = 1 << 15

WIDTH = 24  # bytes of a key
_KEY = np.dtype(("S", WIDTH))
_COLUMNS = ("h", "d", "r")


def row_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("bigint")


def encode(*columns: np.ndarray) -> np.ndarray:
    """Signed 64-bit columns as byte strings of the same order."""
    sign = np.uint64(1 << 63)
    both = np.stack([c.view(np.uint64) ^ sign for c in columns], 1)
    return np.ascontiguousarray(both.astype(">u8")).view(_KEY).ravel()


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    return encode(*(batch.column(c).to_numpy(zero_copy_only=False) for c in _COLUMNS))


def as_number(key: bytes) -> int:
    return int.from_bytes(key.ljust(WIDTH, b"\0"), "big")


def as_key(number: int) -> bytes:
    return number.to_bytes(WIDTH, "big")


class Histogram:
    """Bytes, rows and extreme keys between consecutive probes, per task."""

    def __init__(self, probes: list[bytes]) -> None:
        self.probes = probes

    def __call__(self, batches: Batches) -> Batches:
        probes = np.array(self.probes, _KEY)
        n = len(probes) + 1
        total, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
        low: list[bytes | None] = [None] * n
        high: list[bytes | None] = [None] * n
        for batch in batches:
            keys = _keys(batch)
            sizes = batch.column("size").to_numpy(zero_copy_only=False)
            order = np.argsort(keys)
            keys, sizes = keys[order], sizes[order]
            # Interval i holds the keys from probe i - 1 on, below probe i.
            edges = np.concatenate([[0], np.searchsorted(keys, probes, side="left"), [len(keys)]])
            sums = np.concatenate([[0], np.cumsum(sizes)])
            total += sums[edges[1:]] - sums[edges[:-1]]
            rows += np.diff(edges)
            for i in np.flatnonzero(np.diff(edges)).tolist():
                first, last = bytes(keys[edges[i]]), bytes(keys[edges[i + 1] - 1])
                low[i] = first if low[i] is None else min(low[i], first, key=as_number)
                high[i] = last if high[i] is None else max(high[i], last, key=as_number)
        some = np.flatnonzero(rows).tolist()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some, pa.int32()),
                pa.array(total[some], pa.int64()),
                pa.array(rows[some], pa.int64()),
                pa.array([low[i].ljust(WIDTH, b"\0") for i in some], pa.binary()),
                pa.array([high[i].ljust(WIDTH, b"\0") for i in some], pa.binary()),
            ],
            ["i", "bytes", "rows", "low", "high"],
        )


def histogram(keys: DataFrame, probes: list[bytes]) -> list[tuple[int, int, int, int]]:
    """``(bytes, rows, smallest, largest key)`` of each interval between probes; at
    most one row per interval reaches the driver."""
    counted = keys.mapInArrow(Histogram(probes), "i int, bytes bigint, rows bigint, low binary, high binary")
    sums = counted.groupBy("i").agg(F.sum("bytes"), F.sum("rows"), F.min("low"), F.max("high")).collect()
    out = [(0, 0, 0, 0)] * (len(probes) + 1)
    for i, size, rows, low, high in sums:
        out[i] = (size, rows, as_number(bytes(low)), as_number(bytes(high)))
    return out


def _between(low: int, high: int, probes: int) -> Iterator[int]:
    """Evenly spread keys in ``(low, high]``."""
    span = high - low
    n = min(probes, span)
    for i in range(1, n + 1):
        yield low + span * i // n


def splitters(keys: DataFrame, total: int, parts: int, slack: int) -> list[int]:
    """``parts - 1`` keys; the rows below the i-th have ``i / parts`` of all bytes
    within ``slack``, or as near as whole rows allow."""
    goals = [total * i // parts for i in range(1, parts)]
    # Around each goal: a key and the bytes below it, on both sides.
    below: list[tuple[int, int]] = [(0, 0)] * len(goals)
    above: list[tuple[int, int]] = [((1 << 8 * WIDTH) - 1, total)] * len(goals)
    open_ = set(range(len(goals)))
    while open_:
        each = min(PROBES, max(2, ALL_PROBES // len(open_)))
        wanted = {p for g in open_ for p in _between(below[g][0], above[g][0], each)}
        probes = sorted(wanted)
        seen = histogram(keys, [as_key(p) for p in probes])
        before = 0
        # Nothing lies between a probe and the next key: move it up to that key,
        # and one beyond the last key of the interval below it is as good.
        points: list[tuple[int, int]] = []
        for i, (size, rows, low, high) in enumerate(seen):
            if rows:
                points.append((low, before))
                points.append((high, None if rows > 1 and low != high else before))
                points.append((high + 1, before + size))
            before += size
        known = sorted((b, k) for k, b in points if b is not None)
        for g in list(open_):
            goal = goals[g]
            # The last point at or below the goal, and the first at or above it.
            i = bisect.bisect_left(known, (goal + 1,))
            if i:
                below[g] = max(below[g], known[i - 1][::-1], key=lambda x: (x[1], x[0]))
            i = bisect.bisect_left(known, (goal,))
            if i < len(known):
                above[g] = min(above[g], known[i][::-1], key=lambda x: (x[1], x[0]))
            near = min(below[g], above[g], key=lambda x: abs(x[1] - goal))
            if abs(near[1] - goal) <= slack or above[g][0] - below[g][0] <= 1:
                open_.discard(g)
    return [min(b, a, key=lambda x: abs(x[1] - goal))[0] for b, a, goal in zip(below, above, goals)]


class Place:
    """Keys to the number of the interval they lie in."""

    def __init__(self, bounds: list[bytes]) -> None:
        self.bounds = bounds

    def __call__(self, batches: Batches) -> Batches:
        bounds = np.array(self.bounds, _KEY)
        for batch in batches:
            keys = _keys(batch)
            at = np.searchsorted(bounds, keys, side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], [*batch.schema.names, "interval"])


def shard_by_bytes(
    docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text", tolerance: float = TOLERANCE
) -> DataFrame:
    """``(doc, text, size, shard, slot)`` per row of ``docs``, in shards of near
    equal bytes; ``slot`` counts a shard's rows from 0 without gaps, in key order.

    A row's size is its text's UTF-8 bytes and ``OVERHEAD``; NULL and empty texts
    have none but the overhead. Equal texts are neighbours. NULL ids come first
    among equal texts and share their place with the smallest 64-bit id. Rows that
    repeat an id and a text are parted like others, in the order they were written
    in. Extra columns are ignored; an empty table gives
    an empty one, and with fewer rows than shards some shards stay empty.
    """
    d = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(1 << 63)))
    rows = docs.select(
        F.xxhash64(F.col(text)).alias("h"), d.alias("d"), row_size(F.col(text)).alias("size"),
        F.col(doc_id).alias("doc"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("r"),
    )
    # Written, so that a row keeps its place in every round and in the exchange.
    rows = staged(rows, "rows")
    keys = rows.select(*_COLUMNS, "size")
    total = keys.agg(F.sum("size")).first()[0] or 0
    per_shard = min(-(-total // (shards * INTERVAL_BYTES)), max(1, MAX_INTERVALS // shards))
    per_shard = max(1, per_shard)
    bounds = splitters(keys, total, shards * per_shard, max(1, int(tolerance * total / shards))) if total else []
    bounds = [as_key(b) for b in bounds]
    counts = np.array([n for _, n, _, _ in histogram(keys, bounds)])
    first = np.cumsum(counts) - counts
    places = [(i, i // per_shard, int(first[i] - first[i // per_shard * per_shard])) for i in range(len(counts))]
    places = docs.sparkSession.createDataFrame(places, "interval int, shard int, first bigint")

    kind = rows.schema["doc"].dataType.simpleString()
    placed = rows.mapInArrow(Place(bounds), f"h bigint, d bigint, size bigint, doc {kind}, text string, r bigint, interval int")
    # The one exchange of rows; each interval is numbered from 0 in key order.
    order = Window.partitionBy("interval").orderBy(*_COLUMNS)
    numbered = placed.withColumn("number", F.row_number().over(order).cast("bigint") - 1)
    return numbered.join(F.broadcast(places), "interval").select(
        "doc", "text", "size", "shard", (F.col("first") + F.col("number")).alias("slot")
    )
