"""Approximate nearest neighbours by NN-descent and greedy graph search.

*Building.* Equal vectors fold into one node. Every node first meets the nodes of
a few random groups, then, round by round, its neighbours' neighbours: a node's
``WIDTH`` neighbours and the nearest ``BACK`` of those that have it as one come
together at it (a join), their cosines are computed as one block, and each of them
keeps its best ``WIDTH``. Pairs that met before are skipped, and rounds end when
few lists change. So many vectors meet at one node at most, whatever the data; the
lists are cut before they are exchanged, and every round is written to the shared
folder.

Nodes lie in buckets by a hash of their number. What buckets send one another in a
round (who is called to which meeting, vectors, edges gained) travels as one row for
each pair of buckets, its columns as bytes, and is sorted and cut as vectors.

*Searching.* Queries walk the graph with a list of their best ``BEAM`` nodes: every
step expands all that were not expanded before, and the walk ends when none is
left. A query whose vector is a node starts there; vectors from outside start at
the nearest of ``ENTRIES`` nodes.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docindex.llm.common import Batches, mix, parts, staged
from docindex.sources.scratch import shuffles_freed

WIDTH = 40
BACK = 24
GAINED = 12  # edges that a node takes from one meeting
GROUP = 128  # nodes of a random first group, on average
FIRST_GROUPS = 3
ROUNDS = 12
STILL = 0.01  # stop when a smaller share of the list entries changed
BEAM = 160
ENTRIES = 256
BROADCAST_QUERIES = 50_000
BUCKET = 512  # nodes of a bucket, on average
BLOCK = 4096  # members whose vectors are computed with at a time

_NEVER = float("-inf")
# Numbers of what is packed; vectors have a type of their own.
_TYPES = {"node": "<i8", "other": "<i8", "meeting": "<i8", "cosine": "<f8", "worst": "<f8", "fresh": "?", "back": "?"}
_NODES = "bucket int, node bigint, vector binary, norm double"
_GRAPH = "bucket int, node bigint, vector binary, other binary, cosine binary, fresh binary, gained int, worst double"
_OFFERS = "bucket int, meeting binary, node binary, cosine binary, fresh binary, back binary"
_CALLS = "bucket int, node binary, meeting binary, fresh binary"
_MEMBERS = "bucket int, meeting binary, node binary, fresh binary, worst binary, vector binary"
_FOUND = "bucket int, node binary, other binary, cosine binary"


def _bytes(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The bytes of all binary values, one after another."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8)
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)


def _opened(table: pa.Table | pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [_bytes(table.column(n)).view(_TYPES[n]) for n in names]


def _lengths(column: pa.Array | pa.ChunkedArray, itemsize: int) -> np.ndarray:
    return pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // itemsize if len(column) else np.zeros(0, np.int64)


def _matrix(column: pa.Array | pa.ChunkedArray, rows: int, kind: str) -> np.ndarray:
    return _bytes(column).view(kind).reshape(rows, -1) if rows else np.zeros((0, 1), kind)


def _whole_rows(matrix: np.ndarray) -> np.ndarray:
    """Each row of a matrix as one value of so many bytes."""
    matrix = np.ascontiguousarray(matrix)
    return matrix.view(np.dtype((np.void, matrix.itemsize * matrix.shape[1]))).ravel()


def _bucket(node: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(node.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def _dealt(to: np.ndarray, buckets: int, **columns: np.ndarray) -> pa.Table:
    """A row for each bucket of ``to``, with that part of each column as bytes."""
    bucket = _bucket(to, buckets)
    order = np.argsort(bucket, kind="stable")
    there, sizes = np.unique(bucket, return_counts=True)
    return pa.table({"bucket": pa.array(there, pa.int32())} | {name: parts(c[order], sizes) for name, c in columns.items()})


def _ranks(node: np.ndarray) -> np.ndarray:
    """Each row's place among those of its node, which stand together."""
    first = np.flatnonzero(np.concatenate([[True], np.diff(node) != 0])) if len(node) else np.zeros(0, np.int64)
    return np.arange(len(node)) - np.repeat(first, np.diff([*first, len(node)]))


def _nearest_of(node: np.ndarray, other: np.ndarray, cosine: np.ndarray, width: int) -> np.ndarray:
    """Where each node's ``width`` best edges are, in the order of nodes and places."""
    order = np.lexsort((other, -cosine, node))
    return order[_ranks(node[order]) < width]


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision, summed from the first component on."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i].astype(np.float64) * b[:, i]
    return total


def _packed(nodes: DataFrame, buckets: int) -> tuple[DataFrame, str]:
    """``nodes(node, vector)`` with their bucket, the vector as bytes and its length;
    and the type of the components."""
    single = nodes.schema["vector"].dataType.elementType.simpleString() == "float"
    kind, items = ("<f4", pa.float32()) if single else ("<f8", pa.float64())
    if not single:
        nodes = nodes.withColumn("vector", F.col("vector").cast("array<double>"))

    def pack(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy()
            x = batch.column("vector").flatten().cast(items).to_numpy().astype(kind).reshape(len(node), -1)
            with np.errstate(over="ignore"):
                norm = np.sqrt(_dots(x, x))
            rows = parts(_whole_rows(x), np.ones(len(node), np.int64))
            yield pa.RecordBatch.from_pydict({"bucket": _bucket(node, buckets), "node": node, "vector": rows, "norm": norm})

    return staged(nodes.select("node", "vector").mapInArrow(pack, _NODES), "packed"), kind


def _meetings(members: pa.Table, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members of several meetings to the edges ``(node, other, cosine)`` each member
    gains: its best ``GAINED`` others there, better than the worst it has."""
    meeting, node, fresh, worst = _opened(members, "meeting", "node", "fresh", "worst")
    vectors = _matrix(members.column("vector"), len(node), kind)
    order = np.lexsort((node, meeting))
    meeting, node, fresh, worst = (c[order] for c in (meeting, node, fresh, worst))
    edges = np.flatnonzero(np.concatenate([[True], np.diff(meeting) != 0])).tolist() + [len(meeting)]
    nodes, others, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    start = end = 0
    for lo, hi in zip(edges[:-1], edges[1:]):
        if hi > end:
            # Cosines of near copies differ in digits that float32 does not have.
            start, end = lo, max(hi, next((e for e in reversed(edges) if e <= lo + BLOCK), hi))
            x = vectors[order[start:end]].astype(np.float64)
            x /= np.abs(x).max(axis=1, keepdims=True)  # so that no square under- or overflows
            x /= np.linalg.norm(x, axis=1, keepdims=True)
        if hi - lo < 2:
            continue
        own, met = node[lo:hi], x[lo - start : hi - start]
        near = met @ met.T
        near[(own[:, None] == own) | ~(fresh[lo:hi, None] | fresh[lo:hi])] = _NEVER
        k = min(GAINED, hi - lo - 1)
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        value = np.take_along_axis(near, best, 1)
        row, col = np.nonzero(value > worst[lo:hi, None])
        nodes.append(own[row])
        others.append(own[best[row, col]])
        values.append(value[row, col])
    return np.concatenate(nodes), np.concatenate(others), np.concatenate(values)


def _met(members: DataFrame, graph: DataFrame, kind: str, buckets: int) -> DataFrame:
    """The graph with the edges that ``members`` gain at their meetings."""

    def meet(table: pa.Table) -> pa.Table:
        node, other, cosine = _meetings(table, kind)
        return _dealt(node, buckets, node=node, other=other, cosine=cosine)

    def merge(lists: pa.Table, found: pa.Table) -> pa.Table:
        own = lists.column("node").to_numpy()
        sizes = _lengths(lists.column("other"), 8)
        gained, known = _opened(found, "node", "other", "cosine"), _opened(lists, "other", "cosine")
        node, other, cosine = (np.concatenate(c) for c in zip([np.repeat(own, sizes), *known], gained))
        # ``fresh`` is false where the edge was there before.
        fresh = np.arange(len(node)) >= sizes.sum()
        order = np.lexsort((other, node))
        node, other, cosine, fresh = (c[order] for c in (node, other, cosine, fresh))
        if len(node):
            first = np.flatnonzero(np.concatenate([[True], (np.diff(node) != 0) | (np.diff(other) != 0)]))
            node, other = node[first], other[first]
            cosine, fresh = np.maximum.reduceat(cosine, first), np.logical_and.reduceat(fresh, first)
        best = _nearest_of(node, other, cosine, WIDTH)
        node, other, cosine, fresh = (c[best] for c in (node, other, cosine, fresh))
        lists = lists.take(np.argsort(own))
        own = np.sort(own)
        ends = np.searchsorted(node, own, "right")
        sizes = ends - np.searchsorted(node, own, "left")
        worst = np.full(len(own), _NEVER)
        worst[sizes >= WIDTH] = cosine[ends[sizes >= WIDTH] - 1]
        new = np.diff(np.concatenate([[0], np.cumsum(fresh)])[np.concatenate([[0], ends])]) if len(own) else ends
        return pa.table(
            {
                "bucket": lists.column("bucket"),
                "node": own,
                "vector": lists.column("vector"),
                "other": parts(other, sizes),
                "cosine": parts(cosine, sizes),
                "fresh": parts(fresh, sizes),
                "gained": pa.array(new, pa.int32()),
                "worst": worst,
            }
        )

    found = members.groupBy("bucket").applyInArrow(meet, _FOUND)
    return staged(graph.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(merge, _GRAPH), "graph")


def _called(graph: DataFrame, buckets: int) -> DataFrame:
    """``_MEMBERS`` of the next round's meetings."""

    def offer(batches: Batches) -> Batches:
        for batch in batches:
            sizes = _lengths(batch.column("other"), 8)
            owner = np.repeat(batch.column("node").to_numpy(), sizes)
            other, cosine, fresh = _opened(batch, "other", "cosine", "fresh")
            if not len(owner):
                continue
            cut = _nearest_of(other, owner, cosine, BACK)
            for meeting, node, at, back in ((owner, other, np.arange(len(owner)), False), (other, owner, cut, True)):
                offers = {"meeting": meeting[at], "node": node[at], "cosine": cosine[at], "fresh": fresh[at]}
                yield from _dealt(meeting[at], buckets, **offers, back=np.full(len(at), back)).to_batches()

    def call(table: pa.Table) -> pa.Table:
        meeting, node, cosine, fresh, back = _opened(table, "meeting", "node", "cosine", "fresh", "back")
        behind = np.flatnonzero(back)
        behind = behind[_nearest_of(meeting[behind], node[behind], cosine[behind], BACK)]
        taken = np.concatenate([np.flatnonzero(~back), behind])
        taken = taken[np.lexsort((node[taken], meeting[taken]))]
        meeting, node, fresh = meeting[taken], node[taken], fresh[taken]
        first = np.flatnonzero(np.concatenate([[True], (np.diff(meeting) != 0) | (np.diff(node) != 0)]))
        meeting, node, fresh = meeting[first], node[first], np.logical_or.reduceat(fresh, first)
        lively = np.isin(meeting, meeting[fresh])
        meeting, node, fresh = meeting[lively], node[lively], fresh[lively]
        return _dealt(node, buckets, node=node, meeting=meeting, fresh=fresh)

    def send(lists: pa.Table, calls: pa.Table) -> pa.Table:
        own = lists.column("node").to_numpy()
        worst = lists.column("worst").to_numpy()
        vector = _whole_rows(_bytes(lists.column("vector")).reshape(len(own), -1))
        node, meeting, fresh = _opened(calls, "node", "meeting", "fresh")
        order = np.argsort(own)
        at = order[np.searchsorted(own[order], node)]
        return _dealt(meeting, buckets, meeting=meeting, node=node, fresh=fresh, worst=worst[at], vector=vector[at])

    offers = graph.select("node", "other", "cosine", "fresh").mapInArrow(offer, _OFFERS)
    calls = offers.groupBy("bucket").applyInArrow(call, _CALLS)
    lists = graph.select("bucket", "node", "vector", "worst")
    # A bucket whose nodes nobody calls has nothing to send, one without nodes is not called.
    return lists.groupBy("bucket").cogroup(calls.groupBy("bucket")).applyInArrow(send, _MEMBERS)


def build(nodes: DataFrame, kind: str, total: int, buckets: int) -> DataFrame:
    """The graph ``(node, other, cosine)`` of the ``total`` packed ``nodes``.

    Meetings compare the vectors as they are: rounded ones would make the members
    of a group of near copies alike, and their edges arbitrary.
    """
    groups = max(1, math.ceil(total / GROUP))
    drawn = [F.pmod(F.xxhash64("node", F.lit(i)), F.lit(groups)) * FIRST_GROUPS + i for i in range(FIRST_GROUPS)]

    def begin(batches: Batches) -> Batches:
        for batch in batches:
            node = batch.column("node").to_numpy()
            if not len(node):
                continue
            vector = _whole_rows(_bytes(batch.column("vector")).reshape(len(node), -1))
            for i in range(FIRST_GROUPS):
                meeting = batch.column(f"group{i}").to_numpy()
                same = {"fresh": np.ones(len(node), bool), "worst": np.full(len(node), _NEVER)}
                yield from _dealt(meeting, buckets, meeting=meeting, node=node, **same, vector=vector).to_batches()

    first = nodes.select("node", "vector", *[g.alias(f"group{i}") for i, g in enumerate(drawn)])
    none = [F.lit(b"").alias(c) for c in ("other", "cosine", "fresh")]
    lists = nodes.select("bucket", "node", "vector", *none, F.lit(0).alias("gained"), F.lit(_NEVER).alias("worst"))
    graph = _met(first.mapInArrow(begin, _MEMBERS), lists, kind, buckets)
    for _ in range(ROUNDS):
        graph = _met(_called(graph, buckets), graph, kind, buckets)
        if (graph.agg(F.sum("gained")).first()[0] or 0) <= STILL * total * WIDTH:
            break

    def opened(batches: Batches) -> Batches:
        for batch in batches:
            other, cosine = _opened(batch, "other", "cosine")
            node = np.repeat(batch.column("node").to_numpy(), _lengths(batch.column("other"), 8))
            yield pa.RecordBatch.from_pydict({"node": node, "other": other, "cosine": cosine})

    edges = graph.select("node", "other", "cosine").mapInArrow(opened, "node bigint, other bigint, cosine double")
    return staged(edges, "edges")


def _cosines(kind: str) -> Callable[[Batches], Batches]:
    """In double precision, on the vectors as they are."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            n = batch.num_rows
            a, b = (_matrix(batch.column(c), n, kind) for c in ("q", "vector"))
            with np.errstate(all="ignore"):
                value = _dots(a, b) / (batch.column("q_norm").to_numpy() * batch.column("norm").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("other"), pa.array(value)], names=["query", "other", "cosine"])

    return run


def search(graph: DataFrame, nodes: DataFrame, kind: str, starts: DataFrame) -> DataFrame:
    """``(query, other, cosine)``: the best ``BEAM`` nodes of each query.

    ``starts(query, vector, norm, other)``: one row or more per query, with nodes to
    begin at. Every node is scored once per query.
    """
    queries = staged(starts.select("query", "vector", "norm").dropDuplicates(["query"]), "queries")
    own = queries.withColumnsRenamed({"vector": "q", "norm": "q_norm"})
    if queries.count() <= BROADCAST_QUERIES:
        own = F.broadcast(own)

    def scored(pairs: DataFrame) -> DataFrame:
        met = pairs.join(nodes.select(F.col("node").alias("other"), "vector", "norm"), "other").join(own, "query")
        met = met.select("query", "other", "q", "q_norm", "vector", "norm")
        return staged(met.mapInArrow(_cosines(kind), "query bigint, other bigint, cosine double"), "scored")

    order = Window.partitionBy("query").orderBy(F.desc("cosine"), "other")

    def best(rows: DataFrame) -> DataFrame:
        return staged(rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= BEAM).drop("place"), "beam")

    new = scored(starts.select("query", "other").distinct())
    seen, beam = new, best(new.withColumn("expanded", F.lit(False)))
    while True:
        wave = beam.filter(~F.col("expanded")).select("query", F.col("other").alias("node"))
        if wave.isEmpty():
            break  # at the latest when every node a query can reach is expanded
        reached = wave.join(graph, "node").select("query", "other").distinct()
        new = scored(reached.join(seen.select("query", "other"), ["query", "other"], "left_anti"))
        seen = seen.unionByName(new)
        beam = best(beam.withColumn("expanded", F.lit(True)).unionByName(new.withColumn("expanded", F.lit(False))))
    return beam.select("query", "other", "cosine")


def valid_vectors(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part."""
    v = F.col(embedding)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    usable = rows.filter(F.col(vec_id).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    # An id that repeats counts once, with its smallest vector.
    return usable.groupBy(F.col(vec_id).cast("bigint").alias("vec_id")).agg(F.min(v).alias("vector"))


def nearest(
    rows: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row where ``is_query`` (a
    condition on the column ``vec_id``) holds, the ``k`` rows found with the
    largest cosine, nearest first, ties to the smaller id; its own row excluded.

    Vectors that are NULL, empty, zero, or hold NULL or non-finite components take
    no part, nor do rows without an id; of an id that repeats the smallest vector
    counts. Cosines need one length: vectors of another than the most frequent one
    (of equally frequent ones the largest) take no part either. Of equal vectors only the ``k + 1``
    smallest ids are kept as answers, which is all that ties can ask for. Extra
    columns are ignored; an empty table, or a single vector, gives an empty result.
    """
    with shuffles_freed(rows.sparkSession):
        return _nearest(rows, is_query, k, vec_id, embedding)


def _nearest(rows: DataFrame, is_query: Column, k: int, vec_id: str, embedding: str) -> DataFrame:
    valid = staged(valid_vectors(rows, vec_id, embedding), "vectors")
    lengths = valid.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    if usual:
        valid = valid.filter(F.size("vector") == usual.length)
    by_vector = Window.partitionBy("vector")
    ranked = valid.withColumn("place", F.row_number().over(by_vector.orderBy("vec_id")))
    kept = ranked.filter(F.col("place") <= k + 1).drop("place")
    kept = staged(kept.withColumn("node", F.min("vec_id").over(by_vector)), "members")
    nodes = staged(kept.filter("node = vec_id").select("node", "vector"), "nodes")
    total = nodes.count()
    buckets = max(1, math.ceil(total / BUCKET))
    packed, kind = _packed(nodes, buckets)
    graph = build(packed, kind, total, buckets)

    # Queries share the search of their node.
    asked = valid.filter(is_query).select(F.col("vec_id").alias("query_id"), "vector")
    asked = staged(asked.join(nodes, "vector").select("query_id", "node"), "asked")
    starts = packed.join(asked.select("node").distinct(), "node", "left_semi")
    found = search(graph, packed, kind, starts.select(F.col("node").alias("query"), "vector", "norm", F.col("node").alias("other")))
    # A node's own copies come before all others, so k + 1 nodes are enough.
    order = Window.partitionBy("query").orderBy(F.desc("cosine"), "other")
    found = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= 2 * k + 2)
    answers = found.join(kept.select(F.col("node").alias("other"), "vec_id"), "other")
    answers = asked.join(answers, asked.node == answers.query).filter("vec_id != query_id")
    first = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.col("cosine").alias("score"))
