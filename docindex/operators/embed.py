"""Which chunks lack a vector, and the job that makes one for each."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docindex.config import BY_CONTENT, BY_ID
from docindex.operators.sizes import BROADCAST_ROWS
from docindex.operators.tables import keep_keys
from docindex.schemas import ATTEMPTS, EMBEDDINGS
from docindex.sources.scratch import written

# Takes texts and the model's name, gives one vector per text, in order.
Embedder = Callable[[Sequence[str], str], Sequence[Sequence[float] | None]]

# Fixed value: characters of the text quoted with an error.
ERROR_PREFIX = 50


def of_version(embeddings: DataFrame, model: str, version: str) -> DataFrame:
    """Vectors of one model version."""
    return embeddings.filter(
        (F.col("embedder") == model) & (F.col("embedderVersion") == version)
    )


def backlog(
    chunks: DataFrame,
    embeddings: DataFrame,
    model: str,
    version: str,
    reuse: str = BY_CONTENT,
) -> DataFrame:
    """Chunks without a vector of this model version.

    ``by_content`` also asks that the vector was made from the chunk's present
    text; ``by_id`` takes any vector stored under the (positional) chunk id.
    """
    keys = {BY_ID: ["chunkId"], BY_CONTENT: ["chunkId", "chunkContentHash"]}[reuse]
    done = of_version(embeddings, model, version).select(*keys)
    return chunks.join(done, keys, "left_anti")


def backlog_by_keys(
    chunks: DataFrame,
    embeddings: DataFrame,
    model: str,
    version: str,
    reuse: str = BY_CONTENT,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """The same for stored chunks, whose text is not shuffled: keys alone are joined,
    and what is missing is written and fetched by a semi join. NULL keys have no
    vector and stay."""
    keys = {BY_ID: ["chunkId"], BY_CONTENT: ["chunkId", "chunkContentHash"]}[reuse]
    missing = written(backlog(chunks.select(*keys), embeddings, model, version, reuse), "backlog")
    n = missing.count()
    nameless = F.col("chunkId").isNull() | F.col(keys[-1]).isNull()
    return keep_keys(chunks, missing, keys, n, limit).unionByName(chunks.filter(nameless))


def embed_chunks(
    chunks: DataFrame,
    embedder: Embedder,
    model: str,
    version: str,
    batch: int = 64,
    partitions: int | None = None,
    dimension: int | None = None,
    carry: Sequence[str] = (),
    known: str | None = None,
) -> DataFrame:
    """One attempt per chunk (schema ``ATTEMPTS``), made where the chunk is.

    Id, document and text travel in one row, so nothing is matched by position.
    The job does not fail with the embedder: a failing batch is retried text by
    text, and a text that raises, gets no vector or one of the wrong length
    becomes a row with ``error`` set. ``partitions`` spreads the chunks evenly by
    id and bounds how many tasks call the embedder at once.

    Columns ``carry`` are handed on behind the attempt's own. A chunk with a vector in
    the column ``known`` keeps it, unasked; ``reused`` tells these from the others.
    """
    extra = [*carry, *([known] if known else [])]
    work = chunks.select("chunkId", "docId", "chunkContentHash", "chunkText", *[F.col(c).alias(f"_{c}") for c in extra])
    if partitions is not None:
        work = work.repartition(partitions, "chunkId")
    vector_type = pa.list_(pa.float32())
    carried = [T.StructField(c, chunks.schema[c].dataType) for c in carry]
    schema = T.StructType([*ATTEMPTS.fields, *carried, *([T.StructField("reused", T.BooleanType())] if known else [])])

    def row(part: pa.RecordBatch, vectors: pa.Array, prefixes: list, errors: list, reused: bool) -> pa.RecordBatch:
        n = part.num_rows
        columns = [
            part.column(0),
            part.column(1),
            vectors,
            pa.array([model] * n, pa.string()),
            pa.array([version] * n, pa.string()),
            part.column(2),
            pa.array(prefixes, pa.string()),
            pa.array(errors, pa.string()),
            *[part.column(4 + i) for i in range(len(carry))],
        ]
        if known:
            columns.append(pa.array([reused] * n, pa.bool_()))
        return pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    def attempt(texts: list[str]) -> list[tuple[Sequence[float] | None, str | None]]:
        try:
            vectors = list(embedder(texts, model))
            if len(vectors) != len(texts):
                raise ValueError(f"{len(vectors)} vectors for {len(texts)} texts")
        except Exception as exc:
            if len(texts) > 1:
                return [result for text in texts for result in attempt([text])]
            return [(None, f"{type(exc).__name__}: {exc}")]
        return [checked(v) for v in vectors]

    def checked(vector: Sequence[float] | None) -> tuple[Sequence[float] | None, str | None]:
        if vector is None or len(vector) == 0:
            return None, "empty vector"
        if dimension is not None and len(vector) != dimension:
            return None, f"dimension {len(vector)}, expected {dimension}"
        try:
            numbers = [float(x) for x in vector]
            if not all(map(math.isfinite, numbers)):
                return None, "vector with a component that is not finite"
            return numbers, None
        except (TypeError, ValueError) as exc:
            return None, f"{type(exc).__name__}: {exc}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if known:
                vectors = rows.column(4 + len(carry))
                done = rows.filter(vectors.is_valid())
                if done.num_rows:
                    nothing = [None] * done.num_rows
                    yield row(done, done.column(4 + len(carry)).cast(vector_type), nothing, nothing, True)
                rows = rows.filter(vectors.is_null())
            for start in range(0, rows.num_rows, batch):
                part = rows.slice(start, batch)
                texts = part.column(3).to_pylist()
                results = attempt(texts)
                vectors = pa.array([v for v, _ in results], vector_type)
                prefixes = [None if e is None else t[:ERROR_PREFIX] for t, (_, e) in zip(texts, results)]
                yield row(part, vectors, prefixes, [e for _, e in results], False)

    return work.mapInArrow(run, schema)


def vectors_of(attempts: DataFrame) -> DataFrame:
    """The attempts that gave a vector, as embedding rows."""
    return attempts.filter(F.col("error").isNull()).select(*EMBEDDINGS.fieldNames())


def errors_of(attempts: DataFrame) -> DataFrame:
    """The attempts that failed; their chunks stay in the backlog."""
    return attempts.filter(F.col("error").isNotNull()).select(
        "chunkId", "docId", "chunkContentHash", "embedder", "embedderVersion", "textPrefix", "error"
    )


def is_valid_vector(embedding: Column, dimension: int) -> Column:
    """Present, of the expected length, and finite throughout."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(embedding) == dimension) & finite, F.lit(False))
