"""Declared schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("uri", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("docId", T.StringType()),
        T.StructField("contentHash", T.StringType()),
    ]
)

CHUNKS = T.StructType(
    [
        T.StructField("docId", T.StringType()),
        T.StructField("chunkId", T.StringType()),
        T.StructField("chunkText", T.StringType()),
        T.StructField("startOffset", T.IntegerType()),
        T.StructField("endOffset", T.IntegerType()),
        T.StructField("chunkContentHash", T.StringType()),
    ]
)

# chunkContentHash says which text a vector was made from.
EMBEDDINGS = T.StructType(
    [
        T.StructField("chunkId", T.StringType(), False),
        T.StructField("docId", T.StringType(), False),
        T.StructField("embedding", T.ArrayType(T.FloatType()), False),
        T.StructField("embedder", T.StringType(), False),
        T.StructField("embedderVersion", T.StringType(), False),
        T.StructField("chunkContentHash", T.StringType(), False),
    ]
)

# What an embedding job yields per chunk: a vector or an error, never both.
ATTEMPTS = T.StructType(
    [
        T.StructField("chunkId", T.StringType()),
        T.StructField("docId", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("embedder", T.StringType()),
        T.StructField("embedderVersion", T.StringType()),
        T.StructField("chunkContentHash", T.StringType()),
        T.StructField("textPrefix", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

RETRIEVAL_INDEX = T.StructType(
    [
        T.StructField("docId", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("chunkId", T.StringType()),
        T.StructField("chunkText", T.StringType()),
        T.StructField("startOffset", T.IntegerType()),
        T.StructField("endOffset", T.IntegerType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("embedder", T.StringType()),
        T.StructField("embedderVersion", T.StringType()),
    ]
)

# Files a run has read, as they were listed; ``reader`` says by which extractor.
FILES = T.StructType(
    [
        T.StructField("docId", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("reader", T.StringType()),
    ]
)

# Documents a run could not read, and why.
FAILURES = T.StructType(
    [
        T.StructField("docId", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

# Documents a run touched, one row each.
CHANGES = T.StructType(
    [
        T.StructField("docId", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("status", T.StringType()),
        # True where the index goes on serving the rows of an earlier run.
        T.StructField("held", T.BooleanType()),
    ]
)

# One row per committed run: what readers see, and the run's metrics.
RUNS = T.StructType(
    [
        T.StructField("run", T.IntegerType()),
        T.StructField("base", T.IntegerType()),
        T.StructField("indexBase", T.IntegerType()),
        T.StructField("embedder", T.StringType()),
        T.StructField("embedderVersion", T.StringType()),
        T.StructField("chunkSize", T.IntegerType()),
        T.StructField("chunkOverlap", T.IntegerType()),
        T.StructField("liveDocs", T.LongType()),
        T.StructField("touchedSinceBase", T.LongType()),
        T.StructField("totalDocs", T.LongType()),
        T.StructField("newDocs", T.LongType()),
        T.StructField("changedDocs", T.LongType()),
        T.StructField("deletedDocs", T.LongType()),
        T.StructField("failedDocs", T.LongType()),
        T.StructField("docsSkipped", T.LongType()),
        T.StructField("freshnessPct", T.DoubleType()),
        T.StructField("dedupPct", T.DoubleType()),
        T.StructField("chunksWritten", T.LongType()),
        T.StructField("chunksEmbedded", T.LongType()),
        T.StructField("chunksReused", T.LongType()),
        T.StructField("chunksFailed", T.LongType()),
        T.StructField("indexRowsWritten", T.LongType()),
        T.StructField("embedSeconds", T.DoubleType()),
        T.StructField("chunksPerSecond", T.DoubleType()),
        T.StructField("totalSeconds", T.DoubleType()),
        T.StructField("filesRead", T.LongType()),
        T.StructField("stepSeconds", T.MapType(T.StringType(), T.DoubleType())),
        # Where the run's rows lie: the name of its folders, the tables it wrote, and
        # the columns these have besides their own, as DDL.
        T.StructField("attempt", T.StringType()),
        T.StructField("tables", T.ArrayType(T.StringType())),
        T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
        T.StructField("buckets", T.IntegerType()),
    ]
)


def conform(df, schema: T.StructType, keep_extra: bool = False):
    """Bring ``df`` to the columns and types of ``schema``, or fail on analysis. With
    ``keep_extra``, other columns follow as they are."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    extra = [c for c in df.columns if c not in schema.fieldNames()] if keep_extra else []
    return df.select(
        *[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields], *[df[f"`{c}`"] for c in extra]
    )
