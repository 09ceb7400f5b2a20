"""An earlier and a current state of the ``documents`` table.

The current state is the table as it is. The earlier state gives every document
a history by the last digit of its number: 0 did not exist yet, 1 had a longer
text, 3 had another text of the same length, 2 had a second copy at an address
that is gone by now, the others were the same.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docindex.functions.ids import doc_id, sha256_hex
from docindex.operators.changes import CHANGED, DELETED, NEW, UNCHANGED, classify_changes
from docindex.operators.chunks import chunk_docs
from docindex.operators.documents import drop_empty, normalize_docs
from docindex.operators.sizes import KEY_ROW_BYTES
from docindex.operators.tables import keep_keys
from docindex.schemas import EMBEDDINGS, conform
from docindex.sources.scratch import scratch_path

MODEL = "stub"
VERSION = "1"
NEXT_VERSION = "2"
STUB_DIMENSION = 8


def stub_vector(text_hash: Column) -> Column:
    """``HashEmbedder`` as a column expression over the text's SHA-256."""

    def fraction(i: int) -> Column:
        digits = F.substring(text_hash, i * 4 + 1, 4)
        return (F.conv(digits, 16, 10).cast("int") / 65536.0).cast("float")

    return F.array(*[fraction(i) for i in range(STUB_DIMENSION)])


def stub_embeddings(chunks: DataFrame, version: str = VERSION) -> DataFrame:
    """A vector for every chunk, without a Python step."""
    rows = chunks.select(
        "chunkId",
        "docId",
        stub_vector(F.col("chunkContentHash")).alias("embedding"),
        F.lit(MODEL).alias("embedder"),
        F.lit(version).alias("embedderVersion"),
        "chunkContentHash",
    )
    return conform(rows, EMBEDDINGS)


def vector_codes(embedding: Column) -> Column:
    """A stub vector as text, exact in every engine."""
    return F.array_join(F.transform(embedding, lambda x: (x * 65536).cast("int").cast("string")), ",")


class Scenario:
    """Base relations over one data folder.

    What a run would have at hand as a table is written once and read back:
    the changes between the two states, what is new of a table before it is merged,
    and with ``staged`` the normalised documents, for queries that use their text
    several times.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, staged: bool = False) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.staged = staged

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path, compression="zstd")
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def corpus(self) -> DataFrame:
        """``(uri, rawText)`` of the documents."""
        return self.table("documents").select(
            F.concat(F.lit("doc://"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("uri"),
            F.col("text").alias("rawText"),
        )

    @cached_property
    def current(self) -> DataFrame:
        docs = drop_empty(normalize_docs(self.corpus))
        return self.written(docs, "docs") if self.staged else docs

    @cached_property
    def previous(self) -> DataFrame:
        number = F.substring_index("uri", "/", -1).cast("bigint")
        digit = number % 10

        def version(uri: Column, text: Column) -> Column:
            return F.struct(uri.alias("uri"), text.alias("text"))

        uri, text = F.col("uri"), F.col("text")
        gone = F.concat(F.lit("doc://gone/"), number.cast("string"))
        states = (
            F.when(digit == 0, F.array().cast("array<struct<uri:string,text:string>>"))
            .when(digit == 1, F.array(version(uri, F.concat(text, F.lit(" superseded revision")))))
            .when(digit == 2, F.array(version(uri, text), version(gone, text)))
            .when(digit == 3, F.array(version(uri, F.concat(F.lit("#"), F.substr(text, F.lit(2))))))
            .otherwise(F.array(version(uri, text)))
        )
        rows = self.current.select(F.explode(states).alias("d")).select("d.*")
        return rows.select(
            "uri",
            "text",
            doc_id(F.col("uri")).alias("docId"),
            sha256_hex(F.col("text")).alias("contentHash"),
        )

    @cached_property
    def chunks(self) -> DataFrame:
        return chunk_docs(self.current)

    @cached_property
    def previous_chunks(self) -> DataFrame:
        return chunk_docs(self.previous)

    @cached_property
    def previous_embeddings(self) -> DataFrame:
        return stub_embeddings(self.previous_chunks)

    @cached_property
    def changes(self) -> DataFrame:
        changes = classify_changes(self.current, self.previous)
        return self.written(changes.filter(F.col("status") != UNCHANGED), "changes")

    @cached_property
    def changed_keys(self) -> DataFrame:
        return self.changes.filter(F.col("status").isin(NEW, CHANGED)).select("docId")

    @cached_property
    def deleted_keys(self) -> DataFrame:
        return self.changes.filter(F.col("status") == DELETED).select("docId")

    @cached_property
    def n_changed(self) -> int:
        return self.changed_keys.count()

    @cached_property
    def n_deleted(self) -> int:
        return self.deleted_keys.count()

    @cached_property
    def changed(self) -> DataFrame:
        """The new and changed documents."""
        return keep_keys(self.current, self.changed_keys, ["docId"], self.n_changed)

    @cached_property
    def changed_chunks(self) -> DataFrame:
        return self.written(chunk_docs(self.changed), "chunks")

    def address_bytes(self) -> int:
        """A bound on the size of the documents' ids and addresses."""
        widest = F.octet_length("uri") + KEY_ROW_BYTES
        return self.corpus.agg(F.coalesce(F.sum(widest), F.lit(0)).alias("n")).first()["n"]
