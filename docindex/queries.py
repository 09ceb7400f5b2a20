"""Every operator as a query over the given tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables; ``docindex.oracles`` has the same results in SQL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docindex.config import BY_CONTENT, BY_ID, IndexConfig
from docindex.embedders import HashEmbedder
from docindex.extractors import utf8_text
from docindex.functions.text import html_to_text, normalize
from docindex.operators.changes import classify_changes, deleted, new_or_changed, rebuild_needed
from docindex.operators.chunks import chunk_docs
from docindex.operators.documents import drop_empty, extract_html, extract_with, normalize_docs
from docindex.operators.embed import (
    backlog,
    embed_chunks,
    errors_of,
    is_valid_vector,
    of_version,
    vectors_of,
)
from docindex.operators.index import retrieval_index
from docindex.operators.metrics import change_counts, document_metrics
from docindex.operators.tables import cascade_delete, keep_keys, merge_upsert, replace_groups
from docindex.plans.increment import index_directory, run_increment
from docindex.plans.scenario import (
    MODEL,
    NEXT_VERSION,
    STUB_DIMENSION,
    VERSION,
    Scenario,
    stub_embeddings,
    vector_codes,
)
from docindex.sources.bucket_table import BucketTable
from docindex.sources.files import scan_binary
from docindex.sources.scratch import scratch_path
from docindex.sources.store import IndexStore

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


# -- scans, text, documents ------------------------------------------------


@query("binary_scan")
def binary_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to files of two suffixes; those of one suffix read as bytes."""
    pages = Scenario(spark, sf_dir).table("pages").select("url", "html")
    folder = scratch_path(spark, "pages")
    # A file is one row of the scan: keep each small.
    pages.write.option("maxRecordsPerFile", 500).json(f"{folder}/json")
    pages.select("url").write.text(f"{folder}/txt")
    files = scan_binary(spark, folder, "*.json", recursive=True)
    lines = F.split(F.decode("content", "UTF-8"), "\n")
    rows = files.select(F.explode(F.filter(lines, lambda x: x != "")).alias("line"))
    page = F.from_json("line", "url string, html string")
    return rows.select(page.alias("p")).select("p.url", F.sha2("p.html", 256).alias("html_sha256"))


@query("extract_text")
def extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = Scenario(spark, sf_dir).table("pages")
    return drop_empty(normalize_docs(extract_html(pages, uri="url"))).select("uri", "text")


class StrictText:
    """An extractor that cannot read French pages."""

    def __call__(self, content: bytes) -> str:
        if b'lang="fr"' in content:
            raise ValueError("French")
        return utf8_text(content)


@query("extract_with_failures")
def extract_with_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes through a user's extractor; what it cannot read is dropped."""
    pages = Scenario(spark, sf_dir).table("pages")
    files = pages.select("url", F.encode("html", "UTF-8").alias("content"))
    raw = extract_with(files, StrictText(), uri="url")
    raw = raw.select("uri", html_to_text(F.col("rawText")).alias("rawText"))
    return drop_empty(normalize_docs(raw)).select("uri", "docId", "contentHash")


@query("normalize_text")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = Scenario(spark, sf_dir).table("documents")
    return documents.select("doc_id", normalize(F.col("text")).alias("text"))


@query("normalize_text_arrow")
def normalize_text_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = Scenario(spark, sf_dir).table("documents")
    return documents.select("doc_id", normalize(F.col("text"), "arrow").alias("text"))


@query("normalize_composed_text")
def normalize_composed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that need all of it: accents as characters of their own, blanks of every
    kind at both ends and inside."""
    text = F.replace(F.replace("text", F.lit("é"), F.lit("e\u0301")), F.lit(" "), F.lit(" \t"))
    text = F.concat(F.lit("\r\n\x0b"), text, F.lit(" \f\n"))
    documents = Scenario(spark, sf_dir).table("documents")
    return documents.select("doc_id", normalize(text).alias("text"))


@query("normalize_docs")
def normalize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_docs(Scenario(spark, sf_dir).corpus)


@query("drop_empty_docs")
def drop_empty_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document next to a blank and a missing sibling."""
    blank = F.lit(" \t\r\n ")
    variants = F.array(
        F.struct(F.col("uri"), F.col("rawText")),
        F.struct(F.concat("uri", F.lit("/blank")).alias("uri"), blank.alias("rawText")),
        F.struct(F.concat("uri", F.lit("/missing")).alias("uri"), F.lit(None).cast("string").alias("rawText")),
    )
    raw = Scenario(spark, sf_dir).corpus.select(F.explode(variants).alias("v")).select("v.*")
    return drop_empty(normalize_docs(raw)).select("uri", "docId")


# -- changes ---------------------------------------------------------------


@query("detect_new_or_changed")
def detect_new_or_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Scenario(spark, sf_dir)
    return new_or_changed(s.current, s.previous).select("docId", "contentHash", "uri")


@query("detect_deleted")
def detect_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Scenario(spark, sf_dir)
    return deleted(s.current, s.previous).select("docId", "uri")


@query("classify_changes")
def classify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Scenario(spark, sf_dir)
    return classify_changes(s.current, s.previous)


# -- chunks ----------------------------------------------------------------


@query("chunk_docs")
def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Scenario(spark, sf_dir).chunks


@query("chunk_docs_small")
def chunk_documents_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_docs(Scenario(spark, sf_dir).current, size=50, overlap=20)


# -- deletes and upserts ---------------------------------------------------


def _cascade(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    s = Scenario(spark, sf_dir)
    tables = {"docs": s.previous, "chunks": s.previous_chunks, "embeddings": s.previous_embeddings}
    return cascade_delete(s.deleted_keys, tables, ["docId"], s.n_deleted)[name]


@query("cascade_delete_docs")
def cascade_delete_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cascade(spark, sf_dir, "docs").select("docId", "uri")


@query("cascade_delete_chunks")
def cascade_delete_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cascade(spark, sf_dir, "chunks").select("docId", "chunkId")


@query("cascade_delete_embeddings")
def cascade_delete_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cascade(spark, sf_dir, "embeddings").select("docId", "chunkId", "embedder", "embedderVersion")


@query("merge_docs")
def merge_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update where the hash differs, insert what is new."""
    s = Scenario(spark, sf_dir, staged=True)
    differs = F.col("target.contentHash") != F.col("source.contentHash")
    return merge_upsert(
        s.previous, s.changed, ["docId"], update_when=differs, source_rows=s.n_changed
    )


@query("merge_all_docs")
def merge_all_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the whole corpus: equal hashes are left alone."""
    s = Scenario(spark, sf_dir, staged=True)
    differs = F.col("target.contentHash") != F.col("source.contentHash")
    return merge_upsert(s.previous, s.current, ["docId"], update_when=differs, compare=["contentHash"])


@query("merge_chunks")
def merge_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update-all, insert-all: old windows of a shortened document remain."""
    s = Scenario(spark, sf_dir, staged=True)
    fresh = s.changed_chunks
    return merge_upsert(s.previous_chunks, fresh, ["chunkId"], source_rows=fresh.count())


@query("merge_embeddings")
def merge_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite key; only the vector and its provenance are updated."""
    s = Scenario(spark, sf_dir, staged=True)
    todo = backlog(s.chunks, s.previous_embeddings, MODEL, VERSION)
    fresh = s.written(stub_embeddings(todo), "embeddings")
    updated = ("embedding", "docId", "chunkContentHash")
    merged = merge_upsert(
        s.previous_embeddings,
        fresh,
        ["chunkId", "embedder", "embedderVersion"],
        update={c: F.col(f"source.{c}") for c in updated},
        insert={c: F.col(f"source.{c}") for c in s.previous_embeddings.columns},
        source_rows=fresh.count(),
    )
    return _with_codes(merged)


@query("replace_changed_chunks")
def replace_changed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A changed document's whole chunk set is replaced: no old window remains."""
    s = Scenario(spark, sf_dir, staged=True)
    return replace_groups(
        s.previous_chunks, chunk_docs(s.changed), s.changed_keys, ["docId"], s.n_changed
    )


@query("purge_orphan_embeddings")
def purge_orphan_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored vectors whose chunk still has the text they were made from."""
    s = Scenario(spark, sf_dir)
    kept = keep_keys(s.previous_embeddings, s.chunks, ["chunkId", "chunkContentHash"])
    return kept.select("chunkId", "chunkContentHash", "embedderVersion")


# -- stored tables -----------------------------------------------------------


@query("stored_merge_docs")
def stored_merge_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table brought up to date in place: documents that differ or are new
    are merged, those that are gone deleted."""
    s = Scenario(spark, sf_dir, staged=True)
    table = BucketTable(spark, scratch_path(spark, "table"), "docId")
    table.overwrite(s.previous)
    differs = F.col("target.contentHash") != F.col("source.contentHash")
    table.merge(s.current, ["docId"], update_when=differs, compare=["contentHash"])
    table.delete(s.deleted_keys, ["docId"])
    return table.read()


@query("stored_merge_embeddings")
def stored_merge_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of a second version merged by a composite key into a table bucketed by
    chunk; then those of deleted documents removed by a column that is not the
    bucket's."""
    s = Scenario(spark, sf_dir, staged=True)
    table = BucketTable(spark, scratch_path(spark, "table"), "chunkId")
    table.overwrite(s.previous_embeddings)
    keys = ["chunkId", "embedder", "embedderVersion"]
    table.merge(stub_embeddings(s.changed_chunks, NEXT_VERSION), keys, unique_source=True)
    table.delete(s.deleted_keys, ["docId"])
    return _with_codes(table.read())


@query("stored_added_column")
def stored_added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge whose source has a column the table lacks: NULL in all other rows."""
    s = Scenario(spark, sf_dir, staged=True)
    table = BucketTable(spark, scratch_path(spark, "table"), "docId")
    table.overwrite(s.previous)
    table.merge(s.changed.withColumn("nChars", F.length("text")), ["docId"])
    return table.read().select("docId", "contentHash", "nChars")


@query("merge_all_docs_narrow")
def merge_all_docs_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge of the whole corpus by keys and hashes, over a source with NULL keys:
    they match nothing and are inserted."""
    s = Scenario(spark, sf_dir, staged=True)
    nobody = s.current.filter(F.col("contentHash") < "1").withColumn("docId", F.lit(None).cast("string"))
    differs = F.col("target.contentHash") != F.col("source.contentHash")
    merged = merge_upsert(
        s.previous, s.current.unionByName(nobody), ["docId"], update_when=differs, compare=["contentHash"]
    )
    return merged.select("docId", "uri", "contentHash")


# -- vectors ---------------------------------------------------------------


def _with_codes(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(
        "chunkId",
        "docId",
        "chunkContentHash",
        vector_codes(F.col("embedding")).alias("vector"),
        "embedder",
        "embedderVersion",
    )


@query("embed_backlog_by_id")
def embed_backlog_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of this run's documents without any vector under their id."""
    s = Scenario(spark, sf_dir, staged=True)
    return backlog(s.changed_chunks, s.previous_embeddings, MODEL, VERSION, BY_ID).select("chunkId", "docId")


@query("embed_backlog_by_content")
def embed_backlog_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Scenario(spark, sf_dir)
    return backlog(s.chunks, s.previous_embeddings, MODEL, VERSION).select("chunkId", "docId")


@query("embed_backlog_version_bump")
def embed_backlog_version_bump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No stored vector is of the new version, though the table holds two others."""
    s = Scenario(spark, sf_dir, staged=True)
    vectors = s.written(_two_versions(s), "embeddings")
    return backlog(s.chunks, vectors, MODEL, "3").select("chunkId", "docId")


@query("embed_chunks")
def embed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = Scenario(spark, sf_dir).chunks
    attempts = embed_chunks(
        chunks, HashEmbedder(STUB_DIMENSION), MODEL, VERSION, dimension=STUB_DIMENSION
    )
    return _with_codes(vectors_of(attempts))


class FlakyEmbedder:
    """Gives no vector for a text whose hash starts with 0 and raises on 1."""

    def __call__(self, texts: Sequence[str], model: str) -> list[list[float]]:
        digests = [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in texts]
        if any(d.startswith("1") for d in digests):
            raise TimeoutError("no answer")
        vectors = HashEmbedder(STUB_DIMENSION)(texts, model)
        return [[] if d.startswith("0") else v for d, v in zip(digests, vectors)]


@query("embed_errors")
def embed_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = Scenario(spark, sf_dir).chunks
    attempts = embed_chunks(chunks, FlakyEmbedder(), MODEL, VERSION, dimension=STUB_DIMENSION)
    return errors_of(attempts).select("chunkId", "textPrefix", "error")


def _two_versions(s: Scenario) -> DataFrame:
    return merge_upsert(
        s.previous_embeddings,
        stub_embeddings(s.chunks, NEXT_VERSION),
        ["chunkId", "embedder", "embedderVersion"],
        unique_source=True,  # a chunk id holds document and position
    )


@query("embeddings_current_version")
def embeddings_current_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of two versions that a written table holds."""
    s = Scenario(spark, sf_dir, staged=True)
    table = s.written(_two_versions(s), "embeddings")
    return _with_codes(of_version(table, MODEL, NEXT_VERSION))


@query("embeddings_multi_version")
def embeddings_multi_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _two_versions(Scenario(spark, sf_dir, staged=True))
    return table.groupBy("chunkId").agg(F.count(F.lit(1)).alias("versions"))


@query("vector_dim_check")
def vector_dim_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    embedding = F.col("embedding")
    return Scenario(spark, sf_dir).table("embeddings").select(
        "vec_id", F.size(embedding).alias("dim"), is_valid_vector(embedding, 64).alias("ok")
    )


@query("vector_check_failures")
def vector_check_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as it is, a component short, with one that is not finite, and missing."""
    embedding = F.col("embedding").cast("array<float>")
    damaged = F.array(
        F.struct(F.lit("whole").alias("kind"), embedding.alias("vector")),
        F.struct(F.lit("short").alias("kind"), F.slice(embedding, 2, 63).alias("vector")),
        F.struct(
            F.lit("nan").alias("kind"),
            F.concat(F.slice(embedding, 2, 63), F.array(F.lit(float("nan")).cast("float"))).alias("vector"),
        ),
        F.struct(F.lit("missing").alias("kind"), F.lit(None).cast("array<float>").alias("vector")),
    )
    rows = Scenario(spark, sf_dir).table("embeddings").select("vec_id", F.explode(damaged).alias("d"))
    return rows.select("vec_id", "d.kind", is_valid_vector(F.col("d.vector"), 64).alias("ok"))


# -- index, gate, metrics --------------------------------------------------


def _index(spark: SparkSession, sf_dir: str, reuse: str) -> DataFrame:
    s = Scenario(spark, sf_dir, staged=True)
    rows = retrieval_index(
        s.current,
        s.chunks,
        s.previous_embeddings,
        MODEL,
        VERSION,
        reuse,
        address_bytes=s.address_bytes(),
    )
    return _index_with_codes(rows)


def _index_with_codes(rows: DataFrame) -> DataFrame:
    return rows.select(
        "docId",
        "uri",
        "chunkId",
        "chunkText",
        "startOffset",
        "endOffset",
        vector_codes(F.col("embedding")).alias("vector"),
        "embedder",
        "embedderVersion",
    )


@query("retrieval_index_by_id")
def retrieval_index_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's documents and chunks with the vectors stored so far, by chunk id."""
    return _index(spark, sf_dir, BY_ID)


@query("retrieval_index")
def retrieval_index_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, without vectors of an earlier text."""
    return _index(spark, sf_dir, BY_CONTENT)


@query("noop_gate")
def noop_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Would a run publish: from the earlier state, and from an equal one?"""
    s = Scenario(spark, sf_dir, staged=True)

    def gate(name: str, stored: DataFrame, vectors: DataFrame) -> DataFrame:
        missing = backlog(s.chunks, vectors, MODEL, VERSION).agg(F.count(F.lit(1)))
        counts = change_counts(classify_changes(s.current, stored))
        processed = F.col("newDocs") + F.col("changedDocs")
        return counts.withColumn("backlog", missing.scalar()).select(
            F.lit(name).alias("stored"),
            processed.alias("newOrChanged"),
            "deletedDocs",
            "backlog",
            rebuild_needed(processed, F.col("deletedDocs"), F.col("backlog")).alias("rebuild"),
        )

    return gate("earlier", s.previous, s.previous_embeddings).unionByName(
        gate("equal", s.current, stub_embeddings(s.chunks))
    )


@query("run_metrics")
def change_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Scenario(spark, sf_dir, staged=True)
    missing = backlog(s.chunks, s.previous_embeddings, MODEL, VERSION).agg(F.count(F.lit(1)))
    metrics = document_metrics(change_counts(classify_changes(s.current, s.previous)))
    return metrics.withColumn("chunksEmbedded", missing.scalar())


# -- whole runs ------------------------------------------------------------


def _config(spark: SparkSession, **settings) -> IndexConfig:
    return IndexConfig(
        scratch_path(spark, "index"),
        model=MODEL,
        version=settings.pop("version", VERSION),
        dimension=STUB_DIMENSION,
        **settings,
    )


def _earlier_then_current(spark: SparkSession, sf_dir: str, reruns: int = 0, **settings):
    s = Scenario(spark, sf_dir)
    cfg = _config(spark, **settings)
    embedder = HashEmbedder(STUB_DIMENSION)
    earlier = s.previous.select("uri", F.col("text").alias("rawText"))
    reports = [run_increment(spark, cfg, earlier, embedder)]
    for _ in range(1 + reruns):
        reports.append(run_increment(spark, cfg, s.corpus, embedder))
    return IndexStore(spark, cfg.table_path), reports


@query("store_bootstrap")
def first_run_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty tables, then a first run: the stored documents."""
    s = Scenario(spark, sf_dir)
    cfg = _config(spark)
    IndexStore(spark, cfg.table_path).bootstrap()
    run_increment(spark, cfg, s.corpus, HashEmbedder(STUB_DIMENSION))
    return IndexStore(spark, cfg.table_path).docs()


@query("incremental_index")
def incremental_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index after an incremental run over the earlier state: what a full
    build of the current state would give."""
    store, _ = _earlier_then_current(spark, sf_dir)
    return _index_with_codes(store.retrieval_index())


@query("incremental_embeddings")
def incremental_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = _earlier_then_current(spark, sf_dir)
    return _with_codes(store.embeddings())


class NoVectorForSome:
    """Gives no vector for a text whose hash starts with 0."""

    def __call__(self, texts: Sequence[str], model: str) -> list[list[float]]:
        vectors = HashEmbedder(STUB_DIMENSION)(texts, model)
        return [[] if hashlib.sha256(t.encode("utf-8")).hexdigest().startswith("0") else v for t, v in zip(texts, vectors)]


@query("incremental_outage")
def incremental_outage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index after a run in which some chunks got no vector: edited documents with
    such a chunk are served as they were before."""
    s = Scenario(spark, sf_dir)
    cfg = _config(spark)
    earlier = s.previous.select("uri", F.col("text").alias("rawText"))
    run_increment(spark, cfg, earlier, HashEmbedder(STUB_DIMENSION))
    run_increment(spark, cfg, s.corpus, NoVectorForSome())
    return _index_with_codes(IndexStore(spark, cfg.table_path).retrieval_index())


@query("publish_roundtrip")
def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same index after its runs were folded into one and the folders of the
    superseded ones, which nobody else reads, removed."""
    store, _ = _earlier_then_current(spark, sf_dir)
    store.compact()
    store.expire(min_age_seconds=0)
    return _index_with_codes(store.retrieval_index())


def _page_files(spark: SparkSession, s: Scenario, name: str, pages: DataFrame) -> str:
    """Pages written as files, a few hundred in each."""
    folder = scratch_path(spark, name)
    rows = pages.select("url", F.sha2("html", 256).alias("hash")).orderBy("url")
    rows.write.option("maxRecordsPerFile", 200).json(f"{folder}/json")
    return folder


@query("incremental_files")
def incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same files: the first reads all, the second none. One row for
    each line of the files, from the stored documents."""
    s = Scenario(spark, sf_dir)
    folder = _page_files(spark, s, "files", s.table("pages"))
    cfg = _config(spark, corpus_path=folder, glob="*.json", recursive=True)
    for _ in range(2):
        report = index_directory(spark, cfg, HashEmbedder(STUB_DIMENSION), utf8_text)
    lines = IndexStore(spark, cfg.table_path).docs().select(F.explode(F.regexp_extract_all("text", F.lit('"hash":"([0-9a-f]+)"'))).alias("hash"))
    return lines.select("hash", F.lit(report.files_read).cast("bigint").alias("filesReadAgain"))


@query("extract_errors")
def extract_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose extraction fails, with the reason."""
    pages = Scenario(spark, sf_dir).table("pages")
    files = pages.select("url", F.encode("html", "UTF-8").alias("content"))
    raw = extract_with(files, StrictText(), uri="url", reasons=True)
    return raw.filter("error IS NOT NULL").select("uri", "error")


@query("run_history")
def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The committed runs: a first one, an incremental one, and no third for an
    unchanged corpus."""
    store, _ = _earlier_then_current(spark, sf_dir, reruns=1)
    return store.runs().filter("run > 0").select(
        "run",
        "liveDocs",
        "totalDocs",
        "newDocs",
        "changedDocs",
        "deletedDocs",
        "docsSkipped",
        "freshnessPct",
        "dedupPct",
        "chunksWritten",
        "chunksEmbedded",
        "chunksReused",
        "indexRowsWritten",
    )
