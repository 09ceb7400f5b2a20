"""The operators as queries over the given tables.

``docindex.llm.oracles`` has the same results in SQL where SQL can express them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docindex.llm.alignment import align
from docindex.llm.collocations import collocations, top_collocations
from docindex.llm.common import table
from docindex.llm.decontamination import benchmark_hits, n_hit
from docindex.llm.near_dups import near_duplicates
from docindex.llm.neighbours import nearest
from docindex.llm.packing import pack
from docindex.llm.pii import BASE_KINDS, find_personal_data, joined, number_of
from docindex.llm.quality import quality_scores
from docindex.llm.rules import quality_rules
from docindex.llm.sampling import sample_pieces
from docindex.llm.sharding import shard_by_bytes
from docindex.llm.substrings import remove_repeats
from docindex.llm.token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, num=85, den=100)
    return found.select(
        F.col("doc").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"),
    )


@query
def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(table(spark, sf_dir, "documents"), size=20)
    return left.select(
        F.col("doc").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"))
    return judged.select(
        F.col("doc").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        F.col("doc").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("doc").alias("doc_id"),
        *[number_of(F.col("base"), kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_by_bytes(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        F.col("doc").alias("doc_id"),
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_scores(documents, labels.filter(~held_out))
    return scored.select(
        F.col("doc").alias("doc_id"),
        F.coalesce(F.crc32(F.col("doc").cast("string").cast("binary")) % 4 == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    sampled = sample_pieces(table(spark, sf_dir, "documents"))
    return sampled.select(
        F.col("doc").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_ids"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(table(spark, sf_dir, "documents"))
    return counted.select(F.col("doc").alias("doc_id"), "pre_tokens", "tokens")


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(table(spark, sf_dir, "documents"))
    return aligned.select(
        F.col("doc").alias("doc_id"),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"),
    )


@query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("doc").alias("doc_id"),
        "n_words",
        n_hit(F.col("spans")).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = top_collocations(collocations(table(spark, sf_dir, "documents")))
    return phrases.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
