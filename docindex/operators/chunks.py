"""Sliding-window chunks of documents."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docindex.config import DEFAULT_CHUNK_OVERLAP, DEFAULT_CHUNK_SIZE, check_window
from docindex.functions.ids import chunk_id, sha256_hex

def chunk_docs(
    docs: DataFrame,
    size: int = DEFAULT_CHUNK_SIZE,
    overlap: int = DEFAULT_CHUNK_OVERLAP,
    carry: Sequence[str] = (),
    spread: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Windows of ``size`` characters starting every ``size - overlap`` characters.

    Takes ``docId, text``, and columns ``carry`` to hand on to every chunk. A window starts wherever text is left, so the last one
    may lie inside its predecessor. Empty or missing text gives no row. Offsets
    count Unicode code points. No shuffle, no Python.

    Finding a position in UTF-8 text means scanning from its start, so windows are
    not cut from the whole document but from blocks of it. With as many windows to
    a block as there are blocks, both steps scan the text about
    ``sqrt(windows) / 2`` times instead of ``windows / 2`` times. ``spread`` may deal
    out the blocks, which have ``docId`` and their position ``_b``.
    """
    check_window(size, overlap)
    stride = size - overlap

    sized = docs.select("docId", *carry, "text", F.length("text").alias("_n"))
    per_block = F.ceil(F.sqrt(F.col("_n") / stride)).cast("int")
    sized = sized.select("docId", *carry, "text", "_n", (per_block * stride).alias("_step"))
    blocks = sized.select(
        "docId",
        *carry,
        "text",
        "_n",
        "_step",
        F.explode(
            F.when(F.col("_n") > 0, F.sequence(F.lit(0), F.col("_n") - 1, F.col("_step")))
        ).alias("_b"),
    ).select(
        "docId",
        *carry,
        "_n",
        "_step",
        "_b",
        F.substring(F.col("text"), F.col("_b") + 1, F.col("_step") + overlap).alias("_block"),
    )
    if spread is not None:
        blocks = spread(blocks)
    last = F.least(F.col("_n"), F.col("_b") + F.col("_step")) - 1
    windows = blocks.select(
        "docId",
        *carry,
        "_n",
        "_b",
        "_block",
        F.explode(F.sequence(F.col("_b"), last, F.lit(stride))).alias("startOffset"),
    )
    start = F.col("startOffset")
    end = F.least(start + size, F.col("_n"))
    text = F.substring(F.col("_block"), start - F.col("_b") + 1, F.lit(size))
    return windows.select(
        "docId",
        chunk_id(F.col("docId"), start, end).alias("chunkId"),
        text.alias("chunkText"),
        "startOffset",
        end.alias("endOffset"),
        sha256_hex(text).alias("chunkContentHash"),
        *carry,
    )
