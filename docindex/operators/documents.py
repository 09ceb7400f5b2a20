"""Raw files to normalised, hashed documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docindex.functions.ids import doc_id, sha256_hex
from docindex.functions.text import html_to_text, normalize

# Fixed value: characters of text that an extracting task gathers before it hands them on.
PART_BYTES = 1 << 20

RAW_TEXT = T.StructType(
    [T.StructField("uri", T.StringType()), T.StructField("rawText", T.StringType())]
)
RAW_TEXT_OR_ERROR = T.StructType([*RAW_TEXT.fields, T.StructField("error", T.StringType())])


def extract_html(pages: DataFrame, uri: str = "uri", html: str = "html") -> DataFrame:
    """``(uri, rawText)`` of HTML documents, with column expressions only."""
    return pages.select(F.col(uri).alias("uri"), html_to_text(F.col(html)).alias("rawText"))


def extract_with(
    files: DataFrame,
    extractor: Callable[[bytes], str],
    uri: str = "uri",
    content: str = "content",
    reasons: bool = False,
) -> DataFrame:
    """``(uri, rawText)`` through a user's ``bytes -> text`` function; with ``reasons``
    also ``error``, which says why there is no text.

    The function never fails a job: any exception, and any result that is not a
    string, becomes NULL, unlike the empty text of an empty document. Batches are bounded in bytes by Spark's
    ``spark.sql.execution.arrow.maxBytesPerBatch``, and handed back in parts of about
    ``PART_BYTES``, so that a task holds few texts besides the batch itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, texts, errors, held = 0, [], [], 0
            for i, value in enumerate(batch.column(1)):
                try:
                    text, error = extractor(value.as_py()), None
                except Exception as exc:
                    text, error = None, f"{type(exc).__name__}: {exc}"
                if error is None and not isinstance(text, str):
                    text, error = None, f"{type(text).__name__} instead of a text"
                texts.append(text)
                errors.append(error)
                held += len(text or "")
                if held >= PART_BYTES or i + 1 == batch.num_rows:
                    uris = batch.column(0).slice(start, len(texts))
                    columns = [uris, pa.array(texts, pa.string()), pa.array(errors, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns[: len(schema)], names=schema.fieldNames())
                    start, texts, errors, held = i + 1, [], [], 0

    schema = RAW_TEXT_OR_ERROR if reasons else RAW_TEXT
    narrow = files.select(F.col(uri).alias("uri"), F.col(content).alias("content"))
    return narrow.mapInArrow(run, schema)


def normalize_docs(raw: DataFrame, engine: str = "jvm", carry: Sequence[str] = ()) -> DataFrame:
    """``(uri, rawText)`` to ``(uri, text, docId, contentHash)``, blanks included, and
    the columns ``carry`` as they are."""
    return raw.select("uri", normalize(F.col("rawText"), engine).alias("text"), *carry).select(
        "uri",
        "text",
        doc_id(F.col("uri")).alias("docId"),
        sha256_hex(F.col("text")).alias("contentHash"),
        *carry,
    )


def drop_empty(docs: DataFrame) -> DataFrame:
    """Without documents whose text is empty or missing."""
    return docs.filter(F.col("text") != "")
