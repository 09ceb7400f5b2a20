"""Deterministic identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)


def doc_id(uri: Column) -> Column:
    """A document is its address: moving it makes a new document."""
    return sha256_hex(uri)


def chunk_id(doc: Column, start: Column, end: Column) -> Column:
    """A chunk is its position in a document, whatever its text."""
    return sha256_hex(F.concat_ws("_", doc, start.cast("string"), end.cast("string")))
