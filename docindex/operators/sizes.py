"""Broadcast only what is known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docindex.config import IndexConfig

BROADCAST_ROWS = IndexConfig.broadcast_rows

# A row of keys: up to three 64-character identities and the space a hash table
# takes for them.
KEY_ROW_BYTES = 300


def small_side(df: DataFrame, rows: int | None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A frame of keys with a broadcast hint if its known row count allows.

    Without a count, or beyond the limit, the frame is returned as it is: Spark
    then decides from its own size estimate and shuffles if in doubt.
    """
    if rows is not None and rows <= limit:
        return F.broadcast(df)
    return df


def key_rows(size_in_bytes: int) -> int:
    """Wider rows counted in rows of keys, to compare with the same limit."""
    return -(-size_in_bytes // KEY_ROW_BYTES)
