"""What changed between the stored documents and the current corpus.

All joins are on ``docId``, unique on both sides, and carry keys and hashes
only: no text is shuffled and no key can be hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEW = "new"
CHANGED = "changed"
UNCHANGED = "unchanged"
DELETED = "deleted"
# Scanned, but no text came out of it: never indexed so far, or kept at its last
# good version.
FAILED = "failed"
KEPT = "kept"
# Kept, and cut again from its stored text.
RECUT = "recut"
# Not touched itself, but its missing vectors are there now.
COMPLETED = "completed"


def new_or_changed(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``current`` without a stored row of the same id and content."""
    keys = ["docId", "contentHash"]
    return current.join(stored.select(*keys), keys, "left_anti")


def deleted(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``stored`` whose document is not in ``current``."""
    return stored.join(current.select("docId"), "docId", "left_anti")


def classify_changes(current: DataFrame, stored: DataFrame) -> DataFrame:
    """``(docId, uri, status)`` for every document on either side, in one join.

    ``current`` has ``docId, uri, contentHash`` and may have ``readable`` (false
    where extraction failed), ``empty`` (true where there is no text to index: a
    stored version goes) and ``same`` (true where a stored document is known not to
    have changed, whatever the hash); ``stored`` has ``docId, uri, contentHash``.
    """
    readable = F.col("readable") if "readable" in current.columns else F.lit(True)
    empty = F.col("empty") if "empty" in current.columns else F.lit(False)
    same = F.col("same") if "same" in current.columns else F.lit(False)
    now = current.select(
        "docId",
        same.alias("_same"),
        F.lit(True).alias("_now"),
        empty.alias("_empty"),
        F.col("uri").alias("_now_uri"),
        F.col("contentHash").alias("_now_hash"),
        readable.alias("_readable"),
    )
    before = stored.select(
        "docId", F.lit(True).alias("_old"), F.col("uri").alias("_old_uri"), F.col("contentHash").alias("_old_hash")
    )
    status = (
        F.when(F.col("_now").isNull(), DELETED)
        .when(~F.col("_readable"), F.when(F.col("_old").isNull(), FAILED).otherwise(KEPT))
        .when(F.col("_empty"), F.when(F.col("_old").isNull(), FAILED).otherwise(DELETED))
        .when(F.col("_old").isNull(), NEW)
        .when(F.col("_same") | (F.col("_now_hash") == F.col("_old_hash")), UNCHANGED)
        .otherwise(CHANGED)
    )
    return now.join(before, "docId", "full_outer").select(
        "docId", F.coalesce("_now_uri", "_old_uri").alias("uri"), status.alias("status")
    )


def rebuild_needed(new_or_changed, deleted, backlog):
    """The publish gate, of columns or of numbers: is there anything a reader would see?"""
    return (new_or_changed > 0) | (deleted > 0) | (backlog > 0)
