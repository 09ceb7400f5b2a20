"""Upserts and deletes as DataFrame operators.

Each takes the table as it is and returns the table as it should be; the caller
writes the result to a new place. Keys compare with ``=``: a NULL key matches
nothing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docindex.operators.sizes import BROADCAST_ROWS, small_side
from docindex.sources.scratch import written


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, failing at run time if two rows share a key.

    The check is one scalar subquery over the key columns, aggregated before its
    shuffle. NULL keys match nothing and may repeat.
    """
    per_key = df.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    most = per_key.agg(F.max("_n").alias("_most")).scalar()
    message = F.lit(f"more than one source row for the same {', '.join(keys)}")
    return df.filter(F.when(most > 1, F.raise_error(message).cast("boolean")).otherwise(True))


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    *,
    update: Mapping[str, Column] | None = None,
    update_when: Column | None = None,
    insert: Mapping[str, Column] | None = None,
    source_rows: int | None = None,
    unique_source: bool = False,
    compare: list[str] | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """MERGE: update the matched rows of ``target``, insert the unmatched ones.

    ``update`` maps target columns to expressions over ``target.*`` and
    ``source.*`` (default: all columns from the source), applied where
    ``update_when`` is true (NULL is not true). ``insert`` maps columns to
    expressions over ``source.*`` (default: all columns). Two source rows with
    one key are an error unless ``unique_source`` vouches for them.

    With ``source_rows`` (a known count) within ``limit``, the source's keys are
    broadcast to part the target's matched rows from the others: only the matched
    ones are joined, the others are read and passed on without a shuffle.
    Otherwise one full outer join does it.

    ``compare`` names the columns that ``update_when`` reads. With it, and whole rows
    from the source, the merge takes two phases: a join of keys and these columns
    alone finds what to do, and is written; one pass over each side then takes the
    rows by its few keys. No other column is shuffled.
    """
    if compare is not None:
        if update is not None or insert is not None or update_when is None:
            raise ValueError("compare goes with update_when and whole rows")
        return _merge_by_keys(target, source, keys, update_when, compare, unique_source, limit)
    # The rows are checked where they enter the result, their keys need not be.
    rows = source if unique_source else require_unique(source, keys)
    if update is None and update_when is None and insert is None:
        others = delete_keys(target, source, keys, source_rows, limit)
        return others.unionByName(rows.select(*target.columns))
    if source_rows is not None and source_rows <= limit:
        matched = keep_keys(target, source, keys, source_rows, limit)
        others = delete_keys(target, source, keys, source_rows, limit)
        return others.unionByName(_outer_merge(matched, rows, keys, update, update_when, insert))
    return _outer_merge(target, rows, keys, update, update_when, insert)


def _merge_by_keys(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_when: Column,
    compare: list[str],
    unique_source: bool,
    limit: int,
) -> DataFrame:
    changed, n, fresh = rows_to_merge(target, source, keys, update_when, compare, unique_source, limit)
    return delete_keys(target, changed, keys, n, limit).unionByName(fresh.select(*target.columns))


def rows_to_merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_when: Column,
    compare: list[str],
    unique_source: bool = False,
    limit: int = BROADCAST_ROWS,
) -> tuple[DataFrame, int, DataFrame]:
    """The keys that a merge updates or inserts, their number, and the source's rows of
    them with those of NULL keys."""
    names = list(dict.fromkeys([*keys, *compare]))
    narrow = source.select(*names)
    left = (narrow if unique_source else require_unique(narrow, keys)).alias("source")
    right = target.select(*names).withColumn("_present", F.lit(True)).alias("target")
    on = [F.col(f"source.{k}") == F.col(f"target.{k}") for k in keys]
    acts = F.col("target._present").isNull() | F.coalesce(update_when, F.lit(False))
    changed = left.join(right, on, "left").filter(acts).select(*[F.col(f"source.{k}").alias(k) for k in keys])
    changed = written(changed, "merge-keys")
    n = changed.count()
    nameless = F.lit(False)
    for k in keys:  # match nothing, not even themselves
        nameless = nameless | F.col(k).isNull()
    return changed, n, keep_keys(source, changed, keys, n, limit).unionByName(source.filter(nameless))


def _outer_merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: Mapping[str, Column] | None,
    update_when: Column | None,
    insert: Mapping[str, Column] | None,
) -> DataFrame:
    columns = target.columns
    whole_row = {c: F.col(f"source.{c}") for c in columns}
    update = whole_row if update is None else update
    insert = whole_row if insert is None else insert
    unknown = (set(update) | set(insert)) - set(columns)
    if unknown:
        raise ValueError(f"not columns of the target: {sorted(unknown)}")

    in_target = F.col("target._present").isNotNull()
    updates = F.col("source._present").isNotNull()
    if update_when is not None:
        updates = updates & F.coalesce(update_when, F.lit(False))

    def value(field) -> Column:
        old = F.col(f"target.{field.name}")
        if field.name in update:
            old = F.when(updates, update[field.name]).otherwise(old)
        new = insert.get(field.name, F.lit(None))
        return F.when(in_target, old).otherwise(new).cast(field.dataType).alias(field.name)

    left = target.withColumn("_present", F.lit(True)).alias("target")
    right = source.withColumn("_present", F.lit(True)).alias("source")
    on = [F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys]
    return left.join(right, on, "full_outer").select(*[value(f) for f in target.schema.fields])


def delete_keys(
    target: DataFrame,
    keys: DataFrame,
    on: list[str],
    n_keys: int | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows of ``target`` whose ``on`` columns are not among ``keys``."""
    return target.join(small_side(keys.select(*on), n_keys, limit), on, "left_anti")


def keep_keys(
    target: DataFrame,
    keys: DataFrame,
    on: list[str],
    n_keys: int | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows of ``target`` whose ``on`` columns are among ``keys``."""
    return target.join(small_side(keys.select(*on), n_keys, limit), on, "left_semi")


def replace_groups(
    target: DataFrame,
    source: DataFrame,
    groups: DataFrame,
    on: list[str],
    n_groups: int | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """All rows of ``groups`` taken from ``source`` instead of ``target``.

    ``groups`` is separate from ``source`` because a group may have no row left.
    """
    others = delete_keys(target, groups, on, n_groups, limit)
    return others.unionByName(source.select(*target.columns))


def cascade_delete(
    keys: DataFrame,
    tables: Mapping[str, DataFrame],
    on: list[str],
    n_keys: int | None = None,
    limit: int = BROADCAST_ROWS,
) -> dict[str, DataFrame]:
    """The same keys removed from every table given; absent tables are left out."""
    return {name: delete_keys(t, keys, on, n_keys, limit) for name, t in tables.items()}
