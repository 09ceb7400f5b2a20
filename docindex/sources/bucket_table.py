"""A stored table that merges and deletes in place, by hash buckets.

``<root>/data/<attempt>/bucket=<b>/`` holds what one write put into a bucket, whole.
``<root>/versions/<n>.json`` lists for every bucket the write that holds its rows, and
the table's columns. A change reads and rewrites the buckets its keys fall into;
the next version points to these and to the old files of all others.

A write goes to a folder of its own, so writers never mix rows. It becomes visible
as a whole when its version file appears, which only one writer can create: who
comes second is refused and has changed nothing. Columns may be added at any write;
rows written before have NULL there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docindex.config import IndexConfig
from docindex.operators.sizes import BROADCAST_ROWS
from docindex.operators.tables import delete_keys, merge_upsert, rows_to_merge
from docindex.sources.folder import Folder, WriteConflictError

BUCKET = "bucket"

# Rows that stay are written from where they lie if the files are at least this large.
LARGE_FILE = 1 << 20


class BucketTable:
    """One table below ``root``, bucketed by the hash of ``key``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        key: str,
        buckets: int = IndexConfig.buckets,
        broadcast_rows: int = BROADCAST_ROWS,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.folder = Folder(spark, self.root)
        self.key, self.buckets, self.broadcast_rows = key, buckets, broadcast_rows

    # -- versions --------------------------------------------------------------

    def versions(self) -> list[int]:
        """The numbers of the complete versions, oldest first."""
        return [n for n, text in self._version_files() if text is not None]

    def _version_files(self) -> list[tuple[int, dict | None]]:
        found = []
        for name in self.folder.names("versions"):
            if name.endswith(".json"):
                found.append((int(name.removesuffix(".json")), self.folder.read_json(f"versions/{name}")))
        return sorted(found, key=lambda x: x[0])

    def _version(self, number: int | None) -> dict | None:
        if number is not None:
            return self.folder.read_json(f"versions/{number:09d}.json")
        complete = [v for _, v in self._version_files() if v is not None]
        return complete[-1] if complete else None

    def exists(self) -> bool:
        return self._version(None) is not None

    def schema(self, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(self._required(version)["schema"])

    def _required(self, version: int | None) -> dict:
        found = self._version(version)
        if found is None:
            raise ValueError(f"no table at {self.root}" if version is None else f"no version {version} of {self.root}")
        return found

    def files(self, version: int | None = None) -> dict[int, str]:
        """The folder that holds each bucket with rows."""
        return self._files(self._required(version))

    def _files(self, version: dict) -> dict[int, str]:
        return {int(b): f"data/{a}/{BUCKET}={b}" for b, a in version["buckets"].items()}

    # -- reading ---------------------------------------------------------------

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a version, by default the newest; of some ``buckets`` only,
        no others are listed or opened."""
        return self._rows(self._required(version), buckets)

    def _rows(self, version: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(version["schema"])
        held = version["buckets"]
        wanted = held if buckets is None else [str(b) for b in buckets if str(b) in held]
        paths = [f"{self.root}/data/{held[b]}/{BUCKET}={b}" for b in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        # Files of an older schema lack its newer columns and give NULL there.
        return self.spark.read.schema(schema).parquet(*paths)

    def _bucket(self, value: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")

    def touched_buckets(self, keys: DataFrame, version: int | None = None) -> list[int]:
        """The buckets that rows with these keys fall into; at most their number."""
        n = self._required(version)["n"]
        return sorted(r[0] for r in keys.select(self._bucket(F.col(self.key), n)).distinct().collect() if r[0] is not None)

    # -- writing ---------------------------------------------------------------

    def overwrite(self, rows: DataFrame, evolve: bool = True) -> int:
        """The table's rows from now on; creates the table. Returns the version."""
        old = self._version(None)
        schema = _united(T.StructType.fromJson(old["schema"]), rows.schema) if old and evolve else rows.schema
        n = old["n"] if old else self.buckets
        attempt, written = self._write(rows, schema, n)
        return self._commit(old, schema, n, {str(b): attempt for b in written})

    def merge(
        self,
        source: DataFrame,
        keys: list[str],
        *,
        update: Mapping[str, Column] | None = None,
        update_when: Column | None = None,
        insert: Mapping[str, Column] | None = None,
        evolve: bool = True,
        unique_source: bool = False,
        compare: list[str] | None = None,
    ) -> int:
        """MERGE into the stored rows (see ``merge_upsert``). ``keys`` include the
        bucket key, so that matches lie in one bucket. With ``evolve``, columns that
        only the source has are added; without, they are left out. With ``compare``, the
        columns that ``update_when`` reads, these and the keys alone are joined, and
        buckets without a row to update or insert stay (see ``merge_upsert``)."""
        if self.key not in keys:
            raise ValueError(f"the keys of a merge must include {self.key!r}")
        old = self._required(None)
        before = T.StructType.fromJson(old["schema"])
        schema = _united(before, source.schema) if evolve else before
        source = _padded(source, schema)
        if compare is not None:
            if update is not None or insert is not None or update_when is None:
                raise ValueError("compare goes with update_when and whole rows")
            stored = _padded(self._rows(old), schema)
            changed, n, fresh = rows_to_merge(stored, source, keys, update_when, compare, unique_source, self.broadcast_rows)
            touched = self.touched_buckets(fresh)
            others = delete_keys(_padded(self._rows(old, touched), schema), changed, keys, n, self.broadcast_rows)
            return self._replace(old, schema, touched, fresh, others, n)
        touched = self.touched_buckets(source)
        merged = merge_upsert(
            _padded(self._rows(old, touched), schema),
            source,
            keys,
            update=update,
            update_when=update_when,
            insert=insert,
            unique_source=unique_source,
            limit=self.broadcast_rows,
        )
        return self._replace(old, schema, touched, merged)

    def delete(self, keys: DataFrame, on: list[str]) -> int:
        """Remove the rows whose ``on`` columns are among ``keys``. Without the bucket
        key in ``on``, the key columns alone are read to find the buckets."""
        old = self._required(None)
        if self.key in on:
            touched = self.touched_buckets(keys)
        else:
            found = self._rows(old).select(self.key, *on).join(keys.select(*on), on, "left_semi")
            touched = self.touched_buckets(found)
        schema = T.StructType.fromJson(old["schema"])
        n = keys.count()
        left = delete_keys(self._rows(old, touched), keys, on, n, self.broadcast_rows)
        return self._replace(old, schema, touched, None, left, n)

    def _replace(
        self,
        old: dict,
        schema: T.StructType,
        touched: list[int],
        rows: DataFrame | None,
        stay: DataFrame | None = None,
        n_keys: int = 0,
    ) -> int:
        """New contents of the touched buckets: ``rows``, and stored rows that ``stay``. The
        latter are not shuffled, unless the join with ``n_keys`` keys has done it already,
        or the files are small."""
        if stay is not None:
            held = [f for b, f in self._files(old).items() if b in set(touched)]
            if n_keys > self.broadcast_rows or self.folder.mean_bytes(*held) < LARGE_FILE:
                rows, stay = stay if rows is None else stay.unionByName(_padded(rows, stay.schema)), None
        parts = (rows, schema, old["n"]) if stay is None else (rows, schema, old["n"], stay)
        attempt, written = self._write(*parts)
        held = {b: a for b, a in old["buckets"].items() if int(b) not in set(touched)}
        return self._commit(old, schema, old["n"], held | {str(b): attempt for b in written})

    def _write(
        self, rows: DataFrame | None, schema: T.StructType, n: int, stay: DataFrame | None = None
    ) -> tuple[str, list[int]]:
        """Rows into a new folder, and the buckets that have any. A bucket's rows are
        brought together first, in as many parts as their size asks for; rows that
        ``stay`` in their buckets are written as they are read."""
        attempt = uuid.uuid4().hex
        fields = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
        bucket = self._bucket(F.col(f"`{self.key}`"), n).alias(BUCKET)
        path = f"{self.root}/data/{attempt}"
        parts = [] if stay is None else [_padded(stay, schema).select(*fields, bucket)]
        if rows is not None:
            parts.append(_padded(rows, schema).select(*fields, bucket).hint("rebalance", BUCKET))
        reduce(DataFrame.unionByName, parts).write.partitionBy(BUCKET).parquet(path, compression="zstd")
        names = self.folder.names(f"data/{attempt}")
        return attempt, sorted(int(x.split("=")[1]) for x in names if x.startswith(f"{BUCKET}="))

    def _commit(self, old: dict | None, schema: T.StructType, n: int, buckets: dict[str, str]) -> int:
        """Create the next version's file, which must not exist."""
        number = old["version"] + 1 if old else 1
        for taken, found in self._version_files():
            if taken >= number and found is not None:
                raise WriteConflictError(f"version {taken} of {self.root} was committed by another writer")
            if taken >= number:  # left by a writer that died while it created the file
                number = taken + 1
        version = {"version": number, "key": self.key, "n": n, "schema": json.loads(schema.json()), "buckets": buckets}
        self.folder.create_json(f"versions/{number:09d}.json", version)
        return number

    # -- retention -------------------------------------------------------------

    def expire(self, keep: int = 1, min_age_seconds: float = 86_400) -> int:
        """Remove all but the newest ``keep`` versions, and the data folders that no
        kept version needs; returns how many. Readers of kept versions lose nothing.
        Folders younger than ``min_age_seconds`` stay, as they may belong to a write
        that has not committed yet, or to a reader of an expired version."""
        if keep < 1:
            raise ValueError("at least one version must be kept")
        complete = [v for _, v in self._version_files() if v is not None]
        needed = {a for v in complete[-keep:] for a in v["buckets"].values()}
        for v in complete[:-keep]:
            if self.folder.age(f"versions/{v['version']:09d}.json") >= min_age_seconds:
                self.folder.remove(f"versions/{v['version']:09d}.json")
            else:
                needed |= set(v["buckets"].values())
        gone = [a for a in self.folder.names("data") if a not in needed and self.folder.age(f"data/{a}") >= min_age_seconds]
        for attempt in gone:
            self.folder.remove(f"data/{attempt}")
        return len(gone)


def _united(before: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both; a column must keep its type."""
    known = {f.name: f.dataType for f in before.fields}
    for f in new.fields:
        if f.name in known and known[f.name] != f.dataType and not _widens(f.dataType, known[f.name]):
            raise ValueError(f"column {f.name!r} is {known[f.name].simpleString()}, not {f.dataType.simpleString()}")
    added = [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name not in known]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in before.fields] + added)


_WIDER = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def _widens(narrow: T.DataType, wide: T.DataType) -> bool:
    """May a value of the first type be stored as the second?"""
    return narrow == T.NullType() or (narrow in _WIDER and wide in _WIDER and _WIDER.index(narrow) <= _WIDER.index(wide))


def _padded(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` with the columns of ``schema``, NULL where they have none."""
    have = set(rows.columns)
    return rows.select(
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
