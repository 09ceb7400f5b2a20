"""Scan of a corpus directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docindex.config import DEFAULT_GLOB


def scan_binary(
    spark: SparkSession,
    path: str | list[str],
    glob: str = DEFAULT_GLOB,
    recursive: bool = False,
    columns: tuple[str, ...] = ("path", "content"),
) -> DataFrame:
    """One row per file whose name matches ``glob`` (case-sensitive).

    Only ``columns`` reach the scan: without ``content`` no file is opened.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path).select(*columns)


def escaped(path: str) -> str:
    """A path as a pattern that matches nothing else."""
    return "".join(f"\\{c}" if c in "\\{}[]*?," else c for c in path)


class FileCorpus:
    """The files below a folder, listed without opening them, and read by choice."""

    def __init__(
        self, spark: SparkSession, path: str, glob: str = DEFAULT_GLOB, recursive: bool = False, listed_files: int = 100_000
    ) -> None:
        self.spark, self.path, self.glob, self.recursive = spark, path, glob, recursive
        self.listed_files = listed_files

    def listing(self) -> DataFrame:
        """``(uri, modificationTime, length)`` of every file."""
        files = scan_binary(self.spark, self.path, self.glob, self.recursive, ("path", "modificationTime", "length"))
        return files.withColumnRenamed("path", "uri")

    def read(self, wanted: DataFrame | None = None) -> DataFrame:
        """``(uri, content)`` of all files, or of ``wanted(uri, modificationTime)``.

        Up to ``listed_files`` wanted files are named to the scan, which opens no
        others. Of more, the scan drops what is older or younger than all wanted ones
        and a join on the address the rest; both by file attributes it has anyway.
        """
        if wanted is None:
            return scan_binary(self.spark, self.path, self.glob, self.recursive).withColumnRenamed("path", "uri")
        names = [r.uri for r in wanted.select("uri").limit(self.listed_files + 1).collect()]
        if not names:
            return self.spark.createDataFrame([], "uri string, content binary")
        if len(names) <= self.listed_files:
            files = scan_binary(self.spark, [escaped(n) for n in names], self.glob)
            return files.withColumnRenamed("path", "uri")
        oldest, newest = wanted.agg(F.min("modificationTime"), F.max("modificationTime")).first()
        columns = ("path", "modificationTime", "content")
        files = scan_binary(self.spark, self.path, self.glob, self.recursive, columns).withColumnRenamed("path", "uri")
        files = files.filter(F.col("modificationTime").between(F.lit(oldest), F.lit(newest)))
        return files.join(wanted.select("uri"), "uri", "left_semi").select("uri", "content")
