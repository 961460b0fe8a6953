"""File listings as DataFrames.

``binaryFile`` without its ``content`` column lists through the session's own file-system connectors and opens no
file; large listings run as a distributed job.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillmetrics.functions.values import path_date

LISTING = "path string, size bigint, modified timestamp"


def _scan(
    spark: SparkSession, path: str | list[str], pattern: str | None, recursive: bool, base: str | None = None
) -> DataFrame | None:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if base:
        reader = reader.option("basePath", base)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        return reader.load(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def list_files(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """``path, size, modified`` of every file below ``path``; a path that does not exist lists nothing."""
    found = _scan(spark, path, pattern, recursive=True)
    if found is None:
        return spark.createDataFrame([], LISTING)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def with_keys(files: DataFrame, root: str) -> DataFrame:
    """Add ``key``, the path below ``root``, so that listings of two places can be compared."""
    below = r"^.*?\Q" + root.rstrip("/") + r"/\E"
    return files.withColumn("key", F.regexp_replace("path", below, ""))


def with_raw_location(files: DataFrame) -> DataFrame:
    """Add ``dataset`` and ``date`` of ``<dataset>/hourly/YYYYMMDD/<hour>.lz4``; other paths are dropped."""
    return files.select(
        "*",
        F.regexp_extract("path", r"/([^/]+)/hourly/\d{8}/[^/]+$", 1).alias("dataset"),
        path_date(F.col("path")).alias("date"),
    ).where((F.col("dataset") != "") & F.col("date").isNotNull())


def list_raw(spark: SparkSession, root: str) -> DataFrame:
    """All raw files: ``path, size, modified, dataset, date``."""
    return with_raw_location(list_files(spark, root, "*.lz4"))


def stored_files(spark: SparkSession, path: str, days: Iterable[date] | None = None) -> DataFrame:
    """``date, last_file, bytes`` per partition date of a stored table, from the listing alone (no footer is read).

    With ``days`` only the directories of those dates are listed, however many the table has.
    """
    place = path.rstrip("/")
    if days is None:
        found = _scan(spark, place, "*.parquet", recursive=False)
    else:
        names = ",".join(f"date={day:%Y-%m-%d}" for day in sorted(set(days)))
        found = _scan(spark, f"{place}/{{{names}}}", "*.parquet", recursive=False, base=place) if names else None
    if found is None or "date" not in found.columns:
        return spark.createDataFrame([], "date date, last_file string, bytes bigint")
    return found.groupBy(F.col("date").cast("date").alias("date")).agg(
        F.max("path").alias("last_file"), F.sum("length").alias("bytes")
    )
