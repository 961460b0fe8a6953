"""Parquet tables: scan, date-wise replacement, whole replacement, checkpoints."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fillmetrics.schema import NORMALIZED_PARTITIONED
from fillmetrics.sources.listing import stored_files
from fillmetrics.sources.snapshots import PublishedTable


def scan_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table; ``date=`` directories become a DATE column that range filters prune on."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def scan_normalized(spark: SparkSession, path: str) -> DataFrame:
    """Stored fills: the last published version, or the folders as they are where nothing is published."""
    table = PublishedTable(spark, path)
    snapshot = table.snapshot()
    if snapshot is None:
        return scan_table(spark, path, NORMALIZED_PARTITIONED)
    return table.read(snapshot, NORMALIZED_PARTITIONED)


def open_stored(spark: SparkSession, path: str) -> tuple[dict[date, tuple[str, int]], DataFrame]:
    """One state of a stored table: last file (or run) and bytes per date, and the rows."""
    table = PublishedTable(spark, path)
    snapshot = table.snapshot()
    if snapshot is not None:
        held = {day: (entry.run, entry.bytes) for day, entry in snapshot.dates.items()}
        return held, table.read(snapshot, NORMALIZED_PARTITIONED)
    held = {row.date: (row.last_file, row.bytes) for row in stored_files(spark, path).collect()}
    return held, scan_table(spark, path, NORMALIZED_PARTITIONED)


def store_dates(df: DataFrame, path: str, days: Iterable[date], published: bool = True) -> None:
    """Replace ``days`` of a stored table, all at once if it is ``published``.

    A table that has plain folders already keeps them.
    """
    days = list(days)
    table = PublishedTable(df.sparkSession, path)
    plain = not published or table.snapshot() is None and not stored_files(df.sparkSession, path).isEmpty()
    if plain:
        write_by_date(df, path, days=days)
    else:
        table.publish(df, days)


def write_by_date(
    df: DataFrame,
    path: str,
    rebalance: bool = True,
    sort: tuple[str, ...] = (),
    days: Iterable[date] | None = None,
    replace_all: bool = False,
) -> None:
    """Replace exactly the dates present in ``df``, or with ``replace_all`` the whole table.

    With ``rebalance`` rows are grouped by date before the write, AQE splitting a heavy date over several tasks and
    merging light ones, so file sizes follow the advisory partition size whatever the skew. Without it every task
    writes what it holds: right when the rows already arrive clustered by date in large pieces.

    Dynamic overwrite leaves a date without rows as it was. ``days`` names the dates that ``df`` stands for; those
    among them that turn out to have no rows get an empty partition in place of what they held before.
    """
    before = _last_files(df.sparkSession, path, days)
    schema = df.drop("date").schema
    if rebalance:
        df = df.hint("rebalance", "date")
    if sort:
        df = df.sortWithinPartitions("date", *sort)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .option("compression", "snappy")
        .partitionBy("date")
        .parquet(path)
    )
    after = _last_files(df.sparkSession, path, days)
    # Every write names its files anew, so a date whose files did not change was not written.
    for day in sorted(days or []):
        if after.get(day) == before.get(day):
            nothing = df.sparkSession.createDataFrame([], schema)
            nothing.write.mode("overwrite").parquet(f"{path.rstrip('/')}/date={day:%Y-%m-%d}")


def _last_files(spark: SparkSession, path: str, days: Iterable[date] | None) -> dict[date, str]:
    """One file name for each of ``days`` that is stored."""
    if days is None:
        return {}
    return {row.date: row.last_file for row in stored_files(spark, path, days).collect()}


def write_whole(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned table."""
    df.hint("rebalance").write.mode("overwrite").option("compression", "snappy").parquet(path)


def checkpoint_folder(spark: SparkSession, fallback: str) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; ``fallback`` only where that is unset."""
    return spark.conf.get("spark.checkpoint.dir", None) or fallback


def checkpointed(df: DataFrame, fallback_dir: str) -> DataFrame:
    """Cut the lineage of ``df`` in a folder that outlives an executor; ``fallback_dir`` lies next to the tables."""
    spark = df.sparkSession
    spark.sparkContext.setCheckpointDir(checkpoint_folder(spark, fallback_dir))
    return df.checkpoint()
