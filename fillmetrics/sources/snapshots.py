"""Tables by date whose dates are published together.

Every run writes to a folder of its own, ``data/run=<run>/date=<date>``, and touches nothing that is there already. What counts is
named by a manifest: for each date the run that holds it. A version of the table is there once its manifest, one small file,
is there, so a reader sees all dates of a run or none, and a run that was killed leaves the version before it. Readers keep the
version they were opened with. Folders that no kept version names are removed on request.

One writer at a time may publish to a table; a second one that starts while a version is being written is refused. One entry
per date passes through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fillmetrics.sources.folders import remove, subfolders
from fillmetrics.sources.listing import list_files, stored_files

MANIFEST = "date date, run string, run_dates int, bytes bigint, published timestamp"

# A folder that no kept version names may belong to a run under way, or to a reader of an older version.
GRACE = timedelta(days=7)


@dataclass(frozen=True)
class Held:
    """Where the rows of a date are: a run, how many dates that run wrote, and the bytes of this one."""

    run: str
    run_dates: int
    bytes: int


@dataclass(frozen=True)
class Snapshot:
    version: int
    dates: dict[date, Held]


def new_run() -> str:
    return f"r{uuid.uuid4().hex}"


def run_folder(path: str, run: str) -> str:
    return f"{path.rstrip('/')}/run={run}"


def write_run(
    df: DataFrame, path: str, run: str, days: Iterable[date] | None = None, sort: Sequence[str] = ()
) -> dict[date, Held]:
    """Write ``df`` by date below a run's own folder. ``days`` without rows get an empty folder.

    Rows are grouped by date before the write; AQE splits a heavy date over several tasks and merges light ones.
    """
    schema = df.drop("date").schema
    target = run_folder(path, run)
    rows = df.hint("rebalance", "date")
    if sort:
        rows = rows.sortWithinPartitions("date", *sort)
    rows.write.option("compression", "snappy").partitionBy("date").parquet(target)
    written = {row.date: row.bytes for row in stored_files(df.sparkSession, target).collect()}
    for day in sorted(set(days or ()) - written.keys()):
        df.sparkSession.createDataFrame([], schema).coalesce(1).write.parquet(f"{target}/date={day:%Y-%m-%d}")
        written[day] = 0
    return {day: Held(run, len(written), size) for day, size in written.items()}


def read_runs(
    spark: SparkSession, path: str, dates: dict[date, Held], schema: T.StructType | None = None
) -> DataFrame | None:
    """The rows of the dates, each from its run; None where there is no date at all.

    A run that all its dates still come from is read as one folder, so that paths do not grow with the dates.
    """
    by_run: dict[tuple[str, int], list[date]] = {}
    for day, held in sorted(dates.items()):
        by_run.setdefault((held.run, held.run_dates), []).append(day)
    paths = []
    for (run, run_dates), days in by_run.items():
        folder = run_folder(path, run)
        paths += [folder] if len(days) == run_dates else [f"{folder}/date={day:%Y-%m-%d}" for day in days]
    if not paths:
        return None
    reader = spark.read.option("basePath", path)
    if schema is not None:
        partitions = [T.StructField("run", T.StringType()), T.StructField("date", T.DateType())]
        columns = [field for field in schema.fields if field.name not in ("run", "date")]
        reader = reader.schema(T.StructType([*columns, *partitions]))
    return reader.parquet(*paths).drop("run")


def file_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the folders below ``path`` that hold a finished file."""
    number = F.regexp_extract("path", r"/(\d+)/[^/]+$", 1)
    found = list_files(spark, path, "*.parquet").select(number.alias("n")).where(F.col("n") != "")
    return sorted({int(row.n) for row in found.collect()})


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def remove_runs(spark: SparkSession, path: str, referenced: Iterable[tuple[str, date]], before: datetime) -> list[str]:
    """Remove what no reference (run, date) names below ``path`` and was last changed ``before``; the folders removed."""
    dates_of: dict[str, set[str]] = {}
    for run, day in referenced:
        dates_of.setdefault(run, set()).add(f"date={day:%Y-%m-%d}")
    newest = {
        row.run: row.newest
        for row in list_files(spark, path)
        .groupBy(F.regexp_extract("path", r"/run=([^/]+)/", 1).alias("run"))
        .agg(F.max("modified").alias("newest"))
        .collect()
    }
    doomed = []
    for folder in subfolders(spark, path):
        run = folder.name.removeprefix("run=")
        if run in dates_of:
            inner = [day for day in subfolders(spark, folder.path) if day.name.startswith("date=") and day.name not in dates_of[run]]
        else:
            inner = [folder]
        times = [time for time in (folder.modified, newest.get(run)) if time is not None]
        if times and max(times) < before:
            doomed += [entry.path for entry in inner]
    remove(spark, doomed)
    return doomed


class PublishedTable:
    """A table below ``path``; see the module."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.data = f"{self.path}/data"
        self.manifests = f"{self.path}/manifests"

    def versions(self) -> list[int]:
        return file_versions(self.spark, self.manifests)

    def _manifest(self, version: int) -> str:
        return f"{self.manifests}/{version:09d}"

    def snapshot(self, version: int | None = None) -> Snapshot | None:
        """A version, by default the last; None where nothing was published."""
        if version is None:
            version = max(self.versions(), default=None)
        if version is None:
            return None
        rows = self.spark.read.schema(MANIFEST).parquet(self._manifest(version)).where(F.col("date").isNotNull()).collect()
        return Snapshot(version, {row.date: Held(row.run, row.run_dates, row.bytes) for row in rows})

    def read(
        self, snapshot: Snapshot | None = None, schema: T.StructType | None = None, days: Iterable[date] | None = None
    ) -> DataFrame:
        """The rows of a snapshot, by default of the last version; later versions do not change what is read."""
        snapshot = snapshot or self.snapshot()
        if snapshot is None:
            raise ValueError(f"nothing was published at {self.path}")
        wanted = snapshot.dates if days is None else {day: snapshot.dates[day] for day in days if day in snapshot.dates}
        found = read_runs(self.spark, self.data, wanted, schema)
        if found is not None:
            return found
        if schema is not None:
            return self.spark.createDataFrame([], schema)
        found = read_runs(self.spark, self.data, snapshot.dates)
        if found is None:
            raise ValueError(f"version {snapshot.version} of {self.path} has no date, and no schema was given")
        return found.limit(0)

    def write(self, df: DataFrame, days: Iterable[date] | None = None, sort: Sequence[str] = ()) -> dict[date, Held]:
        """Write rows that no reader sees until :meth:`commit` is given what this returns."""
        return write_run(df, self.data, new_run(), days, sort)

    def commit(self, written: dict[date, Held], replace_all: bool = False) -> Snapshot:
        """Publish a version in which these dates are as written and all others as they were (or gone)."""
        before = self.snapshot()
        kept = {} if before is None or replace_all else before.dates
        version = 1 if before is None else before.version + 1
        dates = kept | written
        now = _now()
        rows = [(None, None, None, None, now)]
        rows += [(day, held.run, held.run_dates, held.bytes, now) for day, held in sorted(dates.items())]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("error").parquet(self._manifest(version))
        return Snapshot(version, dates)

    def publish(
        self, df: DataFrame, days: Iterable[date] | None = None, replace_all: bool = False, sort: Sequence[str] = ()
    ) -> Snapshot:
        """Replace the dates in ``df``, and those of ``days`` without rows by empty ones, all at once."""
        return self.commit(self.write(df, days, sort), replace_all)

    def remove_unreferenced(self, keep_versions: int = 1, grace: timedelta = GRACE) -> list[str]:
        """Forget all but the last versions, and remove the folders that none of these names; the folders removed.

        Only what was last changed longer than ``grace`` ago goes: a run under way names its folders last.
        """
        versions = self.versions()
        kept, forgotten = versions[-keep_versions:], versions[:-keep_versions]
        before = _now() - grace
        referenced = {(held.run, day) for version in kept for day, held in self.snapshot(version).dates.items()}
        # Manifests first: none may name a folder that is gone.
        remove(self.spark, [self._manifest(version) for version in forgotten])
        return remove_runs(self.spark, self.data, referenced, before)


def held_files(spark: SparkSession, path: str) -> DataFrame:
    """``date, last_file, bytes`` per date: of a published table from its manifest alone, of any other from a listing."""
    snapshot = PublishedTable(spark, path).snapshot()
    if snapshot is None:
        return stored_files(spark, path)
    rows = [(day, held.run, held.bytes) for day, held in sorted(snapshot.dates.items())]
    return spark.createDataFrame(rows, "date date, last_file string, bytes bigint")


def stored_dates(spark: SparkSession, path: str) -> DataFrame:
    """Distinct dates of a stored table."""
    return held_files(spark, path).select("date")
