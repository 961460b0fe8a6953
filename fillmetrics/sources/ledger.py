"""A ledger of what raw folders hold, so that a run lists only folders that are new, open or changed.

The ledger is a Parquet table that is only added to: per folder and listing one row, with all files of the folder, so that a row
is there whole or not at all. Names of folders are asked for anew in each run, one request per dataset; one entry per folder passes
through the driver. What is due is an anti join (:func:`inventory.due_folders`).
"""

from __future__ import annotations

import re
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillmetrics.operators.inventory import SETTLE_DAYS, due_folders, latest_files
from fillmetrics.sources.folders import subfolders
from fillmetrics.sources.listing import list_files, with_raw_location

FOLDERS = "dataset string, date date, folder string, folder_time timestamp"
FILES = "array<struct<path: string, size: bigint, modified: timestamp>>"
LEDGER = f"dataset string, date date, folder_time timestamp, listed_at timestamp, files {FILES}"


def raw_folders(spark: SparkSession, root: str) -> DataFrame:
    """``dataset, date, folder, folder_time`` of ``<dataset>/hourly/YYYYMMDD``; other names are left out."""
    rows = []
    for dataset in subfolders(spark, root):
        for folder in subfolders(spark, f"{dataset.path}/hourly"):
            if re.fullmatch(r"\d{8}", folder.name):
                try:
                    day = date(int(folder.name[:4]), int(folder.name[4:6]), int(folder.name[6:]))
                except ValueError:
                    continue
                changed = folder.modified and folder.modified.replace(tzinfo=timezone.utc)
                rows.append((dataset.name, day, folder.path, changed))
    return spark.createDataFrame(rows, FOLDERS)


class RawLedger:
    def __init__(self, spark: SparkSession, path: str, settle_days: int = SETTLE_DAYS):
        self.spark = spark
        self.path = path
        self.settle_days = settle_days

    def read(self) -> DataFrame:
        if list_files(self.spark, self.path, "*.parquet").isEmpty():
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def due(self, root: str) -> list[str]:
        """Folders that the next :meth:`refreshed` lists."""
        return [row.folder for row in due_folders(raw_folders(self.spark, root), self.read(), self.settle_days).collect()]

    def refreshed(self, root: str, now: datetime | None = None) -> DataFrame:
        """All raw files as :func:`listing.list_raw` has them, after listing what is due and noting it."""
        now = now or datetime.now(timezone.utc)
        folders = raw_folders(self.spark, root)
        due = due_folders(folders, self.read(), self.settle_days).collect()
        if due:
            found = with_raw_location(list_files(self.spark, [row.folder for row in due], "*.lz4"))
            files = found.groupBy("dataset", "date").agg(F.collect_list(F.struct("path", "size", "modified")).alias("files"))
            listed = self.spark.createDataFrame(due, FOLDERS).drop("folder").join(files, ["dataset", "date"], "left")
            rows = listed.withColumns(
                {"listed_at": F.lit(now).cast("timestamp"), "files": F.coalesce("files", F.array().cast(FILES))}
            )
            rows.select("dataset", "date", "folder_time", "listed_at", "files").write.mode("append").parquet(self.path)
        there = folders.select("dataset", "date")
        return latest_files(self.read()).join(there, ["dataset", "date"], "left_semi").select(
            "path", "size", "modified", "dataset", "date"
        )
