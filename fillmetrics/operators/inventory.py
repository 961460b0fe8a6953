"""Questions about a file listing (``key, size, modified`` and, for summaries, ``dataset``)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillmetrics.functions.values import gigabytes

# Public request and transfer prices in US dollars, and the preset ranges in days.
TRANSFER_PER_GB = 0.09
LIST_PER_REQUEST = 0.005 / 1000
GET_PER_REQUEST = 0.0004 / 1000
KEYS_PER_LIST_REQUEST = 1000
PRESET_DAYS = {"year": 365, "six_months": 180, "three_months": 90, "month": 30}


def modified_between(listing: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Inclusive range of modification times, either end optional (pushed into a ``binaryFile`` listing)."""
    if start is not None:
        listing = listing.where(F.col("modified") >= _instant(start))
    if end is not None:
        listing = listing.where(F.col("modified") <= _instant(end))
    return listing


def _instant(moment: datetime) -> Column:
    """A literal that does not depend on the zone of the Python process; naive times are session time."""
    if moment.tzinfo is not None:
        return F.lit(moment)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def last_days(listing: DataFrame, days: int | str, as_of: datetime) -> DataFrame:
    """Files of the last ``days`` (a number or a preset name) before an explicit ``as_of``."""
    span = PRESET_DAYS[days] if isinstance(days, str) else days
    return modified_between(listing, as_of - timedelta(days=span), as_of)


def pending_files(listing: DataFrame, present: DataFrame) -> DataFrame:
    """Files still to fetch: not present under the same key with the same size."""
    return listing.join(present.select("key", "size"), ["key", "size"], "left_anti")


def summary(listing: DataFrame) -> DataFrame:
    """``dataset, files, total_bytes, total_gb, earliest, latest, days_span`` (whole days), earliest first."""
    grouped = listing.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("size").alias("total_bytes"),
        F.min("modified").alias("earliest"),
        F.max("modified").alias("latest"),
    )
    return _with_span(grouped, "dataset").orderBy("earliest", "dataset")


def total(summaries: DataFrame) -> DataFrame:
    """The same figures over all datasets; one row."""
    merged = summaries.agg(
        F.sum("files").alias("files"),
        F.sum("total_bytes").alias("total_bytes"),
        F.min("earliest").alias("earliest"),
        F.max("latest").alias("latest"),
    )
    return _with_span(merged)


def _with_span(df: DataFrame, *keys: str) -> DataFrame:
    span = F.extract(F.lit("DAY"), F.col("latest") - F.col("earliest")).cast("bigint")
    return df.select(
        *keys,
        "files",
        "total_bytes",
        gigabytes(F.col("total_bytes")).alias("total_gb"),
        "earliest",
        "latest",
        span.alias("days_span"),
    )


def transfer_cost(
    totals: DataFrame,
    list_requests: int | None = None,
    per_gb: float = TRANSFER_PER_GB,
    per_list: float = LIST_PER_REQUEST,
    per_get: float = GET_PER_REQUEST,
) -> DataFrame:
    """Cost columns for each row of :func:`summary` or :func:`total`.

    ``list_requests`` is the number of listing calls made; if unknown it follows from the file count.
    """
    requests = (
        F.lit(list_requests) if list_requests is not None else F.ceil(F.col("files") / F.lit(KEYS_PER_LIST_REQUEST))
    )
    priced = totals.select(
        "*",
        (requests * F.lit(per_list)).alias("list_cost"),
        (F.col("files") * F.lit(per_get)).alias("get_cost"),
        (F.col("total_gb") * F.lit(per_gb)).alias("transfer_cost"),
    )
    return priced.withColumn("total_cost", F.col("list_cost") + F.col("get_cost") + F.col("transfer_cost"))


# A folder of a date may grow until so many days after the date is over.
SETTLE_DAYS = 2


def due_folders(folders: DataFrame, ledger: DataFrame, settle_days: int = SETTLE_DAYS) -> DataFrame:
    """The ``folders`` (``dataset, date, ..., folder_time``) that have to be listed again.

    A folder is closed once it was listed ``settle_days`` after the end of its date, and as long as its own time of change
    (null in stores that keep none) is the one noted then.
    """
    settled = F.date_add("date", 1 + settle_days).cast("timestamp")
    closed = ledger.where(F.col("listed_at") >= settled).select(
        F.col("dataset").alias("known"), F.col("date").alias("known_date"), F.col("folder_time").alias("known_time")
    )
    same = (
        (F.col("dataset") == F.col("known"))
        & (F.col("date") == F.col("known_date"))
        & F.col("folder_time").eqNullSafe(F.col("known_time"))
    )
    return folders.join(closed, same, "left_anti")


def latest_files(ledger: DataFrame) -> DataFrame:
    """``dataset, date, path, size, modified``: the files of each folder as of its last listing."""
    last = ledger.groupBy("dataset", "date").agg(F.max_by("files", "listed_at").alias("files"))
    return last.select("dataset", "date", F.inline("files"))
