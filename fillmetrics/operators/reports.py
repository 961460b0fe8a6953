"""One-row summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillmetrics.functions.values import exact_mean, to_double

SUMMARY = (
    "total_fills",
    "unique_users",
    "unique_coins",
    "total_days",
    "earliest_date",
    "latest_date",
    "total_volume",
    "total_trades",
)
REPORT = (
    *SUMMARY,
    "average_dau",
    "peak_dau",
    "average_daily_volume",
    "peak_daily_volume",
    "total_new_users",
    "average_new_users",
    "peak_new_users",
)


def beside(*one_row: DataFrame) -> DataFrame:
    """Put one-row frames side by side.

    Each is packed into a struct and read as a scalar subquery, which is guaranteed to be a single row; no join.
    """
    packed = [(frame.select(F.struct(*frame.columns).alias("row")).scalar(), frame.columns) for frame in one_row]
    spark = one_row[0].sparkSession
    rows = spark.range(1).select(*[subquery.alias(f"r{place}") for place, (subquery, _) in enumerate(packed)])
    return rows.select(
        *[F.col(f"r{place}.{name}").alias(name) for place, (_, names) in enumerate(packed) for name in names]
    )


def _stored(activity: DataFrame) -> DataFrame:
    return activity.agg(
        F.coalesce(F.sum("fills"), F.lit(0)).alias("total_fills"), F.count_distinct("coin").alias("unique_coins")
    )


def _days() -> list[Column]:
    return [
        F.count_distinct("date").alias("total_days"),
        F.min("date").alias("earliest_date"),
        F.max("date").alias("latest_date"),
        to_double(F.sum("total_volume")).alias("total_volume"),
        F.sum("total_trades").alias("total_trades"),
    ]


def _peaks() -> list[Column]:
    return [
        exact_mean(F.col("dau")).alias("average_dau"),
        F.max("dau").alias("peak_dau"),
        exact_mean(F.col("total_volume")).alias("average_daily_volume"),
        to_double(F.max("total_volume")).alias("peak_daily_volume"),
    ]


def _acquisition() -> list[Column]:
    return [
        F.coalesce(F.sum("new_users"), F.lit(0)).alias("unique_users"),
        F.sum("new_users").alias("total_new_users"),
        exact_mean(F.col("new_users")).alias("average_new_users"),
        F.max("new_users").alias("peak_new_users"),
    ]


def data_summary(activity: DataFrame, first_trades: DataFrame, metrics: DataFrame) -> DataFrame:
    """Eight figures over everything stored; fill and coin counts come from ``user_activity``, not from the fills.

    A hash that occurs on two days counts twice in ``total_trades``, which is a sum of daily counts.
    """
    users = first_trades.agg(F.count(F.lit(1)).alias("unique_users"))
    return beside(_stored(activity), users, metrics.agg(*_days())).select(*SUMMARY)


def summary_report(activity: DataFrame, metrics: DataFrame, daily_new: DataFrame) -> DataFrame:
    """The summary with mean and peak DAU, mean and peak daily volume, and total, mean and peak of new users.

    Every user is new on exactly one day, so the number of users is the total of new users; each input is read once.
    """
    daily = metrics.agg(*_days(), *_peaks())
    acquisition = daily_new.agg(*_acquisition())
    return beside(_stored(activity), daily, acquisition).select(*REPORT)


def summary_report_of_days(days: DataFrame) -> DataFrame:
    """The same row from :func:`marts.days`, for fills without stored summaries; they are read once for all figures."""
    # A day without new users has no row among the new users.
    found = days.withColumn("new_users", F.when(F.col("new_users") > 0, F.col("new_users")))
    return found.agg(
        F.coalesce(F.sum("fills"), F.lit(0)).alias("total_fills"),
        F.coalesce(F.sum("new_coins"), F.lit(0)).alias("unique_coins"),
        *_days(),
        *_peaks(),
        *_acquisition(),
    ).select(*REPORT)
