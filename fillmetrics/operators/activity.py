"""Active and new users over time."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fillmetrics.functions.filters import as_list, in_coins, in_dates, in_month
from fillmetrics.functions.values import exact_mean, month_of, to_double


def dau(metrics: DataFrame, start=None, end=None) -> DataFrame:
    """Daily active users of the whole market from ``daily_metrics``: ``date, dau, total_volume, total_trades``.

    Users count on both sides; trades are distinct A-side hashes.
    """
    return (
        in_dates(metrics, start, end)
        .select("date", "dau", to_double(F.col("total_volume")).alias("total_volume"), "total_trades")
        .orderBy("date")
    )


def dau_of_coins(volumes: DataFrame, coins: str | Iterable[str], start=None, end=None) -> DataFrame:
    """The same columns for a coin selection from ``daily_user_volume``: A-side users, trades are A-side fills.

    The table has one row per date, user and coin, so for one coin counting rows is counting users and nothing but
    per-date sums is shuffled.
    """
    selected = as_list(coins)
    users = F.count("user_address") if len(set(selected)) == 1 else F.count_distinct("user_address")
    return (
        in_coins(in_dates(volumes, start, end), selected)
        .groupBy("date")
        .agg(
            users.alias("dau"),
            to_double(F.sum("daily_volume")).alias("total_volume"),
            F.sum("trade_count").alias("total_trades"),
        )
        .orderBy("date")
    )


def mau(volumes: DataFrame, month: str | None = None, coins: str | Iterable[str] | None = None) -> DataFrame:
    """Monthly active users from ``daily_user_volume``: ``month, mau, total_volume, total_trades``."""
    return (
        in_coins(in_month(volumes, month), coins)
        .groupBy(month_of(F.col("date")).alias("month"))
        .agg(
            F.count_distinct("user_address").alias("mau"),
            to_double(F.sum("daily_volume")).alias("total_volume"),
            F.sum("trade_count").alias("total_trades"),
        )
        .orderBy("month")
    )


def approx_dau(fills: DataFrame, start=None, end=None, rsd: float = 0.05) -> DataFrame:
    """Approximate daily users straight from the fills: one fixed-size sketch per date and task is shuffled."""
    return (
        in_dates(fills, start, end)
        .groupBy("date")
        .agg(F.approx_count_distinct("user_address", rsd).alias("dau"))
        .orderBy("date")
    )


def approx_dau_check(
    fills: DataFrame, start=None, end=None, rsd: float = 0.05, tolerance: float = 4.0
) -> DataFrame:
    """Exact daily users and whether the estimate lies within ``tolerance`` standard deviations (one user at least)."""
    return (
        in_dates(fills, start, end)
        .groupBy("date")
        .agg(
            F.count_distinct("user_address").alias("dau"),
            F.approx_count_distinct("user_address", rsd).alias("estimate"),
        )
        .select(
            "date",
            "dau",
            (F.abs(F.col("estimate") - F.col("dau")) <= F.greatest(F.lit(1.0), F.lit(tolerance * rsd) * F.col("dau"))).alias(
                "within"
            ),
        )
        .orderBy("date")
    )


def new_users(first_trades: DataFrame) -> DataFrame:
    """New users per day, ``date, new_users``; a day without any is absent."""
    return (
        first_trades.groupBy(F.col("first_trade_date").alias("date"))
        .agg(F.count(F.lit(1)).alias("new_users"))
        .orderBy("date")
    )


def densified(series: DataFrame, value: str) -> DataFrame:
    """Add the absent days of a ``date, value`` series with value 0 (an option, never the default).

    Every day is stretched up to the next one present; like :func:`centred_mean` this looks at one row per day.
    """
    following = F.lead("date").over(Window.orderBy("date"))
    last = F.coalesce(F.date_sub(following, 1), F.col("date"))
    stretched = series.select("date", value, F.sequence("date", last, F.expr("interval 1 day")).alias("days"))
    filled = stretched.select(F.explode("days").alias("day"), "date", value)
    amount = F.when(F.col("day") == F.col("date"), F.col(value)).otherwise(F.lit(0))
    return filled.select(F.col("day").alias("date"), amount.alias(value)).orderBy("date")


def centred_mean(series: DataFrame, value: str = "new_users", rows: int = 7) -> DataFrame:
    """Centred mean over ``rows`` rows, null where the window is incomplete.

    The window has no partition key because its input has one row per day, a few thousand at most.
    """
    half = rows // 2
    frame = Window.orderBy("date").rowsBetween(-half, rows - 1 - half)
    mean = F.when(F.count(value).over(frame) == rows, F.avg(value).over(frame))
    return series.select("*", mean.alias(f"ma_{rows}")).orderBy("date")


def dau_statistics(daily: DataFrame) -> DataFrame:
    """Mean, median, extremes of ``dau`` with the earliest date of each extreme; one row."""
    return daily.agg(
        exact_mean(F.col("dau")).alias("average_dau"),
        F.median("dau").alias("median_dau"),
        F.max("dau").alias("max_dau"),
        F.min("dau").alias("min_dau"),
        F.min_by("date", F.struct(-F.col("dau"), F.col("date"))).alias("peak_date"),
        F.min_by("date", F.struct(F.col("dau"), F.col("date"))).alias("lowest_date"),
    )


def new_user_statistics(daily_new: DataFrame) -> DataFrame:
    """Total, mean per day present, and the earliest peak day with its count; one row."""
    return daily_new.agg(
        F.sum("new_users").alias("total_new_users"),
        exact_mean(F.col("new_users")).alias("average_per_day"),
        F.min_by("date", F.struct(-F.col("new_users"), F.col("date"))).alias("peak_date"),
        F.max("new_users").alias("peak_new_users"),
    )
