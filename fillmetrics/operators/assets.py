"""Top users and per-coin statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fillmetrics.functions.filters import in_dates
from fillmetrics.functions.values import to_double

TOP_USER_COLUMNS = ("user_address", "total_trades", "total_volume", "active_days", "unique_coins")


def top_users(volumes: DataFrame, limit: int = 100, start=None, end=None) -> DataFrame:
    """Users by volume: ``user_address, total_trades, total_volume, active_days, unique_coins``; ties by address.

    The ranking needs sums only. Active days and coins are counted afterwards for the ``limit`` users that remain,
    which spares an expansion of the whole table for two distinct counts. The join has no hint: for a usual limit
    Spark broadcasts it, for a very large one it shuffles.
    """
    scope = in_dates(volumes, start, end)
    ranked = (
        scope.groupBy("user_address")
        .agg(F.sum("trade_count").alias("total_trades"), F.sum("daily_volume").alias("total_volume"))
        .orderBy(F.desc("total_volume"), F.asc_nulls_last("user_address"))
        .limit(limit)
    )
    leaders = ranked.select(F.col("user_address").alias("leader"))
    # A semi join moves below the aggregate that makes the volumes; an inner join would aggregate everything again.
    detail = (
        scope.select("date", "coin", "user_address")
        .join(leaders, F.col("user_address").eqNullSafe(F.col("leader")), "left_semi")
        .groupBy(F.col("user_address").alias("counted"))
        .agg(F.count_distinct("date").alias("active_days"), F.count_distinct("coin").alias("unique_coins"))
    )
    detail = ranked.join(detail, F.col("user_address").eqNullSafe(F.col("counted")))
    return detail.orderBy(F.desc("total_volume"), F.asc_nulls_last("user_address")).select(
        "user_address",
        "total_trades",
        to_double(F.col("total_volume")).alias("total_volume"),
        "active_days",
        "unique_coins",
    )


def _coin_totals(volumes: DataFrame, start=None, end=None) -> DataFrame:
    return (
        in_dates(volumes, start, end)
        .groupBy("coin")
        .agg(
            F.sum("trade_count").alias("total_trades"),
            F.count_distinct("user_address").alias("unique_traders"),
            F.sum("daily_volume").alias("total_volume"),
        )
    )


def _edge(totals: DataFrame) -> DataFrame:
    return totals.select(
        "coin", "total_trades", "unique_traders", to_double(F.col("total_volume")).alias("total_volume")
    )


def coin_statistics(volumes: DataFrame, start=None, end=None) -> DataFrame:
    """``coin, total_trades, unique_traders, total_volume``, largest volume first; ties by coin."""
    totals = _coin_totals(volumes, start, end)
    return _edge(totals.orderBy(F.desc("total_volume"), F.asc_nulls_last("coin")))


def top_assets(volumes: DataFrame, limit: int = 20, start=None, end=None) -> DataFrame:
    """The first ``limit`` coins with the number of all coins traded beside them."""
    totals = _coin_totals(volumes, start, end)
    counted = totals.agg(F.count(F.lit(1)).alias("unique_assets"))
    return (
        totals.withColumn("unique_assets", counted.scalar())
        .orderBy(F.desc("total_volume"), F.asc_nulls_last("coin"))
        .limit(limit)
        .select(
            "coin",
            "total_trades",
            "unique_traders",
            to_double(F.col("total_volume")).alias("total_volume"),
            "unique_assets",
        )
    )


def top_assets_ranked(volumes: DataFrame, limit: int = 10, start=None, end=None) -> DataFrame:
    """The first ``limit`` coins with their rank number (numbered after the limit, so over ``limit`` rows)."""
    kept = (
        _coin_totals(volumes, start, end).orderBy(F.desc("total_volume"), F.asc_nulls_last("coin")).limit(limit)
    )
    place = F.row_number().over(Window.orderBy(F.desc("total_volume"), F.asc_nulls_last("coin")))
    return kept.select(
        place.alias("rank"),
        "coin",
        to_double(F.col("total_volume")).alias("total_volume"),
        "unique_traders",
        "total_trades",
    )
