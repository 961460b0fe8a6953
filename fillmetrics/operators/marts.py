"""Summary tables.

``user_activity`` is the one aggregate taken from the fills themselves: volume and fill count per date, user, coin and
side. The other summaries of volume and users are aggregates of it, so the wide fills table is scanned once for them;
only the distinct trade hashes need a second, two-column scan. Grouping keys always contain the user (or the hash), so
a coin or a date with a third of all rows is pre-aggregated in each task and then spread over the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillmetrics.functions.filters import in_coins, in_dates, on_side
from fillmetrics.functions.values import to_double

MARKET_SIDES = ("A",)
_USER, _HASH, _FIRST, _COIN, _DAY = range(5)


def user_activity(fills: DataFrame) -> DataFrame:
    """``date, user_address, coin, side, volume, fills``."""
    return fills.groupBy("date", "user_address", "coin", "side").agg(
        F.sum(F.col("sz") * F.col("px")).alias("volume"), F.count(F.lit(1)).alias("fills")
    )


def daily_user_volume(fills: DataFrame, sides: Iterable[str] = MARKET_SIDES) -> DataFrame:
    """``date, user_address, coin, daily_volume, trade_count`` of the fills on ``sides``, straight from the fills."""
    return (
        fills.where(on_side(sides))
        .groupBy("date", "user_address", "coin")
        .agg(F.sum(F.col("sz") * F.col("px")).alias("daily_volume"), F.count(F.lit(1)).alias("trade_count"))
    )


def daily_user_volume_from_activity(activity: DataFrame, sides: Iterable[str] = MARKET_SIDES) -> DataFrame:
    """The same table from ``user_activity``. One side needs no aggregation at all."""
    sides = list(sides)
    kept = activity.where(on_side(sides))
    if len(sides) == 1:
        return kept.select(
            "date", "user_address", "coin", F.col("volume").alias("daily_volume"), F.col("fills").alias("trade_count")
        )
    return kept.groupBy("date", "user_address", "coin").agg(
        F.sum("volume").alias("daily_volume"), F.sum("fills").alias("trade_count")
    )


def user_first_trade(fills: DataFrame) -> DataFrame:
    """``user_address, first_trade_date`` over all sides. Takes the fills or any of their per-date summaries."""
    return fills.groupBy("user_address").agg(F.min("date").alias("first_trade_date"))


def daily_metrics(fills: DataFrame) -> DataFrame:
    """``date, dau, total_volume, total_trades``: users of both sides, A-side volume, distinct A-side hashes."""
    ask = F.col("side") == "A"
    return fills.groupBy("date").agg(
        F.count_distinct("user_address").alias("dau"),
        F.sum(F.when(ask, F.col("sz") * F.col("px")).otherwise(F.lit(0))).alias("total_volume"),
        F.count_distinct(F.when(ask, F.col("hash"))).alias("total_trades"),
    )


def daily_metrics_from_activity(activity: DataFrame, fills: DataFrame) -> DataFrame:
    """The same table, users and volume from ``user_activity`` and only the hashes from the fills.

    The side filter reaches the Parquet scan and two columns are read. Both inputs of the join have one row per date.
    """
    ask = F.col("side") == "A"
    users = activity.groupBy("date").agg(
        F.count_distinct("user_address").alias("dau"),
        F.sum(F.when(ask, F.col("volume")).otherwise(F.lit(0))).alias("total_volume"),
    )
    trades = fills.where(ask).groupBy("date").agg(F.count_distinct("hash").alias("total_trades"))
    return users.join(trades, "date", "left").select(
        "date", "dau", "total_volume", F.coalesce("total_trades", F.lit(0)).cast("bigint").alias("total_trades")
    )


def days(fills: DataFrame) -> DataFrame:
    """``date, dau, new_users, new_coins, total_volume, total_trades, fills`` in one pass over fills that are not stored.

    A fill gives an entry for each figure: users and A-side hashes by date, users and coins by their first date, and the
    date's volume. All are combined in each task and shuffled once. Null dates, users and coins count as in the summaries.
    """
    ask, day = F.col("side") == "A", F.col("date")
    volume = F.when(ask, F.col("sz") * F.col("px")).otherwise(F.lit(0))
    no_day, no_volume = F.when(F.lit(False), day), F.when(F.lit(False), volume)

    def entry(kind: int, key: Column, date: Column = no_day, first: Column = no_day, amount: Column = no_volume, count=None):
        return F.struct(
            F.lit(kind).cast("tinyint").alias("kind"),
            key.cast("string").alias("key"),
            date.alias("date"),
            first.alias("first"),
            amount.alias("volume"),
            F.lit(count).cast("bigint").alias("fills"),
        )

    entries = F.array(
        entry(_USER, F.col("user_address"), day),
        entry(_HASH, F.when(ask & day.isNotNull(), F.col("hash")), day),
        entry(_FIRST, F.col("user_address"), first=day),
        entry(_COIN, F.col("coin"), first=day),
        entry(_DAY, F.lit(None), day, amount=volume, count=1),
    )
    kind = F.col("kind")
    listed = fills.select(F.inline(entries)).where(kind.isin(_FIRST, _DAY) | F.col("key").isNotNull())
    grouped = listed.groupBy("kind", "key", "date").agg(
        F.min("first").alias("first"), F.sum("volume").alias("volume"), F.sum("fills").alias("fills")
    )
    dated = grouped.withColumn("date", F.when(kind.isin(_FIRST, _COIN), F.col("first")).otherwise(F.col("date")))

    def counted(wanted: int) -> Column:
        return F.count(F.when(kind == wanted, F.lit(1)))

    return dated.groupBy("date").agg(
        counted(_USER).alias("dau"),
        counted(_FIRST).alias("new_users"),
        counted(_COIN).alias("new_coins"),
        F.sum("volume").alias("total_volume"),
        counted(_HASH).alias("total_trades"),
        F.sum("fills").alias("fills"),
    )


def user_daily_volume(volumes: DataFrame, coins: str | Iterable[str] | None = None) -> DataFrame:
    """User-day totals over all coins or a selection: ``date, user_address, daily_volume``."""
    return in_coins(volumes, coins).groupBy("date", "user_address").agg(F.sum("daily_volume").alias("daily_volume"))


def user_daily_volume_from_fills(
    fills: DataFrame,
    coins: str | Iterable[str] | None = None,
    sides: Iterable[str] = MARKET_SIDES,
) -> DataFrame:
    """The same totals in one aggregation of the fills."""
    chosen = in_coins(fills, coins).where(on_side(sides))
    return chosen.groupBy("date", "user_address").agg(F.sum(F.col("sz") * F.col("px")).alias("daily_volume"))


def coin_preaggregate(
    fills: DataFrame,
    coins: str | Iterable[str],
    sides: Iterable[str] = MARKET_SIDES,
    start=None,
    end=None,
) -> DataFrame:
    """A custom summary for often-queried coins: ``date, user_address, volume``."""
    totals = user_daily_volume_from_fills(in_dates(fills, start, end), coins, sides)
    return totals.withColumnRenamed("daily_volume", "volume")


def _reconciled(df: DataFrame, volume: Column) -> DataFrame:
    ask, bid = (F.sum(F.when(F.col("side") == side, volume).otherwise(F.lit(0))) for side in ("A", "B"))
    sums = df.groupBy("date").agg(
        F.sum(volume).alias("all_volume"),
        ask.alias("a_volume"),
        bid.alias("b_volume"),
    )
    return sums.select(
        "date",
        to_double(F.col("all_volume")).alias("all_volume"),
        to_double(F.col("a_volume")).alias("a_volume"),
        to_double(F.col("b_volume")).alias("b_volume"),
        to_double(F.col("a_volume") - F.col("b_volume")).alias("gap"),
    ).orderBy("date")


def side_reconciliation(fills: DataFrame) -> DataFrame:
    """``date, all_volume, a_volume, b_volume, gap``: both sides should agree, and each should be half of all."""
    return _reconciled(fills, F.col("sz") * F.col("px"))


def side_reconciliation_from_activity(activity: DataFrame) -> DataFrame:
    """The same from ``user_activity``, without reading the fills."""
    return _reconciled(activity, F.col("volume"))
