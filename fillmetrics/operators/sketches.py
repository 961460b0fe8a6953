"""Distinct users as sketches that can be united and subtracted.

A theta sketch holds a bounded random part of the users it has seen. One per date, coin and side is stored; users of any
range, month or choice of coins are the estimate of a union of these, without expanding users by coin again, and new users are the
estimate of a difference. With ``2 ** log_entries`` entries the relative standard error of a union is one over the square root of
their number; sets no larger than that are exact. Null users are not counted, as in the exact forms.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillmetrics.functions.filters import in_coins, in_dates, on_side
from fillmetrics.functions.values import month_of
from fillmetrics.operators.marts import MARKET_SIDES

LOG_ENTRIES = 12
# Deviations within which an estimate has to lie.
TOLERANCE = 4.0


def user_sketches(activity: DataFrame, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """``date, coin, side, users`` (a sketch) of ``user_activity`` or of fills."""
    return activity.groupBy("date", "coin", "side").agg(F.theta_sketch_agg("user_address", log_entries).alias("users"))


def united(sketches: DataFrame, *by: str | Column, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """One sketch per group; at most one row per date, coin and side is read for each."""
    return sketches.groupBy(*by).agg(F.theta_union_agg("users", log_entries).alias("users"))


def estimated(sketches: DataFrame, name: str) -> DataFrame:
    return sketches.withColumn(name, F.theta_sketch_estimate("users")).drop("users")


def users_by_date(
    sketches: DataFrame, coins: str | Iterable[str] | None = None, start=None, end=None, sides: Iterable[str] = ("A", "B")
) -> DataFrame:
    """``date, dau``: both sides, as the whole market counts, unless ``sides`` are named."""
    chosen = in_coins(in_dates(sketches, start, end), coins).where(on_side(sides))
    return estimated(united(chosen, "date"), "dau").orderBy("date")


def users_by_month(
    sketches: DataFrame, coins: str | Iterable[str] | None = None, sides: Iterable[str] = MARKET_SIDES
) -> DataFrame:
    """``month, mau``."""
    chosen = in_coins(sketches, coins).where(on_side(sides))
    return estimated(united(chosen, month_of(F.col("date")).alias("month")), "mau").orderBy("month")


def users_by_coin(sketches: DataFrame, start=None, end=None, sides: Iterable[str] = MARKET_SIDES) -> DataFrame:
    """``coin, unique_traders`` over any range of dates."""
    chosen = in_dates(sketches, start, end).where(on_side(sides))
    return estimated(united(chosen, "coin"), "unique_traders")


def users_in_range(
    sketches: DataFrame, start=None, end=None, coins: str | Iterable[str] | None = None, sides: Iterable[str] = ("A", "B")
) -> DataFrame:
    """``users``, ``new_users`` (not seen before ``start``): one row, for any range and choice of coins."""
    chosen = in_coins(sketches, coins).where(on_side(sides))
    within = united(in_dates(chosen, start, end))
    if start is None:
        users = F.theta_sketch_estimate("users")
        return within.select(users.alias("users"), users.alias("new_users"))
    earlier = united(chosen.where(F.col("date") < F.lit(start).cast("date"))).select(F.col("users").alias("earlier"))
    # Two rows of one sketch each.
    both = within.withColumn("earlier", earlier.scalar())
    fresh = F.when(F.col("earlier").isNull(), F.col("users")).otherwise(F.theta_difference("users", "earlier"))
    return both.select(
        F.theta_sketch_estimate("users").alias("users"),
        F.theta_sketch_estimate(fresh).alias("new_users"),
    )


def within_bound(
    estimate: Column, exact: Column, of: Column | None = None, log_entries: int = LOG_ENTRIES, tolerance: float = TOLERANCE
) -> Column:
    """Whether an estimate lies within the bound of the exact count (one user at least).

    ``of`` is the number of users in the union that a difference was taken from: its error goes with that.
    """
    share = tolerance / math.sqrt((1 << log_entries) - 1)
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), F.lit(share) * (exact if of is None else of))


# -- volumes -------------------------------------------------------------------------------------------------------

# Entries of a quantile sketch, and its normalised rank error (99 % confidence) at that number.
QUANTILE_ENTRIES = 1000
RANK_ERROR = 0.0035


def volume_sketches(totals: DataFrame, entries: int = QUANTILE_ENTRIES) -> DataFrame:
    """``date, users, volumes`` (a quantile sketch of user-day totals): bucket counts for thresholds named later."""
    return totals.groupBy("date").agg(
        F.count(F.lit(1)).alias("users"), F.kll_sketch_agg_double(F.col("daily_volume").cast("double"), entries).alias("volumes")
    )


def users_reaching(sketches: DataFrame, thresholds: Iterable[float]) -> DataFrame:
    """``date, threshold, users, user_count``: estimated users at or above each threshold, from the sketches alone."""

    def reaching(limit: float) -> Column:
        # The rank counts what is at or below a value, so it is asked for just below the threshold.
        rank = F.kll_sketch_get_rank_double("volumes", F.lit(math.nextafter(limit, -math.inf)))
        count = F.round(F.col("users") * (1 - rank)).cast("bigint")
        return F.struct(F.lit(float(limit)).alias("threshold"), count.alias("user_count"))

    return sketches.select("date", "users", F.inline(F.array(*map(reaching, thresholds)))).select(
        "date", "threshold", "users", "user_count"
    )


def volume_quantiles(sketches: DataFrame, ranks: Iterable[float], start=None, end=None) -> DataFrame:
    """``rank, volume`` over any range of dates, from merged sketches."""
    merged = in_dates(sketches, start, end).agg(F.kll_merge_agg_double("volumes").alias("volumes"))
    found = [
        F.struct(F.lit(float(rank)).alias("rank"), F.kll_sketch_get_quantile_double("volumes", F.lit(float(rank))).alias("volume"))
        for rank in ranks
    ]
    return merged.select(F.inline(F.array(*found)))
