"""Journeys of users through the volume buckets as a state that is merged day by day.

The state has one row per user: the first date of each rank (``d0, d1, ...``), the last date and its rank. Minima and maxima
merge, so new dates are added without looking at older ones. They do not take back: where a date is written anew, the users
whose state names that date, and only they, are looked up again in the totals.

All functions start from user-day totals (``date, user_address, daily_volume``). Rows without a user are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillmetrics.functions.buckets import USER_BUCKETS, bucket_rank, check_thresholds
from fillmetrics.operators.cohorts import steps


def _first(thresholds: Sequence[float]) -> list[str]:
    return [f"d{rank}" for rank in range(len(check_thresholds(thresholds)) + 1)]


def journeys(totals: DataFrame, thresholds: Sequence[float] = USER_BUCKETS) -> DataFrame:
    """``user_address, d0, d1, ..., last_date, last_rank`` over all dates of ``totals``."""
    ranked = totals.where(F.col("user_address").isNotNull()).select(
        "user_address", "date", bucket_rank(F.col("daily_volume"), thresholds).alias("rank")
    )
    first = [F.min(F.when(F.col("rank") == rank, F.col("date"))).alias(name) for rank, name in enumerate(_first(thresholds))]
    grouped = ranked.groupBy("user_address").agg(*first, F.max(F.struct("date", "rank")).alias("last"))
    return grouped.select(
        "user_address", *_first(thresholds), F.col("last.date").alias("last_date"), F.col("last.rank").alias("last_rank")
    )


def merged(states: DataFrame, thresholds: Sequence[float] = USER_BUCKETS) -> DataFrame:
    """One state per user out of several."""
    grouped = states.groupBy("user_address").agg(
        *[F.min(name).alias(name) for name in _first(thresholds)],
        F.max(F.struct("last_date", "last_rank")).alias("last"),
    )
    return grouped.select("user_address", *_first(thresholds), "last.last_date", "last.last_rank")


def _names(thresholds: Sequence[float], days: Sequence[date]) -> Column:
    """Whether a state rests on a row of one of the days."""
    found = F.lit(False)
    for name in [*_first(thresholds), "last_date"]:
        found = found | F.coalesce(F.col(name).isin(list(days)), F.lit(False))
    return found


def advanced(
    before: DataFrame,
    added: DataFrame,
    rewritten: Sequence[date] = (),
    history: DataFrame | None = None,
    thresholds: Sequence[float] = USER_BUCKETS,
) -> DataFrame:
    """The state after dates were appended or written anew.

    ``added`` are the totals of those dates as they are now, ``rewritten`` the dates that ``before`` knows in another
    form, ``history`` the totals of all dates as they are now. Without rewritten dates the history is not read.
    """
    states = journeys(added, thresholds)
    if not rewritten:
        return merged(before.unionByName(states), thresholds)
    if history is None:
        raise ValueError("rewritten dates need the history")
    stale = _names(thresholds, rewritten)
    lost = before.where(stale).select(F.col("user_address").alias("lost"))
    again = journeys(history.join(lost, F.col("user_address") == F.col("lost"), "left_semi"), thresholds)
    return merged(before.where(~stale).unionByName(again).unionByName(states), thresholds)


def step_dates(days: Iterable[date]) -> list[date]:
    """Dates whose moves change with the totals of ``days``: moves into a day, and out of it into the next."""
    return sorted({moved for day in days for moved in (day, day + timedelta(days=1))})


def advanced_steps(
    before: DataFrame, totals: DataFrame, days: Iterable[date], thresholds: Sequence[float] = USER_BUCKETS
) -> DataFrame:
    """Moves per date (:func:`cohorts.steps`) after the totals of ``days`` changed.

    Of ``totals`` only those days and their neighbours are read.
    """
    changed = step_dates(days)
    near = sorted({day for moved in changed for day in (moved, moved - timedelta(days=1))})
    again = steps(totals.where(F.col("date").isin(near)), thresholds).where(F.col("date").isin(changed))
    return before.where(~F.col("date").isin(changed)).unionByName(again)
