"""Users by volume bucket: distributions, day-over-day transitions and mobility.

All functions start from user-day totals (``date, user_address, daily_volume``), which hold at most one row per user
and day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fillmetrics.functions.buckets import (
    CUMULATIVE,
    DAILY_BUCKETS,
    HORIZONS,
    USER_BUCKETS,
    above_label,
    bucket_label,
    bucket_rank,
    check_thresholds,
    rank_label,
)
from fillmetrics.functions.values import to_double


def volume_buckets(totals: DataFrame, thresholds: Sequence[float] = DAILY_BUCKETS) -> DataFrame:
    """``date, volume_bucket, user_count, bucket_volume``."""
    return (
        totals.groupBy("date", bucket_label(F.col("daily_volume"), thresholds).alias("volume_bucket"))
        .agg(F.count(F.lit(1)).alias("user_count"), to_double(F.sum("daily_volume")).alias("bucket_volume"))
        .orderBy("date")
    )


def user_daily_buckets(totals: DataFrame, thresholds: Sequence[float] = USER_BUCKETS) -> DataFrame:
    """``date, volume_bucket, user_count``."""
    return (
        totals.groupBy("date", bucket_label(F.col("daily_volume"), thresholds).alias("volume_bucket"))
        .agg(F.count(F.lit(1)).alias("user_count"))
        .orderBy("date")
    )


def cumulative_thresholds(totals: DataFrame, thresholds: Sequence[float] = CUMULATIVE) -> DataFrame:
    """Users at or above each threshold per day: ``date, user_count, volume_bucket``.

    All thresholds are counted side by side in one pass and turned into rows afterwards, when only one row per day is
    left. Days on which nobody reaches a threshold are absent for it.
    """
    limits = check_thresholds(thresholds)
    counted = totals.groupBy("date").agg(
        *[
            F.count(F.when(F.col("daily_volume") >= F.lit(limit), F.lit(1))).alias(f"n{place}")
            for place, limit in enumerate(limits)
        ]
    )
    pairs = F.array(
        *[
            F.struct(F.col(f"n{place}").alias("user_count"), F.lit(above_label(limit)).alias("volume_bucket"))
            for place, limit in enumerate(limits)
        ]
    )
    return counted.select("date", F.inline(pairs)).where(F.col("user_count") > 0)


def threshold_averages(cumulative: DataFrame) -> DataFrame:
    """Mean users per threshold over the days present."""
    return cumulative.groupBy("volume_bucket").agg(
        (F.sum("user_count").cast("double") / F.count(F.lit(1))).alias("average_users")
    )


def user_mix(bucket_counts: DataFrame) -> DataFrame:
    """Share of every bucket in its day; input and window hold one row per day and bucket."""
    share = F.col("user_count") / F.sum("user_count").over(Window.partitionBy("date"))
    return bucket_counts.select("*", share.alias("share"))


def user_mix_average(mix: DataFrame) -> DataFrame:
    """Mean share per bucket over the days on which it occurs."""
    return mix.groupBy("volume_bucket").agg(F.avg("share").alias("average_share"))


def steps(totals: DataFrame, thresholds: Sequence[float] = USER_BUCKETS) -> DataFrame:
    """Moves from one day to the next: ``date`` (the later day), ``rank, next_rank, cnt``.

    A user's following day is looked up with ``lead``; one shuffle by user instead of a self join.
    """
    by_user = Window.partitionBy("user_address").orderBy("date")
    ranked = totals.where(F.col("user_address").isNotNull()).select(
        "user_address", "date", bucket_rank(F.col("daily_volume"), thresholds).alias("rank")
    )
    moves = ranked.select(
        "rank",
        "date",
        F.lead("rank").over(by_user).alias("next_rank"),
        F.lead("date").over(by_user).alias("next_date"),
    ).where(F.col("next_date") == F.date_add("date", 1))
    return moves.groupBy(F.col("next_date").alias("date"), "rank", "next_rank").agg(F.count(F.lit(1)).alias("cnt"))


def transitions_of_steps(steps: DataFrame, thresholds: Sequence[float] = USER_BUCKETS) -> DataFrame:
    """Moves between buckets over the days of ``steps``: ``bucket_t, bucket_t1, cnt, pct`` (within ``bucket_t``)."""
    counted = steps.groupBy("rank", "next_rank").agg(F.sum("cnt").alias("cnt"))
    return counted.select(
        rank_label(F.col("rank"), thresholds).alias("bucket_t"),
        rank_label(F.col("next_rank"), thresholds).alias("bucket_t1"),
        "cnt",
        (F.col("cnt").cast("double") / F.sum("cnt").over(Window.partitionBy("rank"))).alias("pct"),
    ).orderBy("bucket_t", "bucket_t1")


def bucket_transitions(totals: DataFrame, thresholds: Sequence[float] = USER_BUCKETS) -> DataFrame:
    """Moves between buckets from one day to the next, straight from the totals."""
    return transitions_of_steps(steps(totals, thresholds), thresholds)


def bucket_retention(transitions: DataFrame) -> DataFrame:
    """Users staying in their bucket: the diagonal of the transitions."""
    return transitions.where(F.col("bucket_t") == F.col("bucket_t1")).select("bucket_t", "cnt", "pct")


def first_dates(totals: DataFrame, thresholds: Sequence[float] = USER_BUCKETS) -> DataFrame:
    """One row per user: the first date of each rank, ``d0, d1, ...``.

    Per user only these matter for mobility: the earliest of them is the start, and every other rank is first met after
    it. That is a plain MIN aggregate with a fixed number of dates per user, so it combines before the shuffle and
    needs neither a sort nor a join.
    """
    ranks = range(len(check_thresholds(thresholds)) + 1)
    return (
        totals.where(F.col("user_address").isNotNull())
        .select("user_address", "date", bucket_rank(F.col("daily_volume"), thresholds).alias("rank"))
        .groupBy("user_address")
        .agg(*[F.min(F.when(F.col("rank") == rank, F.col("date"))).alias(f"d{rank}") for rank in ranks])
    )


def _moves(first: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """One row per user: start rank and the days until the first higher and the first lower rank."""
    ranks = range(len(check_thresholds(thresholds)) + 1)
    start = F.least(*[F.col(f"d{rank}") for rank in ranks])
    start_rank = F.coalesce(*[F.when(F.col(f"d{rank}") == start, F.lit(rank)) for rank in ranks])
    started = first.select("*", start.alias("start_date"), start_rank.alias("start_rank"))

    def first_move(wanted) -> F.Column:
        dates = [F.when(wanted(rank), F.col(f"d{rank}")) for rank in ranks]
        return F.datediff(F.least(*dates), F.col("start_date"))

    return started.select(
        "start_rank",
        first_move(lambda rank: F.lit(rank) > F.col("start_rank")).alias("up_after"),
        first_move(lambda rank: F.lit(rank) < F.col("start_rank")).alias("down_after"),
    )


def bucket_mobility(
    totals: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    thresholds: Sequence[float] = USER_BUCKETS,
) -> DataFrame:
    """Share of each start bucket that moves up or down within ``(start, start + horizon]``, straight from the totals."""
    return mobility_of_journeys(first_dates(totals, thresholds), horizons, thresholds)


def mobility_of_journeys(
    journeys: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    thresholds: Sequence[float] = USER_BUCKETS,
) -> DataFrame:
    """The same from the first date of each rank per user (:func:`first_dates`, or stored journeys).

    Columns ``start_rank, horizon, upgrade_rate, downgrade_rate, cohort_size``. The start is the user's first day;
    users seen for less than the horizon stay in the cohort.
    """
    counts = [F.count(F.lit(1)).alias("cohort_size")]
    for place, days in enumerate(horizons):
        counts.append(F.count(F.when(F.col("up_after") <= days, F.lit(1))).alias(f"up{place}"))
        counts.append(F.count(F.when(F.col("down_after") <= days, F.lit(1))).alias(f"down{place}"))
    cohorts = _moves(journeys, thresholds).groupBy("start_rank").agg(*counts)
    size = F.nullif(F.col("cohort_size"), F.lit(0))
    rows = F.array(
        *[
            F.struct(
                F.lit(days).cast("int").alias("horizon"),
                (F.col(f"up{place}").cast("double") / size).alias("upgrade_rate"),
                (F.col(f"down{place}").cast("double") / size).alias("downgrade_rate"),
            )
            for place, days in enumerate(horizons)
        ]
    )
    return (
        cohorts.select("start_rank", "cohort_size", F.inline(rows))
        .select("start_rank", "horizon", "upgrade_rate", "downgrade_rate", "cohort_size")
        .orderBy("start_rank", "horizon")
    )


def mobility_long(mobility: DataFrame, thresholds: Sequence[float] = USER_BUCKETS) -> DataFrame:
    """Mobility with labels, one row per rate: ``bucket, horizon, cohort_size, type, rate``."""
    labelled = mobility.withColumn("bucket", rank_label(F.col("start_rank"), thresholds))
    return labelled.unpivot(
        ["bucket", "horizon", "cohort_size"], ["upgrade_rate", "downgrade_rate"], "type", "rate"
    )
