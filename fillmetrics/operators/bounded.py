"""The top users without summing all users, with a proof that they are the top.

Stored per date are its first users by volume, the *leaders*, and a *floor*: nobody else had more on that date. Over a range of
dates the volumes of a user as a leader are a lower bound of the user's total, and with the floors of the other dates an
upper bound. Let the threshold be the ``limit``-th largest lower bound. Whoever's upper bound is below it is not among the first
``limit``, and neither is anybody who never led if all floors together are below it. Only the rows of the users that remain are
summed. Where the floors are too high for a proof, all users remain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fillmetrics.functions.filters import in_dates
from fillmetrics.operators.assets import top_users

LEADERS = 1000


def daily_leaders(totals: DataFrame, leaders: int = LEADERS) -> DataFrame:
    """``date, place, user_address, daily_volume, floor`` of the first ``leaders`` of each date, from user-day totals.

    The floor is the volume of the last leader, or zero if all users of the date are leaders. It is a bound only for volumes that are
    not negative, as volumes are. Places beyond ``leaders`` are dropped in each task before the shuffle.
    """
    by_date = Window.partitionBy("date").orderBy(F.desc("daily_volume"), F.asc_nulls_last("user_address"))
    ranked = totals.select("date", "user_address", "daily_volume").withColumn("place", F.row_number().over(by_date))
    kept = ranked.where(F.col("place") <= leaders)
    full = Window.partitionBy("date")
    floor = F.when(F.count(F.lit(1)).over(full) == leaders, F.min("daily_volume").over(full)).otherwise(F.lit(0))
    return kept.select("date", "place", "user_address", "daily_volume", floor.alias("floor"))


def _bounds(leaders: DataFrame, limit: int, start=None, end=None) -> tuple[DataFrame, DataFrame]:
    """``user_address, low, above_floors`` (high less all floors) of the leaders; ``threshold, floors`` in one row."""
    chosen = in_dates(leaders, start, end)
    floors = chosen.groupBy("date").agg(F.max("floor").alias("floor")).agg(F.sum("floor").alias("floors"))
    per_user = chosen.groupBy("user_address").agg(F.sum("daily_volume").alias("low"), F.sum("floor").alias("spared"))
    threshold = (
        per_user.select("low").orderBy(F.desc("low")).limit(limit).agg(F.min("low").alias("threshold"), F.count(F.lit(1)).alias("n"))
    )
    # Fewer leaders than the limit prove nothing about the others.
    proof = threshold.select(
        F.when(F.col("n") == limit, F.col("threshold")).alias("threshold"), floors.scalar().alias("floors")
    )
    return per_user.select("user_address", "low", (F.col("low") - F.col("spared")).alias("above_floors")), proof


def candidates(leaders: DataFrame, limit: int = 100, start=None, end=None) -> tuple[DataFrame | None, dict]:
    """The users that may be among the first ``limit``, or None where all may be; and the proof, one row fetched."""
    users, proof = _bounds(leaders, limit, start, end)
    row = proof.first()
    proven = row.threshold is not None and row.floors < row.threshold
    told = {"threshold": row.threshold, "floors": row.floors, "proven": proven}
    if not proven:
        return None, told
    # A tie with the threshold stays: it may win by address.
    kept = users.where(F.col("above_floors") + F.lit(row.floors) >= F.lit(row.threshold))
    return kept.select(F.col("user_address").alias("candidate")), told


def bounded_top_users(leaders: DataFrame, volumes: DataFrame, limit: int = 100, start=None, end=None) -> DataFrame:
    """What :func:`assets.top_users` gives, summing only the users that may be among the first ``limit``."""
    kept, _ = candidates(leaders, limit, start, end)
    if kept is not None:
        volumes = volumes.join(kept, F.col("user_address").eqNullSafe(F.col("candidate")), "left_semi")
    return top_users(volumes, limit, start, end)


def bounded_reading(leaders: DataFrame, volumes: DataFrame, limit: int = 100, start=None, end=None) -> DataFrame:
    """What the proof saves: ``proven, users, candidates, rows, rows_summed`` of a range; one row."""
    kept, told = candidates(leaders, limit, start, end)
    chosen = in_dates(volumes, start, end)
    may = F.lit(True)
    if kept is not None:
        chosen = chosen.join(kept, F.col("user_address").eqNullSafe(F.col("candidate")), "left")
        may = F.col("candidate").isNotNull()
    user = F.struct("user_address")  # a null user is one, too
    return chosen.agg(
        F.lit(told["proven"]).alias("proven"),
        F.count_distinct(user).alias("users"),
        F.count_distinct(F.when(may, user)).alias("candidates"),
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(may, F.lit(1))).alias("rows_summed"),
    )
