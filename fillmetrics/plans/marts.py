"""Building and refreshing the stored summaries, published together.

Layout below the mart root: ``fills`` (typed), ``user_activity``, ``user_daily_volume`` and, if asked for, ``daily_user_volume`` (several
sides), ``user_sketches``, ``volume_sketches`` and ``daily_leaders`` are kept by date, each run in folders of its own; ``user_first_trade``, ``daily_metrics``,
``daily_new_users``, ``user_journeys`` and ``bucket_steps`` are whole tables, a new folder per run.

``state`` is written last, as one small file. It holds the settings, for each date the run that holds it and the fills file
it was made from, and the run of the whole tables. A reader that opened one state sees the marts of that state, all of
them, whatever is built meanwhile; a build that broke off leaves the state before it. Dates whose fills differ from the
state are made again. One job at a time may write below a mart root.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillmetrics.functions.buckets import USER_BUCKETS
from fillmetrics.operators import activity as users
from fillmetrics.operators import bounded, cohorts, journeys, marts, normalize, sketches
from fillmetrics.schema import NORMALIZED_PARTITIONED, NUMERIC
from fillmetrics.session import sized_shuffles
from fillmetrics.sources.folders import remove, subfolders
from fillmetrics.sources.snapshots import GRACE, Held, file_versions, held_files, new_run, read_runs, remove_runs, write_run
from fillmetrics.sources.tables import open_stored, scan_table, write_whole

FILLS = "fills"
ACTIVITY = "user_activity"
VOLUMES = "daily_user_volume"
TOTALS = "user_daily_volume"
SKETCHES = "user_sketches"
VOLUME_SKETCHES = "volume_sketches"
LEADERS = "daily_leaders"
METRICS = "daily_metrics"
FIRST_TRADES = "user_first_trade"
NEW_USERS = "daily_new_users"
JOURNEYS = "user_journeys"
STEPS = "bucket_steps"
DATED = (FILLS, ACTIVITY, VOLUMES, TOTALS, SKETCHES, VOLUME_SKETCHES, LEADERS)
WHOLE = (METRICS, FIRST_TRADES, NEW_USERS, JOURNEYS, STEPS)
TABLES = (FILLS, ACTIVITY, VOLUMES, TOTALS, METRICS, FIRST_TRADES)

STATE = (
    "date date, last_file string, run string, run_dates int, sides string, numeric string, thresholds array<double>, "
    "sketches boolean"
)


def mart_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


@dataclass(frozen=True)
class State:
    """What the marts below a root are made of: settings, the run of the whole tables, files and runs by date."""

    sides: tuple[str, ...]
    numeric: str
    thresholds: tuple[float, ...]
    sketches: bool
    run: str
    dates: dict[date, str] = field(default_factory=dict)
    runs: dict[date, Held] = field(default_factory=dict)

    def require(self, sides: Iterable[str], numeric: str) -> None:
        """Raise unless the marts mean what is asked for."""
        if (self.sides, self.numeric) != (_sides(sides), numeric):
            raise ValueError(
                f"marts were built with sides={self.sides} and numeric={self.numeric!r}, not with "
                f"sides={_sides(sides)} and numeric={numeric!r}; ask for the former or rebuild them"
            )


def _sides(sides: Iterable[str]) -> tuple[str, ...]:
    return tuple(sorted(set(sides)))


def read_state(spark: SparkSession, root: str, version: int | None = None) -> State | None:
    """A state, by default the last (one row per stored date passes through the driver); none of an older layout."""
    if version is None:
        version = max(file_versions(spark, mart_path(root, "state")), default=None)
    if version is None:
        return None
    rows = spark.read.schema(STATE).parquet(mart_path(root, f"state/{version:09d}")).collect()
    header = next(row for row in rows if row.date is None)
    if header.run is None:
        return None
    dated = [row for row in rows if row.date is not None]
    return State(
        tuple(header.sides.split(",")),
        header.numeric,
        tuple(header.thresholds),
        header.sketches,
        header.run,
        {row.date: row.last_file for row in dated},
        {row.date: Held(row.run, row.run_dates, 0) for row in dated},
    )


def _write_state(spark: SparkSession, root: str, state: State) -> None:
    """A new version in one file, which is there as a whole or not at all."""
    settings = (",".join(state.sides), state.numeric, list(state.thresholds), state.sketches)
    rows = [(None, None, state.run, None, *settings)]
    rows += [(day, name, state.runs[day].run, state.runs[day].run_dates, *settings) for day, name in sorted(state.dates.items())]
    number = max(file_versions(spark, mart_path(root, "state")), default=0) + 1
    spark.createDataFrame(rows, STATE).coalesce(1).write.mode("error").parquet(mart_path(root, f"state/{number:09d}"))


def marts_exist(spark: SparkSession, root: str) -> bool:
    return read_state(spark, root) is not None


def empty_fills(spark: SparkSession, numeric: str) -> DataFrame:
    return normalize.typed_fills(spark.createDataFrame([], NORMALIZED_PARTITIONED), numeric)


def read_dated(spark: SparkSession, root: str, state: State, name: str) -> DataFrame | None:
    """A dated mart of one state; None where it has no date."""
    return read_runs(spark, mart_path(root, name), state.runs)


def read_whole(spark: SparkSession, root: str, state: State, name: str) -> DataFrame:
    return scan_table(spark, mart_path(root, f"{name}/{state.run}"))


def build_marts(
    spark: SparkSession,
    fills_path: str,
    root: str,
    days: Iterable[date] | None = None,
    sides: Iterable[str] = marts.MARKET_SIDES,
    numeric: str = NUMERIC,
    append_only: bool = False,
    thresholds: Sequence[float] = USER_BUCKETS,
    with_sketches: bool | None = None,
) -> None:
    """Build all marts, or bring them up to date for ``days`` after those dates were written or rewritten.

    Other ``sides`` or ``numeric`` than those of existing marts raise before anything is written. First trades and
    journeys are merged; only users whose stored row rests on a rewritten date are looked up in the whole history, and none
    if ``append_only`` promises that ``days`` only add fills. ``thresholds`` are those of the stored journeys and steps.
    ``with_sketches`` adds distinct users as sketches per date, coin and side, volumes as sketches per date, and the leaders of
    each date; a refresh keeps what there is.
    """
    sides = _sides(sides)
    before = read_state(spark, root) if days is not None else None
    if before is not None:
        before.require(sides, numeric)
        thresholds = before.thresholds
        with_sketches = before.sketches if with_sketches is None else with_sketches
        if with_sketches and not before.sketches:
            raise ValueError("sketches can only be added by building all marts")
    # One state of the fills: what is published from now on will differ from it.
    held, source = open_stored(spark, fills_path)
    days = None if before is None else sorted(set(days))
    wanted = sorted(held) if days is None else [day for day in days if day in held]
    run = new_run()
    fresh = {day: Held(run, len(wanted), 0) for day in wanted}
    kept = {} if before is None else {day: was for day, was in before.runs.items() if day not in days and day in held}
    state = State(
        sides,
        numeric,
        tuple(float(limit) for limit in thresholds),
        bool(with_sketches),
        run,
        {day: held[day][0] if day in fresh else before.dates[day] for day in kept | fresh},
        kept | fresh,
    )

    def store(df: DataFrame, name: str, *sort: str) -> DataFrame:
        """The rows of the new dates, read back."""
        if not fresh:
            return df.limit(0)
        write_run(df, mart_path(root, name), run, wanted, sort)
        return read_runs(spark, mart_path(root, name), fresh)

    def store_whole(df: DataFrame, name: str, small: bool = True) -> DataFrame:
        path = mart_path(root, f"{name}/{run}")
        if small:
            # One row per date, or a few.
            df.coalesce(1).write.parquet(path)
        else:
            write_whole(df, path)
        return scan_table(spark, path)

    def all_dates(name: str, none: DataFrame) -> DataFrame:
        found = read_dated(spark, root, state, name)
        return none if found is None else found

    with sized_shuffles(spark, sum(held[day][1] for day in wanted)):
        chosen = source if days is None else source.where(F.col("date").isin(wanted))
        fills = store(normalize.typed_fills(chosen, numeric), FILLS, "side", "coin")
        activity = store(marts.user_activity(fills), ACTIVITY, "side", "coin")
        rewritten = [] if append_only or days is None else [day for day in days if day in before.dates]

        def store_volumes() -> None:
            volumes = marts.daily_user_volume_from_activity(activity, sides)
            if len(sides) > 1:
                volumes = store(volumes, VOLUMES, "coin")
            totals = store(marts.user_daily_volume(volumes), TOTALS)
            if state.sketches:
                store(sketches.volume_sketches(totals), VOLUME_SKETCHES)
                store(bounded.daily_leaders(totals), LEADERS, "place")
            steps_of_days = [] if days is None else days
            if before is None:
                states, steps = journeys.journeys(totals, thresholds), cohorts.steps(totals, thresholds)
            else:
                history = all_dates(TOTALS, totals)
                states = journeys.advanced(
                    read_whole(spark, root, before, JOURNEYS), totals, rewritten, history, thresholds
                )
                steps = journeys.advanced_steps(
                    read_whole(spark, root, before, STEPS), history, steps_of_days, thresholds
                )
            store_whole(states, JOURNEYS, small=False)
            store_whole(steps, STEPS)

        def store_metrics() -> None:
            metrics = marts.daily_metrics_from_activity(activity, fills)
            if before is not None:
                known = read_whole(spark, root, before, METRICS)
                metrics = metrics.unionByName(known.where(~F.col("date").isin(days)))
            store_whole(metrics, METRICS)

        def store_first_trades() -> None:
            seen = activity.select("user_address", "date")
            if before is not None:
                known = read_whole(spark, root, before, FIRST_TRADES).withColumnRenamed("first_trade_date", "date")
                lost = known.where(F.col("date").isin(rewritten)).select(F.col("user_address").alias("lost"))
                seen = seen.unionByName(known.where(~F.col("date").isin(rewritten)))
                if rewritten:
                    history = all_dates(ACTIVITY, activity).select("user_address", "date")
                    seen = seen.unionByName(
                        history.join(lost, F.col("user_address").eqNullSafe(F.col("lost")), "left_semi")
                    )
            first = store_whole(marts.user_first_trade(seen), FIRST_TRADES, small=False)
            store_whole(users.new_users(first), NEW_USERS)

        def store_sketches() -> None:
            if state.sketches:
                store(sketches.user_sketches(activity), SKETCHES, "coin", "side")

        # These depend on fills and activity only; submitted together they fill the cluster better.
        work: list[Callable[[], None]] = [store_volumes, store_metrics, store_first_trades, store_sketches]
        with ThreadPoolExecutor(len(work)) as pool:
            for done in [pool.submit(step) for step in work]:
                done.result()

    _write_state(spark, root, state)


def stale_dates(spark: SparkSession, fills_path: str, root: str) -> list[date]:
    """Dates whose stored fills are not those the marts were made from (one entry per date)."""
    state = read_state(spark, root)
    made = state.dates if state else {}
    held = {row.date: row.last_file for row in held_files(spark, fills_path).collect()}
    return sorted(day for day in held.keys() | made.keys() if held.get(day) != made.get(day))


def remove_unreferenced(spark: SparkSession, root: str, keep_states: int = 1, grace: timedelta = GRACE) -> list[str]:
    """Forget all but the last states, and remove the folders that none of these names; the folders removed.

    Only what was last changed longer than ``grace`` ago goes, as builds under way name their folders last.
    """
    versions = file_versions(spark, mart_path(root, "state"))
    kept = [read_state(spark, root, version) for version in versions[-keep_states:]]
    kept = [state for state in kept if state is not None]
    cutoff = datetime.now(timezone.utc).replace(tzinfo=None) - grace
    remove(spark, [mart_path(root, f"state/{version:09d}") for version in versions[:-keep_states]])
    referenced = {(held.run, day) for state in kept for day, held in state.runs.items()}
    gone = [path for name in DATED for path in remove_runs(spark, mart_path(root, name), referenced, cutoff)]
    runs = {state.run for state in kept}
    doomed = [
        folder.path
        for name in WHOLE
        for folder in subfolders(spark, mart_path(root, name))
        if folder.name not in runs and folder.modified is not None and folder.modified < cutoff
    ]
    remove(spark, doomed)
    return gone + doomed
