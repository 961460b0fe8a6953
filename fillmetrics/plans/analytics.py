"""One object for all questions: opens the marts (building them on first use) and offers every metric as a method."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fillmetrics.functions.buckets import CUMULATIVE, DAILY_BUCKETS, HORIZONS, USER_BUCKETS
from fillmetrics.functions.filters import as_list, in_dates
from fillmetrics.functions.values import to_double
from fillmetrics.operators import activity, assets, bounded, cohorts, marts, reports, sketches
from fillmetrics.plans import marts as stored
from fillmetrics.schema import NUMERIC
from fillmetrics.sources.bucketed import store_by_user

Coins = str | Iterable[str] | None


class FillAnalytics:
    """Metrics over a normalised fills table and its marts. Results are lazy DataFrames.

    All answers come from the state of the marts that was the last when the object was made, whatever is built meanwhile;
    ``refresh`` goes on to the state that is the last now. ``from_fills`` works on a DataFrame of fills without stored
    marts; the summaries are then part of each plan.
    """

    def __init__(
        self,
        spark: SparkSession,
        data_dir: str,
        mart_dir: str,
        rebuild: bool = False,
        numeric: str = NUMERIC,
        sides: Iterable[str] = marts.MARKET_SIDES,
        with_sketches: bool = False,
    ):
        self.spark = spark
        self.with_sketches = with_sketches
        self.data_dir = data_dir
        self.mart_dir = mart_dir
        self.numeric = numeric
        self.sides = tuple(sides)
        self._state = None if rebuild else stored.read_state(spark, mart_dir)
        if self._state:
            self._state.require(self.sides, numeric)
        else:
            self.rebuild_database()

    @classmethod
    def from_fills(cls, fills: DataFrame, sides: Iterable[str] = marts.MARKET_SIDES) -> FillAnalytics:
        made = cls.__new__(cls)
        made.spark = fills.sparkSession
        made.mart_dir = None
        made.sides = tuple(sides)
        made.fills = fills
        made.user_activity = marts.user_activity(fills)
        made.daily_user_volume = marts.daily_user_volume(fills, made.sides)
        made.user_daily_volume = marts.user_daily_volume_from_fills(fills, sides=made.sides)
        made.user_first_trade = marts.user_first_trade(fills)
        made.daily_metrics = marts.daily_metrics_from_activity(made.user_activity, fills)
        made.user_sketches = sketches.user_sketches(fills)
        made.volume_sketches = sketches.volume_sketches(made.user_daily_volume)
        made.daily_leaders = bounded.daily_leaders(made.user_daily_volume)
        return made

    def rebuild_database(self) -> None:
        """Build all marts again from the stored fills."""
        had = getattr(self, "_state", None)
        stored.build_marts(
            self.spark,
            self.data_dir,
            self.mart_dir,
            sides=self.sides,
            numeric=self.numeric,
            with_sketches=self.with_sketches or bool(had and had.sketches),
        )
        self.refresh()

    def refresh(self) -> None:
        """Read the marts as they are now."""
        self._state = stored.read_state(self.spark, self.mart_dir)
        for name in (*stored.DATED, *stored.WHOLE):
            self.__dict__.pop(name, None)

    def store_by_user(self, table: str, buckets: int = 200) -> None:
        """Keep the user-day totals by user in a catalog table as well; until ``refresh``, questions per user read that one.

        Transitions and mobility for any thresholds then need no shuffle by user.
        """
        self.user_daily_volume = store_by_user(self.user_daily_volume, table, self.mart_dir, buckets)

    def _mart(self, name: str) -> DataFrame:
        found = stored.read_dated(self.spark, self.mart_dir, self._state, name)
        if found is None:
            none = FillAnalytics.from_fills(stored.empty_fills(self.spark, self.numeric), self.sides)
            found = getattr(none, name)
        return found

    def _whole(self, name: str) -> DataFrame:
        return stored.read_whole(self.spark, self.mart_dir, self._state, name)

    @cached_property
    def fills(self) -> DataFrame:
        return self._mart(stored.FILLS)

    @cached_property
    def user_activity(self) -> DataFrame:
        return self._mart(stored.ACTIVITY)

    @cached_property
    def daily_user_volume(self) -> DataFrame:
        """One side's volumes are rows of the activity table; several sides have a table of their own."""
        if len(set(self.sides)) == 1:
            return marts.daily_user_volume_from_activity(self.user_activity, self.sides)
        return self._mart(stored.VOLUMES)

    @cached_property
    def user_daily_volume(self) -> DataFrame:
        return self._mart(stored.TOTALS)

    @cached_property
    def user_first_trade(self) -> DataFrame:
        return self._whole(stored.FIRST_TRADES)

    @cached_property
    def daily_metrics(self) -> DataFrame:
        return self._whole(stored.METRICS)

    @cached_property
    def daily_new_users(self) -> DataFrame:
        """One row per day with new users."""
        if self.mart_dir is None:
            return activity.new_users(self.user_first_trade)
        return self._whole(stored.NEW_USERS).orderBy("date")

    def _sketch(self, name: str) -> DataFrame:
        if not self._state.sketches:
            raise ValueError("these marts have no sketches; build them with with_sketches=True")
        return self._mart(name)

    @cached_property
    def user_sketches(self) -> DataFrame:
        """Distinct users as sketches per date, coin and side."""
        return self._sketch(stored.SKETCHES)

    @cached_property
    def volume_sketches(self) -> DataFrame:
        """User-day volumes as a quantile sketch per date."""
        return self._sketch(stored.VOLUME_SKETCHES)

    @cached_property
    def daily_leaders(self) -> DataFrame:
        """The first users of each date by volume."""
        return self._sketch(stored.LEADERS)

    def user_totals(self, coins: Coins = None) -> DataFrame:
        """User-day totals: the stored table for all coins, an aggregate for a selection."""
        selected = as_list(coins)
        if not selected:
            return self.user_daily_volume
        if self.mart_dir is None:
            return marts.user_daily_volume_from_fills(self.fills, selected, self.sides)
        return marts.user_daily_volume(self.daily_user_volume, selected)

    # -- activity ----------------------------------------------------------------------------------------------

    def get_dau(self, start_date=None, end_date=None, coins: Coins = None) -> DataFrame:
        """Daily active users. With coins the meaning changes: see :func:`activity.dau_of_coins`."""
        selected = as_list(coins)
        if selected:
            return activity.dau_of_coins(self.daily_user_volume, selected, start_date, end_date)
        return activity.dau(self.daily_metrics, start_date, end_date)

    def get_mau(self, month: str | None = None, coins: Coins = None) -> DataFrame:
        return activity.mau(self.daily_user_volume, month, coins)

    def get_daily_new_users(self) -> DataFrame:
        """``date, new_users``; a day without any is absent."""
        return self.daily_new_users

    def get_new_users_with_mean(self, rows: int = 7) -> DataFrame:
        return activity.centred_mean(self.get_daily_new_users(), rows=rows)

    def get_dau_statistics(self) -> DataFrame:
        return activity.dau_statistics(self.daily_metrics)

    def get_new_user_statistics(self) -> DataFrame:
        return activity.new_user_statistics(self.get_daily_new_users())

    def get_users_by_sketch(self, start_date=None, end_date=None, coins: Coins = None, sides=("A", "B")) -> DataFrame:
        """Estimated ``users`` and ``new_users`` of any range and choice of coins; one row."""
        return sketches.users_in_range(self.user_sketches, start_date, end_date, coins, sides)

    def get_mau_by_sketch(self, coins: Coins = None) -> DataFrame:
        return sketches.users_by_month(self.user_sketches, coins, self.sides)

    def get_approx_dau(self, start_date=None, end_date=None, rsd: float = 0.05) -> DataFrame:
        return activity.approx_dau(self.user_activity, start_date, end_date, rsd)

    # -- cohorts -----------------------------------------------------------------------------------------------

    def get_volume_buckets(
        self, start_date=None, end_date=None, buckets: Sequence[float] | None = None, coins: Coins = None
    ) -> DataFrame:
        totals = in_dates(self.user_totals(coins), start_date, end_date)
        return cohorts.volume_buckets(totals, DAILY_BUCKETS if buckets is None else buckets)

    def get_user_daily_buckets(self, buckets: Sequence[float] | None = None) -> DataFrame:
        return cohorts.user_daily_buckets(self.user_totals(), USER_BUCKETS if buckets is None else buckets)

    def get_cumulative_thresholds(
        self, thresholds: Sequence[float] = CUMULATIVE, coins: Coins = None
    ) -> DataFrame:
        return cohorts.cumulative_thresholds(self.user_totals(coins), thresholds)

    def get_users_reaching(self, thresholds: Sequence[float]) -> DataFrame:
        """Estimated users per day at or above any thresholds, from one sketch per day."""
        return sketches.users_reaching(self.volume_sketches, thresholds)

    def get_threshold_averages(self, thresholds: Sequence[float] = CUMULATIVE, coins: Coins = None) -> DataFrame:
        return cohorts.threshold_averages(self.get_cumulative_thresholds(thresholds, coins))

    def get_user_mix(self, buckets: Sequence[float] | None = None) -> DataFrame:
        return cohorts.user_mix(self.get_user_daily_buckets(buckets))

    def get_user_mix_average(self, buckets: Sequence[float] | None = None) -> DataFrame:
        return cohorts.user_mix_average(self.get_user_mix(buckets))

    def get_bucket_transitions(self, buckets: Sequence[float] | None = None) -> DataFrame:
        limits = USER_BUCKETS if buckets is None else buckets
        if self._stores(limits):
            return cohorts.transitions_of_steps(self._whole(stored.STEPS), limits)
        return cohorts.bucket_transitions(self.user_totals(), limits)

    def get_bucket_retention(self, buckets: Sequence[float] | None = None) -> DataFrame:
        return cohorts.bucket_retention(self.get_bucket_transitions(buckets))

    def get_bucket_mobility(
        self, horizon_days: Sequence[int] | None = None, buckets: Sequence[float] | None = None
    ) -> DataFrame:
        limits = USER_BUCKETS if buckets is None else buckets
        horizons = HORIZONS if horizon_days is None else horizon_days
        if self._stores(limits):
            return cohorts.mobility_of_journeys(self._whole(stored.JOURNEYS), horizons, limits)
        return cohorts.bucket_mobility(self.user_totals(), horizons, limits)

    def _stores(self, buckets: Sequence[float]) -> bool:
        """Whether journeys and steps are stored for these buckets."""
        return self.mart_dir is not None and tuple(map(float, buckets)) == self._state.thresholds

    def get_mobility_long(
        self, horizon_days: Sequence[int] | None = None, buckets: Sequence[float] | None = None
    ) -> DataFrame:
        limits = USER_BUCKETS if buckets is None else buckets
        return cohorts.mobility_long(self.get_bucket_mobility(horizon_days, limits), limits)

    # -- users and assets --------------------------------------------------------------------------------------

    def get_top_users_by_volume(self, limit: int = 100, start_date=None, end_date=None) -> DataFrame:
        return assets.top_users(self.daily_user_volume, limit, start_date, end_date)

    def get_top_users_bounded(self, limit: int = 100, start_date=None, end_date=None) -> DataFrame:
        """The same, summing only users that the daily leaders leave in question."""
        return bounded.bounded_top_users(self.daily_leaders, self.daily_user_volume, limit, start_date, end_date)

    def get_coin_statistics(self, start_date=None, end_date=None) -> DataFrame:
        return assets.coin_statistics(self.daily_user_volume, start_date, end_date)

    def get_top_assets(self, limit: int = 20) -> DataFrame:
        return assets.top_assets(self.daily_user_volume, limit)

    def get_top_assets_ranked(self, limit: int = 10) -> DataFrame:
        return assets.top_assets_ranked(self.daily_user_volume, limit)

    def get_side_reconciliation(self) -> DataFrame:
        return marts.side_reconciliation_from_activity(self.user_activity)

    # -- summaries and SQL -------------------------------------------------------------------------------------

    def data_summary(self) -> DataFrame:
        return reports.data_summary(self.user_activity, self.user_first_trade, self.daily_metrics)

    def get_data_summary(self) -> dict:
        """The eight summary figures as a dictionary (one row is fetched)."""
        row: Row = self.data_summary().first()
        return row.asDict()

    def get_summary_report(self) -> DataFrame:
        if self.mart_dir is None:
            return reports.summary_report_of_days(marts.days(self.fills))
        return reports.summary_report(self.user_activity, self.daily_metrics, self.get_daily_new_users())

    def _views(self) -> dict[str, DataFrame]:
        """The tables that SQL may name, amounts as double."""

        def view(df: DataFrame, *amounts: str) -> DataFrame:
            return df.withColumns({amount: to_double(F.col(amount)) for amount in amounts}) if amounts else df

        return {
            "fills": view(self.fills, "px", "sz", "closed_pnl", "fee"),
            "daily_user_volume": view(self.daily_user_volume, "daily_volume"),
            "daily_metrics": view(self.daily_metrics, "total_volume"),
            "user_first_trade": self.user_first_trade,
        }

    def register_views(self, prefix: str = "") -> None:
        """Temp views ``fills``, ``daily_user_volume``, ``user_first_trade`` and ``daily_metrics`` of the session."""
        for name, df in self._views().items():
            df.createOrReplaceTempView(prefix + name)

    def execute_custom_query(self, query: str) -> DataFrame:
        """A SELECT in Spark SQL over this object's own tables, whatever other objects the session has.

        The names are bound within the statement; a table that it does not name is not read.
        """
        prefix = f"fillmetrics_{uuid.uuid4().hex}_"
        names = list(self._views())
        self.register_views(prefix)
        try:
            bound = ", ".join(f"{name} AS (SELECT * FROM {prefix}{name})" for name in names)
            return self.spark.sql(f"WITH {bound} SELECT * FROM (\n{query.strip().rstrip(';')}\n)")
        finally:
            # What was analysed needs the views no longer.
            for name in names:
                self.spark.catalog.dropTempView(prefix + name)
