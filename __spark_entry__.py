
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from datetime import date, datetime

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle_queries  # noqa: E402
from fillmetrics import FillAnalytics  # noqa: E402
from fillmetrics import adapters as ad  # noqa: E402
from fillmetrics.operators import activity, bounded, cohorts, inventory, journeys, marts, normalize, quality  # noqa: E402
from fillmetrics.operators import reconcile, rescue, sketches  # noqa: E402
from fillmetrics.schema import NODE_FILLS, NODE_FILLS_BY_BLOCK, NODE_TRADES  # noqa: E402
from fillmetrics.sources.raw import count_lines  # noqa: E402
from fillmetrics.sources.snapshots import PublishedTable  # noqa: E402
from fillmetrics.sources.tables import checkpoint_folder  # noqa: E402

try:
    from fillmetrics.llm import registry as llm
except ImportError as missing:  # the library is complete without the operators for training text
    if missing.name not in ("fillmetrics.llm", "fillmetrics.llm.registry", "corpus_pipeline"):
        raise  # they are there and broken
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

BUCKETS = oracle_queries.BUCKETS
HORIZONS = oracle_queries.HORIZONS
COINS = list(oracle_queries.COINS)
AS_OF = datetime(2024, 2, 5)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.table(spark, sf_dir, "events")


def _event_metrics(spark: SparkSession, sf_dir: str) -> FillAnalytics:
    return FillAnalytics.from_fills(ad.fills_from_events(_events(spark, sf_dir)))


def _line_metrics(spark: SparkSession, sf_dir: str) -> FillAnalytics:
    lines, orders, part = (ad.table(spark, sf_dir, name) for name in ("lineitem", "orders", "part"))
    return FillAnalytics.from_fills(ad.fills_from_lineitem(lines, orders, part))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.fills_from_orders(ad.table(spark, sf_dir, "orders"))


def _doubled(df: DataFrame, *names: str) -> DataFrame:
    """Amounts are decimal inside the engine and double at its edge."""
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def _rounded(df: DataFrame, name: str) -> DataFrame:
    """Means of quotients depend on summation order in the last digit."""
    return df.withColumn(name, F.round(name, 10))


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored fills: one source per date, losing lines dropped before they are parsed."""
    return normalize.accepted(_winning_fills(spark, sf_dir, ad.EVENT_CATALOG))


def _winning_fills(spark: SparkSession, sf_dir: str, catalog) -> DataFrame:
    raw = ad.raw_by_dataset(_events(spark, sf_dir))
    return normalize.convert_all({name: normalize.winning_rows(lines, catalog) for name, lines in raw.items()})


def _converted(make, dataset: str) -> Query:
    return lambda spark, sf_dir: normalize.accepted(normalize.convert(make(_events(spark, sf_dir)), dataset))


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.source_plan(ad.raw_files_from_events(_events(spark, sf_dir)), ad.GAPPED_CATALOG)


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = normalize.accepted(_winning_fills(spark, sf_dir, ad.GAPPED_CATALOG))
    written = stored.groupBy("date").agg(F.count(F.lit(1)).alias("records"))
    return normalize.run_status(_plan(spark, sf_dir), written)


def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _plan(spark, sf_dir)
    return normalize.pending(plan, plan.where(F.col("dataset") == NODE_TRADES))


def _raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = list(ad.raw_by_dataset(_events(spark, sf_dir)).values())
    return count_lines(raw[0].unionByName(raw[1]).unionByName(raw[2]))


def _count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = quality.expected_fills(_winning_fills(spark, sf_dir, ad.EVENT_CATALOG))
    # A store that lost some fills of one source, which the check has to find.
    lost = (F.col("dataset_source") == NODE_FILLS) & (F.col("coin") == COINS[0])
    return quality.count_check(_raw_counts(spark, sf_dir), expected, _normalized(spark, sf_dir).where(~lost))


def _all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.accepted(normalize.convert_all(ad.raw_by_dataset(_events(spark, sf_dir))))


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fills whose number of the trade is damaged where the number of the order ends in 7."""
    raw = ad.raw_fills(_events(spark, sf_dir))
    damaged = raw.withColumn("value", F.regexp_replace("value", r'("oid":\d*7,"tid":)\d+', '$1"7x"'))
    found = normalize.rejected(normalize.convert(damaged, NODE_FILLS))
    return found.groupBy("dataset_source", "date", "defect").agg(F.count(F.lit(1)).alias("n"))


def _untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices that are no numbers, and sizes with more digits than their type, by the last digit of the order's number."""
    last = F.col("oid") % 10
    spoilt = _normalized(spark, sf_dir).withColumns(
        {
            "px": F.when(last == 3, F.concat("px", F.lit("x"))).otherwise(F.col("px")),
            "sz": F.when(last == 4, F.lit("0.1234567")).otherwise(F.col("sz")),
        }
    )
    return normalize.count_untyped(spoilt)


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.listing_from_documents(ad.table(spark, sf_dir, "documents"))


def _inventory_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = ad.present_files(ad.table(spark, sf_dir, "documents"), ad.table(spark, sf_dir, "labels"))
    return inventory.pending_files(_listing(spark, sf_dir), present)


# Dates that the queries below write anew, and those that a killed write would have changed.
REWRITTEN = [date(2024, 1, day) for day in (9, 10, 11)]
KILLED = [date(2024, 1, day) for day in (20, 21)]


def _snapshot_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fills per version and date: a reader from before a rewrite, a reader after it, and a write that broke off in between."""
    fills = ad.fills_from_events(_events(spark, sf_dir))
    shared = checkpoint_folder(spark, spark.conf.get("spark.sql.warehouse.dir"))
    table = PublishedTable(spark, f"{shared}/snapshot-{uuid.uuid4().hex}")
    table.publish(fills.where(F.col("coin") != COINS[0]))
    early = table.read()
    table.write(fills.where(F.col("date").isin(KILLED)))
    table.publish(fills.where(F.col("date").isin(REWRITTEN) & (F.col("date") != REWRITTEN[-1])), days=REWRITTEN)
    table.write(fills.where(F.col("date").isin(KILLED)))
    versions = early.withColumn("version", F.lit(1)).unionByName(table.read().withColumn("version", F.lit(2)))
    return versions.groupBy("version", "date").agg(
        F.count(F.lit(1)).alias("fills"), F.sum(F.col("sz") * F.col("px")).cast("double").alias("volume")
    )


def _advanced_journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The journeys after dates were appended in two batches, and one batch of older dates was written anew in between."""
    now = _event_metrics(spark, sf_dir).user_daily_volume
    # What the rewritten dates held before: other volumes, and some users that are gone now.
    odd = F.pmod(F.crc32(F.col("user_address").cast("binary")), F.lit(3)) == 0
    user = F.when(odd, F.concat(F.lit("gone"), "user_address")).otherwise(F.col("user_address"))
    then = now.where(F.col("date").isin(REWRITTEN)).withColumns({"daily_volume": F.col("daily_volume") * 7, "user_address": user})
    middle, last = REWRITTEN[-1], date(2024, 1, 19)
    start = now.where((F.col("date") <= middle) & ~F.col("date").isin(REWRITTEN)).unionByName(then)
    state = journeys.journeys(start, BUCKETS)
    state = journeys.advanced(state, now.where((F.col("date") > middle) & (F.col("date") <= last)), thresholds=BUCKETS)
    state = journeys.advanced(
        state, now.where(F.col("date").isin(REWRITTEN)), REWRITTEN, now.where(F.col("date") <= last), BUCKETS
    )
    return journeys.advanced(state, now.where(F.col("date") > last), thresholds=BUCKETS)


def _advanced_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moves per date after some dates were written anew, of which only these and their neighbours are read."""
    now = _event_metrics(spark, sf_dir).user_daily_volume
    amount = F.when(F.col("date").isin(REWRITTEN), F.col("daily_volume") * 7).otherwise(F.col("daily_volume"))
    before = cohorts.steps(now.withColumn("daily_volume", amount), BUCKETS)
    return journeys.advanced_steps(before, now, REWRITTEN, BUCKETS)


def _sketch_mau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly users, exact and whether the union of daily sketches is close."""
    metrics = _line_metrics(spark, sf_dir)
    close = sketches.users_by_month(metrics.user_sketches).select("month", F.col("mau").alias("estimate"))
    return metrics.get_mau().join(close, "month", "left").select(
        "month", "mau", sketches.within_bound(F.col("estimate"), F.col("mau")).alias("within")
    )


def _sketch_traders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traders per coin over a range, exact and whether the union of sketches is close."""
    metrics = _line_metrics(spark, sf_dir)
    close = sketches.users_by_coin(metrics.user_sketches, "1996-01-01", "1997-12-31")
    exact = metrics.get_coin_statistics("1996-01-01", "1997-12-31")
    return exact.join(close.withColumnRenamed("unique_traders", "estimate"), "coin", "left").select(
        "coin", "unique_traders", sketches.within_bound(F.col("estimate"), F.col("unique_traders")).alias("within")
    )


def _sketch_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of a choice of coins in a range and those not seen before it, exact and whether the sketches are close."""
    metrics = _line_metrics(spark, sf_dir)
    coins, start, end = ["Brand#1", "Brand#2"], "1995-01-01", "1995-12-31"
    close = sketches.users_in_range(metrics.user_sketches, start, end, coins)
    chosen = metrics.fills.where(F.col("coin").isin(coins) & (F.col("date") <= F.lit(end).cast("date")))
    per_user = chosen.groupBy("user_address").agg(
        F.min("date").alias("first"), F.max("date").alias("last")
    ).where(F.col("last") >= F.lit(start).cast("date"))
    exact = per_user.agg(
        F.count(F.lit(1)).alias("users"),
        F.count(F.when(F.col("first") >= F.lit(start).cast("date"), F.lit(1))).alias("new_users"),
    )
    estimates = close.select(F.struct("users", "new_users").alias("estimate")).scalar()
    return exact.withColumn("estimate", estimates).select(
        "users",
        "new_users",
        sketches.within_bound(F.col("estimate.users"), F.col("users")).alias("users_within"),
        sketches.within_bound(F.col("estimate.new_users"), F.col("new_users"), F.col("users") * 2).alias("new_users_within"),
    )


def _ledger_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of a listing that had been listed once before: which are due, and what the ledger holds afterwards."""
    files = _listing(spark, sf_dir).select(
        "dataset",
        F.col("modified").cast("date").alias("date"),
        F.col("key").alias("path"),
        "size",
        F.col("modified").cast("timestamp").alias("modified"),
    )

    def as_of(moment: datetime) -> DataFrame:
        listed_at = F.lit(moment.isoformat(sep=" ")).cast("timestamp")
        return files.where(F.col("modified") <= listed_at).groupBy("dataset", "date").agg(
            F.max("modified").alias("folder_time"),
            F.collect_list(F.struct("path", "size", "modified")).alias("files"),
        ).withColumn("listed_at", listed_at)

    first, second = as_of(LISTED[0]), as_of(LISTED[1])
    due = inventory.due_folders(second, first)
    held = inventory.latest_files(first.unionByName(due)).groupBy("dataset", "date").agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")
    )
    listed = due.select("dataset", "date", F.lit(True).alias("listed"))
    return held.join(listed, ["dataset", "date"], "left").withColumn("listed", F.coalesce("listed", F.lit(False)))


def _kept(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """The same rows, computed once and read from the shared folder from then on."""
    folder = f"{checkpoint_folder(spark, spark.conf.get('spark.sql.warehouse.dir'))}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    return spark.read.parquet(folder)


def _reconciled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Expected fills, and a store in which some were swapped, some doubled and as many lost.

    Both are read twice, to be compared and for what differs, so the raw lines are converted once beforehand.
    """
    expected = _kept(spark, _normalized(spark, sf_dir), "expected")
    last = F.col("oid") % 100
    doubled = (last == 7) & (F.col("date") < F.lit(REWRITTEN[0]))
    lost = (last == 9) & (F.col("date") < F.lit(REWRITTEN[0]))
    swapped = (last == 11) & F.col("date").isin(KILLED)
    stored = (
        expected.where(~F.coalesce(lost, F.lit(False)))
        .withColumn("user_address", F.when(swapped, F.concat("user_address", F.lit("x"))).otherwise(F.col("user_address")))
        .withColumn("copy", F.explode(F.when(doubled, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        .drop("copy")
    )
    return expected, stored


def _content_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected, stored = _reconciled(spark, sf_dir)
    checked = reconcile.content_check(expected, stored)
    found = reconcile.differing_rows(expected, stored, checked)
    return found.select("dataset_source", "date", "oid", "user_address", "px", "missing")


def _top_users_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = _event_metrics(spark, sf_dir)
    leaders = bounded.daily_leaders(metrics.user_daily_volume, PROOF_LEADERS)
    return bounded.bounded_reading(leaders, metrics.daily_user_volume, PROOF_LIMIT, *PROOF_RANGE)


def _top_users_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = _event_metrics(spark, sf_dir)
    leaders = bounded.daily_leaders(metrics.user_daily_volume, PROOF_LEADERS)
    return bounded.bounded_top_users(leaders, metrics.daily_user_volume, PROOF_LIMIT, *PROOF_RANGE)


PROOF_LEADERS, PROOF_LIMIT, PROOF_RANGE = 50, 5, ("2024-01-05", "2024-01-06")
REACHED = [100, 250, 1000]


def _sketch_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users reaching thresholds, exact and whether the quantile sketches are within their rank error (one user at least)."""
    totals = _event_metrics(spark, sf_dir).user_daily_volume
    close = sketches.users_reaching(sketches.volume_sketches(totals), REACHED).withColumnRenamed("user_count", "estimate")
    reaching = [F.count(F.when(F.col("daily_volume") >= limit, F.lit(1))) for limit in REACHED]
    pairs = F.array(*[F.struct(F.lit(float(limit)).alias("threshold"), n.alias("user_count")) for limit, n in zip(REACHED, reaching)])
    exact = totals.groupBy("date").agg(pairs.alias("pairs")).select("date", F.inline("pairs"))
    bound = F.greatest(F.lit(1.0), 2 * sketches.RANK_ERROR * F.col("users"))
    return exact.join(close, ["date", "threshold"], "left").select(
        "date", "threshold", "user_count", (F.abs(F.col("estimate") - F.col("user_count")) <= bound).alias("within")
    )


def _unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines of which some have fields that no schema names."""
    raw = ad.raw_by_dataset(_events(spark, sf_dir))
    added = {
        NODE_TRADES: (r'"hash":"(\d*4)"', '"hash":"$1","venue":"v1"'),
        NODE_FILLS: (r'"oid":(\d*3),', '"oid":$1,"liquidation":{"mark":"2.5"},'),
        NODE_FILLS_BY_BLOCK: (r'"builder":"0xb"', '"builder":"0xb","builderTier":2'),
    }
    found = None
    for dataset, lines in raw.items():
        lines = lines.withColumn("value", F.regexp_replace("value", *added[dataset]))
        if dataset == NODE_FILLS_BY_BLOCK:
            lines = lines.withColumn("value", F.regexp_replace("value", r'^\{', '{"height":1,'))
        counted = rescue.unknown_fields(lines, dataset)
        found = counted if found is None else found.unionByName(counted)
    return found


LISTED = (datetime(2024, 1, 6, 12), datetime(2024, 1, 8, 12))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: upgrade and downgrade rates of users by their first volume bucket."""
    return _event_metrics(spark, "/root/testdata/sf0.001").get_bucket_mobility(HORIZONS, BUCKETS)


def _on_events(ask: Callable[[FillAnalytics], DataFrame]) -> Query:
    return lambda spark, sf_dir: ask(_event_metrics(spark, sf_dir))


def _on_lines(ask: Callable[[FillAnalytics], DataFrame]) -> Query:
    return lambda spark, sf_dir: ask(_line_metrics(spark, sf_dir))


def _known_to_workers(query: Query) -> Query:
    """Python workers started from another folder look for the package here; a cluster has it installed or shipped."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        environment = spark.sparkContext.environment
        paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
        if ROOT not in paths:
            environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    optional = llm.queries() if llm else {}
    return _core_queries() | {name: _known_to_workers(query) for name, query in optional.items()}


def _core_queries() -> dict[str, Query]:
    return {
        # raw records, source choice, typed fills
        "normalize_trades": _converted(ad.raw_trades, NODE_TRADES),
        "normalize_fills": _converted(ad.raw_fills, NODE_FILLS),
        "normalize_blocks": _converted(ad.raw_blocks, NODE_FILLS_BY_BLOCK),
        "normalize_all": _all_sources,
        "rejected_rows": _rejected,
        "untyped_counts": _untyped,
        "overlap_dedup": _normalized,
        "source_plan": _plan,
        "pending_dates": _pending,
        "normalize_status": _status,
        "normalize_stats": lambda spark, sf_dir: normalize.run_statistics(_status(spark, sf_dir)),
        "snapshot_versions": _snapshot_versions,
        "typed_fills": lambda spark, sf_dir: _doubled(
            ad.fills_from_events(_events(spark, sf_dir)), "px", "sz", "closed_pnl", "fee"
        ),
        "typed_from_text": lambda spark, sf_dir: _doubled(
            normalize.typed_fills(_normalized(spark, sf_dir)), "px", "sz", "closed_pnl", "fee"
        ),
        # summaries
        "user_activity": _on_events(lambda m: _doubled(m.user_activity, "volume")),
        "daily_user_volume": _on_events(lambda m: _doubled(m.daily_user_volume, "daily_volume")),
        "daily_user_volume_both_sides": _on_events(
            lambda m: _doubled(marts.daily_user_volume_from_activity(m.user_activity, ("A", "B")), "daily_volume")
        ),
        "user_first_trade": _on_events(lambda m: m.user_first_trade),
        "daily_metrics": _on_events(lambda m: _doubled(m.daily_metrics, "total_volume")),
        "daily_metrics_from_activity": _on_events(
            lambda m: _doubled(marts.daily_metrics_from_activity(m.user_activity, m.fills), "total_volume")
        ),
        "user_daily_volume": _on_events(lambda m: _doubled(m.user_daily_volume, "daily_volume")),
        "coin_preagg": _on_events(lambda m: _doubled(marts.coin_preaggregate(m.fills, COINS), "volume")),
        "side_reconciliation": _on_events(lambda m: m.get_side_reconciliation()),
        "custom_sql": _on_events(lambda m: m.execute_custom_query(oracle_queries.CUSTOM_SQL)),
        # activity
        "dau": _on_events(lambda m: m.get_dau()),
        "dau_range": _on_events(lambda m: m.get_dau("2024-01-05", "2024-01-20")),
        "dau_coin": _on_events(lambda m: m.get_dau(coins=COINS[0])),
        "dau_coins": _on_events(lambda m: m.get_dau(coins=COINS)),
        "approx_dau": _on_events(lambda m: activity.approx_dau_check(m.fills)),
        "dau_stats": _on_events(lambda m: m.get_dau_statistics()),
        "mau": _on_lines(lambda m: m.get_mau()),
        "mau_month": _on_lines(lambda m: m.get_mau("1998-03")),
        "mau_coin": _on_lines(lambda m: m.get_mau(coins=["Brand#1", "Brand#2"])),
        "daily_new_users": _on_lines(lambda m: m.get_daily_new_users()),
        "new_users_ma7": _on_lines(lambda m: m.get_new_users_with_mean()),
        "new_users_dense": _on_lines(lambda m: activity.densified(m.get_daily_new_users(), "new_users")),
        "new_user_stats": _on_lines(lambda m: m.get_new_user_statistics()),
        # volume buckets
        "volume_buckets": _on_events(lambda m: m.get_volume_buckets()),
        "volume_buckets_coin": _on_events(
            lambda m: m.get_volume_buckets("2024-01-03", "2024-01-25", BUCKETS, COINS)
        ),
        "user_daily_buckets": _on_events(lambda m: m.get_user_daily_buckets()),
        "cumulative_thresholds": _on_events(lambda m: m.get_cumulative_thresholds()),
        "cumulative_thresholds_coin": _on_events(lambda m: m.get_cumulative_thresholds(coins=COINS)),
        "threshold_averages": _on_events(lambda m: m.get_threshold_averages()),
        "user_mix": _on_events(lambda m: m.get_user_mix()),
        "user_mix_average": _on_events(lambda m: _rounded(m.get_user_mix_average(), "average_share")),
        "bucket_transitions": _on_events(lambda m: m.get_bucket_transitions(BUCKETS)),
        "bucket_retention": _on_events(lambda m: m.get_bucket_retention(BUCKETS)),
        "bucket_mobility": _on_events(lambda m: m.get_bucket_mobility(HORIZONS, BUCKETS)),
        "mobility_long": _on_events(lambda m: m.get_mobility_long(HORIZONS, BUCKETS)),
        "journeys_advanced": _advanced_journeys,
        "steps_advanced": _advanced_steps,
        # distinct users by sketches
        "sketch_mau": _sketch_mau,
        "sketch_traders": _sketch_traders,
        "sketch_range": _sketch_range,
        "sketch_buckets": _sketch_buckets,
        # users, assets, summaries
        "top_users_bounded": _top_users_bounded,
        "top_users_proof": _top_users_proof,
        "top_users": _on_lines(lambda m: m.get_top_users_by_volume()),
        "top_users_range": _on_events(lambda m: m.get_top_users_by_volume(20, "2024-01-05", "2024-01-20")),
        "coin_statistics": _on_events(lambda m: m.get_coin_statistics()),
        "coin_statistics_range": _on_lines(lambda m: m.get_coin_statistics("1996-01-01", "1997-12-31")),
        "top_assets": _on_lines(lambda m: m.get_top_assets()),
        "top_assets_ranked": _on_lines(lambda m: m.get_top_assets_ranked()),
        "data_summary": _on_events(lambda m: m.data_summary()),
        "summary_report": _on_lines(lambda m: m.get_summary_report()),
        # checks
        "content_check": lambda spark, sf_dir: reconcile.content_check(*_reconciled(spark, sf_dir)),
        "content_differences": _content_differences,
        "unknown_fields": _unknown_fields,
        "raw_counts": _raw_counts,
        "processed_counts": lambda spark, sf_dir: quality.processed_counts(_normalized(spark, sf_dir)),
        "count_check": _count_check,
        "overlap_check": lambda spark, sf_dir: quality.overlap_check(
            _all_sources(spark, sf_dir), normalize.overlaps(ad.EVENT_CATALOG)
        ),
        "completeness": lambda spark, sf_dir: quality.completeness(_orders(spark, sf_dir)),
        "missing_dates": lambda spark, sf_dir: quality.missing_dates(_orders(spark, sf_dir)),
        "overall_stats": lambda spark, sf_dir: quality.overall_statistics(_normalized(spark, sf_dir)),
        "stats_by_source": lambda spark, sf_dir: quality.statistics_by_source(_normalized(spark, sf_dir)),
        "top_coins_by_count": lambda spark, sf_dir: quality.top_coins_by_count(_line_metrics(spark, sf_dir).fills),
        # file inventory
        "inventory_range": lambda spark, sf_dir: inventory.last_days(_listing(spark, sf_dir), "month", AS_OF),
        "inventory_pending": _inventory_pending,
        "listing_ledger": _ledger_round,
        "inventory_summary": lambda spark, sf_dir: inventory.summary(_listing(spark, sf_dir)),
        "inventory_total": lambda spark, sf_dir: inventory.total(inventory.summary(_listing(spark, sf_dir))),
        "inventory_cost": lambda spark, sf_dir: inventory.transfer_cost(inventory.summary(_listing(spark, sf_dir))),
    }


def oracle_sql() -> dict[str, str]:
    return oracle_queries.all_sql() | (llm.oracle_sql() if llm else {})
