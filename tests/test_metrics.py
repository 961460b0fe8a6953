from datetime import date, timedelta
from decimal import Decimal

import pytest
from fixtures import FILLS, TOTALS, as_rows, day, fill
from pyspark.sql import functions as F

from fillmetrics import FillAnalytics
from fillmetrics.functions import buckets as b
from fillmetrics.functions.filters import in_month
from fillmetrics.operators import activity, assets, cohorts, marts

TWO_SIDED = [
    fill("u1", side="A", sz="5", hash_="h1"),
    fill("u2", side="B", sz="5", hash_="h1"),
    fill("u1", side="A", sz="1", hash_="h1"),
    fill("u3", side="B", sz="1", hash_="h1"),
]


def metrics_of(spark, rows):
    return FillAnalytics.from_fills(spark.createDataFrame(rows, FILLS))


def totals_of(spark, rows):
    return spark.createDataFrame([(u, on, None if v is None else Decimal(v)) for u, on, v in rows], TOTALS)


JOURNEYS = [
    ("u1", day(1), 500), ("u1", day(2), 5000), ("u1", day(3), 500),
    ("u2", day(1), 500), ("u2", day(3), 500), ("u2", day(9), 20000),
    ("u3", day(1), 5000), ("u3", day(2), 500),
]


def test_two_sided_counting(spark):
    metrics = metrics_of(spark, TWO_SIDED)
    assert as_rows(metrics.get_dau()) == [(day(1), 3, 600.0, 1)]
    assert as_rows(metrics.get_dau(coins="BTC")) == [(day(1), 1, 600.0, 2)]
    assert as_rows(metrics.get_dau(coins=["BTC", "ETH"])) == [(day(1), 1, 600.0, 2)]
    assert as_rows(metrics.get_dau(coins=[])) == as_rows(metrics.get_dau())
    assert as_rows(metrics.get_side_reconciliation()) == [(day(1), 1200.0, 600.0, 600.0, 0.0)]
    assert as_rows(metrics.user_first_trade) == [("u1", day(1)), ("u2", day(1)), ("u3", day(1))]
    both = FillAnalytics.from_fills(spark.createDataFrame(TWO_SIDED, FILLS), sides=("A", "B"))
    assert both.get_dau(coins="BTC").first().dau == 3


def test_summaries_from_activity_equal_those_from_fills(spark):
    rows = TWO_SIDED + [
        fill("u4", "ETH", "B", on=day(2)),
        fill("u4", "ETH", "A", "0.10", "3", "h9", day(3)),
        fill("u1", "ETH", "A", "7", "3", "h9", day(3)),
        fill(None, "BTC", "A", "7", "3", "h8", day(3)),
    ]
    fills = spark.createDataFrame(rows, FILLS)
    by_user = marts.user_activity(fills)
    assert as_rows(marts.daily_metrics_from_activity(by_user, fills)) == as_rows(marts.daily_metrics(fills))
    assert as_rows(marts.user_first_trade(by_user)) == as_rows(marts.user_first_trade(fills))
    for sides in (("A",), ("B",), ("A", "B")):
        assert as_rows(marts.daily_user_volume_from_activity(by_user, sides)) == as_rows(
            marts.daily_user_volume(fills, sides)
        )
    assert as_rows(marts.side_reconciliation_from_activity(by_user)) == as_rows(marts.side_reconciliation(fills))


def test_one_user_per_row_for_a_single_coin(spark):
    rows = [fill("u1"), fill("u2", sz="2"), fill(None), fill("u1", "ETH")]
    volumes = marts.daily_user_volume(spark.createDataFrame(rows, FILLS))
    one = activity.dau_of_coins(volumes, "BTC")
    assert as_rows(one) == as_rows(activity.dau_of_coins(volumes, ["BTC", "none"]))
    assert one.first().dau == 2


def test_bucket_edges(spark):
    volumes = [("a", day(1), "999.99"), ("b", day(1), "1000"), ("c", day(1), "10000"), ("d", day(1), "100000")]
    frame = totals_of(spark, volumes + [("e", day(1), None)])
    got = frame.select(
        "user_address",
        b.bucket_rank(F.col("daily_volume"), b.USER_BUCKETS).alias("rank"),
        b.bucket_label(F.col("daily_volume"), b.USER_BUCKETS).alias("label"),
    )
    assert as_rows(got) == [
        ("a", 0, "< $1,000"),
        ("b", 1, "$1,000 - $10,000"),
        ("c", 2, "$10,000 - $100,000"),
        ("d", 3, ">= $100,000"),
        ("e", 3, ">= $100,000"),
    ]
    assert as_rows(cohorts.cumulative_thresholds(frame)) == [
        (day(1), 1, "> $100,000"), (day(1), 2, "> $10,000"), (day(1), 3, "> $1,000"),
    ]


@pytest.mark.parametrize("thresholds", [[], [1, 1], [2, 1]])
def test_thresholds_must_increase(thresholds):
    with pytest.raises(ValueError):
        b.labels(thresholds)


def test_transitions(spark):
    moves = cohorts.bucket_transitions(totals_of(spark, JOURNEYS))
    low, mid = "< $1,000", "$1,000 - $10,000"
    assert as_rows(moves) == [(mid, low, 2, 1.0), (low, mid, 1, 1.0)]
    assert cohorts.bucket_retention(moves).count() == 0


def test_mobility(spark):
    result = cohorts.bucket_mobility(totals_of(spark, JOURNEYS), [7, 8])
    assert as_rows(result) == [
        (0, 7, 0.5, 0.0, 2), (0, 8, 1.0, 0.0, 2), (1, 7, 0.0, 1.0, 1), (1, 8, 0.0, 1.0, 1),
    ]
    long = cohorts.mobility_long(result)
    assert long.columns == ["bucket", "horizon", "cohort_size", "type", "rate"]
    assert long.count() == 8 and {row.bucket for row in long.collect()} == {"< $1,000", "$1,000 - $10,000"}


def test_mobility_looks_at_every_later_day_not_only_the_first(spark):
    rows = [("u", day(1), 5000), ("u", day(2), 5000), ("u", day(3), 1), ("u", day(4), 200000), ("u", day(5), 20000)]
    assert as_rows(cohorts.bucket_mobility(totals_of(spark, rows), [1, 2, 3])) == [
        (1, 1, 0.0, 0.0, 1), (1, 2, 0.0, 1.0, 1), (1, 3, 1.0, 1.0, 1),
    ]


def test_centred_mean(spark):
    def series(days):
        return spark.createDataFrame([(on, n) for n, on in enumerate(days, 1)], "date date, new_users bigint")

    means = [row.ma_7 for row in activity.centred_mean(series([day(n) for n in range(1, 10)])).collect()]
    assert means == [None, None, None, 4.0, 5.0, 6.0, None, None, None]
    assert {row.ma_7 for row in activity.centred_mean(series([day(n) for n in range(1, 6)])).collect()} == {None}
    gap = [day(n) for n in (1, 2, 3, 4, 5, 6, 20)]
    assert [row.ma_7 for row in activity.centred_mean(series(gap)).collect()][3] == 4.0


def test_peaks_take_the_earliest_date(spark):
    daily = spark.createDataFrame(
        [(day(3), 5), (day(1), 5), (day(2), 1), (day(4), 1)], "date date, dau bigint"
    )
    row = activity.dau_statistics(daily).first()
    assert (row.average_dau, row.median_dau, row.max_dau, row.min_dau) == (3.0, 3.0, 5, 1)
    assert (row.peak_date, row.lowest_date) == (day(1), day(2))


def test_month_is_a_half_open_range(spark):
    frame = spark.createDataFrame([(date(2025, 12, 31),), (date(2026, 1, 1),), (date(2025, 11, 30),)], "date date")
    assert as_rows(in_month(frame, "2025-12")) == [(date(2025, 12, 31),)]


def test_top_users_break_ties_by_address(spark):
    rows = [fill("c"), fill("a"), fill("b", "ETH"), fill("b", on=day(2)), fill(None, sz="9")]
    top = assets.top_users(marts.daily_user_volume(spark.createDataFrame(rows, FILLS)), 3)
    assert [tuple(row) for row in top.collect()] == [
        (None, 1, 900.0, 1, 1), ("b", 2, 200.0, 2, 2), ("a", 1, 100.0, 1, 1),
    ]


def test_invariants(spark):
    start = day(1)
    rows = [
        fill(f"u{n % 7}", "BTC" if n % 3 else "ETH", "A" if n % 2 else "B", str(1 + n), "2", f"h{n // 2}",
             start + timedelta(days=n % 5))
        for n in range(60)
    ]
    metrics = metrics_of(spark, rows)
    for row in metrics.get_side_reconciliation().collect():
        assert row.a_volume + row.b_volume == row.all_volume
    per_day = {row.date: row.n for row in metrics.user_totals().groupBy("date").agg(F.count("*").alias("n")).collect()}
    counted = metrics.get_user_daily_buckets([50, 100]).groupBy("date").agg(F.sum("user_count").alias("n"))
    assert {row.date: row.n for row in counted.collect()} == per_day
    shares = metrics.get_user_mix([50, 100]).groupBy("date").agg(F.sum("share").alias("s")).collect()
    assert all(abs(row.s - 1) < 1e-12 for row in shares)
    kept = metrics.get_bucket_transitions([50, 100]).groupBy("bucket_t").agg(F.sum("pct").alias("s")).collect()
    assert all(abs(row.s - 1) < 1e-12 for row in kept)
    new = metrics.get_daily_new_users().agg(F.sum("new_users")).first()[0]
    assert new == metrics.get_data_summary()["unique_users"] == 7


def test_one_user_with_a_third_of_all_rows(spark):
    """A heavy user and coin are combined before the shuffle; results stay whole."""
    heavy = spark.range(30000).select(
        F.lit(day(1)).alias("date"),
        F.when(F.col("id") % 3 == 0, F.lit("whale")).otherwise(F.concat(F.lit("u"), F.col("id"))).alias("user_address"),
        F.lit("BTC").alias("coin"), F.lit("A").alias("side"),
        F.lit(1).cast("decimal(18,8)").alias("px"), F.lit(1).cast("decimal(18,8)").alias("sz"),
        F.col("id").cast("string").alias("hash"),
    )
    metrics = FillAnalytics.from_fills(heavy)
    assert metrics.get_top_users_by_volume(1).first().total_volume == 10000.0
    assert as_rows(metrics.get_dau()) == [(day(1), 20001, 30000.0, 30000)]
