"""Content reconciliation, bounded ranking, unknown fields, quantile sketches, wide prices, views of several objects."""

import random
from datetime import datetime
from decimal import Decimal

import __spark_entry__ as contract
import pytest
from fixtures import BLOCK, FILL, TRADE, as_rows, day, fill, FILLS, put_raw, raw
from pyspark.sql import functions as F

from fillmetrics import FillAnalytics, PipelineConf, run_pipeline
from fillmetrics.operators import assets, bounded, marts, normalize, reconcile, reports, rescue, sketches
from fillmetrics.schema import NODE_FILLS, NODE_FILLS_BY_BLOCK, NODE_TRADES

ROWS = "dataset_source string, date date, user string, px string"
COLUMNS = ("user", "px")


def test_swapped_and_doubled_rows_are_found_where_counts_agree(spark):
    expected = [("s", day(1), "a", "1"), ("s", day(1), "b", "2"), ("s", day(1), "c", None), ("s", day(2), "a", "1"), ("t", day(1), "a", "1")]
    stored = [("s", day(1), "a", "2"), ("s", day(1), "b", "1"), ("s", day(1), "c", None), ("s", day(2), "a", "1"), ("t", day(1), "a", "1")]
    left, right = (spark.createDataFrame(rows, ROWS) for rows in (expected, stored))
    checked = reconcile.content_check(left, right, COLUMNS)
    assert {(r.dataset_source, r.date): (r.same_count, r.passed) for r in checked.collect()} == {
        ("s", day(1)): (True, False), ("s", day(2)): (True, True), ("t", day(1)): (True, True)
    }
    assert as_rows(reconcile.differing_rows(left, right, checked, COLUMNS), "user", "px", "missing") == [
        ("a", "1", 1), ("a", "2", -1), ("b", "1", -1), ("b", "2", 1)
    ]
    doubled = spark.createDataFrame([*expected[:1], *expected[:1], *expected[2:]], ROWS)
    checked = reconcile.content_check(left, doubled, COLUMNS)
    assert as_rows(reconcile.differing_rows(left, doubled, checked, COLUMNS), "user", "missing") == [("a", -1), ("b", 1)]


@pytest.mark.parametrize("left,right", [(("x", None), (None, "x")), (("", None), (None, None)), (("ab", "c"), ("a", "bc"))])
def test_nulls_and_borders_of_columns_count(spark, left, right):
    frames = [spark.createDataFrame([("s", day(1), *row)], ROWS) for row in (left, right)]
    assert not reconcile.content_check(*frames, COLUMNS).first().passed
    assert reconcile.content_check(frames[0], frames[0], COLUMNS).first().passed


def test_keys_of_one_side_only(spark):
    some = spark.createDataFrame([("s", day(1), "a", "1"), (None, None, "a", "1")], ROWS)
    none = some.limit(0)
    assert {(r.expected_records, r.stored_records, r.passed) for r in reconcile.content_check(some, none, COLUMNS).collect()} == {(1, 0, False)}
    assert reconcile.content_check(some, some, COLUMNS).where("passed").count() == 2
    checked = reconcile.content_check(none, some, COLUMNS)
    assert as_rows(reconcile.differing_rows(none, some, checked, COLUMNS), "missing") == [(-1,), (-1,)]


def test_rows_are_not_shuffled_to_find_the_failed_keys(spark):
    rows = [(source, day(on), str(user), "1") for source in "st" for on in (1, 2) for user in range(5)]
    left, right = (spark.createDataFrame(some, ROWS) for some in (rows, rows[1:]))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = reconcile.differing_rows(left, right, reconcile.content_check(left, right, COLUMNS), COLUMNS)
        joins = [line for line in plan_of(found).split("\n") if "LeftSemi" in line]
        assert len(joins) == 2 and all("BroadcastHashJoin" in line for line in joins)
        assert as_rows(found, "dataset_source", "user", "missing") == [("s", "0", 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_raw_lines_are_converted_once_for_the_content_checks(spark, folder):
    rows = [(7, 2), (9, 2), (12, 2), (7, 12), (9, 12), (11, 20), (13, 20), (11, 25)]
    events = [(number * 100 + last, datetime(2024, 1, on), number, "click", 2.5, '{"k": 3}') for number, (last, on) in enumerate(rows)]
    kinds = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(events, kinds).write.parquet(f"{folder}/events.parquet")
    checked, found = (contract.queries()[name](spark, folder) for name in ("content_check", "content_differences"))
    for df in (checked, found):
        assert "from_json" not in plan_of(df) and "JsonToStructs" not in plan_of(df)
    assert {(r.date.day, r.expected_records, r.stored_records) for r in checked.where("not passed").collect()} == {(2, 6, 6), (20, 2, 2)}
    assert as_rows(found, "oid", "user_address", "missing") == [
        (109, "1", 1), (511, "5", 1), (511, "5x", -1), (7, "0", -1)
    ]


@pytest.mark.parametrize("seed,skewed", [(1, True), (2, True), (3, False)])
def test_bounded_ranking_equals_the_full_one(spark, seed, skewed):
    random.seed(seed)
    rows = []
    for number in range(1, 6):
        for user in range(60):
            size = 10 ** random.randint(0, 4) * (1 + user % 7) if skewed and user < 10 else random.randint(1, 9)
            rows.append(fill(f"u{user}" if user else None, random.choice(["x", "y"]), px="1", sz=str(size), on=day(number)))
    volumes = marts.daily_user_volume(spark.createDataFrame(rows, FILLS))
    totals = marts.user_daily_volume(volumes)
    for leaders, limit in ((12, 5), (12, 12), (3, 5), (1000, 100)):
        table = bounded.daily_leaders(totals, leaders)
        assert as_rows(bounded.bounded_top_users(table, volumes, limit)) == as_rows(assets.top_users(volumes, limit))
    reading = bounded.bounded_reading(bounded.daily_leaders(totals, 12), volumes, 5).first()
    assert reading.users == 60 and reading.rows == volumes.count()
    assert (reading.proven and reading.candidates <= 12 and reading.rows_summed < reading.rows) == skewed
    one_day = bounded.bounded_top_users(bounded.daily_leaders(totals, 12), volumes, 5, day(2), day(2))
    assert as_rows(one_day) == as_rows(assets.top_users(volumes, 5, day(2), day(2)))


def test_bounded_ranking_of_nothing(spark):
    volumes = marts.daily_user_volume(spark.createDataFrame([], FILLS))
    leaders = bounded.daily_leaders(marts.user_daily_volume(volumes))
    assert bounded.bounded_top_users(leaders, volumes).collect() == []


def test_unknown_fields_are_reported(spark):
    cases = {
        NODE_TRADES: (TRADE, TRADE.replace('"coin"', '"venue":{"id":1},"coin"').replace('"user":"0xb"', '"user":"0xb","tier":null'), {("venue", 1), ("side_info.tier", 1)}),
        NODE_FILLS: (FILL, FILL.replace('"coin"', '"liquidation":"x","coin"'), {("liquidation", 1)}),
        NODE_FILLS_BY_BLOCK: (BLOCK, BLOCK.replace('"builder"', '"tier":1,"builder"').replace('"events"', '"height":7,"events"'), {("height", 1), ("events.tier", 1)}),
    }
    for dataset, (plain, changed, expected) in cases.items():
        assert rescue.rescued(raw(spark, dataset, plain, "", "{broken", "[]", "null", "7"), dataset).count() == 0
        found = rescue.unknown_fields(raw(spark, dataset, plain, changed), dataset)
        assert {(row.field, row.records) for row in found.collect()} == expected
        kept = rescue.as_variant(rescue.rescued(raw(spark, dataset, changed), dataset))
        assert dict(kept.dtypes)["fields"] == "variant" and kept.count() == len(expected)
        # What is known is read as before.
        assert normalize.accepted(normalize.convert(raw(spark, dataset, changed), dataset)).count() > 0


def test_quantile_sketches_answer_any_threshold(spark):
    totals = spark.range(40000).select(
        F.date_add(F.lit(day(1)), F.pmod("id", F.lit(2)).cast("int")).alias("date"),
        F.col("id").cast("string").alias("user_address"),
        F.pmod(F.xxhash64("id"), F.lit(100000)).cast("decimal(20,2)").alias("daily_volume"),
    )
    made = sketches.volume_sketches(totals)
    limits = [0, 100, 5000, 50000, 99999, 200000]
    for row in sketches.users_reaching(made, limits).collect():
        exact = totals.where((F.col("date") == F.lit(row.date)) & (F.col("daily_volume") >= row.threshold)).count()
        assert abs(row.user_count - exact) <= 2 * sketches.RANK_ERROR * row.users
    for row in sketches.volume_quantiles(made, [0.1, 0.5, 0.9]).collect():
        below = totals.where(F.col("daily_volume") <= row.volume).count() / 40000
        assert abs(below - row.rank) <= 2 * sketches.RANK_ERROR


def test_stored_sketches_and_leaders(spark, folder):
    conf = PipelineConf(f"{folder}/raw", f"{folder}/fills", f"{folder}/marts", with_sketches=True)
    for number in (1, 2):
        put_raw(conf.raw_root, "node_fills_by_block", f"2025080{number}", "00", [BLOCK, BLOCK.replace("0xa", f"0x{number}")])
        run_pipeline(spark, conf)
    opened = FillAnalytics(spark, conf.fills_path, conf.mart_root)
    assert as_rows(opened.get_top_users_bounded(2)) == as_rows(opened.get_top_users_by_volume(2))
    assert {(row.date, row.user_count) for row in opened.get_users_reaching([10]).collect()} == {(day(1), 2), (day(2), 2)}
    assert opened.get_users_by_sketch().first().users == 4
    assert opened.get_users_by_sketch(day(2), day(2)).first().new_users == 1
    without = FillAnalytics(spark, conf.fills_path, f"{folder}/without")
    with pytest.raises(ValueError, match="sketches"):
        without.get_users_by_sketch()


def test_prices_of_a_million_and_more(spark, folder):
    conf = PipelineConf(f"{folder}/raw", f"{folder}/fills", f"{folder}/marts")
    put_raw(conf.raw_root, "node_fills_by_block", "20250801", "00", [BLOCK.replace('"px":"10"', '"px":"123456789012.5"')])
    run_pipeline(spark, conf)
    opened = FillAnalytics(spark, conf.fills_path, conf.mart_root)
    assert opened.get_top_users_by_volume(1).first().total_volume == 123456789012.5
    assert opened.get_dau().first().total_volume == 123456789012.5


def test_two_objects_answer_sql_from_their_own_tables(spark):
    one, two = (FillAnalytics.from_fills(spark.createDataFrame([fill(user)] * n, FILLS).withColumns(
        {"closed_pnl": F.lit(0).cast("decimal(38,18)"), "fee": F.lit(0).cast("decimal(38,18)")})) for user, n in (("a", 1), ("b", 2)))
    asked = "WITH x AS (SELECT user_address, count(*) AS n FROM fills GROUP BY 1) SELECT * FROM x ORDER BY n -- all\n;"
    first, second = one.execute_custom_query(asked), two.execute_custom_query(asked)
    assert (as_rows(first), as_rows(second)) == ([("a", 1)], [("b", 2)])
    assert not [table for table in spark.catalog.listTables() if table.name.startswith("fillmetrics_")]
    one.register_views()
    assert spark.sql("SELECT count(*) FROM fills").first()[0] == 1


def test_totals_by_user_need_no_shuffle_by_user(spark, folder):
    conf = PipelineConf(f"{folder}/raw", f"{folder}/fills", f"{folder}/marts")
    for number in (1, 2, 3):
        lines = [BLOCK.replace("0xa", f"0x{user}").replace('"sz":"1"', f'"sz":"{user * number}"') for user in range(20)]
        put_raw(conf.raw_root, "node_fills_by_block", f"2025080{number}", "00", lines)
    run_pipeline(spark, conf)
    opened = FillAnalytics(spark, conf.fills_path, conf.mart_root)
    limits = [50, 200]
    expected = as_rows(opened.get_bucket_transitions(limits)), as_rows(opened.get_bucket_mobility([1], limits))
    assert "Exchange hashpartitioning(user_address" in plan_of(opened.get_bucket_transitions(limits))
    opened.store_by_user("totals_by_user", 4)
    asked = opened.get_bucket_transitions(limits), opened.get_bucket_mobility([1], limits)
    assert tuple(map(as_rows, asked)) == expected
    for df in asked:
        assert "Exchange hashpartitioning(user_address" not in plan_of(df) and "Bucketed: true" in plan_of(df)
    opened.refresh()
    assert as_rows(opened.get_bucket_transitions(limits)) == expected[0]
    opened.store_by_user("totals_by_user", 4)
    assert as_rows(opened.get_bucket_transitions(limits)) == expected[0]
    spark.sql("DROP TABLE totals_by_user")


def test_report_of_fills_reads_them_once(spark):
    columns = "date date, px decimal(12,2), sz decimal(6,0), user_address string, coin string, side string, hash string"
    picks = random.Random(5)
    rows = [
        (picks.choice([day(1), day(2), day(3), day(9), None]), Decimal(picks.choice(["1.25", "7.50"])), Decimal(picks.randint(1, 3)))
        + tuple(picks.choice([*values, None]) for values in ("abcdefgh", "xy", "AB", "123456"))
        for _ in range(60)
    ]
    # A user, a coin and a hash that are seen without a date only; the prices of a day are absent.
    rows += [(None, Decimal(2), Decimal(1), "late", "zz", "A", "77"), (day(4), None, Decimal(1), "a", "x", "A", "1")]
    for some in (rows, [row for row in rows if row[0]], rows[-1:], rows[-2:-1], []):
        metrics = FillAnalytics.from_fills(spark.createDataFrame(some, columns))
        report = metrics.get_summary_report()
        parts = metrics.user_activity, metrics.daily_metrics, metrics.get_daily_new_users()
        wanted = reports.summary_report(*parts)
        assert report.dtypes == wanted.dtypes and report.collect() == wanted.collect()
    metrics = FillAnalytics.from_fills(spark.createDataFrame(rows, columns))
    assert plan_of(metrics.get_summary_report()).count("Scan ExistingRDD") == 1


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
