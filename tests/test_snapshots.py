"""Published tables: readers during a rewrite, killed writes, empty dates, removal; raw ledgers; advanced states."""

import dataclasses
import os
import random
from datetime import date, datetime, timedelta

import pytest
from fixtures import BLOCK, FILL, TOTALS, as_rows, day, put_raw
from pyspark.sql import functions as F

from fillmetrics import FillAnalytics, PipelineConf, run_pipeline
from fillmetrics.operators import cohorts, journeys, sketches
from fillmetrics.plans import marts as stored
from fillmetrics.plans.marts import build_marts, remove_unreferenced
from fillmetrics.sources.ledger import RawLedger
from fillmetrics.sources.listing import list_raw
from fillmetrics.sources.snapshots import PublishedTable, held_files

NOW = timedelta(0)


def rows(spark, *pairs):
    return spark.createDataFrame([(day(number), value) for number, value in pairs], "date date, x int")


def test_a_reader_sees_all_old_or_all_new_dates(spark, folder):
    table = PublishedTable(spark, f"{folder}/t")
    assert table.snapshot() is None
    table.publish(rows(spark, (1, 1), (2, 2), (3, 3)))
    early = table.read()
    written = table.write(rows(spark, (2, 20), (3, 30)))
    # The rewrite has its files, but nobody reads them yet.
    assert as_rows(table.read(), "date", "x") == as_rows(early, "date", "x") == [(day(1), 1), (day(2), 2), (day(3), 3)]
    table.commit(written)
    assert as_rows(table.read(), "date", "x") == [(day(1), 1), (day(2), 20), (day(3), 30)]
    assert as_rows(early, "date", "x") == [(day(1), 1), (day(2), 2), (day(3), 3)]
    assert as_rows(table.read(table.snapshot(1)), "x") == [(1,), (2,), (3,)]
    assert as_rows(table.read(days=[day(2)]), "x") == [(20,)]


def test_a_killed_write_leaves_the_version_before(spark, folder):
    table = PublishedTable(spark, f"{folder}/t")
    table.publish(rows(spark, (1, 1)))

    def broken(value):
        raise RuntimeError("lost")

    bad = rows(spark, (1, 7), (2, 8)).withColumn("x", F.when(F.col("x") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="lost"):
        table.publish(bad)
    assert as_rows(table.read(), "date", "x") == [(day(1), 1)]
    assert table.versions() == [1]
    assert [row.date for row in held_files(spark, table.path).collect()] == [day(1)]


def test_a_second_writer_of_a_version_is_refused(spark, folder):
    table = PublishedTable(spark, f"{folder}/t")
    table.publish(rows(spark, (1, 1)))
    table.snapshot = lambda version=None: None  # a writer that has not seen version 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        table.publish(rows(spark, (1, 2)))
    assert as_rows(PublishedTable(spark, table.path).read(), "x") == [(1,)]


def test_dates_without_rows_and_replacing_all(spark, folder):
    table = PublishedTable(spark, f"{folder}/t")
    table.publish(rows(spark, (1, 1), (2, 2)))
    table.publish(rows(spark, (1, 5)), days=[day(1), day(2), day(4)])
    assert as_rows(table.read(), "date", "x") == [(day(1), 5)]
    assert sorted(table.snapshot().dates) == [day(1), day(2), day(4)]
    table.publish(rows(spark, (9, 9)), replace_all=True)
    assert as_rows(table.read(), "date", "x") == [(day(9), 9)]
    table.publish(rows(spark), replace_all=True)
    assert table.snapshot().dates == {}
    assert table.read(schema=rows(spark).schema).collect() == []


def test_ranges_prune_folders_and_runs_are_read_as_one_path(spark, folder):
    table = PublishedTable(spark, f"{folder}/t")
    table.publish(rows(spark, *[(number, number) for number in range(1, 29)]))
    plan = table.read().where(F.col("date") == F.lit(day(3)))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "InMemoryFileIndex(1 paths)" in plan
    assert table.read().where(F.col("date") == F.lit(day(3))).inputFiles()
    table.publish(rows(spark, (3, 33)))
    assert as_rows(table.read().where(F.col("date") >= F.lit(day(27))), "x") == [(27,), (28,)]


def test_removal_of_what_no_version_names(spark, folder):
    table = PublishedTable(spark, f"{folder}/t")
    for value in (1, 2, 3):
        table.publish(rows(spark, (1, value), (value + 1, value)))
    table.write(rows(spark, (1, 99)))
    assert table.remove_unreferenced() == []  # all too young
    assert table.versions() == [3]
    gone = table.remove_unreferenced(grace=NOW - timedelta(hours=1))
    assert len(gone) == 3  # date 1 of the first two runs, and the run that was never published
    assert as_rows(table.read(), "date", "x") == [(day(1), 3), (day(2), 1), (day(3), 2), (day(4), 3)]
    assert table.remove_unreferenced(grace=NOW - timedelta(hours=1)) == []


@pytest.fixture()
def conf(spark, folder):
    made = PipelineConf(f"{folder}/raw", f"{folder}/fills", f"{folder}/marts", with_sketches=True)
    for number in (1, 2, 3):
        put_raw(made.raw_root, "node_fills_by_block", f"2025080{number}", "00", [BLOCK])
    run_pipeline(spark, made)
    return made


def answers(opened):
    names = (*stored.TABLES, "daily_new_users")
    found = {name: as_rows(getattr(opened, name), *sorted(getattr(opened, name).columns)) for name in names}
    found["mobility"] = as_rows(opened.get_bucket_mobility())
    found["transitions"] = as_rows(opened.get_bucket_transitions())
    found["sketch"] = as_rows(opened.get_users_by_sketch())
    return found


def test_an_open_reader_keeps_its_state_of_all_marts(spark, folder, conf):
    opened = FillAnalytics(spark, conf.fills_path, conf.mart_root)
    before = answers(opened)
    put_raw(conf.raw_root, "node_fills_by_block", "20250802", "00", [BLOCK.replace("0xb", "0xother")] * 2)
    put_raw(conf.raw_root, "node_fills_by_block", "20250804", "00", [BLOCK.replace("0xb", "0xnew")])
    run_pipeline(spark, dataclasses.replace(conf, skip_existing=False))
    assert answers(opened) == before
    opened.refresh()
    after = answers(opened)
    assert after != before
    build_marts(spark, conf.fills_path, f"{folder}/again", with_sketches=True)
    assert after == answers(FillAnalytics(spark, conf.fills_path, f"{folder}/again"))
    gone = remove_unreferenced(spark, conf.mart_root, grace=NOW - timedelta(hours=1))
    assert gone and answers(FillAnalytics(spark, conf.fills_path, conf.mart_root)) == after


def test_a_broken_build_leaves_the_state_before(spark, folder, conf, monkeypatch):
    before = answers(FillAnalytics(spark, conf.fills_path, conf.mart_root))
    put_raw(conf.raw_root, "node_fills_by_block", "20250804", "00", [BLOCK.replace("0xb", "0xnew")])
    with monkeypatch.context() as patch:
        patch.setattr(journeys, "advanced_steps", None)
        with pytest.raises(TypeError):
            run_pipeline(spark, conf)
    assert answers(FillAnalytics(spark, conf.fills_path, conf.mart_root)) == before
    run_pipeline(spark, conf)
    assert len(answers(FillAnalytics(spark, conf.fills_path, conf.mart_root))["daily_metrics"]) == 4


def test_plain_tables_stay_plain(spark, folder):
    made = PipelineConf(f"{folder}/raw", f"{folder}/fills", f"{folder}/marts", published=False)
    put_raw(made.raw_root, "node_fills_by_block", "20250801", "00", [BLOCK])
    run_pipeline(spark, made)
    put_raw(made.raw_root, "node_fills_by_block", "20250802", "00", [BLOCK])
    run_pipeline(spark, dataclasses.replace(made, published=True))
    assert sorted(name for name in os.listdir(made.fills_path) if name[0] not in "._") == ["date=2025-08-01", "date=2025-08-02"]
    assert FillAnalytics(spark, made.fills_path, made.mart_root).daily_metrics.count() == 2


def test_marts_of_no_fills(spark, folder):
    table = PublishedTable(spark, f"{folder}/fills")
    made = PipelineConf(f"{folder}/raw", f"{folder}/fills", f"{folder}/marts")
    put_raw(made.raw_root, "node_fills_by_block", "20250801", "00", [BLOCK])
    run_pipeline(spark, made)
    table.publish(table.read().limit(0), replace_all=True)
    run_pipeline(spark, dataclasses.replace(made, skip_normalize=True))
    opened = FillAnalytics(spark, made.fills_path, made.mart_root)
    assert opened.fills.count() == opened.daily_metrics.count() == opened.user_first_trade.count() == 0
    assert opened.get_bucket_mobility().count() == opened.get_top_users_by_volume().count() == 0


# -- raw ledger ----------------------------------------------------------------------------------------------------


def test_only_new_open_and_changed_folders_are_listed(spark, folder):
    raw, now = f"{folder}/raw", datetime(2025, 9, 1)
    first = date(2020, 1, 1)
    for number in range(1500):
        put_raw(raw, "node_fills", f"{first + timedelta(days=number):%Y%m%d}", "00", ["x"])
    put_raw(raw, "node_fills", "notadate", "00", ["x"])
    ledger = RawLedger(spark, f"{folder}/ledger")
    assert len(ledger.due(raw)) == 1500
    assert ledger.refreshed(raw, now).count() == 1500
    assert ledger.due(raw) == []
    put_raw(raw, "node_fills", "20250901", "00", ["x"])  # new, and open: its date is not over
    put_raw(raw, "node_fills", "20200105", "07", ["x"])  # changed
    os.makedirs(f"{raw}/node_trades/hourly/20200101")  # empty
    assert sorted(path[-8:] for path in ledger.due(raw)) == ["20200101", "20200105", "20250901"]
    columns = ["path", "size", "modified", "dataset", "date"]
    assert as_rows(ledger.refreshed(raw, now), *columns) == as_rows(list_raw(spark, raw), *columns)
    assert [path[-8:] for path in ledger.due(raw)] == ["20250901"]
    ledger.refreshed(raw, now + timedelta(days=4))
    assert ledger.due(raw) == []


def test_a_pipeline_with_a_ledger_does_the_same(spark, folder):
    conf = PipelineConf(f"{folder}/raw", f"{folder}/fills", f"{folder}/marts", skip_marts=True, ledger_path=f"{folder}/ledger")
    put_raw(conf.raw_root, "node_fills_by_block", "20250801", "00", [BLOCK])
    put_raw(conf.raw_root, "node_fills", "20250601", "00", [FILL])
    for number in (2, 3):
        status = run_pipeline(spark, conf)
        plain = run_pipeline(spark, dataclasses.replace(conf, ledger_path=None, fills_path=f"{folder}/plain"))
        assert as_rows(status) == as_rows(plain)
        put_raw(conf.raw_root, "node_fills_by_block", f"2025080{number}", "00", [BLOCK])


# -- journeys ------------------------------------------------------------------------------------------------------


def test_appended_and_rewritten_days_give_the_full_state(spark):
    random.seed(3)
    limits = [10, 100]
    held = {}
    state = steps = None
    for round_ in range(6):
        changed = [day(2 + 3 * round_), day(3 + 3 * round_)] if round_ % 2 == 0 else [day(2), day(6 + round_)]
        for on in changed:
            held[on] = [(f"u{n}", on, random.choice([1, 10, 50, 100, 500])) for n in range(8) if random.random() < 0.6]
        now = spark.createDataFrame(
            [(user, on, value) for group in held.values() for user, on, value in group] + [(None, day(1), 5)],
            "user_address string, date date, daily_volume int",
        )
        if state is None:
            state, steps = journeys.journeys(now, limits), cohorts.steps(now, limits)
        else:
            known = [on for on in changed if on in seen]
            added = now.where(F.col("date").isin(changed))
            state = journeys.advanced(state, added, known, now, limits)
            steps = journeys.advanced_steps(steps, now, changed, limits)
            state, steps = (spark.createDataFrame(df.collect(), df.schema) for df in (state, steps))
        seen = set(held)
        assert as_rows(state) == as_rows(journeys.journeys(now, limits))
        assert as_rows(steps) == as_rows(cohorts.steps(now, limits))
        assert as_rows(cohorts.mobility_of_journeys(state, [1, 5], limits)) == as_rows(cohorts.bucket_mobility(now, [1, 5], limits))
        assert as_rows(cohorts.transitions_of_steps(steps, limits)) == as_rows(cohorts.bucket_transitions(now, limits))


def test_appending_reads_no_history(spark):
    empty = spark.createDataFrame([], TOTALS)
    state = journeys.journeys(empty)
    assert journeys.advanced(state, empty).columns == state.columns
    with pytest.raises(ValueError):
        journeys.advanced(state, empty, [day(1)])


# -- sketches ------------------------------------------------------------------------------------------------------


def test_unions_and_differences_of_sketches_stay_within_the_bound(spark):
    users = spark.range(60000).select(
        F.date_add(F.lit(day(1)), F.pmod(F.col("id"), F.lit(20)).cast("int")).alias("date"),
        F.concat(F.lit("u"), F.floor(F.col("id") / 2)).alias("user_address"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("coin"),
        F.lit("A").alias("side"),
    )
    made = sketches.user_sketches(users)
    share = sketches.TOLERANCE / 4095**0.5
    row = sketches.users_in_range(made, day(6), day(15)).first()
    within = users.where(F.col("date").between(F.lit(day(6)), F.lit(day(15))))
    exact = within.select("user_address").distinct()
    fresh = exact.join(users.where(F.col("date") < F.lit(day(6))).select("user_address").distinct(), "user_address", "left_anti")
    assert abs(row.users - exact.count()) <= share * exact.count()
    assert abs(row.new_users - fresh.count()) <= 2 * share * exact.count()
    for coin_row in sketches.users_by_coin(made).collect():
        truth = users.where(F.col("coin") == coin_row.coin).select("user_address").distinct().count()
        assert abs(coin_row.unique_traders - truth) <= share * truth
    assert sketches.users_in_range(made, day(6), day(15), coins="none").first().users == 0
