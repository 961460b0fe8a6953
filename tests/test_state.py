"""Marts after interruptions, rewritten dates and other settings; values that must not be lost in silence."""

import dataclasses

import pytest
from fixtures import BLOCK, FILL, TRADE, as_rows, day, put_raw, raw
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fillmetrics import FillAnalytics, PipelineConf, run_pipeline, validate
from fillmetrics.operators import marts, normalize
from fillmetrics.plans.marts import TABLES, build_marts, read_state, stale_dates
from fillmetrics.schema import NODE_FILLS, NODE_FILLS_BY_BLOCK, NODE_TRADES
from fillmetrics.sources.tables import scan_normalized


@pytest.fixture()
def conf(spark, folder):
    made = PipelineConf(f"{folder}/raw", f"{folder}/fills", f"{folder}/marts")
    put_raw(made.raw_root, "node_fills_by_block", "20250801", "00", [BLOCK])
    run_pipeline(spark, made)
    return made


def contents(spark, conf, **more):
    opened = FillAnalytics(spark, conf.fills_path, conf.mart_root, **more)
    return {name: as_rows(getattr(opened, name), *sorted(getattr(opened, name).columns)) for name in TABLES}


def rebuilt(spark, conf, folder, **more):
    other = dataclasses.replace(conf, mart_root=f"{folder}/rebuilt")
    build_marts(spark, conf.fills_path, other.mart_root, **more)
    return contents(spark, other, **more)


@pytest.mark.parametrize("writer", ["user_daily_volume", "daily_metrics_from_activity", "user_first_trade"])
def test_an_interrupted_refresh_is_made_up_for(spark, folder, conf, monkeypatch, writer):
    put_raw(conf.raw_root, "node_fills_by_block", "20250802", "00", [BLOCK.replace("0xb", "0xnew")])

    def broken(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(marts, writer, broken)
        with pytest.raises(RuntimeError):
            run_pipeline(spark, conf)
    assert stale_dates(spark, conf.fills_path, conf.mart_root) == [day(2)]
    run_pipeline(spark, conf)
    assert contents(spark, conf) == rebuilt(spark, conf, folder)
    assert stale_dates(spark, conf.fills_path, conf.mart_root) == []


def test_an_interrupted_rebuild_is_not_taken_for_done(spark, folder, conf, monkeypatch):
    def broken(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(marts, "user_daily_volume", broken)
        with pytest.raises(RuntimeError):
            build_marts(spark, conf.fills_path, conf.mart_root)
    assert contents(spark, conf) == rebuilt(spark, conf, folder)


def test_rewritten_dates_are_noticed(spark, folder, conf):
    put_raw(conf.raw_root, "node_fills_by_block", "20250801", "00", [BLOCK, BLOCK.replace("0xb", "0xmore")])
    run_pipeline(spark, dataclasses.replace(conf, skip_existing=False, skip_marts=True))
    run_pipeline(spark, conf)
    opened = FillAnalytics(spark, conf.fills_path, conf.mart_root)
    assert as_rows(opened.get_dau(), "dau") == [(3,)]
    assert contents(spark, conf) == rebuilt(spark, conf, folder)


def test_a_user_lost_by_rewriting_moves_to_a_later_first_trade(spark, folder, conf):
    put_raw(conf.raw_root, "node_fills_by_block", "20250803", "00", [BLOCK])
    run_pipeline(spark, conf)
    put_raw(conf.raw_root, "node_fills_by_block", "20250801", "00", [BLOCK.replace("0xb", "0xc")])
    run_pipeline(spark, dataclasses.replace(conf, skip_existing=False))
    first = dict(as_rows(FillAnalytics(spark, conf.fills_path, conf.mart_root).user_first_trade))
    assert first == {"0xa": day(1), "0xb": day(3), "0xc": day(1)}


def test_other_settings_are_refused_or_rebuilt(spark, folder, conf):
    with pytest.raises(ValueError, match="sides"):
        FillAnalytics(spark, conf.fills_path, conf.mart_root, sides=("A", "B"))
    before = contents(spark, conf)
    put_raw(conf.raw_root, "node_fills_by_block", "20250802", "00", [BLOCK])
    with pytest.raises(ValueError, match="numeric"):
        run_pipeline(spark, dataclasses.replace(conf, numeric="double"))
    assert contents(spark, conf) == before
    both = FillAnalytics(spark, conf.fills_path, conf.mart_root, rebuild=True, sides=("B", "A"))
    assert {row.user_address for row in both.get_top_users_by_volume().collect()} == {"0xa", "0xb"}
    assert read_state(spark, conf.mart_root).sides == ("A", "B")


def test_stored_fills_are_typed_and_filtered_in_the_scan(spark, conf):
    fills = FillAnalytics(spark, conf.fills_path, conf.mart_root).fills
    assert dict(fills.dtypes)["px"] == "decimal(26,14)"
    plan = fills.where(F.col("px") > 5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(px" in plan


def test_validation_without_raw_files(spark, folder, conf):
    checks = validate(spark, dataclasses.replace(conf, raw_root=f"{folder}/nothing"))
    assert checks["count_check"].count() == 0


@pytest.mark.parametrize(
    "dataset,line,field",
    [
        (NODE_FILLS, FILL.replace('"tid":70', '"tid":99999999999999999999'), "tid"),
        (NODE_FILLS, FILL.replace('"oid":7', '"oid":"seven"'), "oid"),
        (NODE_FILLS, FILL.replace('"crossed":true', '"crossed":"yes"'), "crossed"),
        (NODE_TRADES, TRADE.replace('"oid":1', '"oid":[1]'), "oid"),
        (NODE_FILLS_BY_BLOCK, BLOCK.replace('"block_number":9', '"block_number":"x"'), "block_number"),
    ],
)
def test_values_of_another_type_are_defects(spark, dataset, line, field):
    converted = normalize.convert(raw(spark, dataset, line), dataset)
    assert all(field in row.defect for row in normalize.rejected(converted).collect())
    assert normalize.rejected(converted).count() >= 1
    with pytest.raises(PySparkException, match="bad raw record"):
        normalize.accepted(converted).collect()


def test_a_quoted_number_is_read(spark):
    lines = raw(spark, NODE_FILLS, FILL.replace('"oid":7', '"oid":"7"'))
    assert as_rows(normalize.accepted(normalize.convert(lines, NODE_FILLS)), "oid") == [(7,)]


@pytest.mark.parametrize("px,sz,fits", [
    ("0.00000123456789", "20000000000", True), ("0.100000000000000", "1.50000000", True), ("1e-3", "2E3", True),
    ("1000000", "1", True), ("999999999999.5", "3", True), ("1000000000000", "1", False),
    ("0.000000000000001", "1", False), ("1", "0.0000001", False), ("1", "200000000000", False), ("x", "1", False),
])
def test_no_digit_is_lost(spark, px, sz, fits):
    line = FILL.replace('"2000.10"', f'"{px}"').replace('"0.5"', f'"{sz}"')
    stored = normalize.accepted(normalize.convert(raw(spark, NODE_FILLS, line), NODE_FILLS))
    if fits:
        row = normalize.typed_fills(stored).first()
        assert (float(row.px), float(row.sz)) == (float(px), float(sz))
    else:
        with pytest.raises(PySparkException, match="no exact"):
            normalize.typed_fills(stored).collect()
    assert sum(normalize.count_untyped(stored).first()) == (0 if fits else 1)
    lenient = normalize.typed_fills(stored, strict=False).first()
    assert (lenient.px is None or lenient.sz is None) != fits


def test_scan_of_stored_fills_is_unchanged(spark, conf):
    assert scan_normalized(spark, conf.fills_path).count() == 2
