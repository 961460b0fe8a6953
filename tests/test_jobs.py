import dataclasses
import os

import pyarrow as pa
import pytest
from fixtures import BLOCK, FILL, TRADE, as_rows, day, put_raw
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fillmetrics import FillAnalytics, PipelineConf, run_pipeline, validate
from fillmetrics.operators import inventory
from fillmetrics.plans.marts import build_marts
from fillmetrics.sources.listing import list_raw, with_keys
from fillmetrics.sources.raw import count_lines, line_arrays, read_raw
from fillmetrics.sources.snapshots import stored_dates
from fillmetrics.sources.tables import checkpoint_folder, checkpointed, scan_normalized, write_by_date


def compressed(text: bytes) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.CompressedOutputStream(sink, "lz4") as stream:
        stream.write(text)
    return sink.getvalue().to_pybytes()


@pytest.mark.parametrize("block", [1, 3, 7, 1 << 20])
def test_lines_survive_any_block_size(block):
    text = "ab\n\n  \ncccé\n{\"x\": 1}\r\nlast".encode()
    arrays = line_arrays(pa.BufferReader(compressed(text)), block)
    assert [line for array in arrays for line in array.to_pylist()] == ["ab", "cccé", '{"x": 1}\r', "last"]


def test_joined_frames_are_read_to_the_end():
    both = compressed(b"a\nb\n") + compressed(b"c\n")
    assert [line for array in line_arrays(pa.BufferReader(both)) for line in array.to_pylist()] == ["a", "b", "c"]


@pytest.mark.parametrize("transport", ["stream", "content"])
def test_raw_reader(spark, folder, transport):
    put_raw(folder, "node_fills", "20250801", "00", [FILL, "", FILL])
    put_raw(folder, "node_fills", "20250801", "01", [FILL])
    put_raw(folder, "node_fills", "not_a_date", "01", ["x"])
    put_raw(folder, "node_fills", "20251399", "01", ["x"])
    assert list_raw(spark, folder).count() == 2
    lines = read_raw(spark, [f"{folder}/node_fills/hourly/20250801"], transport, block_bytes=100)
    assert as_rows(lines, "dataset", "date", "value") == [("node_fills", day(1), FILL)] * 3
    assert as_rows(count_lines(lines)) == [("node_fills", 3)]


def settings(folder, **more):
    return PipelineConf(f"{folder}/raw", f"{folder}/fills", f"{folder}/marts", **more)


def prepared(folder):
    raw = f"{folder}/raw"
    put_raw(raw, "node_trades", "20250401", "00", [TRADE, TRADE.replace("0xa", "0xq")])
    put_raw(raw, "node_trades", "20250525", "00", [TRADE])
    put_raw(raw, "node_fills", "20250525", "01", [FILL] * 3)
    put_raw(raw, "node_trades", "20250610", "03", [TRADE])
    put_raw(raw, "node_trades", "20250101", "03", [TRADE])
    put_raw(raw, "node_fills_by_block", "20250801", "00", [BLOCK])
    put_raw(raw, "node_fills_by_block", "20250802", "00", ['{"block_number":1}'])
    return settings(folder)


def marts_of(spark, conf):
    opened = FillAnalytics(spark, conf.fills_path, conf.mart_root)
    names = ("user_activity", "daily_user_volume", "user_daily_volume", "user_first_trade", "daily_metrics")
    return {name: as_rows(getattr(opened, name), *sorted(getattr(opened, name).columns)) for name in names}


def test_pipeline_from_raw_files_to_metrics(spark, folder):
    conf = prepared(folder)
    status = run_pipeline(spark, conf)
    assert as_rows(status) == [
        (day(1, 1), None, 0, 0, "no_data"),
        (day(1, 4), "node_trades", 1, 4, "success"),
        (day(25, 5), "node_fills", 1, 3, "success"),
        (day(10, 6), "node_fills", 0, 0, "no_files"),
        (day(1), "node_fills_by_block", 1, 2, "success"),
        (day(2), "node_fills_by_block", 1, 0, "success"),
    ]
    opened = FillAnalytics(spark, conf.fills_path, conf.mart_root)
    summary = opened.get_data_summary()
    assert (summary["total_fills"], summary["unique_users"], summary["total_days"]) == (9, 3, 3)
    top = opened.execute_custom_query("SELECT coin, count(*) AS n FROM fills GROUP BY coin ORDER BY n DESC, coin")
    assert [tuple(row) for row in top.collect()] == [("BTC", 6), ("ETH", 3)]
    assert dict(opened.execute_custom_query("SELECT * FROM fills").dtypes)["px"] == "double"

    # A second run finds nothing to do, and the stored fills are the same as after one run.
    again = run_pipeline(spark, conf)
    assert {row.status for row in again.collect()} == {"no_data", "no_files"}
    assert scan_normalized(spark, conf.fills_path).count() == 9

    # New data: the marts follow, and equal a full rebuild.
    put_raw(conf.raw_root, "node_fills_by_block", "20250803", "00", [BLOCK.replace("0xb", "0xnew")])
    run_pipeline(spark, conf)
    refreshed = marts_of(spark, conf)
    build_marts(spark, conf.fills_path, f"{folder}/rebuilt")
    assert refreshed == marts_of(spark, dataclasses.replace(conf, mart_root=f"{folder}/rebuilt"))
    assert ("0xnew", day(3)) in [(user, on) for on, user in refreshed["user_first_trade"]]

    # Merging new dates gives the same first trades as recomputing them.
    put_raw(conf.raw_root, "node_fills_by_block", "20250804", "00", [BLOCK.replace("0xb", "0xnewer")])
    run_pipeline(spark, dataclasses.replace(conf, append_only=True))
    merged = marts_of(spark, conf)
    build_marts(spark, conf.fills_path, f"{folder}/rebuilt2")
    assert merged == marts_of(spark, dataclasses.replace(conf, mart_root=f"{folder}/rebuilt2"))


def test_rewritten_dates_lose_their_old_rows(spark, folder):
    conf = prepared(folder)
    run_pipeline(spark, conf)
    put_raw(conf.raw_root, "node_trades", "20250401", "00", ['{"time":"2025-04-01T00:00:00Z"}'])
    run_pipeline(spark, dataclasses.replace(conf, skip_existing=False))
    assert scan_normalized(spark, conf.fills_path).where(F.col("date") == F.lit(day(1, 4))).count() == 0
    assert day(1, 4) in [row.date for row in stored_dates(spark, conf.fills_path).collect()]
    refreshed = marts_of(spark, conf)
    assert all(user != "0xq" for _, user in refreshed["user_first_trade"])
    build_marts(spark, conf.fills_path, f"{folder}/rebuilt")
    assert refreshed == marts_of(spark, dataclasses.replace(conf, mart_root=f"{folder}/rebuilt"))


def test_bad_record_stops_before_anything_is_written(spark, folder):
    conf = settings(folder)
    put_raw(conf.raw_root, "node_fills_by_block", "20250801", "00", [BLOCK, "{broken"])
    with pytest.raises(PySparkException, match="bad raw record"):
        run_pipeline(spark, conf)
    assert stored_dates(spark, conf.fills_path).count() == 0
    assert not os.path.exists(conf.mart_root)
    aside = dataclasses.replace(conf, on_bad="quarantine", quarantine_path=f"{folder}/bad", skip_marts=True)
    assert as_rows(run_pipeline(spark, aside), "records_written") == [(2,)]
    assert as_rows(spark.read.parquet(f"{folder}/bad"), "text") == [("{broken",)]
    with pytest.raises(ValueError):
        run_pipeline(spark, dataclasses.replace(conf, on_bad="quarantine"))


def test_validation_of_a_finished_run(spark, folder):
    conf = prepared(folder)
    run_pipeline(spark, dataclasses.replace(conf, skip_marts=True))
    checks = validate(spark, conf)
    assert as_rows(checks["count_check"]) == [
        ("node_fills", 3, 3, 3, 1.0, None, True),
        ("node_fills_by_block", 2, 2, 2, 1.0, None, True),
        ("node_trades", 5, 4, 4, 0.8, 2.0, True),
    ]
    assert as_rows(checks["processed_counts"]) == [
        ("node_fills", 3), ("node_fills_by_block", 2), ("node_trades", 4), ("total", 9)
    ]
    assert (day(25, 5), "node_fills", "node_fills", 3, True) in as_rows(checks["overlap_check"])
    assert as_rows(checks["completeness"]) == [(day(1, 4), day(1), 3, 123, 120)]
    assert checks["missing_dates"].count() == 120
    assert as_rows(checks["overall_statistics"]) == [(9, 3, 2, 3, day(1, 4), day(1))]
    assert as_rows(checks["top_coins_by_count"]) == [("BTC", 6), ("ETH", 3)]
    assert checks["statistics_by_source"].count() == 3


def test_inventory_of_two_places(spark, folder):
    for place in ("there", "here"):
        put_raw(f"{folder}/{place}", "node_fills", "20250801", "00", [FILL])
    put_raw(f"{folder}/there", "node_fills", "20250801", "01", [FILL])
    there = with_keys(list_raw(spark, f"{folder}/there"), f"{folder}/there")
    here = with_keys(list_raw(spark, f"{folder}/here"), f"{folder}/here")
    assert as_rows(inventory.pending_files(there, here), "key") == [("node_fills/hourly/20250801/01.lz4",)]
    assert as_rows(inventory.summary(there), "dataset", "files", "days_span") == [("node_fills", 2, 0)]


def test_steps_can_be_skipped(spark, folder):
    conf = prepared(folder)
    run_pipeline(spark, dataclasses.replace(conf, skip_marts=True))
    assert not os.path.exists(conf.mart_root)
    assert run_pipeline(spark, dataclasses.replace(conf, skip_normalize=True)) is None
    assert os.path.exists(conf.mart_root)


def test_lines_of_a_large_file_are_spread_before_parsing(spark, folder):
    put_raw(folder, "node_fills", "20250801", "00", [FILL] * 500 + [FILL.replace("0xa", f"0x{n}") for n in range(500)])
    put_raw(folder, "node_fills", "20250801", "01", [FILL])
    directory = [f"{folder}/node_fills/hourly/20250801"]
    limit = os.path.getsize(f"{directory[0]}/01.lz4")
    spread = read_raw(spark, directory, spread_above=limit, parts=4)
    assert as_rows(spread) == as_rows(read_raw(spark, directory))
    held = spread.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(held) == 5 and max(row["count"] for row in held) < 400


def test_a_run_with_spread_files_stores_the_same_fills(spark, folder):
    conf = prepared(folder)
    run_pipeline(spark, dataclasses.replace(conf, skip_marts=True))
    other = dataclasses.replace(conf, fills_path=f"{folder}/fills2", skip_marts=True, spread_raw_file=1)
    run_pipeline(spark, other)
    columns = ["date", "user_address", "hash", "oid", "px", "dataset_source"]
    assert as_rows(scan_normalized(spark, conf.fills_path), *columns) == as_rows(
        scan_normalized(spark, other.fills_path), *columns
    )


@pytest.mark.parametrize("sort", [(), ("x",)])
def test_a_heavy_date_is_written_in_several_files(spark, folder, sort):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(60000).select(
            F.when(F.col("id") % 3 > 0, F.lit(day(1))).otherwise(F.lit(day(2))).alias("date"),
            F.sha2(F.col("id").cast("string"), 256).alias("x"),
        )
        write_by_date(rows, f"{folder}/t", days=[day(1), day(2)], sort=sort)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    parts = [name for name in os.listdir(f"{folder}/t/date=2025-08-01") if name.endswith(".parquet")]
    assert len(parts) > 1
    assert spark.read.parquet(f"{folder}/t").count() == 60000


def test_other_dates_survive_and_ranges_prune(spark, folder):
    schema = "date date, x int"
    write_by_date(spark.createDataFrame([(day(1), 1), (day(2), 2)], schema), f"{folder}/t")
    write_by_date(spark.createDataFrame([(day(2), 9)], schema), f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t")
    assert as_rows(stored, "date", "x") == [(day(1), 1), (day(2), 9)]
    plan = stored.where(F.col("date") >= F.lit(day(2)))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_checkpoint_folder_of_the_cluster_is_used(spark, folder):
    class Named:
        class conf:
            get = staticmethod(lambda key, default: "/shared" if key == "spark.checkpoint.dir" else default)

    assert checkpoint_folder(Named, "/own") == "/shared"
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert checkpoint_folder(spark, f"{folder}/own") == (named or f"{folder}/own")
    assert checkpointed(spark.range(3), f"{folder}/own").count() == 3
    assert os.listdir(named or f"{folder}/own")
