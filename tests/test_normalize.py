from datetime import date
from decimal import Decimal

import pytest
from fixtures import BLOCK, FILL, TRADE, as_rows, day, raw
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fillmetrics.functions.values import iso_millis, path_date
from fillmetrics.operators import normalize
from fillmetrics.schema import CATALOG, NODE_FILLS, NODE_FILLS_BY_BLOCK, NODE_TRADES, NORMALIZED, SourceSpec


def good(df, dataset):
    return normalize.accepted(normalize.convert(df, dataset))


def test_trade_gives_one_fill_per_party(spark):
    out = good(raw(spark, NODE_TRADES, TRADE), NODE_TRADES)
    assert out.columns == [*NORMALIZED.names, "date"]
    first, second = sorted(out.collect(), key=lambda row: row.user_address)
    assert (first.user_address, first.oid, first.cloid, first.start_position) == ("0xa", 1, None, "0")
    assert (second.user_address, second.oid, second.cloid, second.start_position) == ("0xb", 2, "c2", "5")
    for row in (first, second):
        assert row.side == "A" and row.time == 1743465601250 and row.px == "100.50"
        assert row.dataset_source == NODE_TRADES
        absent = "tid direction closed_pnl crossed fee fee_token block_number block_time builder builder_fee local_time"
        assert all(row[name] is None for name in absent.split())


def test_trade_without_parties_gives_no_fill(spark):
    lines = ['{"time":"2025-04-01T00:00:00Z"}', TRADE[: TRADE.index('"side_info"')] + '"side_info":[]}']
    assert good(raw(spark, NODE_TRADES, *lines), NODE_TRADES).count() == 0


def test_fill_keeps_number_text(spark):
    row = good(raw(spark, NODE_FILLS, FILL), NODE_FILLS).first()
    assert (row.px, row.sz, row.closed_pnl, row.fee) == ("2000.10", "0.5", "0.0", "0.25")
    assert (row.oid, row.tid, row.crossed, row.direction) == (7, 70, True, "Open Long")
    assert (row.cloid, row.builder, row.block_number, row.local_time) == (None, None, None, None)


def test_builder_is_read_for_blocks_only(spark):
    line = FILL.replace('"feeToken"', '"builder":"0xz","builderFee":"1","feeToken"')
    assert good(raw(spark, NODE_FILLS, line), NODE_FILLS).first().builder is None


def test_block_shares_metadata(spark):
    rows = sorted(good(raw(spark, NODE_FILLS_BY_BLOCK, BLOCK), NODE_FILLS_BY_BLOCK).collect(), key=lambda r: r.side)
    assert [(r.user_address, r.builder, r.builder_fee) for r in rows] == [("0xa", "0xz", "0.01"), ("0xb", None, None)]
    assert {(r.block_number, r.block_time, r.local_time) for r in rows} == {
        (9, "2025-08-01T00:00:00", "2025-08-01T00:00:00.1")
    }


def test_block_without_events_gives_no_fill(spark):
    lines = ['{"block_number":1}', '{"block_number":1,"events":[]}', '{"block_number":1,"events":null}']
    assert good(raw(spark, NODE_FILLS_BY_BLOCK, *lines), NODE_FILLS_BY_BLOCK).count() == 0


BAD = [
    (NODE_TRADES, TRADE.replace('"coin":"BTC",', "")),
    (NODE_TRADES, TRADE.replace("2025-04-01T00:00:01.250Z", "yesterday")),
    (NODE_TRADES, TRADE.replace('"user":"0xb",', "")),
    (NODE_TRADES, TRADE[:-5]),
    (NODE_TRADES, '{"time":"2025-04-01T00:00:00Z","side_info":7}'),
    (NODE_FILLS, FILL.replace('"hash":"0xf1",', "")),
    (NODE_FILLS, FILL.replace("1750000000000", '"soon"')),
    (NODE_FILLS, '["0xa"]'),
    (NODE_FILLS, FILL + "x"),
    (NODE_FILLS, FILL[:-1] + ",1]"),
    (NODE_FILLS, FILL[:-1] + ",{}]"),
    (NODE_FILLS, FILL.replace('"0xa"', "5")),
    (NODE_FILLS, "no json"),
    (NODE_FILLS_BY_BLOCK, BLOCK[:-4]),
    (NODE_FILLS_BY_BLOCK, '{"events":{"a":1}}'),
    (NODE_FILLS_BY_BLOCK, "[1]"),
    (NODE_FILLS_BY_BLOCK, '{"events":[["0xa",{"coin":"BTC"}]]}'),
]


@pytest.mark.parametrize("dataset,line", BAD)
def test_bad_record_stops_the_run_or_is_set_aside(spark, dataset, line):
    lines = raw(spark, dataset, {NODE_TRADES: TRADE, NODE_FILLS: FILL, NODE_FILLS_BY_BLOCK: BLOCK}[dataset], line)
    converted = normalize.convert(lines, dataset)
    with pytest.raises(PySparkException, match="bad raw record"):
        normalize.accepted(converted).collect()
    kept = normalize.accepted(converted, "quarantine").count()
    defects = normalize.rejected(converted).collect()
    assert len(defects) == 1 and defects[0].text and defects[0].dataset_source == dataset
    assert kept == converted.count() - 1


def test_unknown_handling_of_bad_rows_is_refused(spark):
    with pytest.raises(ValueError):
        normalize.accepted(normalize.convert(raw(spark, NODE_FILLS, FILL), NODE_FILLS), "ignore")


def test_json_is_parsed_once_per_row(spark):
    out = good(raw(spark, NODE_FILLS, FILL), NODE_FILLS)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_pairs_of_unusual_spelling(spark):
    lines = [
        ' [ "0xa" , {"coin":"E}]H","px":"1","sz":"1","side":"B","time":1,"hash":"h","extra":{"a":[{"b":1}]}} ] ',
        '["0\\"a$1",{"coin":"\u2028","px":"1","sz":"1","side":"B","time":1,"hash":"h"}]\r',
    ]
    rows = good(raw(spark, NODE_FILLS, *lines), NODE_FILLS).collect()
    assert sorted((row.user_address, row.coin) for row in rows) == [('0"a$1', "\u2028"), ("0xa", "E}]H")]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_iso_times_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = {
            "2025-04-01T00:00:01.250Z": 1743465601250,
            "2025-04-01T00:00:01.250": 1743465601250,
            "2025-04-01T02:00:01.250+02:00": 1743465601250,
            "2025-04-01T00:00:01.899999999": 1743465601899,
            "2025-04-01T00:00:01": 1743465601000,
            "later": None,
        }
        frame = spark.createDataFrame([(text,) for text in texts], "t string")
        assert {row.t: row.ms for row in frame.select("t", iso_millis(F.col("t")).alias("ms")).collect()} == texts
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_date_comes_from_the_directory(spark):
    paths = {
        "file:/r/node_fills/hourly/20250801/3.lz4": date(2025, 8, 1),
        "file:/r/node_fills/hourly/20251399/3.lz4": None,
        "file:/r/node_fills/hourly/not_a_date/3.lz4": None,
    }
    frame = spark.createDataFrame([(path,) for path in paths], "p string")
    assert {row.p: row.d for row in frame.select("p", path_date(F.col("p")).alias("d")).collect()} == paths


def test_source_choice(spark):
    expected = {
        date(2025, 3, 21): None,
        date(2025, 5, 24): NODE_TRADES,
        date(2025, 5, 25): NODE_FILLS,
        date(2025, 6, 10): NODE_FILLS,
        date(2025, 6, 21): NODE_FILLS,
        date(2025, 7, 26): NODE_FILLS,
        date(2025, 7, 27): NODE_FILLS_BY_BLOCK,
        date(2030, 1, 1): NODE_FILLS_BY_BLOCK,
    }
    frame = spark.createDataFrame([(on,) for on in expected], "date date")
    chosen = frame.select("date", normalize.source_for(F.col("date"), CATALOG).alias("s"))
    assert {row.date: row.s for row in chosen.collect()} == expected


def test_equal_priority_goes_by_name(spark):
    both = [SourceSpec(name, date(2025, 1, 1), date(2025, 12, 31), 1) for name in ("b", "a")]
    assert spark.range(1).select(normalize.source_for(F.lit(day(1)), both)).first()[0] == "a"


def test_plan_status_without_fallback(spark):
    files = spark.createDataFrame(
        [
            (date(2025, 3, 1), NODE_TRADES, 5),
            (date(2025, 6, 10), NODE_TRADES, 5),
            (date(2025, 5, 25), NODE_TRADES, 5),
            (date(2025, 5, 25), NODE_FILLS, 7),
            (date(2025, 5, 25), NODE_FILLS, 8),
        ],
        "date date, dataset string, size bigint",
    )
    plan = normalize.source_plan(files)
    assert as_rows(plan) == [
        (date(2025, 3, 1), None, 0, 0, 0, "no_data"),
        (date(2025, 5, 25), NODE_FILLS, 2, 15, 8, "success"),
        (date(2025, 6, 10), NODE_FILLS, 0, 0, 0, "no_files"),
    ]
    done = spark.createDataFrame([(date(2025, 5, 25),)], "date date")
    assert normalize.pending(plan, done).count() == 2
    written = spark.createDataFrame([(date(2025, 5, 25), 9)], "date date, records bigint")
    status = normalize.run_status(plan, written)
    assert as_rows(status.where("status = 'success'")) == [(date(2025, 5, 25), NODE_FILLS, 2, 9, "success")]
    assert as_rows(normalize.run_statistics(status)) == [(NODE_FILLS, 1, 2, 9), ("total", 1, 2, 9)]


def test_deduplication_returns_the_winning_rows_once(spark):
    on = date(2025, 5, 25)
    unified = normalize.accepted(
        normalize.convert_all(
            {NODE_TRADES: raw(spark, NODE_TRADES, TRADE, on=on), NODE_FILLS: raw(spark, NODE_FILLS, FILL, on=on)}
        )
    )
    kept = normalize.winning_rows(unified, dataset="dataset_source")
    assert unified.count() == 3
    assert as_rows(kept) == as_rows(good(raw(spark, NODE_FILLS, FILL, on=on), NODE_FILLS))


def test_typed_fills_refuse_or_count_bad_numbers(spark):
    stored = good(raw(spark, NODE_FILLS, FILL, FILL.replace("2000.10", "n/a")), NODE_FILLS)
    with pytest.raises(PySparkException):
        normalize.typed_fills(stored).collect()
    lenient = normalize.typed_fills(stored, strict=False)
    assert sorted(lenient.select("px").collect(), key=str) == [(Decimal("2000.10000000"),), (None,)]
    assert normalize.count_untyped(stored).first().asDict() == {"px": 1, "sz": 0, "closed_pnl": 0, "fee": 0}
