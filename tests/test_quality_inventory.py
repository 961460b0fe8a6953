from datetime import date, datetime, timezone

from fixtures import as_rows, day

from fillmetrics.operators import inventory, quality
from fillmetrics.sources.listing import list_files

GIB = 1024**3


def dated(spark, *days):
    return spark.createDataFrame([(on,) for on in days], "date date")


def test_completeness(spark):
    frame = dated(spark, day(1), day(2), day(5), day(5))
    assert as_rows(quality.completeness(frame)) == [(day(1), day(5), 3, 5, 2)]
    assert [row.date for row in quality.missing_dates(frame).collect()] == [day(3), day(4)]


def test_completeness_of_nothing(spark):
    empty = dated(spark)
    assert as_rows(quality.completeness(empty)) == [(None, None, 0, 0, 0)]
    assert quality.missing_dates(empty).count() == 0


def test_overlap_check(spark):
    stored = spark.createDataFrame(
        [(day(1), "good"), (day(1), "good"), (day(2), "other"), (day(3), "good")], "date date, dataset_source string"
    )
    listed = [(day(1), "good"), (day(2), "good"), (day(9), "good")]
    assert as_rows(quality.overlap_check(stored, listed)) == [
        (day(1), "good", "good", 2, True), (day(2), "good", "other", 1, False), (day(9), "good", None, 0, None),
    ]


def test_count_check(spark):
    raw = spark.createDataFrame([("node_trades", 2), ("node_fills", 3)], "dataset string, raw_records bigint")
    expected = spark.createDataFrame([("node_trades", 4), ("node_fills", 3)], "dataset string, expected_records bigint")
    stored = spark.createDataFrame([("node_trades",)] * 4 + [("node_fills",)] * 2, "dataset_source string")
    assert as_rows(quality.count_check(raw, expected, stored)) == [
        ("node_fills", 3, 3, 2, 2 / 3, None, False), ("node_trades", 2, 4, 4, 2.0, 2.0, True),
    ]


def listing(spark):
    return spark.createDataFrame(
        [
            ("d1", "k1", GIB, datetime(2025, 8, 1)),
            ("d1", "k2", GIB, datetime(2025, 8, 3, 12)),
            ("d2", "k3", 0, datetime(2025, 8, 2)),
        ],
        "dataset string, key string, size bigint, modified timestamp_ntz",
    )


def test_inventory(spark):
    files = listing(spark)
    summary = inventory.summary(files)
    assert as_rows(summary, "dataset", "files", "total_gb", "days_span") == [("d1", 2, 2.0, 2), ("d2", 1, 0.0, 0)]
    assert as_rows(inventory.total(summary), "files", "total_gb", "days_span") == [(3, 2.0, 2)]
    cost = inventory.transfer_cost(summary, list_requests=1).where("dataset = 'd1'").first()
    assert abs(cost.transfer_cost - 0.18) < 1e-12
    assert cost.total_cost == cost.list_cost + cost.get_cost + cost.transfer_cost
    assert inventory.summary(files.where("false")).count() == 0


def test_pending_files_compare_key_and_size(spark):
    present = spark.createDataFrame([("k1", GIB), ("k2", 5)], "key string, size bigint")
    assert as_rows(inventory.pending_files(listing(spark), present), "key") == [("k2",), ("k3",)]


def test_modification_range_is_inclusive(spark):
    files = listing(spark)
    assert as_rows(inventory.modified_between(files, datetime(2025, 8, 2), datetime(2025, 8, 3, 12)), "key") == [
        ("k2",), ("k3",)
    ]
    assert as_rows(inventory.last_days(files, "month", datetime(2025, 8, 31)), "key") == [("k1",), ("k2",), ("k3",)]
    assert as_rows(inventory.last_days(files, 1, datetime(2025, 8, 2)), "key") == [("k1",), ("k3",)]


def test_listing_of_real_files(spark, folder):
    for name in ("a.lz4", "b.txt"):
        with open(f"{folder}/{name}", "wb") as out:
            out.write(b"12345")
    found = list_files(spark, folder, "*.lz4")
    assert [(row.path.rsplit("/", 1)[1], row["size"]) for row in found.collect()] == [("a.lz4", 5)]
    soon = datetime(2100, 1, 1, tzinfo=timezone.utc)
    assert inventory.modified_between(found, end=soon).count() == 1
    assert inventory.modified_between(found, start=soon).count() == 0
    assert list_files(spark, f"{folder}/absent").count() == 0


def test_overlap_dates_are_the_documented_ones():
    from fillmetrics.schema import OVERLAP_EXPECTED

    assert dict(OVERLAP_EXPECTED)[date(2025, 7, 27)] == "node_fills_by_block"
