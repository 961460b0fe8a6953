"""Checks on the normalised table."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillmetrics.functions.values import days_inclusive
from fillmetrics.schema import NODE_TRADES, OVERLAP_EXPECTED


def processed_counts(normalized: DataFrame) -> DataFrame:
    """Stored fills per source, and the total under ``total``."""
    return (
        normalized.rollup("dataset_source")
        .agg(F.count(F.lit(1)).alias("processed_records"), F.grouping("dataset_source").alias("is_total"))
        .select(
            F.when(F.col("is_total") == 1, F.lit("total")).otherwise(F.col("dataset_source")).alias("dataset_source"),
            "processed_records",
        )
    )


def expected_fills(converted: DataFrame) -> DataFrame:
    """Fills that the raw lines of the winning sources hold, per dataset: ``dataset, expected_records``."""
    return converted.groupBy(F.col("dataset_source").alias("dataset")).agg(
        F.count(F.lit(1)).alias("expected_records")
    )


def count_check(raw_counts: DataFrame, expected: DataFrame, normalized: DataFrame) -> DataFrame:
    """Raw lines, expected and stored fills per dataset, fills per line, and whether the stored count is as expected.

    All three inputs of the joins have one row per dataset. A trade line should give two fills.
    """
    stored = normalized.groupBy(F.col("dataset_source").alias("dataset")).agg(
        F.count(F.lit(1)).alias("processed_records")
    )
    joined = raw_counts.join(expected, "dataset", "left").join(stored, "dataset", "left")
    filled = joined.select(
        "dataset",
        "raw_records",
        F.coalesce("expected_records", F.lit(0)).alias("expected_records"),
        F.coalesce("processed_records", F.lit(0)).alias("processed_records"),
    )
    return filled.select(
        "*",
        F.try_divide(F.col("processed_records").cast("double"), F.col("raw_records")).alias("fills_per_line"),
        F.when(F.col("dataset") == NODE_TRADES, F.lit(2.0)).alias("nominal_fills_per_line"),
        (F.col("processed_records") == F.col("expected_records")).alias("passed"),
    )


def overlap_check(
    normalized: DataFrame, expectation: Iterable[tuple[date, str]] = OVERLAP_EXPECTED
) -> DataFrame:
    """Sources found on the listed dates: ``date, expected_source, dataset_source, records, passed``.

    A listed date without data appears once with null source and ``passed`` null. The list is a literal of a few
    dates; the scan is limited to them.
    """
    listed = dict(expectation)
    expected = normalized.sparkSession.createDataFrame(list(listed.items()), "date date, expected_source string")
    found = (
        normalized.where(F.col("date").isin(list(listed)))
        .groupBy("date", "dataset_source")
        .agg(F.count(F.lit(1)).alias("records"))
    )
    return expected.join(found, "date", "left").select(
        "date",
        "expected_source",
        "dataset_source",
        F.coalesce("records", F.lit(0)).alias("records"),
        (F.col("dataset_source") == F.col("expected_source")).alias("passed"),
    )


def completeness(dated: DataFrame) -> DataFrame:
    """``min_date, max_date, unique_dates, expected_days, missing_days``; one row, also for an empty table."""
    span = dated.agg(
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count_distinct("date").alias("unique_dates"),
    )
    expected = F.coalesce(days_inclusive(F.col("min_date"), F.col("max_date")), F.lit(0)).cast("bigint")
    return span.select("*", expected.alias("expected_days"), (expected - F.col("unique_dates")).alias("missing_days"))


def missing_dates(dated: DataFrame) -> DataFrame:
    """Days between the first and the last date that have no row; the table is read once, for its distinct dates."""
    present = dated.where(F.col("date").isNotNull()).select("date").distinct()
    calendar = present.agg(F.min("date").alias("low"), F.max("date").alias("high")).select(
        F.explode(F.sequence("low", "high", F.expr("interval 1 day"))).alias("date")
    )
    return calendar.join(present, "date", "left_anti").orderBy("date")


def overall_statistics(normalized: DataFrame) -> DataFrame:
    """``total_fills, unique_users, unique_coins, total_days, earliest_date, latest_date``."""
    return normalized.agg(
        F.count(F.lit(1)).alias("total_fills"),
        F.count_distinct("user_address").alias("unique_users"),
        F.count_distinct("coin").alias("unique_coins"),
        F.count_distinct("date").alias("total_days"),
        F.min("date").alias("earliest_date"),
        F.max("date").alias("latest_date"),
    )


def statistics_by_source(normalized: DataFrame) -> DataFrame:
    """``dataset_source, fills, users, coins, days, min_date, max_date``."""
    return (
        normalized.groupBy("dataset_source")
        .agg(
            F.count(F.lit(1)).alias("fills"),
            F.count_distinct("user_address").alias("users"),
            F.count_distinct("coin").alias("coins"),
            F.count_distinct("date").alias("days"),
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
        )
        .orderBy("dataset_source")
    )


def top_coins_by_count(normalized: DataFrame, limit: int = 10) -> DataFrame:
    """Coins with the most fills: ``coin, trades``; ties by coin."""
    return (
        normalized.groupBy("coin")
        .agg(F.count(F.lit(1)).alias("trades"))
        .orderBy(F.desc("trades"), F.asc_nulls_last("coin"))
        .limit(limit)
    )
