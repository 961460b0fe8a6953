"""All checks of a normalised table in one call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillmetrics.operators import normalize, quality
from fillmetrics.plans.pipeline import PipelineConf
from fillmetrics.sources.listing import list_raw
from fillmetrics.sources.raw import count_lines, raw_directory, read_raw
from fillmetrics.sources.tables import scan_normalized


def _raw_by_dataset(spark: SparkSession, conf: PipelineConf, winners_only: bool) -> dict[str, DataFrame]:
    """Raw lines per dataset; the directories (one per date and dataset) are looked up on the driver."""
    files = list_raw(spark, conf.raw_root)
    if winners_only:
        files = normalize.winning_rows(files, conf.catalog)
    found = files.select("dataset", "date").distinct().collect()
    return {
        dataset: read_raw(
            spark,
            [raw_directory(conf.raw_root, dataset, row.date) for row in found if row.dataset == dataset],
            conf.transport,
        )
        for dataset in sorted({row.dataset for row in found})
    }


def check_counts(spark: SparkSession, conf: PipelineConf) -> DataFrame:
    """Raw lines, fills expected from the winning sources, and fills stored, per dataset. Reads the raw files."""
    raw_counts = spark.createDataFrame([], "dataset string, raw_records bigint")
    for raw in _raw_by_dataset(spark, conf, winners_only=False).values():
        raw_counts = raw_counts.unionByName(count_lines(raw))
    winning = _raw_by_dataset(spark, conf, winners_only=True)
    if winning:
        expected = quality.expected_fills(normalize.convert_all(winning).where(F.col("defect").isNull()))
    else:
        expected = spark.createDataFrame([], "dataset string, expected_records bigint")
    return quality.count_check(raw_counts, expected, scan_normalized(spark, conf.fills_path))


def validate(spark: SparkSession, conf: PipelineConf, with_raw: bool = True) -> dict[str, DataFrame]:
    """Every check by name, each a lazy DataFrame; ``with_raw`` includes the one that reads the raw files again."""
    stored = scan_normalized(spark, conf.fills_path)
    checks = {
        "processed_counts": quality.processed_counts(stored),
        "overlap_check": quality.overlap_check(stored, normalize.overlaps(conf.catalog)),
        "completeness": quality.completeness(stored),
        "missing_dates": quality.missing_dates(stored),
        "overall_statistics": quality.overall_statistics(stored),
        "statistics_by_source": quality.statistics_by_source(stored),
        "top_coins_by_count": quality.top_coins_by_count(stored),
    }
    if with_raw:
        checks["count_check"] = check_counts(spark, conf)
    return checks
