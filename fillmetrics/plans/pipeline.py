"""The whole job: normalise pending dates, then bring the marts up to date."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fillmetrics.operators import normalize
from fillmetrics.operators.marts import MARKET_SIDES
from fillmetrics.plans.marts import build_marts, marts_exist, stale_dates
from fillmetrics.schema import CATALOG, NUMERIC, SourceSpec
from fillmetrics.session import BYTES_PER_PARTITION, configure, sized_shuffles
from fillmetrics.sources.ledger import RawLedger
from fillmetrics.sources.listing import list_raw
from fillmetrics.sources.raw import raw_directory, read_raw
from fillmetrics.sources.snapshots import stored_dates
from fillmetrics.sources.tables import scan_normalized, store_dates, write_by_date

PLAN = "date date, dataset string, files bigint, bytes bigint, largest bigint, status string"

# A raw file larger than this keeps one task decoding for long; several tasks read it, or its lines are dealt out before they are
# parsed. The choice is made file by file, whatever else a run reads.
SPREAD_RAW_FILE = 64 << 20

# How much larger rows are in a shuffle than in a compressed raw file; only the number of partitions depends on it.
RAW_INFLATION = 4


@dataclass(frozen=True)
class PipelineConf:
    """Where data lives and what to run.

    ``on_bad`` is ``fail`` (one pass) or ``quarantine`` (a second pass collects the defective rows under
    ``quarantine_path``). ``spread_raw_file`` is the file size above which several tasks read a file, or its lines are spread
    before parsing. ``published``
    fills change for readers once per run, all dates together; a table with plain date folders keeps them. With a
    ``ledger_path`` only new and open raw folders are listed. ``with_sketches`` adds that mart when all are built.
    """

    raw_root: str
    fills_path: str
    mart_root: str
    quarantine_path: str | None = None
    on_bad: str = "fail"
    skip_existing: bool = True
    skip_normalize: bool = False
    skip_marts: bool = False
    rebuild_marts: bool = False
    append_only: bool = False
    transport: str = "stream"
    spread_raw_file: int = SPREAD_RAW_FILE
    published: bool = True
    numeric: str = NUMERIC
    sides: Sequence[str] = MARKET_SIDES
    with_sketches: bool = False
    ledger_path: str | None = None
    catalog: Sequence[SourceSpec] = field(default=CATALOG)


def normalize_dates(spark: SparkSession, conf: PipelineConf) -> DataFrame:
    """Normalise all dates (or those not stored yet) and return one status row per date considered.

    The plan has one row per date, so it passes through the driver; the records never do.
    """
    if conf.on_bad == "quarantine" and not conf.quarantine_path:
        raise ValueError("on_bad='quarantine' needs quarantine_path")
    if conf.ledger_path:
        files = RawLedger(spark, conf.ledger_path).refreshed(conf.raw_root)
    else:
        files = list_raw(spark, conf.raw_root)
    plan = normalize.source_plan(files, conf.catalog)
    if conf.skip_existing:
        plan = normalize.pending(plan, stored_dates(spark, conf.fills_path))
    decided = plan.select("date", "dataset", "files", "bytes", "largest", "status").orderBy("date").collect()
    plan = spark.createDataFrame(decided, PLAN)

    chosen = [row for row in decided if row.status == "success"]
    if not chosen:
        return normalize.run_status(plan, spark.createDataFrame([], "date date, records bigint"))

    total = sum(row.bytes for row in chosen)
    raw = {
        dataset: _read_dates(spark, conf, dataset, [row for row in chosen if row.dataset == dataset])
        for dataset in sorted({row.dataset for row in chosen})
    }
    converted = normalize.convert_all(raw)
    days = [row.date for row in chosen]
    good = normalize.accepted(converted, conf.on_bad)
    with sized_shuffles(spark, total * RAW_INFLATION):
        if conf.on_bad == "quarantine":
            write_by_date(normalize.rejected(converted), conf.quarantine_path, days=days)
        # Last, so that a run which broke off before leaves its dates pending.
        store_dates(good, conf.fills_path, days, conf.published)

    written = (
        scan_normalized(spark, conf.fills_path)
        .where(F.col("date").isin(days))
        .groupBy("date")
        .agg(F.count(F.lit(1)).alias("records"))
    )
    return normalize.run_status(plan, written)


def _read_dates(spark: SparkSession, conf: PipelineConf, dataset: str, plan: list[Row]) -> DataFrame:
    oversized = [row for row in plan if row.largest > conf.spread_raw_file]
    return read_raw(
        spark,
        [raw_directory(conf.raw_root, dataset, row.date) for row in plan],
        conf.transport,
        spread_above=conf.spread_raw_file if oversized else None,
        split_above=conf.spread_raw_file if oversized else None,
        parts=math.ceil(sum(row.bytes for row in oversized) * RAW_INFLATION / BYTES_PER_PARTITION) or 1,
    )


def run_pipeline(spark: SparkSession, conf: PipelineConf) -> DataFrame | None:
    """Run both steps; either can be skipped, and an error in the first stops the second.

    Returns the status per date, or ``None`` if normalisation was skipped. Marts are built on first use, rebuilt on
    request, and otherwise refreshed for the dates written now or left over from an interrupted run.
    """
    configure(spark)
    status = None
    touched: list[date] = []
    if not conf.skip_normalize:
        outcome = normalize_dates(spark, conf).collect()
        status = spark.createDataFrame(
            outcome,
            "date date, dataset string, files_processed bigint, records_written bigint, status string",
        )
        touched = [row.date for row in outcome if row.status == "success"]
    if conf.skip_marts:
        return status
    build = {"sides": conf.sides, "numeric": conf.numeric, "with_sketches": conf.with_sketches or None}
    if conf.rebuild_marts or not marts_exist(spark, conf.mart_root):
        build_marts(spark, conf.fills_path, conf.mart_root, **build)
        return status
    days = sorted({*touched, *stale_dates(spark, conf.fills_path, conf.mart_root)})
    if days:
        build_marts(spark, conf.fills_path, conf.mart_root, days=days, append_only=conf.append_only, **build)
    return status
