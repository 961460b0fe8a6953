"""Headline timings at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Three groups: the job (raw LZ4 files -> stored fills -> marts), metrics on the stored marts, and metrics computed
straight from line-item fills without marts. All report the median of three runs after a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable, Iterator

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyarrow as pa  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from fillmetrics import FillAnalytics, PipelineConf  # noqa: E402
from fillmetrics import adapters as ad  # noqa: E402
from fillmetrics.plans.marts import build_marts  # noqa: E402
from fillmetrics.plans.pipeline import normalize_dates  # noqa: E402
from fillmetrics.session import local_session  # noqa: E402
from fillmetrics.sources.tables import scan_normalized, write_by_date  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
# The larger mart build repeats the stored fills so many times, a third of them under one user.
COPIES = int(os.environ.get("BENCH_COPIES", "20"))
BUCKETS = [500, 1000, 2500]


def seconds(work: Callable[[], object]) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def drain(df: DataFrame) -> None:
    """Run the whole plan and throw the rows away on the executors."""
    df.write.format("noop").mode("overwrite").save()


def write_raw_files(events: DataFrame, root: str) -> None:
    """The events as LZ4 raw files, one per dataset and date, in the directory layout of the archive."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: dict[tuple, list[str]] = {}
        for batch in batches:
            for dataset, day, value in zip(*[column.to_pylist() for column in batch.columns]):
                lines.setdefault((dataset, day), []).append(value)
        for (dataset, day), values in lines.items():
            folder = f"{root}/{dataset}/hourly/{day:%Y%m%d}"
            os.makedirs(folder, exist_ok=True)
            with pa.CompressedOutputStream(f"{folder}/0.lz4", "lz4") as out:
                out.write(("\n".join(values) + "\n").encode())
        yield pa.RecordBatch.from_arrays([pa.array([len(lines)], pa.int64())], names=["n"])

    for raw in ad.raw_by_dataset(events).values():
        drain(raw.repartition(int(CPUS), "date").mapInArrow(write, "n long"))


def main() -> None:
    spark: SparkSession = local_session(CPUS, "bench", os.environ.get("BENCH_MEMORY", "8g"))
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    events = ad.table(spark, SF_DIR, "events")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    write_raw_files(events, f"{folder}/raw")

    def job(target: str) -> PipelineConf:
        return PipelineConf(f"{folder}/raw", f"{target}/fills", f"{target}/marts", catalog=ad.EVENT_CATALOG)

    attempts: dict[str, list[float]] = {"job_normalize": [], "job_build_marts": []}
    for attempt in range(RUNS + 1):
        conf = job(f"{folder}/{attempt}")
        attempts["job_normalize"].append(seconds(lambda: normalize_dates(spark, conf).collect()))
        attempts["job_build_marts"].append(seconds(lambda: build_marts(spark, conf.fills_path, conf.mart_root)))
    timings.update({name: statistics.median(took[1:]) for name, took in attempts.items()})
    stored_rows = scan_normalized(spark, conf.fills_path).count()

    copies = (
        scan_normalized(spark, conf.fills_path)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
        .withColumn(
            "user_address",
            F.when(F.col("copy") % 3 == 0, F.lit("0xhot")).otherwise(F.concat_ws("-", "user_address", "copy")),
        )
        .drop("copy")
    )
    write_by_date(copies, f"{folder}/large/fills", replace_all=True)
    large_seconds = seconds(lambda: build_marts(spark, f"{folder}/large/fills", f"{folder}/large/marts"))

    opened = FillAnalytics(spark, conf.fills_path, conf.mart_root)
    line_fills = ad.fills_from_lineitem(*[ad.table(spark, SF_DIR, name) for name in ("lineitem", "orders", "part")])
    direct = FillAnalytics.from_fills(line_fills)
    metrics: dict[str, Callable[[], DataFrame]] = {
        "dau": lambda: opened.get_dau(),
        "dau_coin": lambda: opened.get_dau(coins="click"),
        "mau": lambda: opened.get_mau(),
        "new_users": lambda: opened.get_daily_new_users(),
        "volume_buckets": lambda: opened.get_volume_buckets(),
        "volume_buckets_coin": lambda: opened.get_volume_buckets(coins=["click", "purchase"]),
        "user_daily_buckets": lambda: opened.get_user_daily_buckets(),
        "cumulative_thresholds": lambda: opened.get_cumulative_thresholds(),
        "bucket_transitions": lambda: opened.get_bucket_transitions(BUCKETS),
        "bucket_mobility": lambda: opened.get_bucket_mobility([2, 7], BUCKETS),
        "top_users": lambda: opened.get_top_users_by_volume(),
        "coin_statistics": lambda: opened.get_coin_statistics(),
        "data_summary": lambda: opened.data_summary(),
        "summary_report": lambda: opened.get_summary_report(),
        "lines_daily_user_volume": lambda: direct.daily_user_volume,
        "lines_daily_metrics": lambda: direct.daily_metrics,
        "lines_mau": lambda: direct.get_mau(),
        "lines_top_users": lambda: direct.get_top_users_by_volume(),
        "lines_bucket_mobility": lambda: direct.get_bucket_mobility(),
        "lines_coin_statistics": lambda: direct.get_coin_statistics(),
    }
    for name, ask in metrics.items():
        drain(ask())
        timings[name] = statistics.median(seconds(lambda: drain(ask())) for _ in range(RUNS))

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in timings.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "stored_fills": stored_rows,
                "normalize_fills_per_sec": round(stored_rows / timings["job_normalize"]),
                "mart_fills_per_sec": round(stored_rows / timings["job_build_marts"]),
                "large_mart_fills": stored_rows * COPIES,
                "large_mart_seconds": round(large_seconds, 3),
                "large_mart_fills_per_sec_and_core": round(stored_rows * COPIES / large_seconds / int(CPUS)),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
