"""Session settings the library relies on."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE merges small shuffle partitions, splits skewed ones and picks join strategies from measured sizes.
# Dynamic overwrite replaces only the dates that a job writes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (a cluster's own session, for example)."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# One shuffle partition per this much input before AQE merges small ones. A driver short of memory for very many
# partitions wants a larger setting, not a ceiling, under which partitions would outgrow their tasks.
BYTES_PER_PARTITION = 128 << 20


@contextmanager
def sized_shuffles(
    spark: SparkSession, input_bytes: int, bytes_per_partition: int = BYTES_PER_PARTITION
) -> Iterator[int]:
    """Within the block, start shuffles with enough partitions for an input of known size.

    AQE merges what turns out small; a session default fit for small runs would put terabytes into a few hundred
    partitions. The session's own setting returns afterwards.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(default, math.ceil(input_bytes / bytes_per_partition))
    spark.conf.set(key, str(wanted))
    try:
        yield wanted
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def local_session(cpus: int | str = "*", app: str = "fillmetrics", memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the benchmark; clusters bring their own session and shuffle sizing."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Noting the Python call site of every column costs more than a small query; clusters may keep it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
