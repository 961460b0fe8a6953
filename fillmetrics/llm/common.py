"""What several operators share: reading a table, cutting lineage, labels of rows, connected components."""

from __future__ import annotations

import ctypes
import os
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SLICE_ROWS = 1024
BATCH_BYTES = "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a session on one machine may do without and use one beside its warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_checkpoints")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def narrow_batches(spark: SparkSession) -> None:
    """From here on rows go to Python in batches of some ``BATCH_BYTES``, unless the session names a bound of its own.

    Spark's own bound, 10,000 rows or 64 MB, is held several times per task: in the executor on the way there and back, in the
    worker as a batch and as texts.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, BATCH_BYTES)


def sliced(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into smaller ones, so that only the texts of a few rows are in memory as Python's."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def fold(identifier: str, folds: int) -> Column:
    """crc32 of the identifier as text, modulo ``folds``; null where the identifier is null."""
    return F.pmod(F.crc32(F.col(identifier).cast("string").cast("binary")), F.lit(folds)).cast("int")


def chance(key: Column, salt: str) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1_000_000)) / F.lit(1_000_000.0)


_KEPT: list[tuple[str, object, object]] = []


def kept_in_worker(kind: str, source: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept for the next task of this worker as long as it is asked for with the same object or text.

    A broadcast value is one object for all tasks of a worker. A worker keeps one thing at a time, as it goes from one
    operator to the next: what it kept goes before anything is made.
    """
    same = any(held == kind and (of is source or isinstance(source, str) and of == source) for held, of, _ in _KEPT)
    if not same:
        nothing_kept_in_worker()
        _KEPT.append((kind, source, make()))
    return _KEPT[0][2]


def nothing_kept_in_worker() -> None:
    """Let go of what an operator before kept; the C library, where it is glibc, gives the memory back to the system."""
    if not _KEPT:
        return
    _KEPT.clear()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


def components(links: DataFrame) -> DataFrame:
    """``node``, ``label`` for every node of the links (``a``, ``b``): the smallest node reachable.

    Labels run along links and then jump to the label of their label, so that rounds grow with the logarithm of a
    chain's length. Each round is aggregated before it is shuffled and cut off by a checkpoint; only whether anything
    changed comes to the driver.
    """
    edges = checkpointed(
        links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
        .unionByName(links.select(F.col("b").alias("src"), F.col("a").alias("dst")))
        .where(F.col("src") != F.col("dst"))
        .distinct()
    )
    labels = checkpointed(
        edges.groupBy(F.col("src").alias("node"))
        .agg(F.min("dst").alias("low"))
        .select("node", F.least("node", "low").alias("label"))
    )
    while True:
        heard = (
            edges.join(labels, edges.dst == labels.node)
            .groupBy(F.col("src").alias("node"))
            .agg(F.min("label").alias("heard"))
        )
        lowered = labels.join(heard, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "heard").alias("low")
        )
        target = labels.select(F.col("node").alias("low"), F.col("label").alias("lower"))
        moved = checkpointed(
            lowered.join(target, "low").select("node", F.least("low", "lower").alias("label"), "old")
        )
        labels = moved.select("node", "label")
        if moved.where(F.col("label") != F.col("old")).isEmpty():
            return labels
