"""Reader for LZ4-frame JSON lines.

Spark's text reader cannot open LZ4 frames, so this is the one place where Python runs on the executors. The ``binaryFile``
scan packs files into tasks by their size; decoding happens in that same stage, block by block, so memory per task
is bounded by the block size and not by the file size. Unusually large files are read by several tasks, a run of blocks
each (:mod:`lz4runs`). Where their blocks depend on each other one task decodes the file, and as decoding is quick next
to JSON parsing, its lines can be spread over the cluster before they are parsed.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillmetrics.sources.listing import with_raw_location
from fillmetrics.sources.lz4runs import RUN_BYTES, Run, run_texts, runs_of

BLOCK_BYTES = 8 << 20

# Ship the decoding functions of this module with the job, so executors need only pyarrow and not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RAW_LINES = "dataset string, date date, path string, value string"


def open_path(path: str) -> pa.NativeFile:
    """Open a listed path on an executor; the schemes known to Arrow (local, HDFS, S3, GCS) work unchanged."""
    if path.startswith("file:/"):
        return pa.OSFile("/" + path[len("file:") :].lstrip("/"))
    filesystem, location = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return filesystem.open_input_stream(location)


def open_at(path: str) -> pa.NativeFile:
    """The same, for reading from any place."""
    if path.startswith("file:/"):
        return pa.OSFile("/" + path[len("file:") :].lstrip("/"))
    filesystem, location = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return filesystem.open_input_file(location)


def _line_array(text: bytes) -> pa.Array:
    """Split decoded text into its non-blank lines, in Arrow."""
    whole = pa.array([text], pa.large_binary()).cast(pa.large_string())
    lines = pc.split_pattern(whole, "\n").flatten()
    filled = pc.not_equal(pc.ascii_trim_whitespace(lines), "")
    return lines.filter(filled).cast(pa.string())


def line_arrays(source: pa.NativeFile, block_bytes: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Stream the lines of one LZ4-frame file; a line that crosses a block edge stays whole."""
    pending: list[bytes] = []
    with pa.CompressedInputStream(source, "lz4") as stream:
        while block := stream.read(block_bytes):
            cut = block.rfind(b"\n")
            if cut < 0:
                pending.append(block)
                continue
            yield _line_array(b"".join([*pending, block[:cut]]))
            pending = [block[cut + 1 :]]
    rest = b"".join(pending)
    if rest:
        yield _line_array(rest)


def _decoder(opener: Callable[[str], pa.NativeFile], block_bytes: int):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inline = "content" in batch.schema.names
            for row in range(batch.num_rows):
                path = batch.column("path")[row]
                if inline:
                    source = pa.BufferReader(batch.column("content")[row].as_buffer())
                else:
                    source = opener(path.as_py())
                for lines in line_arrays(source, block_bytes):
                    count = len(lines)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(batch.column("dataset")[row], count),
                            pa.repeat(batch.column("date")[row], count),
                            pa.repeat(path, count),
                            lines,
                        ],
                        names=["dataset", "date", "path", "value"],
                    )

    return decode


RUNS = "path string, dataset string, date date, first boolean, start long, end long, flags int, largest int"


def _run_lister(opener: Callable[[str], pa.NativeFile], run_bytes: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "dataset", "date", "first", "start", "end", "flags", "largest"]
        kinds = [None, None, None, pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        for batch in batches:
            for row in range(batch.num_rows):
                place = [batch.column(name)[row] for name in names[:3]]
                with opener(place[0].as_py()) as source:
                    runs = [(not k, run.start, run.end, run.flags, run.largest) for k, run in enumerate(runs_of(source, run_bytes))]
                columns = [pa.repeat(value, len(runs)) for value in place]
                columns += [pa.array([run[k] for run in runs], kinds[k + 3]) for k in range(5)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return find


def _run_decoder(opener: Callable[[str], pa.NativeFile], block_bytes: int):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                run = Run(row["start"], row["end"], row["flags"], row["largest"])
                with opener(row["path"]) as source:
                    for text in run_texts(source, run, row["first"], block_bytes):
                        lines = _line_array(text)
                        place = [pa.scalar(row["dataset"]), pa.scalar(row["date"], pa.date32()), pa.scalar(row["path"])]
                        yield pa.RecordBatch.from_arrays(
                            [*(pa.repeat(value, len(lines)) for value in place), lines], names=["dataset", "date", "path", "value"]
                        )

    return decode


def read_raw(
    spark: SparkSession,
    directories: list[str],
    transport: str = "stream",
    opener: Callable[[str], pa.NativeFile] = open_path,
    block_bytes: int = BLOCK_BYTES,
    spread_above: int | None = None,
    parts: int = 1,
    split_above: int | None = None,
    run_bytes: int = RUN_BYTES,
    seekable: Callable[[str], pa.NativeFile] = open_at,
) -> DataFrame:
    """Non-blank lines of all ``*.lz4`` files in the date directories: ``dataset, date, path, value``.

    ``stream`` opens each file from the executor and has no size limit. ``content`` takes the bytes through Spark's
    own connector (useful where only the cluster holds the credentials) and is limited to files under 2 GB.
    Files larger than ``split_above`` bytes are read by several tasks, about ``run_bytes`` each as far as their blocks are
    independent, and the lines of longer runs are dealt out; ``stream`` only. Lines of files larger than ``spread_above`` bytes are dealt out over ``parts`` partitions.
    """
    if transport not in ("stream", "content"):
        raise ValueError(f"unknown transport {transport!r}")
    if not directories:
        return spark.createDataFrame([], RAW_LINES)
    scan = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.lz4")
        .load(directories)
    )
    content = ["content"] if transport == "content" else []

    def lines(files: DataFrame) -> DataFrame:
        located = with_raw_location(files.select("path", *content))
        return located.select("path", "dataset", "date", *content).mapInArrow(
            _decoder(opener, block_bytes), RAW_LINES
        )

    def spread(found: DataFrame) -> DataFrame:
        # Numbered rather than hashed by text: equal lines spread too, and a repeated task deals them out as before.
        return found.withColumn("n", F.monotonically_increasing_id()).repartition(parts, "n").drop("n")

    if split_above is not None and transport == "stream":
        large = with_raw_location(scan.where(F.col("length") > split_above).select("path")).select("path", "dataset", "date")
        # The list of runs is short; dealt out by place, as many tasks as there are read them.
        runs = large.mapInArrow(_run_lister(seekable, run_bytes), RUNS).repartition(parts, "path", "start")
        whole = F.col("end") - F.col("start") > 2 * run_bytes  # blocks that depend on each other
        split = runs.where(~whole).mapInArrow(_run_decoder(seekable, block_bytes), RAW_LINES)
        long = runs.where(whole).mapInArrow(_run_decoder(seekable, block_bytes), RAW_LINES)
        return lines(scan.where(F.col("length") <= split_above)).unionByName(split).unionByName(spread(long))
    if spread_above is None:
        return lines(scan)
    above = spread(lines(scan.where(F.col("length") > spread_above)))
    return lines(scan.where(F.col("length") <= spread_above)).unionByName(above)


def raw_directory(root: str, dataset: str, day) -> str:
    return f"{root.rstrip('/')}/{dataset}/hourly/{day:%Y%m%d}"


def count_lines(raw: DataFrame) -> DataFrame:
    """Raw lines per dataset."""
    return raw.groupBy("dataset").agg(F.count(F.lit(1)).alias("raw_records"))
