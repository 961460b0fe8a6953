"""Large raw files read in runs of blocks: the same lines as in one piece, wherever blocks, frames and lines meet."""

import os
import random
import struct

import pyarrow as pa
import pytest
import xxhash
from fixtures import FILL, as_rows
from pyspark.sql import functions as F

from fillmetrics.sources.lz4runs import HEADER_CHECK, MAGIC, Run, run_texts, runs_of
from fillmetrics.sources.raw import line_arrays, read_raw


def frame(data: bytes, block: int, block_sum=False, content_sum=False, sized=False, stored=()) -> bytes:
    flags = 0x60 | 0x10 * block_sum | 0x04 * content_sum | 0x08 * sized
    descriptor = bytes([flags, 0x40]) + (struct.pack("<Q", len(data)) if sized else b"")
    out = struct.pack("<I", MAGIC) + descriptor + bytes([(xxhash.xxh32(descriptor).intdigest() >> 8) & 0xFF])
    for number, at in enumerate(range(0, len(data), block)):
        raw = data[at : at + block]
        packed = raw if number in stored else pa.compress(raw, codec="lz4_raw", asbytes=True)
        out += struct.pack("<I", len(packed) | (0x80000000 if number in stored else 0)) + packed
        out += struct.pack("<I", xxhash.xxh32(packed).intdigest()) if block_sum else b""
    return out + b"\0\0\0\0" + (struct.pack("<I", xxhash.xxh32(data).intdigest()) if content_sum else b"")


def dependent(data: bytes) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.CompressedOutputStream(sink, "lz4") as out:
        out.write(data)
    return sink.getvalue().to_pybytes()


SKIPPABLE = struct.pack("<II", 0x184D2A53, 5) + b"hello"


def lines_of(file: bytes, run_bytes: int, block_bytes: int) -> list[str]:
    source = pa.BufferReader(file)
    found = []
    for number, run in enumerate(runs_of(source, run_bytes)):
        for text in run_texts(source, run, number == 0, block_bytes):
            found += [line for line in text.decode().split("\n") if line.strip()]
    return found


def test_header_checks():
    for descriptor, check in HEADER_CHECK.items():
        assert check == (xxhash.xxh32(bytes(descriptor)).intdigest() >> 8) & 0xFF


@pytest.mark.parametrize("seed", range(12))
def test_runs_give_the_lines_of_the_whole(seed):
    random.seed(seed)
    lines = ["é" * random.choice([0, 1, 3, 200]) + f"line {k}" * random.choice([0, 1, 30]) for k in range(random.randint(0, 80))]
    data = "\n".join(lines).encode() + random.choice([b"", b"\n", b"\n\n"])
    cut = random.randint(0, len(data))
    options = {"block_sum": seed % 2 == 0, "content_sum": seed % 3 == 0, "sized": seed % 4 == 0, "stored": range(0, 99, 3)}
    files = [
        frame(data, random.randint(1, 300), **options),
        frame(data[:cut], 7, **options) + SKIPPABLE + frame(data[cut:], 50) + frame(b"", 5),
        dependent(data[:cut]) + frame(data[cut:], 40),
        dependent(data),
        frame(data[:cut], 33) + dependent(data[cut:]),
    ]
    expected = [line for line in data.decode().split("\n") if line.strip()]
    for file in files:
        for run_bytes in (1, 60, 1 << 20):
            for block_bytes in (5, 1 << 16):
                assert lines_of(file, run_bytes, block_bytes) == expected


def test_damaged_files_are_refused():
    good = frame(b"some lines\n" * 50, 64)
    with pytest.raises(ValueError, match="no readable"):
        list(runs_of(pa.BufferReader(b"no frame at all, but text")))
    with pytest.raises((EOFError, OSError, struct.error)):
        lines_of(good[:60], 1, 64)
    assert list(runs_of(pa.BufferReader(b""))) == []


def test_one_file_is_read_by_several_tasks(spark, folder):
    lines = [FILL.replace("0xa", f"0x{k}") for k in range(3000)]
    place = f"{folder}/node_fills/hourly/20250801"
    os.makedirs(place)
    with open(f"{place}/00.lz4", "wb") as out:
        out.write(frame("\n".join(lines).encode(), 4096))
    with open(f"{place}/01.lz4", "wb") as out:
        out.write(dependent(b"small\n"))
    whole = read_raw(spark, [place])
    split = read_raw(spark, [place], split_above=1000, run_bytes=5000, parts=8)
    assert as_rows(split) == as_rows(whole)
    tasks = split.where(F.col("value") != "small").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) > 4 and max(row["count"] for row in tasks) < 1500
    # Dependent blocks are one long run, whose lines are dealt out.
    with open(f"{place}/00.lz4", "wb") as out:
        out.write(dependent("\n".join(lines).encode()))
    dealt = read_raw(spark, [place], split_above=1000, run_bytes=100, parts=8)
    assert as_rows(dealt) == as_rows(whole)
    tasks = dealt.where(F.col("value") != "small").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) == 8
    assert next(iter(line_arrays(pa.BufferReader(dependent(b"x\n"))))).to_pylist() == ["x"]


def test_runs_are_at_least_as_long_as_asked_for():
    file = frame(b"x" * 10000, 100)
    runs = list(runs_of(pa.BufferReader(file), 200))
    assert all(isinstance(run, Run) and run.end - run.start >= 200 for run in runs[:-1]) and len(runs) > 3
    assert [a.end for a in runs[:-1]] == [b.start for b in runs[1:]]
