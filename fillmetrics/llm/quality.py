"""Quality rules with cross-document line frequency.

Lines are normalised (A-Z lower-cased, white space one space) and hashed; each document counts a line once. Per host, the
documents that hold a line are counted over the whole corpus; a line in more than ``least`` of the host's documents, whatever their
number, is boilerplate and is removed, and in a small host one in more than ``few`` and more than ``share`` of them. A document is rejected if it fails the base rules (fewer than 20
words, or over 30 % of them in repeated 8-word windows), or if removal leaves fewer than ``left_words`` words or less than
``left_share`` of its words.

Words are runs of anything but ASCII white space. A null text has none. A null host is a host of its own. Rows that repeat a
document count as documents each. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillmetrics.llm.common import checkpointed

LEAST = 20
FEW, SHARE = 4, 0.5
LEFT_WORDS, LEFT_SHARE = 20, 0.3
WINDOW = 8
LEAST_WORDS, MOST_REPEATED_PERCENT = 20, 30
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
MOST_BROADCAST = 500_000

FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of words found twice or more; windows are compared exactly, by doubling their length."""
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(word, len(number)) for word in words], dtype=np.int64)
    length = 1
    while length < window:
        pairs = ids[:-length] * (len(words) + 1) + ids[length:]
        values, ids = np.unique(pairs, return_inverse=True)
        length *= 2
        if len(values) == len(ids):
            return 0
    again = np.bincount(ids)[ids] > 1
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(again)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def measures(text: str | None) -> tuple[list[int], dict[int, int]]:
    """The counts of FIELDS, and the words of each line by the line's hash."""
    from xxhash import xxh64_intdigest

    if not text:
        return [0, 0, 0, 0, 0], {}
    raw = text.encode()
    words = raw.split()
    seen: set[bytes] = set()
    lines: dict[int, int] = {}
    repeats = 0
    for line in raw.split(b"\n"):
        parts = line.split()
        if parts:
            repeats += line in seen
            seen.add(line)
            key = xxh64_intdigest(b" ".join(parts).lower())
            lines[key] = lines.get(key, 0) + len(parts)
    return [
        len(words),
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        repeats,
        repeated_words(words),
    ], lines


def _measured(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            found = [measures(text) for text in batch.column(2).to_pylist()]
            counts = np.array([f[0] for f in found], dtype=np.int64).reshape(-1, 5)
            texts = [None if text is None else xxh3_128_digest(text.encode()) for text in batch.column(2).to_pylist()]
            hashes = [np.fromiter(f[1].keys(), dtype=np.uint64, count=len(f[1])).view(np.int64) for f in found]
            columns = [
                batch.column(0),
                batch.column(1),
                *[pa.array(counts[:, k]) for k in range(5)],
                pa.array(hashes, pa.list_(pa.int64())),
                pa.array([list(f[1].values()) for f in found], pa.list_(pa.int32())),
                pa.array(texts, pa.binary()),
            ]
            names = ["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines", "line_words", "digest"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, host string, {FIELDS}, lines array<long>, line_words array<int>, digest binary"
    return docs.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


def documents(measured: DataFrame) -> DataFrame:
    """One row of each document: rows that share host, id and text are one, rows without an id are each their own."""
    keys = ["host", "doc_id", "digest"]
    repeated = (
        measured.where(F.col("doc_id").isNotNull())
        .groupBy(*keys)
        .agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > 1)
        .select(*[F.col(name).alias(f"its_{name}") for name in keys], "first")
    )
    repeated = checkpointed(repeated)
    if repeated.isEmpty():
        return measured
    same = [F.col(name).eqNullSafe(F.col(f"its_{name}")) for name in keys]
    return measured.join(repeated, same, "left").where(F.col("first").isNull() | (F.col("first") == F.col("row")))


def frequent_lines(measured: DataFrame, least: int = LEAST, few: int = FEW, share: float = SHARE) -> DataFrame:
    """``host``, ``line`` in more than ``least`` documents of the host, or in more than ``few`` and more than ``share`` of them."""
    distinct = documents(measured)
    hosts = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    counted = (
        distinct.select("host", F.explode("lines").alias("line"))
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("holders"))
        .where(F.col("holders") > min(least, few))
        .withColumnRenamed("host", "its_host")
    )
    return counted.join(hosts, F.col("its_host").eqNullSafe(F.col("host"))).where(
        (F.col("holders") > least) | ((F.col("holders") > few) & (F.col("holders") > share * F.col("documents")))
    ).select("host", "line")


def judged(
    docs: DataFrame,
    host: str = "source",
    least: int = LEAST,
    few: int = FEW,
    share: float = SHARE,
    left_words: int = LEFT_WORDS,
    left_share: float = LEFT_SHARE,
) -> DataFrame:
    """Per row: ``doc_id``, the counts, ``removed_words``, ``base_failed``, ``kept``."""
    plain = docs.select("doc_id", F.col(host).cast("string").alias("host"), F.col("text").cast("string"))
    measured = checkpointed(_measured(plain))
    frequent = checkpointed(frequent_lines(measured, least, few, share)).select(
        F.col("host").alias("its_host"), F.col("line").alias("its_line")
    )
    if frequent.count() <= MOST_BROADCAST:
        frequent = F.broadcast(frequent)
    lines = measured.select(
        "row", "host", F.explode(F.arrays_zip(F.col("lines").alias("hash"), F.col("line_words").alias("words"))).alias("held")
    ).select("row", "host", F.col("held.hash").alias("line"), F.col("held.words").alias("words"))
    removed = (
        lines.join(frequent, (F.col("line") == F.col("its_line")) & F.col("host").eqNullSafe(F.col("its_host")))
        .groupBy("row")
        .agg(F.sum("words").alias("removed_words"))
    )
    left = F.col("n_words") - F.col("removed_words")
    failed = (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT
    )
    return (
        measured.drop("lines", "line_words", "digest")
        .join(removed, "row", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (left >= left_words) & (left >= left_share * F.col("n_words")))
        .drop("row", "host")
    )


def cleaned_text(text: str, gone: set[int]) -> str:
    """The text without its boilerplate lines, given by their hashes."""
    from xxhash import xxh64_intdigest

    return "\n".join(
        line for line in text.split("\n") if xxh64_intdigest(b" ".join(line.encode().split()).lower()) not in gone
    )
