"""Whether stored fills are those of the raw files, row by row, without sorting or joining the rows.

A multiset of rows has a digest that does not depend on their order: how many there are, and the sum and exclusive or of their
hashes. Digests are aggregated per source and date, in parts before the shuffle, and compared; equal counts with another
content (a fill swapped for another, one doubled and one lost) give other sums. Only where they differ are the rows
themselves counted against each other. Two hashes of 64 bits are summed, so that rows are told apart beyond one hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillmetrics.schema import NORMALIZED

COLUMNS = tuple(NORMALIZED.names)
KEYS = ("dataset_source", "date")
_DIGEST = ("records", "sum1", "sum2", "xor1")


def _hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    # A hash of several columns passes over nulls, so each column says first whether it is one.
    parts = [part for name in columns for part in (F.col(name).isNull(), F.col(name))]
    return F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)


def digests(rows: DataFrame, columns: Sequence[str] = COLUMNS, keys: Sequence[str] = KEYS) -> DataFrame:
    """``keys``, ``records``, ``sum1``, ``sum2``, ``xor1`` of the rows of each key."""
    first, second = _hashes(columns)
    hashed = rows.select(*keys, first.alias("h1"), second.alias("h2"))
    return hashed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.col("h1").cast("decimal(20,0)")).alias("sum1"),
        F.sum(F.col("h2").cast("decimal(20,0)")).alias("sum2"),
        F.bit_xor("h1").alias("xor1"),
    )


def content_check(
    expected: DataFrame, stored: DataFrame, columns: Sequence[str] = COLUMNS, keys: Sequence[str] = KEYS
) -> DataFrame:
    """``keys``, ``expected_records``, ``stored_records``, ``same_count``, ``passed`` (the same rows, as often)."""
    raw, held = digests(expected, columns, keys), digests(stored, columns, keys)
    other = held.select(*[F.col(name).alias(f"its_{name}") for name in held.columns])
    same_key = _all([F.col(key).eqNullSafe(F.col(f"its_{key}")) for key in keys])
    # One row per key on both sides.
    both = raw.join(other, same_key, "full_outer")
    equal = _all([F.col(name).eqNullSafe(F.col(f"its_{name}")) for name in _DIGEST])
    return both.select(
        *[F.coalesce(F.col(key), F.col(f"its_{key}")).alias(key) for key in keys],
        F.coalesce("records", F.lit(0)).alias("expected_records"),
        F.coalesce("its_records", F.lit(0)).alias("stored_records"),
        F.col("records").eqNullSafe(F.col("its_records")).alias("same_count"),
        equal.alias("passed"),
    )


def differing_rows(
    expected: DataFrame,
    stored: DataFrame,
    checked: DataFrame,
    columns: Sequence[str] = COLUMNS,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """The rows, of keys that failed in ``checked``, that are stored less or more often than expected.

    ``columns``, ``keys``, ``missing`` (negative: too many). Rows are counted by their hashes before anything is shuffled, so a
    row that is repeated without end is one row; one of each stands for the others.
    """
    # One row per key that failed, sent to every task: otherwise all rows would be shuffled to find the few keys.
    failed = F.broadcast(checked.where(~F.col("passed")).select(*[F.col(key).alias(f"its_{key}") for key in keys]))
    same_key = _all([F.col(key).eqNullSafe(F.col(f"its_{key}")) for key in keys])
    names = list(dict.fromkeys([*columns, *keys]))
    first, second = _hashes(columns)

    def counted(rows: DataFrame, sign: int) -> DataFrame:
        return rows.join(failed, same_key, "left_semi").select(
            *keys, first.alias("h1"), second.alias("h2"), F.lit(sign).cast("bigint").alias("sign"), F.struct(*names).alias("row")
        )

    totals = (
        counted(expected, 1)
        .unionByName(counted(stored, -1))
        .groupBy(*keys, "h1", "h2")
        .agg(F.sum("sign").alias("missing"), F.any_value("row").alias("row"))
    )
    return totals.where(F.col("missing") != 0).select("row.*", "missing")


def _all(conditions: Sequence[Column]) -> Column:
    found = conditions[0]
    for condition in conditions[1:]:
        found = found & condition
    return found
