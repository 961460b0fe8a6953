"""Date, month, coin and side predicates (columns and literals only, never SQL text)."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_date(value: str | date) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)


def as_list(values: str | Iterable[str] | None) -> list[str]:
    """One coin, several coins or nothing; an empty selection means no filter."""
    if not values:
        return []
    return [values] if isinstance(values, str) else list(values)


def in_dates(df: DataFrame, start: str | date | None = None, end: str | date | None = None) -> DataFrame:
    """Inclusive date range, either end optional; date literals reach ``PartitionFilters``."""
    if start:
        df = df.where(F.col("date") >= F.lit(as_date(start)))
    if end:
        df = df.where(F.col("date") <= F.lit(as_date(end)))
    return df


def in_month(df: DataFrame, month: str | None = None) -> DataFrame:
    """Month ``YYYY-MM`` as a half-open date range, which prunes partitions without formatting each date."""
    if not month:
        return df
    first = date.fromisoformat(f"{month}-01")
    following = date(first.year + first.month // 12, first.month % 12 + 1, 1)
    return df.where((F.col("date") >= F.lit(first)) & (F.col("date") < F.lit(following)))


def in_coins(df: DataFrame, coins: str | Iterable[str] | None = None) -> DataFrame:
    selected = as_list(coins)
    return df.where(F.col("coin").isin(selected)) if selected else df


def on_side(sides: Iterable[str]) -> Column:
    return F.col("side").isin(list(sides))
