"""Small conversions: times, path dates, sizes, and the step from exact decimals to the double API edge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_millis(text: Column) -> Column:
    """ISO time to epoch milliseconds, finer digits cut off; null if unreadable. Times without offset are UTC."""
    zoned = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.unix_millis(zoned.try_cast("timestamp"))


def path_date(path: Column) -> Column:
    """Date of ``.../YYYYMMDD/file``; null where the directory is not a date."""
    digits = F.regexp_extract(path, r"/(\d{8})/[^/]+$", 1)
    dashed = F.regexp_replace(digits, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return dashed.try_cast("date")


def days_inclusive(first: Column, last: Column) -> Column:
    return F.datediff(last, first) + F.lit(1)


def gigabytes(size: Column) -> Column:
    return size / F.lit(float(1024**3))


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def to_double(amount: Column) -> Column:
    return amount.cast("double")


def exact_mean(amount: Column) -> Column:
    """Mean as exact sum over count: the sum is taken before the step to double, so its order is irrelevant."""
    return to_double(F.sum(amount)) / F.count(amount)
