"""Volume buckets: labels, ranks and the cumulative thresholds.

A bucket list is any strictly increasing list of thresholds. Labels are whole dollars; a null volume falls into
the top bucket because no comparison with it is true.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default thresholds.
DAILY_BUCKETS = (100, 1_000, 10_000, 100_000, 1_000_000)
USER_BUCKETS = (1_000, 10_000, 100_000)
CUMULATIVE = (1_000, 10_000, 100_000)
HORIZONS = (7, 30)


def check_thresholds(thresholds: Sequence[float]) -> list[float]:
    values = list(thresholds)
    if not values:
        raise ValueError("at least one bucket threshold is needed")
    if any(low >= high for low, high in zip(values, values[1:])):
        raise ValueError(f"bucket thresholds must increase strictly: {values}")
    return values


def dollars(amount: float) -> str:
    return f"${amount:,.0f}"


def labels(thresholds: Sequence[float]) -> list[str]:
    """All labels in rank order: one below the first threshold, one between each pair, one above the last."""
    values = check_thresholds(thresholds)
    between = [f"{dollars(low)} - {dollars(high)}" for low, high in zip(values, values[1:])]
    return [f"< {dollars(values[0])}", *between, f">= {dollars(values[-1])}"]


def _pick(volume: Column, thresholds: Sequence[float], outcomes: Sequence) -> Column:
    limits = check_thresholds(thresholds)
    picked = F.when(volume < F.lit(limits[0]), F.lit(outcomes[0]))
    for limit, outcome in zip(limits[1:], outcomes[1:]):
        picked = picked.when(volume < F.lit(limit), F.lit(outcome))
    return picked.otherwise(F.lit(outcomes[-1]))


def bucket_label(volume: Column, thresholds: Sequence[float]) -> Column:
    return _pick(volume, thresholds, labels(thresholds))


def bucket_rank(volume: Column, thresholds: Sequence[float]) -> Column:
    return _pick(volume, thresholds, range(len(thresholds) + 1))


def rank_label(rank: Column, thresholds: Sequence[float]) -> Column:
    """Rank to label; a rank outside the list has no label."""
    names = labels(thresholds)
    named = F.when(rank == 0, F.lit(names[0]))
    for position, name in enumerate(names[1:], start=1):
        named = named.when(rank == position, F.lit(name))
    return named


def above_label(threshold: float) -> str:
    """Label of a cumulative threshold. The test behind it is ``>=`` although the label reads ``>``."""
    return f"> {dollars(threshold)}"
