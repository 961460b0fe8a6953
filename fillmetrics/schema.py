"""Table schemas, raw record types and the source catalog."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import types as T

# Dataset names, their inclusive date ranges and priorities (1 wins) are part of the data format.
NODE_TRADES = "node_trades"
NODE_FILLS = "node_fills"
NODE_FILLS_BY_BLOCK = "node_fills_by_block"


@dataclass(frozen=True)
class SourceSpec:
    """One raw dataset: where it is valid and how strongly it is preferred."""

    dataset: str
    start: date
    end: date
    priority: int


CATALOG = (
    SourceSpec(NODE_TRADES, date(2025, 3, 22), date(2025, 6, 21), 3),
    SourceSpec(NODE_FILLS, date(2025, 5, 25), date(2025, 7, 27), 2),
    SourceSpec(NODE_FILLS_BY_BLOCK, date(2025, 7, 27), date(2099, 12, 31), 1),
)

# Days on which two datasets meet, and the one that must have been used.
OVERLAP_EXPECTED = (
    (date(2025, 5, 25), NODE_FILLS),
    (date(2025, 6, 21), NODE_FILLS),
    (date(2025, 7, 27), NODE_FILLS_BY_BLOCK),
)

# The stored column names, order and types. Prices and sizes stay text so no digit is lost.
NORMALIZED = T.StructType(
    [
        T.StructField("coin", T.StringType()),
        T.StructField("px", T.StringType()),
        T.StructField("sz", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("time", T.LongType()),
        T.StructField("hash", T.StringType()),
        T.StructField("user_address", T.StringType()),
        T.StructField("oid", T.LongType()),
        T.StructField("tid", T.LongType()),
        T.StructField("start_position", T.StringType()),
        T.StructField("direction", T.StringType()),
        T.StructField("closed_pnl", T.StringType()),
        T.StructField("crossed", T.BooleanType()),
        T.StructField("fee", T.StringType()),
        T.StructField("fee_token", T.StringType()),
        T.StructField("cloid", T.StringType()),
        T.StructField("block_number", T.LongType()),
        T.StructField("block_time", T.StringType()),
        T.StructField("builder", T.StringType()),
        T.StructField("builder_fee", T.StringType()),
        T.StructField("dataset_source", T.StringType()),
        T.StructField("local_time", T.StringType()),
    ]
)

NORMALIZED_PARTITIONED = T.StructType([*NORMALIZED.fields, T.StructField("date", T.DateType())])

RAW_PARTY = "struct<user: string, start_pos: string, oid: string, cloid: string>"
RAW_TRADE = (
    "coin string, px string, sz string, side string, time string, hash string, "
    f"side_info array<{RAW_PARTY}>"
)

# Scalars are read as text and cast with a check, so that a value of another type is seen instead of turning null.
RAW_FILL = (
    "coin string, px string, sz string, side string, time string, hash string, oid string, tid string, "
    "startPosition string, dir string, closedPnl string, crossed string, fee string, feeToken string, "
    "cloid string, builder string, builderFee string"
)

# The events of a block are pairs [user, {fill}] of mixed types, so their members are first taken as text.
RAW_BLOCK = "block_number string, block_time string, local_time string, events array<array<string>>"

REQUIRED = ("coin", "px", "sz", "side", "time", "hash", "user_address")

# Types of the query columns unless one type is asked for. Prices have room for twelve integer digits and fourteen others. px * sz is
# DECIMAL(38,14): the volume of a fill is rounded there, once, and sums of volumes keep 24 integer digits and do not depend on the
# order in which partial sums arrive, so a re-run after an executor loss gives the same digits. A value with more digits
# than its type is refused, not rounded.
NUMERIC = "exact"
EXACT_TYPES = {"px": "decimal(26,14)", "sz": "decimal(17,6)", "closed_pnl": "decimal(38,18)", "fee": "decimal(38,18)"}
