"""Fills, raw lines and a file listing derived from general tables (events, orders, line items, documents).

Each function is a row-wise expression over a whole table, so the volume of fills grows with the table.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fillmetrics.schema import NODE_FILLS, NODE_FILLS_BY_BLOCK, NODE_TRADES, SourceSpec

BLOCK_EVENTS = 10

# Three sources that overlap within the month covered by the events table.
EVENT_CATALOG = (
    SourceSpec(NODE_TRADES, date(2024, 1, 1), date(2024, 1, 12), 3),
    SourceSpec(NODE_FILLS, date(2024, 1, 10), date(2024, 1, 20), 2),
    SourceSpec(NODE_FILLS_BY_BLOCK, date(2024, 1, 20), date(2099, 12, 31), 1),
)
EVENT_OVERLAPS = ((date(2024, 1, 10), NODE_FILLS), (date(2024, 1, 12), NODE_FILLS), (date(2024, 1, 20), NODE_FILLS_BY_BLOCK))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _price(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


def _event_size() -> Column:
    return F.get_json_object("props", "$.k").cast("decimal(6,0)")


def _millis(ntz: Column) -> Column:
    """Epoch milliseconds of a zone-less timestamp read as UTC, whatever the session zone."""
    return F.unix_millis(F.concat(ntz.cast("string"), F.lit("Z")).cast("timestamp"))


def fills_from_events(events: DataFrame) -> DataFrame:
    """One fill per event; consecutive events share a hash and take the two sides."""
    price = _price("value")
    return events.select(
        F.col("ts").cast("date").alias("date"),
        price.alias("px"),
        _event_size().alias("sz"),
        (price - F.lit(Decimal("50.00"))).alias("closed_pnl"),
        (price * F.lit(Decimal("0.01"))).alias("fee"),
        F.col("user_id").cast("string").alias("user_address"),
        F.col("event_type").alias("coin"),
        F.when(F.col("event_id") % 2 == 0, F.lit("A")).otherwise(F.lit("B")).alias("side"),
        (F.col("event_id") - F.col("event_id") % 2).cast("string").alias("hash"),
        _millis(F.col("ts")).alias("time"),
    )


def fills_from_lineitem(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """One fill per line item over several years: the customer trades a brand; size 1 at the extended price."""
    # Dates are cut before the joins, which shuffle them; prices are not, as one out of range may belong to no order.
    lines = lineitem.select(
        "l_orderkey",
        "l_partkey",
        F.col("l_shipdate").cast("date").alias("date"),
        "l_extendedprice",
        (F.col("l_linenumber") % 2 == 0).alias("even"),
    )
    return (
        lines.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "date",
            _price("l_extendedprice").alias("px"),
            F.lit(1).cast("decimal(6,0)").alias("sz"),
            F.col("o_custkey").cast("string").alias("user_address"),
            F.col("p_brand").alias("coin"),
            F.when(F.col("even"), F.lit("A")).otherwise(F.lit("B")).alias("side"),
            F.col("l_orderkey").cast("string").alias("hash"),
        )
    )


def fills_from_orders(orders: DataFrame) -> DataFrame:
    """One fill per order; the order dates have real gaps."""
    return orders.select(
        F.col("o_orderdate").cast("date").alias("date"),
        _price("o_totalprice").alias("px"),
        F.lit(1).cast("decimal(6,0)").alias("sz"),
        F.col("o_custkey").cast("string").alias("user_address"),
        F.col("o_orderpriority").alias("coin"),
        F.lit("A").alias("side"),
        F.col("o_orderkey").cast("string").alias("hash"),
    )


# -- raw lines ----------------------------------------------------------------------------------------------------


def _texts(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("ts").cast("date").alias("date"),
        F.col("event_type").alias("coin"),
        _price("value").cast("string").alias("px"),
        _event_size().cast("string").alias("sz"),
        F.when(F.col("event_id") % 2 == 0, F.lit("A")).otherwise(F.lit("B")).alias("side"),
        F.col("ts"),
        _millis(F.col("ts")).alias("time"),
        F.col("user_id").cast("string").alias("user"),
        (F.col("event_id") - F.col("event_id") % 2).cast("string").alias("hash"),
    )


def _pair(*extra: Column) -> Column:
    """``["user", {fill}]`` as text; ``to_json`` alone cannot write an array of mixed types."""
    fill = F.struct(
        "coin", "px", "sz", "side", "time", "hash",
        F.col("event_id").alias("oid"),
        (F.col("event_id") * 10).alias("tid"),
        F.lit("0.0").alias("startPosition"),
        F.when(F.col("side") == "A", F.lit("Sell")).otherwise(F.lit("Buy")).alias("dir"),
        F.lit("0.5").alias("closedPnl"),
        (F.col("event_id") % 3 == 0).alias("crossed"),
        F.lit("0.01").alias("fee"),
        F.lit("USDC").alias("feeToken"),
        *extra,
    )
    return F.concat(F.lit('["'), F.col("user"), F.lit('",'), F.to_json(fill), F.lit("]"))


def raw_trades(events: DataFrame) -> DataFrame:
    """Trade lines: one per event, naming the user and a counterparty with an order id of its own."""
    party = F.struct(
        F.col("user"), F.lit("0.0").alias("start_pos"), F.col("event_id").alias("oid"), F.lit("c1").alias("cloid")
    )
    counterparty = F.struct(
        F.concat(F.lit("cp"), F.col("user")).alias("user"),
        F.lit("1.0").alias("start_pos"),
        (F.col("event_id") + 1).alias("oid"),
        F.lit(None).cast("string").alias("cloid"),
    )
    iso = F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
    line = F.to_json(
        F.struct("coin", "px", "sz", "side", iso.alias("time"), "hash", F.array(party, counterparty).alias("side_info"))
    )
    return _texts(events).select(F.lit(NODE_TRADES).alias("dataset"), "date", line.alias("value"))


def raw_fills(events: DataFrame) -> DataFrame:
    """Fill lines: one pair per event."""
    return _texts(events).select(F.lit(NODE_FILLS).alias("dataset"), "date", _pair().alias("value"))


def raw_blocks(events: DataFrame) -> DataFrame:
    """Block lines: up to ten consecutive events of a day per block."""
    builder = F.when(F.col("event_id") % 5 == 0, F.lit("0xb"))
    fee = F.when(F.col("event_id") % 5 == 0, F.lit("0.02"))
    number = F.floor(F.col("event_id") / BLOCK_EVENTS)
    grouped = (
        _texts(events)
        .select("date", number.alias("n"), "event_id", _pair(builder.alias("builder"), fee.alias("builderFee")).alias("e"))
        .groupBy("date", "n")
        .agg(F.array_sort(F.collect_list(F.struct("event_id", "e"))).alias("members"))
    )
    day = F.col("date").cast("string")
    line = F.concat(
        F.lit('{"block_number":'), F.col("n").cast("string"),
        F.lit(',"block_time":"'), day, F.lit('T00:00:00","local_time":"'), day, F.lit('T00:00:01","events":['),
        F.array_join(F.transform("members", lambda member: member["e"]), ","),
        F.lit("]}"),
    )
    return grouped.select(F.lit(NODE_FILLS_BY_BLOCK).alias("dataset"), "date", line.alias("value"))


def raw_by_dataset(events: DataFrame, catalog=EVENT_CATALOG) -> dict[str, DataFrame]:
    """The three layouts, each present on the dates of its catalog entry, overlaps included."""
    makers = {NODE_TRADES: raw_trades, NODE_FILLS: raw_fills, NODE_FILLS_BY_BLOCK: raw_blocks}
    day = F.col("ts").cast("date")
    return {
        spec.dataset: makers[spec.dataset](events.where(day.between(F.lit(spec.start), F.lit(spec.end))))
        for spec in catalog
    }


# -- file listing -------------------------------------------------------------------------------------------------


def listing_from_documents(documents: DataFrame, *extra: str) -> DataFrame:
    """Documents as a listing: source = dataset, characters = bytes, one hour between successive files."""
    modified = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.col("doc_id").cast("int")
    )
    return documents.select(
        F.col("source").alias("dataset"),
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("key"),
        F.col("n_chars").alias("size"),
        modified.alias("modified"),
        *extra,
    )


# Like EVENT_CATALOG, but no source covers the first day and the 19th.
GAPPED_CATALOG = (
    SourceSpec(NODE_TRADES, date(2024, 1, 2), date(2024, 1, 12), 3),
    SourceSpec(NODE_FILLS, date(2024, 1, 10), date(2024, 1, 18), 2),
    SourceSpec(NODE_FILLS_BY_BLOCK, date(2024, 1, 20), date(2099, 12, 31), 1),
)
FILLS_UPLOADED_UNTIL = date(2024, 1, 16)


def raw_files_from_events(events: DataFrame) -> DataFrame:
    """A raw-file listing: one hourly file per dataset and hour with events; one dataset stops early."""
    hours = events.groupBy(F.col("ts").cast("date").alias("date"), F.hour("ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("size")
    )
    datasets = F.array(*[F.lit(name) for name in (NODE_TRADES, NODE_FILLS, NODE_FILLS_BY_BLOCK)])
    files = hours.select("date", "hour", "size", F.explode(datasets).alias("dataset"))
    return files.where((F.col("dataset") != NODE_FILLS) | (F.col("date") <= F.lit(FILLS_UPLOADED_UNTIL)))


def present_files(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Files held already: the labelled documents, those of low quality with a size that differs."""
    held = listing_from_documents(documents.join(labels.select("doc_id", "quality"), "doc_id"), "quality")
    return held.select("key", F.when(F.col("quality") == 1, F.col("size")).otherwise(F.col("size") + 1).alias("size"))
