"""Fields of raw records that the schema does not know, kept and counted instead of vanishing.

A record's fields are looked at once more as a map of texts; what has a known name is left out. The rest is a JSON object per
fill or line (a VARIANT where asked for), and a count per source, date and field that tells when a source has changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fillmetrics.schema import NODE_FILLS, NODE_FILLS_BY_BLOCK, NODE_TRADES, RAW_BLOCK, RAW_FILL, RAW_PARTY, RAW_TRADE

ANY = "map<string,string>"


def _names(ddl: str) -> list[str]:
    return T.StructType.fromDDL(ddl).names


def _unknown(object_text: Column, known: list[str], prefix: str = "") -> Column:
    """A map of the fields of a JSON object that are not ``known``; empty where it is no object."""
    fields = F.from_json(object_text, ANY)
    rest = F.map_filter(fields, lambda name, _: ~name.isin(known))
    if prefix:
        rest = F.transform_keys(rest, lambda name, _: F.concat(F.lit(prefix), name))
    return F.coalesce(rest, F.create_map().cast(ANY))


def rescued(lines: DataFrame, dataset: str) -> DataFrame:
    """``dataset, date, place`` (within the line) and ``fields`` (a map) of all objects with unknown fields."""
    line = F.col("value")
    # Where fields may be: of a trade line and its parties, of the object in a pair, of a block line and its pairs.
    trade, fill, block = (_names(ddl) for ddl in (RAW_TRADE, RAW_FILL, RAW_BLOCK))
    party = T.StructType.fromDDL(f"p {RAW_PARTY}")["p"].dataType.names
    if dataset == NODE_TRADES:
        parties = F.from_json(F.get_json_object(line, "$.side_info"), "array<string>")
        objects = F.concat(
            F.array(_unknown(line, trade)),
            F.coalesce(F.transform(parties, lambda one: _unknown(one, party, "side_info.")), F.array().cast(f"array<{ANY}>")),
        )
    elif dataset == NODE_FILLS:
        objects = F.array(_unknown(F.get_json_object(line, "$[1]"), fill))
    elif dataset == NODE_FILLS_BY_BLOCK:
        events = F.from_json(F.get_json_object(line, "$.events"), "array<array<string>>")
        fills = F.transform(events, lambda pair: _unknown(F.get(pair, F.lit(1)), fill, "events."))
        objects = F.concat(F.array(_unknown(line, block)), F.coalesce(fills, F.array().cast(f"array<{ANY}>")))
    else:
        raise ValueError(f"unknown dataset {dataset!r}")
    found = lines.select("dataset", "date", F.posexplode(objects).alias("place", "fields"))
    return found.where(F.size("fields") > 0)


def unknown_fields(lines: DataFrame, dataset: str) -> DataFrame:
    """``dataset, date, field, records`` with one ``example`` (the least) of each unknown field."""
    return (
        rescued(lines, dataset)
        .select("dataset", "date", F.explode("fields").alias("field", "value"))
        .groupBy("dataset", "date", "field")
        .agg(F.count(F.lit(1)).alias("records"), F.min("value").alias("example"))
    )


def as_variant(found: DataFrame) -> DataFrame:
    """:func:`rescued` rows with their ``fields`` as one VARIANT, to be stored or asked by path."""
    return found.withColumn("fields", F.parse_json(F.to_json("fields")))
