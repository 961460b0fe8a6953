"""Raw records of three layouts to one table of fills, with one source per date."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fillmetrics.functions.values import iso_millis
from fillmetrics.schema import (
    CATALOG,
    EXACT_TYPES,
    NODE_FILLS,
    NODE_FILLS_BY_BLOCK,
    NODE_TRADES,
    NORMALIZED,
    NUMERIC,
    RAW_BLOCK,
    RAW_FILL,
    RAW_PARTY,
    RAW_TRADE,
    REQUIRED,
    SourceSpec,
)

# ---------------------------------------------------------------------------------------------------------------
# Converters. Input: ``date, value`` (one JSON text per row). Output: the stored columns, ``date``, and ``defect``
# (null for a good row) with ``text``, the part of the input it is about. Rows stay on the JVM and in their partition.
#
# Every parse goes through a one-element generator. The optimizer may not move a filter below a generator or merge
# projections across it, so the text is parsed once per row; without it each reference to a field would parse again.
# Only scalars are carried across the explode of parties or events, so a long line is not copied once per fill.
# ---------------------------------------------------------------------------------------------------------------


def _parsed(df: DataFrame, text: str, schema: str, *keep: str | Column) -> DataFrame:
    """``keep`` and the fields of the JSON object in ``text`` as columns."""
    return df.select(*keep, F.inline(F.array(F.from_json(text, schema))))


def _checked(value: Column, kind: T.DataType) -> tuple[Column, Column]:
    """A text as a stored type, and whether it is a text of that type (or absent)."""
    text = value.cast("string")
    if isinstance(kind, T.StringType):
        return text, F.lit(True)
    if isinstance(kind, T.BooleanType):
        cast = F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))
    else:
        cast = text.try_cast(kind)
    return cast, text.isNull() | cast.isNotNull()


def _unified(df: DataFrame, found: dict[str, Column], text: Column) -> DataFrame:
    """Project onto the stored columns (absent ones become null) and judge each row.

    A row is defective if a required value is absent or any value is there but not of its column's type.
    """
    columns, wrong = [], []
    for field in NORMALIZED:
        cast, fits = _checked(found.get(field.name, F.lit(None)), field.dataType)
        columns.append(cast.alias(field.name))
        absent = cast.isNull() if field.name in REQUIRED else F.lit(False)
        if field.name in REQUIRED or not isinstance(field.dataType, T.StringType):
            wrong.append(F.when(absent | ~fits, F.lit(field.name)))
    names = F.concat_ws(", ", *wrong)
    judged = df.select(*columns, "date", text.alias("text"), names.alias("names"))
    defect = F.when(F.col("names") != "", F.concat(F.lit("missing or unreadable: "), F.col("names")))
    return judged.withColumn("defect", defect).drop("names")


# ``["user",{...}]`` to ``{"user":"user","fill":{...}}``; escapes inside the user text are carried over unread.
PAIR_LINE = r'(?s)^\s*\[\s*"((?:[^"\\]|\\.)*+)"\s*,\s*(\{.*\})\s*\]\s*$'
PAIR_OBJECT = '{"user":"$1","fill":$2}'


def _lost_array(name: str) -> Column:
    """True where a record has no array although its line is broken or holds something else under that name."""
    line = F.col("value")
    whole = F.try_parse_json(line).isNotNull() & F.ltrim(line).startswith("{")
    return F.col(name).isNull() & (~whole | F.get_json_object(line, f"$.{name}").isNotNull())


def convert_trades(raw: DataFrame) -> DataFrame:
    """One fill per entry of ``side_info``; the record's side is copied to both parties. No entry, no fill."""
    shared = ("coin", "px", "sz", "side", "hash")
    record = _parsed(raw, "value", RAW_TRADE, "date", "value")
    # A broken record is kept as one defective row, however many parties it names.
    millis = iso_millis(F.col("time"))
    incomplete = reduce(or_, [F.col(name).isNull() for name in shared]) & (F.size("side_info") > 0)
    broken = millis.isNull() | incomplete | _lost_array("side_info")
    stand_in = F.array(F.lit(None).cast(RAW_PARTY))
    listed = record.select(
        "date",
        *shared,
        millis.alias("time"),
        F.when(broken, F.col("value")).alias("line"),
        F.when(broken, stand_in).otherwise(F.col("side_info")).alias("parties"),
    )
    parties = listed.select("date", *shared, "time", "line", F.explode("parties").alias("party"))
    found = {name: F.col(name) for name in (*shared, "time")} | {
        "user_address": F.col("party.user"),
        "oid": F.col("party.oid"),
        "start_position": F.col("party.start_pos"),
        "cloid": F.col("party.cloid"),
        "dataset_source": F.lit(NODE_TRADES),
    }
    return _unified(parties, found, F.coalesce("line", "hash"))


def _fill_columns() -> dict[str, Column]:
    return {name: F.col(name) for name in ("coin", "px", "sz", "side", "time", "hash", "oid", "tid")} | {
        "user_address": F.col("user"),
        "start_position": F.col("startPosition"),
        "direction": F.col("dir"),
        "closed_pnl": F.col("closedPnl"),
        "crossed": F.col("crossed"),
        "fee": F.col("fee"),
        "fee_token": F.col("feeToken"),
        "cloid": F.col("cloid"),
    }


def convert_fills(raw: DataFrame) -> DataFrame:
    """A pair ``[user, {fill}]`` becomes one fill.

    A pair mixes types, which a schema cannot describe. Its frame is rewritten to an object with two fields, so that
    one parse reads and checks everything; a line of any other shape stays as it is and fails that parse.
    """
    rewritten = raw.select("date", "value", F.regexp_replace("value", PAIR_LINE, PAIR_OBJECT).alias("object"))
    pairs = _parsed(rewritten, "object", f"user string, fill struct<{RAW_FILL}>", "date", "value")
    fills = pairs.select("date", "value", "user", "fill.*")
    return _unified(fills, _fill_columns() | {"dataset_source": F.lit(NODE_FILLS)}, F.col("value"))


def convert_blocks(raw: DataFrame) -> DataFrame:
    """Every entry of ``events`` becomes one fill that carries the block's metadata and its builder fields."""
    block = ("date", "block_number", "block_time", "local_time")
    # A broken line is kept as one defective row: a pair without user, holding the line itself.
    stand_in = F.array(F.array(F.lit(None).cast("string"), F.col("value")))
    events = _parsed(raw, "value", RAW_BLOCK, "date", "value").select(
        *block, F.explode(F.when(_lost_array("events"), stand_in).otherwise(F.col("events"))).alias("pair")
    )
    pairs = events.select(*block, F.get("pair", F.lit(0)).alias("user"), F.get("pair", F.lit(1)).alias("fill"))
    fills = _parsed(pairs, "fill", RAW_FILL, *block, "user", F.col("fill").alias("line"))
    found = _fill_columns() | {
        "block_number": F.col("block_number"),
        "block_time": F.col("block_time"),
        "local_time": F.col("local_time"),
        "builder": F.col("builder"),
        "builder_fee": F.col("builderFee"),
        "dataset_source": F.lit(NODE_FILLS_BY_BLOCK),
    }
    return _unified(fills, found, F.col("line"))


CONVERTERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    NODE_TRADES: convert_trades,
    NODE_FILLS: convert_fills,
    NODE_FILLS_BY_BLOCK: convert_blocks,
}


def accepted(converted: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Good rows only. ``fail`` stops the job at the first defective row, in the same pass that produces the rows;
    ``quarantine`` leaves such rows to :func:`rejected`."""
    good = F.col("defect").isNull()
    if on_bad == "fail":
        good = F.when(good, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("bad raw record, "), F.col("defect"), F.lit(": "), F.coalesce("text", F.lit("")))).cast(
                "boolean"
            )
        )
    elif on_bad != "quarantine":
        raise ValueError(f"unknown on_bad {on_bad!r}")
    return converted.where(good).select(*NORMALIZED.names, "date")


def rejected(converted: DataFrame) -> DataFrame:
    """Defective rows with their original text."""
    return converted.where(F.col("defect").isNotNull()).select("dataset_source", "date", "defect", "text")


def convert(raw: DataFrame, dataset: str) -> DataFrame:
    """Dispatch the lines of one dataset to its converter."""
    return CONVERTERS[dataset](raw.where(F.col("dataset") == dataset))


def convert_all(raw_by_dataset: dict[str, DataFrame]) -> DataFrame:
    """All datasets in one output, columns matched by name."""
    converted = [convert(raw, dataset) for dataset, raw in raw_by_dataset.items()]
    unified = converted[0]
    for other in converted[1:]:
        unified = unified.unionByName(other)
    return unified


# ---------------------------------------------------------------------------------------------------------------
# Source choice. The catalog has a handful of entries known when the plan is made, so it becomes a CASE expression:
# no join, and rows or files of a losing source are dropped where they are.
# ---------------------------------------------------------------------------------------------------------------


def source_for(day: Column, catalog: Sequence[SourceSpec] = CATALOG) -> Column:
    """The dataset that counts for a date: lowest priority number among those whose range holds it, else null."""
    chosen = F.lit(None).cast("string")
    for spec in sorted(catalog, key=lambda s: (s.priority, s.dataset), reverse=True):
        chosen = F.when(day.between(F.lit(spec.start), F.lit(spec.end)), F.lit(spec.dataset)).otherwise(chosen)
    return chosen


def overlaps(catalog: Sequence[SourceSpec] = CATALOG) -> list[tuple[date, str]]:
    """First and last days on which sources of the catalog meet, with the source that counts."""
    chosen = lambda day: min((s for s in catalog if s.start <= day <= s.end), key=lambda s: (s.priority, s.dataset))
    days = {
        edge
        for one in catalog
        for other in catalog
        if one != other
        for edge in (max(one.start, other.start), min(one.end, other.end))
        if max(one.start, other.start) <= min(one.end, other.end)
    }
    return [(day, chosen(day).dataset) for day in sorted(days)]


def winning_rows(df: DataFrame, catalog: Sequence[SourceSpec] = CATALOG, dataset: str = "dataset") -> DataFrame:
    """Rows (lines, fills or files) of the chosen source of their date; the date comes from the directory."""
    return df.where(F.col(dataset) == source_for(F.col("date"), catalog))


def source_plan(files: DataFrame, catalog: Sequence[SourceSpec] = CATALOG) -> DataFrame:
    """Per date seen in any dataset: the chosen source, its files, their bytes and the status before any run."""
    chosen = source_for(F.col("date"), catalog)
    wins = F.col("dataset") == chosen
    return (
        files.groupBy("date")
        .agg(
            F.count(F.when(wins, F.lit(1))).alias("files"),
            F.coalesce(F.sum(F.when(wins, F.col("size"))), F.lit(0)).cast("bigint").alias("bytes"),
            F.coalesce(F.max(F.when(wins, F.col("size"))), F.lit(0)).cast("bigint").alias("largest"),
        )
        .select(
            "date",
            chosen.alias("dataset"),
            "files",
            "bytes",
            "largest",
            F.when(chosen.isNull(), F.lit("no_data"))
            .when(F.col("files") == 0, F.lit("no_files"))
            .otherwise(F.lit("success"))
            .alias("status"),
        )
    )


def pending(plan: DataFrame, done: DataFrame) -> DataFrame:
    """Planned dates that the output does not hold yet."""
    return plan.join(done.select("date"), "date", "left_anti")


def run_status(plan: DataFrame, written: DataFrame) -> DataFrame:
    """Outcome per date: ``date, dataset, files_processed, records_written, status``.

    ``written`` holds ``date, records``; both sides have one row per date.
    """
    return plan.join(written, "date", "left").select(
        "date",
        "dataset",
        F.col("files").alias("files_processed"),
        F.when(F.col("status") == "success", F.coalesce("records", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias(
            "records_written"
        ),
        "status",
    )


def run_statistics(status: DataFrame) -> DataFrame:
    """Dates, files and records per dataset over the successful dates, with a final ``total`` row."""
    done = status.where(F.col("status") == "success")
    return (
        done.rollup("dataset")
        .agg(
            F.count(F.lit(1)).alias("dates"),
            F.coalesce(F.sum("files_processed"), F.lit(0)).alias("files"),
            F.coalesce(F.sum("records_written"), F.lit(0)).alias("records"),
        )
        .withColumn("dataset", F.coalesce("dataset", F.lit("total")))
    )


# ---------------------------------------------------------------------------------------------------------------
# Typed fills.
# ---------------------------------------------------------------------------------------------------------------


def _number(name: str, numeric: str) -> tuple[Column, Column]:
    """A text column as a number, and whether nothing of it was lost."""
    text = F.trim(F.col(name))
    cast = text.try_cast(EXACT_TYPES[name] if numeric == NUMERIC else numeric)
    if numeric != NUMERIC and not numeric.startswith("decimal"):
        return cast, cast.isNotNull()
    # The widest type with room for the integer digits tells a rounded value from an equal one; digits beyond its scale
    # are counted in the text.
    fraction = F.length(F.regexp_extract(text, r"\.([0-9]*?)0*$", 1))
    exact = (cast.cast("decimal(38,18)") == text.try_cast("decimal(38,18)")) & (fraction <= 18)
    return cast, cast.isNotNull() & exact


def typed_fills(normalized: DataFrame, numeric: str = NUMERIC, strict: bool = True) -> DataFrame:
    """The ten query columns with their types: per column (``exact``) or the type named for all four amounts.

    ``strict`` raises on text that is no number or has more digits than its type; otherwise such values become null
    (see :func:`count_untyped`).
    """

    def number(name: str) -> Column:
        cast, whole = _number(name, numeric)
        lost = F.col(name).isNotNull() & ~F.coalesce(whole, F.lit(False))
        if strict:
            told = F.concat(F.lit(f"no exact {name}: "), F.col(name))
            return F.when(lost, F.raise_error(told).cast(cast_type(name))).otherwise(cast).alias(name)
        return F.when(~lost, cast).alias(name)

    def cast_type(name: str) -> str:
        return EXACT_TYPES[name] if numeric == NUMERIC else numeric

    return normalized.select(
        F.col("date").cast("date").alias("date"),
        number("px"),
        number("sz"),
        number("closed_pnl"),
        number("fee"),
        F.col("user_address").cast("string").alias("user_address"),
        F.col("coin").cast("string").alias("coin"),
        F.col("side").cast("string").alias("side"),
        F.col("hash").cast("string").alias("hash"),
        F.col("time").cast("bigint").alias("time"),
    )


def count_untyped(normalized: DataFrame, numeric: str = NUMERIC) -> DataFrame:
    """How many values per amount are text that its type cannot hold as it stands."""
    return normalized.agg(
        *[
            F.count(
                F.when(F.col(name).isNotNull() & ~F.coalesce(_number(name, numeric)[1], F.lit(False)), F.lit(1))
            ).alias(name)
            for name in EXACT_TYPES
        ]
    )
