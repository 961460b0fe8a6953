"""Secret scans over an incremental ledger of blobs.

Every historical version of a file is a row; its text is addressed by SHA-256. The ledger is a table of ``blob_id``, ``rules``
(the version of the rule set) and ``findings``; only blobs whose pair with the current version is not in it are scanned,
each once however many paths and versions hold it. Findings are then joined back to all paths.

Only DataFrame functions run. Positions come from regular expressions that return, match by match, the text from the end of
the last match on: lengths add up to ends. The blobs' texts are shuffled once, by document, never by content, so that a text with
many copies is one row there; joining findings back is a plain join by blob, of which Spark splits hot keys.

A null text is the empty blob. Repeated rows get the same findings each. A null ``doc_id`` is kept. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fillmetrics.llm.common import checkpointed

# Rules by kind: pattern, the group whose length counts, its least length. The first three are the base; patterns of
# later ones are as published by those who issue the tokens. A run that is too short as a whole has no longer part, so
# least lengths of runs are part of their patterns; a short ``assign`` match takes its text with it and is dropped later.
RULES = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    "github": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
}
# A cheap necessary condition for a match that is long enough, by kind; what fails it is not searched for positions.
HINTS = {
    "assign": r"(?i)(?:passw|secret|token|api_?key)",
    "access": r"AKIA",
    "hex": r"[0-9a-f]{24}",
    "pem": r"PRIVATE KEY",
    "github": r"gh[pousr]_",
}
BASE = ("assign", "access", "hex")
VERSION = "base-1+tokens-1"
LEDGER = "blob_id string, rules string, findings array<struct<start: int, place: int, end: int, kind: string>>"


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def _sums(values: Column, start: Column) -> Column:
    """The running sums of a short array, copied once per element."""
    return F.aggregate(
        values,
        F.array().cast("array<int>"),
        lambda so_far, value: F.concat(so_far, F.array(F.coalesce(F.try_element_at(so_far, F.lit(-1)), start) + value)),
    )


def _running(values: Column) -> Column:
    """Running sums of an array of any length: within blocks of about its square root, and over these."""
    # One-element arrays keep what follows from being worked out once per use.
    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values))).cast("int"))
    blocks = lambda held: F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(held["v"])), held["s"]), lambda at: F.slice(held["v"], at, held["s"])
    )
    summed = F.transform(F.array(F.struct(values.alias("v"), size.alias("s"))), lambda held: F.struct(blocks(held).alias("b")))
    placed = F.transform(
        summed,
        lambda held: F.struct(
            held["b"].alias("b"),
            _sums(F.transform(held["b"], lambda block: F.aggregate(block, F.lit(0), lambda a, b: a + b)), F.lit(0)).alias("e"),
        ),
    )
    return F.flatten(
        F.transform(
            placed,
            lambda held: F.flatten(
                F.transform(
                    held["b"], lambda block, k: _sums(block, F.when(k == 0, F.lit(0)).otherwise(F.element_at(held["e"], F.greatest(k, F.lit(1)))))
                )
            ),
        )
    )


def _found(text: Column, kind: str, place: int) -> Column:
    """start, place, end, kind of each long enough match of a kind."""
    pattern, group, least = RULES[kind]
    grouped = f"({pattern})" if not pattern.startswith("(?i)") else f"(?i)({pattern[4:]})"
    counted = group + 1  # behind the parentheses just added
    # The rest without a match is one last piece: else each of its places would be tried as a start.
    rest = grouped.removeprefix("(?i)")
    flags = "(?is)" if grouped.startswith("(?i)") else "(?s)"
    steps = flags + ".*?(?:" + rest + r"|\z)"
    pieces = F.regexp_extract_all(text, F.lit(steps), F.lit(0))
    matches = F.regexp_extract_all(text, F.lit(steps), F.lit(1))
    judged = F.regexp_extract_all(text, F.lit(steps), F.lit(counted)) if group else matches
    ends = _running(F.transform(pieces, F.length))
    rows = F.transform(
        F.arrays_zip(ends.alias("end"), matches.alias("match"), judged.alias("judged")),
        lambda row: F.struct(
            (row["end"] - F.length(row["match"])).alias("start"),
            F.lit(place).alias("place"),
            row["end"].alias("end"),
            F.lit(kind).alias("kind"),
            F.length(row["judged"]).alias("counted"),
        ),
    )
    kept = F.filter(rows, lambda row: (row["end"] > row["start"]) & (row["counted"] >= least))
    return F.transform(kept, lambda row: F.struct(row["start"], row["place"], row["end"], row["kind"]))


def findings(text: Column) -> Column:
    """All matches of all rules in a text, by start, then kind as listed."""
    nothing = F.array().cast("array<struct<start: int, place: int, end: int, kind: string>>")
    each = [
        F.when(text.rlike(HINTS[kind]), _found(text, kind, place)).otherwise(nothing) for place, kind in enumerate(RULES)
    ]
    return F.array_sort(F.concat(*each))


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: str = VERSION) -> tuple[DataFrame, DataFrame]:
    """Findings by row of ``versions`` (``doc_id``, ``blob_id``, ``findings``) and the rows to append to the ledger."""
    spark = versions.sparkSession
    known = (ledger if ledger is not None else empty_ledger(spark)).where(F.col("rules") == rules)
    blob = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)
    paths = checkpointed(versions.select("doc_id", blob.alias("blob_id")))
    unseen = (
        paths.groupBy("blob_id")
        .agg(F.min("doc_id").alias("its_id"))
        .join(known.select("blob_id").distinct(), "blob_id", "left_anti")
    )
    texts = versions.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where(
        F.col("text") != ""
    )
    # The id finds the text; the address decides, since an id may have several texts.
    scanned = (
        texts.join(unseen, F.col("doc_id").eqNullSafe(F.col("its_id")))
        .where(F.sha2(F.col("text").cast("binary"), 256) == F.col("blob_id"))
        .select("blob_id", F.lit(rules).alias("rules"), findings(F.col("text")).alias("findings"))
    )
    fresh = checkpointed(scanned.dropDuplicates(["blob_id"]))
    current = known.unionByName(fresh).where(F.size("findings") > 0).select("blob_id", "findings")
    nothing = F.array().cast("array<struct<start: int, place: int, end: int, kind: string>>")
    by_path = paths.join(current, "blob_id", "left").select(
        "doc_id", "blob_id", F.coalesce("findings", nothing).alias("findings")
    )
    return by_path, fresh


def spans_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def _sql_of(kind: str, place: int) -> str:
    pattern, group, least = RULES[kind]
    flags, rest = ("(?is)", pattern[4:]) if pattern.startswith("(?i)") else ("(?s)", pattern)
    quoted = (flags + ".*?(?:(" + rest + r")|\z)").replace("'", "''")
    part = lambda number: f"regexp_extract_all(text, '{quoted}', {number})"
    return f"""
SELECT doc_id, '{kind}' AS kind, {place} AS place, p AS pieces, m AS matches, unnest(range(1, len(p) + 1)) AS i,
    {f"{part(group + 1)}" if group else "m"} AS judged, {least} AS least
FROM (SELECT doc_id, text, {part(0)} AS p, {part(1)} AS m FROM documents WHERE text IS NOT NULL)"""


def sql() -> str:
    """The query over ``documents`` in another database's SQL; ids are taken to be unique."""
    every = " UNION ALL ".join(_sql_of(kind, place) for place, kind in enumerate(RULES))
    counts = ", ".join(f"coalesce(count(*) FILTER (kind = '{kind}'), 0) AS n_{kind}" for kind in BASE)
    base = ", ".join(f"'{kind}'" for kind in BASE)
    joined = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place)"
    return f"""
WITH every AS ({every}), spans AS (
    SELECT doc_id, kind, place, list_sum(list_transform(pieces[1:i], lambda x: length(x))) AS e,
        list_sum(list_transform(pieces[1:i], lambda x: length(x))) - length(matches[i]) AS s
    FROM every WHERE coalesce(matches[i], '') <> '' AND length(judged[i]) >= least
), by_doc AS (
    SELECT doc_id, {counts}, sha256(coalesce({joined} FILTER (kind IN ({base})), '')) AS base_sha256, {joined} AS spans
    FROM spans GROUP BY doc_id
)
SELECT d.doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in BASE)},
    coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN by_doc b USING (doc_id)"""
