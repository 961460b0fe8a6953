"""Test items inside long documents: size-partitioned MinHash search, verified by exact shingle containment.

An item counts as contained if at least ``percent`` of its different shingles (``shingle`` words in a row, lower-cased, split
at everything but letters and digits) are in the document. Items are partitioned by size in powers of two. An item's sketch
is its lowest shingle hashes, as many as an item of its partition's largest size may miss, and one: a document that contains the
item enough has at least one of them, so no pair is lost, however long the document. Documents need no sketch: each shingle is
looked up once among those of the items, and documents with fewer shingles than an item's share are not matched with it.
Candidates are then counted exactly, on texts of shingles.

Only DataFrame functions run. The items' sketches are broadcast if counted to be few, else joined by shuffle; so are the
candidates. Items with fewer words than a shingle have none and are never contained; nor is anything in a null or empty text.
Rows without ``doc_id`` or ``item_id`` are not matched; of repeated ids, the best row counts. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillmetrics.llm.common import checkpointed

SHINGLE = 5
PERCENT = 80
# Rows up to which a side is broadcast: some ten megabytes of numbers.
MOST_BROADCAST = 500_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once; a column would be put in again wherever the body names it, lambdas included."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(plain, " "), lambda word: word != "")


def _windows(values: Column, shingle: int, joined: Callable[..., Column]) -> Column:
    starts = F.when(F.size(values) >= shingle, F.sequence(F.lit(0), F.size(values) - shingle)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda at: joined(*[F.get(values, at + k) for k in range(shingle)]))


def shingle_hashes(text: Column, shingle: int) -> Column:
    return _let(
        F.transform(words(text), lambda word: F.xxhash64(word)), lambda hashes: _windows(hashes, shingle, F.xxhash64)
    )


def shingle_texts(text: Column, shingle: int) -> Column:
    return _let(words(text), lambda list_: _windows(list_, shingle, lambda *parts: F.concat_ws(" ", *parts)))


def sketches(items: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``item_id``, ``needed`` (shingles that a document must share), ``hash``: the lowest hashes of each item."""
    sized = (
        items.where(F.col("item_id").isNotNull())
        .select("item_id", F.array_sort(F.array_distinct(shingle_hashes(F.col("text"), shingle))).alias("hashes"))
        .where(F.size("hashes") > 0)
        .withColumn("n", F.size("hashes"))
    )
    largest = F.pow(F.lit(2), F.length(F.bin("n"))).cast("int") - 1
    needed = lambda n: F.ceil(n * F.lit(percent) / F.lit(100)).cast("int")
    return sized.select(
        "item_id", needed(F.col("n")).alias("needed"), F.explode_outer(F.slice("hashes", F.lit(1), largest - needed(largest) + 1)).alias("hash")
    )


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MOST_BROADCAST else df


def contained(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``item_id``, ``shared``, ``n_shingles``, ``containment`` of every item contained in a document."""
    docs = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.col("text").cast("string"))
    items = items.select("item_id", F.col("text").cast("string"))
    lowest = checkpointed(sketches(items, shingle, percent))
    # Not ``explode``: the filter that Spark derives from it is pushed below the hashes and would compute them again for each.
    probes = (
        docs.select("doc_id", shingle_hashes(F.col("text"), shingle).alias("hashes"))
        .select("doc_id", F.size("hashes").alias("held"), F.explode_outer("hashes").alias("hash"))
        .join(_small(lowest, lowest.count()), "hash")
        .where(F.col("held") >= F.col("needed"))
    )
    candidates = checkpointed(probes.select("doc_id", "item_id").distinct())
    known = items.where(F.col("item_id").isNotNull()).select(
        "item_id", F.array_distinct(shingle_texts(F.col("text"), shingle)).alias("wanted")
    )
    return (
        docs.join(_small(candidates, candidates.count()), "doc_id")
        .select("doc_id", "item_id", shingle_texts(F.col("text"), shingle).alias("found"))
        .join(_small(known, items.count()), "item_id")
        .select(
            "doc_id",
            "item_id",
            F.size(F.array_intersect("wanted", "found")).cast("long").alias("shared"),
            F.size("wanted").cast("long").alias("n_shingles"),
        )
        .groupBy("doc_id", "item_id")
        .agg(F.max_by(F.struct("shared", "n_shingles"), F.try_divide("shared", "n_shingles")).alias("best"))
        .where(F.col("best.shared") * 100 >= F.col("best.n_shingles") * percent)
        .select(
            "doc_id", "item_id", "best.*", (F.col("best.shared") / F.col("best.n_shingles")).alias("containment")
        )
    )


def decontaminated(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows whose text contains no item, whatever other rows share their id."""
    digest = F.sha2(F.col("text").cast("string").cast("binary"), 256)
    texts = docs.where(F.col("text").isNotNull()).select(digest.alias("doc_id"), "text")
    found = contained(texts, items, shingle, percent)
    hit = checkpointed(found.select(F.col("doc_id").alias("its_digest")).distinct())
    rows = docs.select(F.struct(*[F.col(name) for name in docs.columns]).alias("row"), digest.alias("digest"))
    return rows.join(_small(hit, hit.count()), F.col("digest") == F.col("its_digest"), "left_anti").select("row.*")


SQL = r"""
WITH d AS (
    SELECT doc_id, list_filter(string_split(trim(regexp_replace(lower(text), '[^\pL\pN]+', ' ', 'g')), ' '), lambda w: w <> '') AS ws
    FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), ds AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) AS s FROM d
), b AS (
    SELECT item_id, list_filter(string_split(trim(regexp_replace(lower(text), '[^\pL\pN]+', ' ', 'g')), ' '), lambda w: w <> '') AS ws
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), bs AS (
    SELECT DISTINCT item_id, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) AS s FROM b
), n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, n_shingles, count(*) / n_shingles AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) * 100 >= n_shingles * 80
"""
