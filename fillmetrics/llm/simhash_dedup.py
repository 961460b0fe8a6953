"""Near duplicates by SimHash: 64-bit fingerprints, joined with themselves by walking one binary trie against itself.

Fingerprint: a text is lower-cased in A-Z and split at ASCII white space; every run of ``shingle`` words, repeats
included, is hashed with XXH64 (seed 42). A bit is one if more than half the hashes have it. A shorter text is one shingle;
a text without words, or null, has fingerprint zero and is linked like any other.

Join: level by level, all pairs of trie nodes that may still lie within the error budget are one DataFrame. A step joins both
nodes with their children, adds the differing bits and drops pairs beyond the budget. A pair of nodes is met once, since a
node paired with itself goes on with ordered children only. No node has more partners than there are bit patterns within the
budget (2,081 for two bits), so no key grows with the size of a group; exact copies are one leaf.

Rows with a null or a repeated ``doc_id`` are fingerprinted like others; a null id never becomes a component's id
unless the whole component has none. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillmetrics.llm.common import checkpointed, components, nothing_kept_in_worker

BITS = 64
SHINGLE = 3
BUDGET = 2


def depths_for(prints: int) -> tuple[int, ...]:
    """Depths at which the frontier is materialised.

    Down to the depth that tells so many prints apart the trie is dense, and a step of k bits tries 4^k pairs of children for each
    pair of nodes: two bits at a time (from 12 on, above which there are few pairs). Below, a node has hardly more than one
    child, whatever the step. The depths follow from the count, so that they suit any number of prints alike.
    """
    dense = list(range(14, min(max(prints, 1).bit_length() + 1, BITS), 2))
    found = [6, 12, *dense]
    for step in (4, 8, 16):
        found.append(found[-1] + step)
    return tuple([depth for depth in found if depth < BITS] + [BITS])


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text in UTF-8, as an unsigned number."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, 42)
    ends = list(accumulate(len(word) + 1 for word in words))
    starts = [0, *ends]
    hashes = np.array(
        [xxh64_intdigest(joined[start : end - 1], 42) for start, end in zip(starts, ends[shingle - 1 :])], dtype="<u8"
    )
    ones = np.zeros(BITS, dtype=np.int64)
    for place in range(0, len(hashes), 65536):
        block = hashes[place : place + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id") -> DataFrame:
    """``key``, ``fp`` (the fingerprint's bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        nothing_kept_in_worker()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(text, shingle) for text in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=[key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col("text").cast("string")).mapInArrow(run, f"{key} {kind}, fp long")


def trie_pairs(prints: DataFrame, budget: int = BUDGET, depths: tuple[int, ...] | None = None) -> DataFrame:
    """Pairs ``a``, ``b`` of different values of ``prints.fp`` that differ in at most ``budget`` bits, each once.

    ``depths`` end with the 64 of the leaves; by default they follow from the number of prints.
    """
    spark = prints.sparkSession
    leaves = prints.select("fp").distinct()
    above, *deeper = depths or depths_for(leaves.count())
    # Pairs of patterns at the first depth; the next step finds out which of them exist.
    frontier = (
        spark.range(1 << (2 * above))
        .select(F.shiftright("id", above).alias("a"), F.col("id").bitwiseAND((1 << above) - 1).alias("b"))
        .withColumn("errors", F.bit_count(F.col("a").bitwiseXOR(F.col("b"))))
        .where((F.col("a") <= F.col("b")) & (F.col("errors") <= budget))
    )
    for depth in deeper:
        step = depth - above
        node = F.shiftrightunsigned("fp", BITS - depth) if depth < BITS else F.col("fp")
        parent = F.shiftrightunsigned("fp", BITS - above)
        children = leaves.select(parent.alias("parent"), node.alias("child")).distinct()
        left = children.select(F.col("parent").alias("a"), F.col("child").alias("a_child"))
        right = children.select(F.col("parent").alias("b"), F.col("child").alias("b_child"))
        differing = F.bit_count(F.col("a_child").bitwiseXOR(F.col("b_child")).bitwiseAND(F.lit((1 << step) - 1)))
        frontier = (
            frontier.join(left, "a")
            .join(right, "b")
            .where((F.col("a") != F.col("b")) | (F.col("a_child") <= F.col("b_child")))
            .withColumn("errors", F.col("errors") + differing)
            .where(F.col("errors") <= budget)
            .select(F.col("a_child").alias("a"), F.col("b_child").alias("b"), "errors")
        )
        above = depth
    return frontier.where(F.col("a") != F.col("b")).select("a", "b", "errors")


def near_duplicates(docs: DataFrame, budget: int = BUDGET, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest doc_id reachable) of every row."""
    prints = checkpointed(fingerprints(docs, shingle))
    values = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    labels = components(trie_pairs(prints, budget)).withColumnRenamed("node", "fp")
    linked = values.join(labels, "fp")
    lowest = linked.groupBy("label").agg(F.min("first_id").alias("lowest"))
    by_value = values.join(labels, "fp", "left").join(lowest, "label", "left").select(
        "fp", F.coalesce("lowest", "first_id").alias("component_id")
    )
    return prints.join(by_value, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame, budget: int = BUDGET, shingle: int = SHINGLE) -> DataFrame:
    """One row of each component.

    A document is an id with a text, since rows may share either. The one with the smallest id stays (a null id is larger
    than any; ties go by a digest of the text), and one row of it if the row is repeated.
    """
    digest = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)
    keyed = docs.select("doc_id", "text", F.struct("doc_id", digest.alias("digest")).alias("document"))
    prints = checkpointed(fingerprints(keyed, shingle, "document"))
    labels = components(trie_pairs(prints, budget)).withColumnRenamed("node", "fp")
    held = prints.groupBy("fp", "document").agg(F.count(F.lit(1)).alias("rows")).join(labels, "fp", "left")
    rank = F.struct(F.col("document.doc_id").isNull().alias("unnamed"), "document", "rows")
    group = F.coalesce("label", "fp").alias("group")
    stays = held.groupBy(group).agg(F.min(rank).alias("stays")).select("group", "stays.document", "stays.rows")
    decided = checkpointed(
        held.select(group, F.col("document").alias("other"))
        .join(stays, "group")
        .select(
            F.col("other.doc_id").alias("its_id"),
            F.col("other.digest").alias("its_digest"),
            (F.col("other") == F.col("document")).alias("stays"),
            "rows",
        )
    )
    named = [F.col(name) for name in docs.columns]
    rows = docs.select(F.struct(*named).alias("row"), F.col("doc_id").alias("id"), digest.alias("digest"))
    same = F.col("id").eqNullSafe(F.col("its_id")) & (F.col("digest") == F.col("its_digest"))
    left = rows.join(decided.where(~F.col("stays")), same, "left_anti")
    repeated = decided.where(F.col("stays") & (F.col("rows") > 1))
    if not repeated.isEmpty():
        single = left.join(repeated, same, "left_anti").select("row")
        one = left.join(repeated, same, "left_semi").groupBy("id", "digest").agg(
            F.max_by("row", F.xxhash64(F.to_json("row"))).alias("row")
        )
        return single.unionByName(one.select("row")).select("row.*")
    return left.select("row.*")
