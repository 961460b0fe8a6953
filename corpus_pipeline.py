"""From raw documents to packed sequences: five stages, each written as Parquet and read again by the next.

Columns other than those of ``documents`` go along up to the last stage. ORACLE_SQL is None: fitted models (language, personal
data) and the packing search have no SQL form; the tests hold ``run`` against a brute-force version instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillmetrics.llm import decontamination, language_id, packing, pii, simhash_dedup
from fillmetrics.llm.common import fold, narrow_batches, shared_folder, table
from fillmetrics.sources.folders import remove

# A language is doubted where its posterior probability is not even one half.
LEAST_SCORE = 0.5


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    narrow_batches(spark)
    model = language_id.fit(docs, fold("doc_id", 4) != 2)
    known = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return language_id.predicted(docs, model).where(known).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    narrow_batches(spark)
    return simhash_dedup.deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    narrow_batches(spark)
    clean = pii.masked(docs, pii.fit(docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in a sequence."""
    narrow_batches(spark)
    return packing.packed(packing.pieces(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", languages),
    ("simhash_dedup", near_duplicates),
    ("decontamination", decontamination_stage),
    ("pii", personal_data),
    ("best_fit_packing", packed_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; what goes between them is written below the shared checkpoint folder.

    Once a stage is written, what it read is removed. What the last stage reads stays: its result is not yet computed.
    """
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs, written = table(spark, sf_dir, "documents"), None
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
            if written:
                remove(spark, [written])
            written = f"{folder}/{name}"
    return docs
