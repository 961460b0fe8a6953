"""Queries of the operators over their whole tables, with production parameters, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from fillmetrics.llm import byte_bpe, collocations, conversation_repair, decontamination, html_text, language_id, license_scan, packing
from fillmetrics.llm import pii, quality, secret_scan, simhash_dedup, toxicity
from fillmetrics.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("notices", F.array_join("notices", ","))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        toxicity.predicted(F.col("score")).alias("predicted"),
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(packing.pieces(table(spark, sf_dir, "documents")))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secret_scan.scan(table(spark, sf_dir, "documents"))
    of_kind = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")
    base = F.filter("findings", lambda f: f["kind"].isin(*secret_scan.BASE))
    return found.select(
        "doc_id",
        *[of_kind(kind).alias(f"n_{kind}") for kind in secret_scan.BASE],
        F.sha2(secret_scan.spans_text(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("findings")).alias("spans"),
    )


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_texts(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string"))
    found = pii.with_spans(docs, pii.fit(docs))
    of_kind = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[of_kind(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.spans_text("base").cast("binary"), 256).alias("base_sha256"),
        pii.spans_text(F.concat("base", "added")).alias("spans"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs, fold("doc_id", 4) != 2)
    return language_id.predicted(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = byte_bpe.decoded(byte_bpe.encoded(table(spark, sf_dir, "documents")))
    return tokens.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.Repair(rows).digested()


def queries() -> dict[str, Query]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_toxicity": op2_toxicity,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_secret_scan": op4_secret_scan,
        "op5_html_text": op5_html_text,
        "op6_quality_rules": op6_quality_rules,
        "op7_pii": op7_pii,
        "op8_language_id": op8_language_id,
        "op9_simhash_dedup": op9_simhash_dedup,
        "op10_decontamination": op10_decontamination,
        "op11_collocations": op11_collocations,
        "op12_byte_bpe": op12_byte_bpe,
        "op13_conversation_repair": op13_conversation_repair,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": license_scan.sql(),
        "op4_secret_scan": secret_scan.sql(),
        "op10_decontamination": decontamination.SQL,
        "op11_collocations": collocations.SQL,
    }
