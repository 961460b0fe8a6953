"""Awkward rows and empty tables through every operator."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from fillmetrics.llm import (
    decontamination,
    html_text,
    language_id,
    license_scan,
    packing,
    pii,
    quality,
    secret_scan,
    simhash_dedup,
    toxicity,
)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int, text string, score double")


def items(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id bigint, text string, doc_id bigint, hash string")


def run_all(spark, docs):
    """Rows of every operator on ``docs``, by name."""
    model = language_id.fit(docs, F.lit(True))
    scorer = toxicity.fit(docs, labels(spark, [(1, 1, 1, "x", 0.0), (8, 0, 0, "x", 0.0)]))
    known = items(spark, [(1, "brown fox jumps over the lazy dog", 1, "x"), (2, None, 1, "x"), (None, "a b c d e f", 1, "x")])
    return {
        "licenses": license_scan.scan(docs).collect(),
        "toxicity": toxicity.scored(docs, scorer).collect(),
        "packing": packing.packed(packing.pieces(docs)).collect(),
        "secrets": secret_scan.scan(docs)[0].collect(),
        "quality": quality.judged(docs).collect(),
        "pii": pii.with_spans(docs, pii.fit(docs)).collect(),
        "language": language_id.predicted(docs, model).collect(),
        "simhash": simhash_dedup.near_duplicates(docs).collect(),
        "leaks": decontamination.contained(docs, known).collect(),
    }


def test_awkward_rows(spark, awkward):
    found = run_all(spark, awkward)
    n = awkward.count()
    for name in ("licenses", "toxicity", "secrets", "quality", "pii", "language", "simhash"):
        assert len(found[name]) == n, name
    assert all(0 <= row.score <= 1 for row in found["toxicity"])
    assert {row.doc_id: row.lang_pred for row in found["language"]}[2] == "und"
    assert {row.doc_id: row.lang_pred for row in found["language"]}[5] == "und"
    empty = {row.fingerprint for row in found["simhash"] if row.doc_id in (2, 3, 4)}
    assert empty == {"0" * 16}
    by_id = {row.doc_id: row.component_id for row in found["simhash"]}
    assert (by_id[1], by_id[7], by_id[4], by_id[None]) == (1, 6, 2, by_id[None])
    assert {(row.doc_id, row.item_id) for row in found["leaks"]} == {(1, 1)}
    # Texts of one piece hold at least the closing id; pieces fill their sequences without a gap.
    by_sequence = {}
    for row in found["packing"]:
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert {row.doc_id for row in found["packing"] if row.length == 1} >= {2, 3, 4}
    kept = {row.doc_id: (row.base_failed, row.kept) for row in found["quality"]}
    assert kept[2] == (True, False) and kept[5] == (True, False)
    spans = {row.doc_id: [s.kind for s in row.base] for row in found["pii"]}
    assert spans[8] == ["email"] and spans[2] == []
    assert {row.doc_id: [f.kind for f in row.findings] for row in found["secrets"]}[8] == ["assign"]


def test_empty_tables(spark, awkward):
    found = run_all(spark, awkward.limit(0))
    assert {name: len(rows) for name, rows in found.items()} == dict.fromkeys(found, 0)
    assert decontamination.contained(awkward, items(spark)).count() == 0


def test_no_labels(spark, awkward):
    model = toxicity.fit(awkward, labels(spark))
    assert {row.score < 0.5 for row in toxicity.scored(awkward, model).collect()} == {True}


@pytest.mark.parametrize("empty", [False, True])
def test_pages(spark, empty):
    rows = [
        (1, None, None, "x"),
        (2, "https://a.example/x", "", "x"),
        (2, "https://a.example/x", "<p>one<p>two &amp; three", "x"),
        (3, "not a url", "<div><script>if (a < b) x()</script>", "x"),
        (None, "https://a.example/y", "plain & text <b>bold", "x"),
        (5, "https://a.example/z", "<article>" + "<p>long words " * 5000, "x"),
    ]
    pages = spark.createDataFrame([] if empty else rows, "page_id bigint, url string, html string, removed string")
    found = {(row.page_id, row.text) for row in html_text.main_texts(pages).collect() if row.page_id != 5}
    assert found == (
        set()
        if empty
        else {(1, ""), (2, ""), (2, "one\n\ntwo & three"), (3, ""), (None, "plain & text bold")}
    )


@pytest.mark.parametrize("empty", [False, True])
def test_stages_keep_columns(spark, awkward, folder, empty):
    docs = awkward.limit(0) if empty else awkward
    items(spark, [(1, "brown fox jumps over the lazy dog", 1, "x")]).write.parquet(f"{folder}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    assert {row.doc_id for row in docs.select("doc_id").collect()} <= {1, 6, 8, None}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == (0 if empty else packing.pieces(docs).count())
