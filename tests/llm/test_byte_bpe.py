"""Byte-level BPE against the tiktoken library, with leaves so small that every joint is used."""

import random

import numpy as np
import pytest

from fillmetrics.llm import byte_bpe

tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(None)


@pytest.fixture(scope="module")
def expected(ranks):
    encoding = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoding.encode_ordinary


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


@pytest.mark.parametrize("leaf_chars,leaf_bytes", [(1, 1), (3, 2), (8, 64), (8192, 64)])
def test_small_leaves(ranks, expected, leaf_chars, leaf_bytes):
    bpe = byte_bpe.ByteBpe(ranks, leaf_chars=leaf_chars, leaf_bytes=leaf_bytes)
    random.seed(leaf_chars)
    letters = "ab tT'sreAvlmd  \n\n\t é漢0!.\x1c\x85 \U0001f600́<|endoftext|>"
    for _ in range(1500):
        text = "".join(random.choices(letters, k=random.randint(0, 50)))
        assert ids(bpe.encode(text)) == expected(text), repr(text)


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 900, " " * 999, "\n " * 700, "'" * 800 + "re", "é" * 700, "the" * 900 + " "])
def test_long_runs(ranks, expected, text):
    for bpe in (byte_bpe.ByteBpe(ranks, leaf_chars=16, leaf_bytes=8), byte_bpe.ByteBpe(ranks)):
        assert ids(bpe.encode(text)) == expected(text)


def test_cache_runs_over(ranks, expected):
    bpe = byte_bpe.ByteBpe(ranks, most_kept=3)
    for text in ("one two three four five six seven", "seven six five four three two one") * 3:
        assert ids(bpe.encode(text)) == expected(text)


def test_query(spark, sf, expected):
    import hashlib

    from fillmetrics.llm import registry
    from fillmetrics.llm.common import table

    texts = {row.doc_id: row.text for row in table(spark, sf, "documents").collect()}
    rows = registry.op12_byte_bpe(spark, sf).collect()
    assert {row.doc_id for row in rows} == set(texts) and len(rows) == len(texts)
    for row in rows:
        tokens = expected(texts[row.doc_id] or "")
        assert row.n_tokens == len(tokens)
        assert row.ids_sha256 == hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((texts[row.doc_id] or "").encode()).hexdigest()


def test_awkward_rows_and_parts(spark, awkward, expected):
    """Long texts are cut into parts; nulls, empty texts and repeated rows have their rows."""
    texts = [(row.doc_id, row.text) for row in awkward.collect()]
    for part_bytes in (20, 50_000, 4 << 20):
        tokens = byte_bpe.decoded(byte_bpe.encoded(awkward, part_bytes=part_bytes))
        got = sorted(((row.doc_id, bytes(row.ids), bytes(row.decoded)) for row in tokens.collect()), key=str)
        wanted = [(id_, np.array(expected(text or ""), "<u4").tobytes(), (text or "").encode()) for id_, text in texts]
        assert got == sorted(wanted, key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.decoded(byte_bpe.encoded(empty)).collect() == []
