import os
import tempfile

import pytest

EXTRA = (
    "score double, lang_pred string, fingerprint string, component_id string, spans string, base string, added string, kept string, "
    "row string, fp string, hash string, held string, words string, lines string, findings string, host string, piece string, "
    "shard string, toxic string, item_id string, digest string, notices string, license_id string, removed string, blob_id string"
)
NAMES = [part.split()[0] for part in EXTRA.split(", ")]


@pytest.fixture(autouse=True)
def _checkpoints(spark):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


@pytest.fixture(scope="session")
def sf():
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.exists(path):
        pytest.skip("test tables are not here")
    return path


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty, blank and very long texts, repeated rows and ids, ties, and columns whose names operators use."""
    long_text = " ".join(f"word{k % 5000} of a very long text" for k in range(20000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
        (1, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, " \t\n\x0b ", "en", "a"),
        (5, "12345 !!! ###", None, "b"),
        (None, "the quick brown fox jumps over the lazy dog near the river bank today", "en", None),
        (None, None, None, None),
        (6, long_text, "en", "a"),
        (7, long_text, "de", "b"),
        (8, "é ñ ß 漢字 \U0001f600 ein kurzer Text mit password=abcdef1 und a@b.example.com", "de", "b"),
    ]
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA}"
    return spark.createDataFrame([(*r, len(r[1] or ""), 0.5, *["x"] * (len(NAMES) - 1)) for r in rows], schema)
