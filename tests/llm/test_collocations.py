"""Phrase collocations against counting by hand, and the index against counting by hand."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from fillmetrics.llm import collocations as co


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def grams_of(rows, depth):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", ascii_lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, depth + 1):
                for at in range(len(words) - size + 1):
                    counts[lang or "und"][tuple(words[at : at + size])] += 1
    return counts


def brute(rows, depth=3, least=10, first=2000, percent=50):
    found = set()
    for lang, counts in grams_of(rows, depth).items():
        n = sum(f for gram, f in counts.items() if len(gram) == 1)
        candidates = {gram: f for gram, f in counts.items() if len(gram) > 1 and f >= least}
        scored = []
        for gram, a in candidates.items():
            holders = (f for other, f in candidates.items() if len(other) > len(gram) and
                       any(other[k : k + len(gram)] == gram for k in range(len(other))))
            if any(100 * f >= percent * a for f in holders):
                continue
            cuts = [(1000000 * a * a // (counts[gram[:k]] * counts[gram[k:]]), k) for k in range(1, len(gram))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(gram).encode(), " ".join(gram), a, counts[gram[:k]], counts[gram[k:]], score))
        for rank, (_, _, _, phrase, a, l, r, score) in enumerate(sorted(scored)[:first], 1):
            found.add((lang, rank, phrase, a, l, r, n, score))
    return found


def texts(seed, number):
    random.seed(seed)
    vocabulary = ["a", "B", "b", "ç", "Ç", "漢", "x\x00", "e\x1c", "the", "The", "of", "q1"]
    joints = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!\x0b", " ; "]
    rows = []
    for _ in range(number):
        words = random.choices(vocabulary, weights=range(1, len(vocabulary) + 1), k=random.randint(0, 40))
        rows.append((random.choice(["en", "de", None, "und"]), "".join(word + random.choice(joints) for word in words)))
    return rows + [("en", None), (None, ""), ("fr", " \t "), ("en", "one two three " * 12), ("en", "one two three " * 12)]


@pytest.mark.parametrize(
    "depth,shard,first,bits",
    [(3, 1 << 20, 2000, 1 << 20), (3, 30, 5, 1 << 16), (4, 100, 2000, 1 << 12), (2, 100, 2000, 64), (4, 50, 2000, None), (3, 50, 2000, 64)],
)
def test_equals_counting(spark, depth, shard, first, bits):
    rows = texts(depth, 300)
    docs = spark.createDataFrame([(*row, "x") for row in rows], "lang string, text string, phrase string").repartition(5)
    got = co.collocations(docs, depth=depth, first=first, shard_words=shard, filter_bits=bits).collect()
    assert len(got) == len({tuple(row) for row in got})
    assert {tuple(row) for row in got} == brute(rows, depth, first=first)


def test_counts_beyond_64_bits(spark):
    """The product of counts is made in decimals wide enough for it."""
    made = spark.sql(
        "SELECT cast(cast(a * a as decimal(32,0)) * 1000000 as decimal(38,0)) div cast(a * a as decimal(38,0)) AS score "
        "FROM VALUES (cast(900000000000000 as decimal(19,0))) AS t(a)"
    )
    assert made.first().score == 1_000_000


@pytest.mark.parametrize("seed", range(20))
def test_intervals_of_the_index(seed):
    rng = np.random.default_rng(seed)
    ids = np.append(rng.integers(0, 4, rng.integers(1, 60)), 0)
    index = co.ShardIndex(ids, 4, depth=4)
    for size, found in enumerate(index.phrases(), 1):
        expected = Counter(tuple(w) for w in zip(*[ids[k:] for k in range(size)]) if 0 not in w)
        got = {tuple(int(x) for x in gram): int(f) for *gram, f in zip(*found.words, found.count)}
        assert got == {tuple(map(int, gram)): f for gram, f in expected.items()}
        # Intervals of one length do not overlap, in either order.
        for starts in (found.ahead, found.back):
            order = np.argsort(starts)
            assert (starts[order][1:] >= (starts + found.count)[order][:-1]).all()


def test_empty_table(spark):
    assert co.collocations(spark.createDataFrame([], "doc_id long, lang string, text string")).collect() == []
