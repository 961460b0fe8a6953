"""Language of a text: log frequencies of known words first, shorter and shorter character n-grams for the others.

Model: counts by language of words, and of the n-grams of all words, of a bounded sample of labelled texts (``per_language`` texts
of each language, chosen by a hash of the id). Each language has a table of its own: its ``most_words`` most frequent words and
its ``most_grams`` most frequent n-grams, or an equal share of what ``FULL_TABLES`` languages would hold where there are more. Equals
at the end of a table are chosen by a hash. A known word votes with its log frequency in each language.
For an unknown word the longest n-grams of which any is known vote with their mean, discounted once per step down.

Null texts and texts without a letter are ``und`` with score 0; so is everything if no labelled text was there to learn from.
Ties go to the language that comes first by name. The score is the posterior probability of the chosen language, in which
a text counts as ``EVIDENCE`` words at most, so that long texts do not all come out as certain.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillmetrics.llm.common import chance, checkpointed, kept_in_worker, nothing_kept_in_worker, sliced

ORDERS = (5, 4, 3, 2, 1)
DISCOUNT = math.log(0.4)
SMOOTHING = 0.1
EVIDENCE = 12
MOST_CACHED = 200_000
FULL_TABLES = 20
MOST_SUMMED = 200_000
UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")


class Table:
    """Log frequencies by key, for the languages that have the key; in all others it has the same least frequency.

    The least frequency is the same for every language, so that one with little text is not likelier for what it never had.
    """

    def __init__(self, counts: Iterable[tuple[str, int, int]], totals: list[int]):
        """``counts``: key, place of the language, count, in the order of the keys."""
        least = SMOOTHING / max(totals)
        self.floor = math.log(least)
        self.rows: dict[str, int] = {}
        self.starts, self.places, self.gains = array("q"), array("h"), array("f")
        for key, place, count in counts:
            if key not in self.rows:
                self.rows[key] = len(self.rows)
                self.starts.append(len(self.places))
            self.places.append(place)
            self.gains.append(math.log(count / totals[place] + least) - self.floor)
        self.starts.append(len(self.places))

    def mean(self, rows: list[int], languages: int) -> list[float]:
        votes = [self.floor] * languages
        for row in rows:
            for k in range(self.starts[row], self.starts[row + 1]):
                votes[self.places[k]] += self.gains[k] / len(rows)
        return votes


@dataclass
class Model:
    """Tables of the languages: words (order 0), and n-grams of the padded words by order."""

    languages: list[str]
    tables: dict[int, Table]

    @classmethod
    def of(cls, counts: list[tuple[str, str, int]]) -> Model:
        """From counts of words by language, all of which are kept."""
        pieces: Counter = Counter()
        for language, word, count in counts:
            pieces[language, 0, word] += count
            padded = f" {word} "
            for n in ORDERS:
                for start in range(len(padded) - n + 1):
                    pieces[language, n, padded[start : start + n]] += count
        totals: Counter = Counter()
        for (language, n, _), count in pieces.items():
            totals[language, n] += count
        return cls.of_pieces(sorted((n, key, language, count) for (language, n, key), count in pieces.items()), totals)

    @classmethod
    def of_pieces(cls, pieces: Iterable[tuple[int, str, str, int]], totals: dict[tuple[str, int], int]) -> Model:
        """From sorted counts of order, key and language, taken one by one, and the counts of all keys by language and order."""
        languages = sorted({language for language, _ in totals})
        place = {language: k for k, language in enumerate(languages)}

        def table(n: int, rows: Iterable[tuple[int, str, str, int]]) -> Table:
            counts = ((key, place[language], count) for _, key, language, count in rows)
            return Table(counts, [max(1, totals.get((language, n), 0)) for language in languages])

        tables = {n: table(n, rows) for n, rows in groupby(pieces, itemgetter(0))} if languages else {}
        return cls(languages, {n: tables[n] if n in tables else table(n, ()) for n in ((0, *ORDERS) if languages else ())})

    def vote(self, word: str) -> list[float]:
        """Log score of a word in each language."""
        row = self.tables[0].rows.get(word) if self.tables else None
        if row is not None:
            return self.tables[0].mean([row], len(self.languages))
        padded = f" {word} "
        for down, n in enumerate(ORDERS if self.tables else (), 1):
            get = self.tables[n].rows.get
            known = [row for row in (get(padded[k : k + n]) for k in range(len(padded) - n + 1)) if row is not None]
            if known:
                return [down * DISCOUNT + mean for mean in self.tables[n].mean(known, len(self.languages))]
        return [0.0] * len(self.languages)


class Votes(dict):
    """Word -> row of a growing matrix of votes; forgotten as a whole when it holds ``MOST_CACHED`` words."""

    def __init__(self, model: Model):
        import numpy as np

        self.model = model
        self.matrix = np.zeros((1024, len(model.languages)), dtype=np.float32)

    def __missing__(self, word: str) -> int:
        import numpy as np

        row = len(self)
        if row == len(self.matrix):
            self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
        self.matrix[row] = self.model.vote(word)
        self[word] = row
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        import numpy as np

        words = WORD.findall(text.lower()) if text else []
        if not any(c.isalpha() for word in words for c in word) or not self.model.languages:
            return UNDETERMINED, 0.0
        if len(self) > MOST_CACHED:
            self.clear()
        rows = list(map(self.__getitem__, words))
        mean = self.matrix[rows].mean(axis=0, dtype=np.float64)
        odds = np.exp((mean - mean.max()) * min(len(words), EVIDENCE))
        best = int(odds.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum())


def _by_language(column: Column, values: dict) -> Column:
    return F.element_at(F.create_map(*[F.lit(part) for item in values.items() for part in item]), column)


def _most_frequent(counted: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows of each language (``language``, ``key``, ``count``), those of the highest counts."""
    # A row for each language and different count.
    levels = counted.groupBy("language", "count").agg(F.count(F.lit(1)).alias("held")).orderBy("language", F.desc("count")).collect()
    taken: Counter = Counter()
    last, share = {}, {}
    for language, count, held in levels:
        if taken[language] < most:
            last[language], share[language] = count, min(1.0, (most - taken[language]) / held)
            taken[language] += held
    if not last:
        return counted
    level = _by_language(F.col("language"), last)
    by_chance = chance(F.col("key"), "language table") < _by_language(F.col("language"), share)
    return counted.where((F.col("count") > level) | ((F.col("count") == level) & by_chance))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Language, n-gram and count from language, word and count; added up as far as they fit."""
    nothing_kept_in_worker()
    names = ["language", "key", "count"]
    kinds = (pa.string(), pa.string(), pa.int64())
    sums: Counter = Counter()

    def given() -> pa.RecordBatch:
        columns = list(zip(*((language, gram, n) for (language, gram), n in sums.items()))) or [(), (), ()]
        sums.clear()
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds)], names=names)

    for batch in batches:
        for language, word, count in zip(*(column.to_pylist() for column in batch.columns)):
            padded = f" {word} "
            for n in ORDERS:
                for start in range(len(padded) - n + 1):
                    sums[language, padded[start : start + n]] += count
                    if len(sums) >= MOST_SUMMED:
                        yield given()
    yield given()


def fit(
    docs: DataFrame,
    learn: Column,
    label: str = "lang",
    per_language: int = 1500,
    most_words: int = 60_000,
    most_grams: int = 200_000,
) -> Model:
    """A model from the rows for which ``learn`` holds; reads only ``doc_id``, ``text`` and ``label``."""
    known = docs.where(learn & F.col(label).isNotNull() & F.col("text").isNotNull())
    held = {row[0]: row[1] for row in known.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not held:
        return Model([], {})
    share = _by_language(F.col(label), {key: min(1.0, per_language / n) for key, n in held.items()})
    words = checkpointed(
        known.where(chance(F.col("doc_id"), "language sample") < share)
        .select(F.col(label).cast("string").alias("language"), F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("key"))
        .where(F.col("key") != "")
        .groupBy("language", "key")
        .count()
    )
    grams = checkpointed(
        words.select("language", "key", "count")
        .mapInArrow(_grams, "language string, key string, count long")
        .groupBy("language", "key")
        .agg(F.sum("count").alias("count"))
    )
    order = F.length("key")
    totals = {
        (row[0], row[1]): row[2]
        for part in (words.withColumn("n", F.lit(0)), grams.withColumn("n", order))
        for row in part.groupBy("language", "n").agg(F.sum("count")).collect()
    }
    crowd = max(1.0, len(held) / FULL_TABLES)
    kept = _most_frequent(words, int(most_words / crowd)).select(F.lit(0).alias("n"), "key", "language", "count").unionByName(
        _most_frequent(grams, int(most_grams / crowd)).select(order.alias("n"), "key", "language", "count")
    )
    table = kept.toArrow().sort_by([("n", "ascending"), ("key", "ascending")])
    parts = sliced(table.to_batches())
    return Model.of_pieces((row for part in parts for row in zip(*(column.to_pylist() for column in part.columns))), totals)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with ``lang_pred`` and ``score``; columns of these names that were there before are replaced."""
    kept = docs.drop("lang_pred", "score")
    place = kept.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = kept_in_worker("language", shared, lambda: Votes(shared.value))
        for batch in sliced(batches):
            found = [votes.predict(text) for text in batch.column(place).to_pylist()]
            columns = [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lang_pred", "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "lang_pred string, score double"])
    return kept.mapInArrow(run, schema)
