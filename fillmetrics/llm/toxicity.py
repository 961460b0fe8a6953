"""Toxicity of disguised text: a noisy channel undone by Viterbi decoding, then a scorer over the restored words.

Language model: letter trigrams (a-z, accented Latin letters, one class for other letters, one for boundaries) counted over every
text. The alphabet bounds the table to 60^3 numbers, whatever the input; its counts grow with the input.

Channel: a token that could be disguised (letters beside signs, digits or their like, letters with spaces between them) is a
lattice, whatever its length: each sign is one of the letters it may stand for, a boundary, or nothing between letters; a
repeated letter is written once or twice. The best path under the model and the channel is the restored text. Other tokens, and signs
around a token that stand for no letter, have a single path. Letters of which no reading could have evidence are not decoded.

Scorer: words and letter sequences of 4 to 6 of a bounded sample of labelled texts (``sample`` rows of labels, chosen by a hash of
the id; folds 1 to 3 of 5) get shrunk log odds of toxic against clean texts. A text's evidence (its strongest, its three
strongest, how many) goes into a logistic regression fitted on fold 4. Fold 0 is never learned from.

A null or empty text has the score of a text without evidence. Without labels every score is 0. Repeated rows are scored each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillmetrics.llm.common import chance, fold, kept_in_worker

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
BOUNDARY, OTHER, SYMBOLS = 0, len(LETTERS) + 1, len(LETTERS) + 2
# What a sign may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}
SEPARATORS = ".-_*~ "
# What hides a letter without saying which, mostly a vowel.
HIDES, HIDDEN = "*#", "aeiou"
SUBSTITUTED, KEPT, KEPT_DIGIT, DROPPED, REPEATED, DOUBLED, VEILED = -2.0, -0.7, -3.0, -1.0, -0.5, -2.0, -1.5

SAMPLE = 20_000
MOST_FEATURES = 50_000
ORDERS = (4, 5, 6)
LEAST_EVIDENCE = 3.0
MOST_CACHED = 200_000

_CODES = np.zeros(0x110000, dtype=np.uint8)
for _code in range(0x80, 0x110000):
    if not 0xD800 <= _code < 0xE000 and chr(_code).isalpha():
        _CODES[_code] = OTHER
for _k, _letter in enumerate(LETTERS, 1):
    _CODES[ord(_letter)] = _k

# A letter, and a sign, a digit or a letter twice in a row.
DISGUISED = re.compile(r"[^\W\d_]\W|\W[^\W\d_]|[^\W\d_][\d_]|[\d_][^\W\d_]|([^\W\d_])\1")
# Signs at the ends of a token that stand for no letter.
EDGES = "".join(sign for sign in map(chr, range(0x21, 0x7F)) if not sign.isalnum() and sign not in "@$!|+*_-~") + "«»„“”‘’¿¡…–—"
# The same in a token of letters alone.
TWICE = re.compile(r"(.)\1")
RUN = re.compile(r"(.)\1+")
NOT_LETTER = re.compile(r"[\W\d_]+")


def trigram_codes(text: str) -> np.ndarray:
    codes = _CODES[np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")].astype(np.int32)
    return (codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:]


def trigrams(docs: DataFrame) -> np.ndarray:
    """Counts of letter trigrams over all texts."""
    size = SYMBOLS**3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            texts = [text for text in batch.column(0).to_pylist() if text]
            # Some megabytes of text are counted at a time.
            while texts:
                chunk, length = [], 0
                while texts and length < 4_000_000:
                    chunk.append(texts.pop())
                    length += len(chunk[-1])
                counts += np.bincount(trigram_codes(f"  {'  '.join(chunk).lower()}  "), minlength=size)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(counts[held])], names=["gram", "n"])

    counts = np.zeros(size, dtype=np.int64)
    summed = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    for row in summed.collect():
        counts[row.gram] = row.n
    return counts


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(third | first two), smoothed towards the third letter's own frequency."""
    cube = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
    single = cube.sum(axis=(0, 1)) + 1
    single /= single.sum()
    return np.log((cube + 5 * single) / (cube.sum(axis=2, keepdims=True) + 5)).astype(np.float32)


def _written(text: str, channel: float) -> tuple[str, tuple[int, ...], float]:
    return text, tuple(int(_CODES[ord(sign)]) for sign in text), channel


VEIL = [_written(letter, VEILED) for letter in HIDDEN]
END = [_written(" ", 0.0)]


@lru_cache(maxsize=65_536)
def stretch(sign: str, times: int) -> list[tuple[str, tuple[int, ...], float]]:
    """What may have been written where a sign stands once, twice or (3) more often; codes of it; log probability."""
    if sign.isalpha():
        if times == 1:
            return [_written(sign, 0.0)]
        if times == 2:
            return [_written(sign * 2, 0.0), _written(sign, DOUBLED)]
        return [_written(sign, REPEATED), _written(sign * 2, 2 * REPEATED)]
    options = [_written(" ", KEPT_DIGIT if sign.isdigit() else KEPT)]
    options += [_written(letter, SUBSTITUTED) for letter in STANDS_FOR.get(sign, "")]
    if times > 1:
        options += [_written(letter * 2, 1.5 * SUBSTITUTED) for letter in STANDS_FOR.get(sign, "")]
    if sign in SEPARATORS:
        options.append(_written("", DROPPED))
    return options


def lattice(token: str, veiled: bool = False) -> list[list[tuple[str, tuple[int, ...], float]]]:
    """Per stretch of the token, what may have been written there, its codes and the channel's log probability.

    With ``veiled``, signs that hide a letter stand for one and not for nothing.
    """
    steps = []
    k = 0
    while k < len(token):
        sign = token[k]
        run = k + 1
        while run < len(token) and token[run] == sign:
            run += 1
        if veiled and sign in HIDES:
            steps += [VEIL] * (run - k)
        else:
            steps.append(stretch(sign, min(run - k, 3)))
        k = run
    return steps


def decoded(token: str, model: list[float], veiled: bool = False) -> str:
    """The best path of the token's lattice, whatever its length: each state keeps its best path as a chain.

    ``model`` is flat, as a list; a state is the last two letters.
    """
    steps = lattice(token, veiled)
    if max(map(len, steps), default=1) == 1:  # a single path
        return "".join([options[0][0] for options in steps]).strip()
    paths: dict[int, tuple[float, tuple | None]] = {BOUNDARY: (0.0, None)}
    for options in [*steps, END]:
        ahead: dict[int, tuple[float, tuple | None]] = {}
        for state, (score, chain) in paths.items():
            for written, codes, channel in options:
                at, total = state, score + channel
                for code in codes:
                    last = at % SYMBOLS
                    if code or last:  # boundaries in a row are one
                        total += model[at * SYMBOLS + code]
                        at = last * SYMBOLS + code
                before = ahead.get(at)
                if before is None or total > before[0]:
                    ahead[at] = (total, (chain, written))
        paths = ahead
    chain = max(paths.values(), key=lambda path: path[0])[1]
    parts = []
    while chain is not None:
        chain, written = chain
        parts.append(written)
    return "".join(reversed(parts)).strip()


@dataclass
class Model:
    letters: np.ndarray
    odds: dict[str, float]
    weights: np.ndarray
    center: np.ndarray


class Evidence(dict):
    """Token -> row of its evidence. Tokens are remembered in two generations: a full one becomes the older."""

    def __init__(self, letters: np.ndarray, odds: dict[str, float], most: int = MOST_CACHED):
        self.letters, self.odds, self.most = letters.ravel().tolist(), odds, most
        # Every letter sequence with odds begins with one of these.
        self.heads = {piece[: ORDERS[0]] for piece in odds if not piece.startswith("=")}
        # The same with repeated letters once; what is shorter then, and whole words.
        single = {RUN.sub(r"\1", piece) for piece in odds if not piece.startswith("=")}
        self.single_heads = {piece[:3] for piece in single if len(piece) >= 3}
        self.single_short = [piece for piece in single if len(piece) < 3]
        self.single_words = {RUN.sub(r"\1", piece[1:]) for piece in odds if piece.startswith("=")}
        self.values_of = np.zeros(1024, dtype=np.float32)
        self.older: dict[str, int] = {}
        self.older_values = self.values_of

    def restored(self, token: str) -> str:
        core = token.strip(EDGES)
        return decoded(core, self.letters) if (TWICE if core.isalpha() else DISGUISED).search(core) else core

    def weigh(self, text: str) -> float:
        get, heads, least = self.odds.get, self.heads, ORDERS[0]
        best = 0.0
        for word in (text,) if text.isalpha() else NOT_LETTER.split(text):
            if len(word) >= 2:
                best = max(best, get("=" + word, 0.0))
                for k in range(len(word) - least + 1):
                    if word[k : k + least] in heads:
                        best = max(best, *[get(word[k : k + n], 0.0) for n in ORDERS])
        return best

    def bare(self, core: str) -> bool:
        """Whether letters cannot have evidence, however often repeated ones were written."""
        single, heads = RUN.sub(r"\1", core), self.single_heads
        return (
            single not in self.single_words
            and not any([single[k : k + 3] in heads for k in range(len(single) - 2)])
            and not any([piece in single for piece in self.single_short])
        )

    def weight(self, token: str) -> float:
        row = self.older.get(token)
        if row is not None:
            return self.older_values[row]
        core = token.strip(EDGES)
        if core != token:
            # The same token without signs around it has the same evidence.
            if (row := self.get(core)) is not None:
                return self.values_of[row]
            if (row := self.older.get(core)) is not None:
                return self.older_values[row]
        if core.isalpha() and TWICE.search(core) and self.bare(core):
            return 0.0
        restored = self.restored(core)
        weight = self.weigh(restored)
        if restored != core:
            # What is written plainly counts as it stands, too.
            weight = max(weight, self.weigh(core))
            if any(sign in core for sign in HIDES):
                weight = max(weight, self.weigh(decoded(core, self.letters, veiled=True)))
        return weight

    def __missing__(self, token: str) -> int:
        row = len(self)
        if row == len(self.values_of):
            self.values_of = np.concatenate([self.values_of, np.zeros_like(self.values_of)])
        self.values_of[row] = self.weight(token)
        self[token] = row
        return row

    def of(self, text: str | None) -> list[float]:
        """Strongest evidence, sum of the three strongest, log of the number of different tokens with evidence."""
        if not text:
            return [0.0, 0.0, 0.0]
        if len(self) > self.most:
            self.older, self.older_values = dict(self), self.values_of
            self.clear()
            self.values_of = np.zeros(1024, dtype=np.float32)
        words = text.lower().split()
        rows = list(map(self.__getitem__, words))
        singles = [k for k, word in enumerate(words) if len(word) == 1]
        start = 0
        for k in range(1, len(singles) + 1):
            if k == len(singles) or singles[k] != singles[k - 1] + 1:
                if k - start >= 2:
                    spaced = " ".join(words[singles[start] : singles[k - 1] + 1])
                    rows += [self[word] for word in decoded(spaced, self.letters).split()]
                start = k
        found = self.values_of[rows]
        strong = np.unique(np.array(rows)[found >= LEAST_EVIDENCE])
        if not len(strong):
            return [float(found.max()) if len(found) else 0.0, 0.0, 0.0]
        weights = np.sort(self.values_of[strong])[::-1]
        return [float(weights[0]), float(weights[:3].sum()), float(np.log1p(len(strong)))]


def _probabilities(x: np.ndarray, weights: np.ndarray, center: np.ndarray) -> np.ndarray:
    z = (x - center) @ weights[:-1] + weights[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Weights and center of a ridge-regularised logistic regression, by Newton's method."""
    center = x.mean(axis=0)
    design = np.hstack([x - center, np.ones((len(x), 1))])
    weights = np.zeros(design.shape[1])
    penalty = ridge * np.diag([1.0] * x.shape[1] + [0.0]) + 1e-6 * np.eye(design.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (y - p) - penalty @ weights
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty, slope)
        weights += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return weights, center


def _mapped(docs: DataFrame, evidence: tuple[np.ndarray, dict[str, float]], extra: list[str], finish, schema: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(evidence)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = shared.value
        cache = kept_in_worker("toxicity", evidence, lambda: Evidence(*evidence))
        for batch in batches:
            rows = np.array([cache.of(text) for text in batch.column(0).to_pylist()], dtype=np.float64).reshape(-1, 3)
            yield finish(batch, rows)

    return docs.select(F.col("text").cast("string"), *extra).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, held_out: int = 0, folds: int = 5, sample: int = SAMPLE) -> Model:
    """A model from the labelled documents whose fold is not ``held_out``, of which at most about ``sample`` are read."""
    docs = docs.select("doc_id", F.col("text").cast("string"))
    letters = log_model(trigrams(docs))
    usable = labels.where(F.col("toxic").isNotNull() & (fold("doc_id", folds) != held_out)).select("doc_id", "toxic").dropDuplicates(["doc_id"])
    share = min(1.0, sample / max(1, labels.count()))
    # At most about ``sample`` rows, so this side is small by construction.
    taken = F.broadcast(usable.where(chance(F.col("doc_id"), "toxicity sample") < share))
    labelled = docs.where(F.col("text").isNotNull()).join(taken, "doc_id")
    last = (held_out + folds - 1) % folds
    odds = _odds(labelled.where(fold("doc_id", folds) != last))

    def finish(batch: pa.RecordBatch, rows: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(rows[:, k]) for k in range(3)]
        return pa.RecordBatch.from_arrays([*columns, batch.column(1).cast(pa.float64())], names=["x0", "x1", "x2", "y"])

    known = _mapped(
        labelled.where(fold("doc_id", folds) == last), (letters, odds), ["toxic"], finish, "x0 double, x1 double, x2 double, y double"
    ).collect()
    if not known or len({row.y for row in known}) < 2:
        return Model(letters, odds, np.array([0.0, 0.0, 0.0, -30.0]), np.zeros(3))
    weights, center = logistic(np.array([[r.x0, r.x1, r.x2] for r in known]), np.array([r.y for r in known]))
    return Model(letters, odds, weights, center)


def _odds(labelled: DataFrame) -> dict[str, float]:
    """Shrunk log odds of words (marked ``=``) and of letter sequences, by the number of texts that hold them."""
    word = F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word")
    words = (
        labelled.select(word, (F.col("toxic") == 1).cast("long").alias("toxic"))
        .where(F.length("word") >= 2)
        .groupBy("word")
        .agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
    )

    def sequences(n: int) -> Column:
        starts = F.when(F.length("word") >= n, F.sequence(F.lit(1), F.length("word") - (n - 1)))
        return F.transform(
            starts.otherwise(F.array().cast("array<int>")), lambda at: F.substring(F.col("word"), at, F.lit(n))
        )

    pieces = F.concat(F.array(F.concat(F.lit("="), F.col("word"))), *map(sequences, ORDERS))
    counted = (
        words.select(F.explode(pieces).alias("piece"), "t", "n").groupBy("piece").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    )
    totals = words.agg(F.sum("t"), F.sum("n")).first()
    if not totals or not totals[0] or totals[0] == totals[1]:
        return {}
    base = float(np.log(totals[0] / (totals[1] - totals[0])))
    odds = F.log((F.col("t") + 0.5) / (F.col("n") - F.col("t") + 0.5)) - F.lit(base) - 1 / F.sqrt("t")
    kept = (
        counted.where(F.col("t") >= 4)
        .select("piece", odds.alias("odds"), "t")
        .where(F.col("odds") >= LEAST_EVIDENCE)
        .orderBy(F.desc(F.col("odds") * F.log1p("t")), "piece")
        .limit(MOST_FEATURES)
    )
    return {row.piece: row.odds for row in kept.collect()}


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` of every row."""
    weights, center = model.weights, model.center

    def finish(batch: pa.RecordBatch, rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(_probabilities(rows, weights, center))], names=["doc_id", "score"]
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _mapped(docs, (model.letters, model.odds), ["doc_id"], finish, f"doc_id {kind}, score double")


def predicted(score: Column) -> Column:
    return (score >= 0.5).cast("int")
