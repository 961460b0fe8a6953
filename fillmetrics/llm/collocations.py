"""Phrase collocations by an FM-index per shard over word ids.

A shard is up to ``shard_words`` words of one language within a task. Its index is a pair of Burrows-Wheeler transforms, of
the word ids and of their reverse, with suffixes sorted to the depth that is asked for: an interval of suffixes that begin with a
phrase of fewer words is the same however longer ties fall. From the intervals of single words, alternate extensions to
the right and to the left enumerate every phrase of the shard with its count, all intervals of one length at a time. Breaks between
pieces have id 0 and are never extended over. Counts are summed across shards, so phrases are dropped as rare only once
their whole count is known. The empty phrase counts all words of a language.

A phrase cannot be frequent unless all its parts are. So hashes of the phrases shorter than the depth are counted first, and the
frequent ones set bits in a filter of fixed size. Then phrases are extended only where the filter has their parts. A bit set by
another phrase costs a row that is dropped later, never a phrase; in a corpus with so many frequent phrases that the filter is
full, everything is extended.

A cut of a candidate into two parts is scored by the counts of both; extensions of a candidate are the candidates that hold it.

A null text is empty, a null language is ``und``; repeated rows count each. Ties in score go by count, then by phrase.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fillmetrics.llm.common import checkpointed

NO_LANG = "und"
DEPTH = 3
LEAST_COUNT = 10
FIRST = 2000
HELD_PERCENT = 50
SCALE = 1_000_000
SHARD_WORDS = 1 << 20
BATCH_ROWS = 50_000
FILTER_BITS = 1 << 27

# Bytes at which a text is cut into pieces become one that no UTF-8 text has; tabs become spaces.
BREAK = b"\xff"
_CUTS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", BREAK * 10 + b" ")


def words_of(text: str) -> list[bytes]:
    """Words in lower case (A-Z only), with a break after each piece."""
    words = text.encode().lower().translate(_CUTS).replace(BREAK, b" " + BREAK + b" ").split()
    words.append(BREAK)
    return words


class Intervals:
    """Phrases of one length: columns of word ids, their intervals in both orders and their counts."""

    __slots__ = ("words", "ahead", "back", "count")

    def __init__(self, words: list[np.ndarray], ahead: np.ndarray, back: np.ndarray, count: np.ndarray):
        self.words, self.ahead, self.back, self.count = words, ahead, back, count


def _suffix_order(ids: np.ndarray, depth: int, symbols: int) -> np.ndarray:
    """Positions sorted by the next ``depth`` ids, as if the text went round."""
    rank = ids
    for _ in range(depth - 1):
        key = ids * max(symbols, len(ids)) + np.roll(rank, -1)
        order = np.argsort(key, kind="stable")
        fresh = np.empty(len(ids), np.int64)
        key = key[order]
        fresh[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank = fresh
    return np.argsort(rank, kind="stable")


class ShardIndex:
    """``ids``: word ids from 1 on, 0 for breaks, the last one a break."""

    def __init__(self, ids: np.ndarray, symbols: int, depth: int = DEPTH):
        self.symbols = symbols
        self.depth = depth
        ids = ids.astype(np.int64)
        self.counts = np.bincount(ids, minlength=symbols)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)[:-1]])
        self.before = self._transform(ids)  # the id before each suffix, in the order of suffixes
        self.after = self._transform(ids[::-1])  # the id after each prefix, in the order of reversed prefixes

    def _transform(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The transform, and the last-to-first mapping of its places."""
        order = _suffix_order(ids, self.depth - 1, self.symbols)
        transform = np.roll(ids, 1)[order]
        mapping = np.empty(len(ids), np.int64)
        mapping[np.argsort(transform, kind="stable")] = np.arange(len(ids))
        return transform, mapping

    def words(self) -> Intervals:
        found = np.flatnonzero(self.counts)
        found = found[found > 0]
        return Intervals([found], self.starts[found], self.starts[found], self.counts[found])

    def extended(self, phrases: Intervals, left: bool) -> Intervals:
        """All phrases that are one word longer at the given end."""
        transform, mapping = self.before if left else self.after
        here, there = (phrases.ahead, phrases.back) if left else (phrases.back, phrases.ahead)
        total = int(phrases.count.sum())
        which = np.repeat(np.arange(len(here)), phrases.count)
        ends = np.cumsum(phrases.count)
        places = np.arange(total) + np.repeat(here - (ends - phrases.count), phrases.count)
        key = which * self.symbols + transform[places]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if total else np.zeros(0, np.int64)
        count = np.diff(np.concatenate([first, [total]]))
        of, word = key[first] // self.symbols, key[first] % self.symbols
        # Smaller ids (and breaks) within the same interval come first in the other order.
        ahead_of = first - (ends - phrases.count)[of]
        real = word > 0
        of, word, count = of[real], word[real], count[real]
        moved, kept = mapping[places[order[first[real]]]], there[of] + ahead_of[real]
        columns = [column[of] for column in phrases.words]
        columns = [word, *columns] if left else [*columns, word]
        return Intervals(columns, moved if left else kept, kept if left else moved, count)

    def phrases(self, keep: Callable[[Intervals], np.ndarray] | None = None) -> Iterator[Intervals]:
        """Phrases of one word, two words, ... up to the depth; with ``keep``, extensions of those it is true of."""
        found = self.words()
        yield found
        for length in range(1, self.depth):
            found = self.extended(found, left=length % 2 == 0)
            if keep is not None:
                kept = keep(found)
                found = Intervals([column[kept] for column in found.words], found.ahead[kept], found.back[kept], found.count[kept])
            yield found


class Shard:
    """The index of some words of a language, and the hashes of its phrases."""

    def __init__(self, lang: str, words: list[bytes], depth: int):
        coded = pa.array([BREAK, *words], pa.binary()).dictionary_encode()
        words.clear()
        self.lang, self.depth, self.dictionary = lang, depth, coded.dictionary
        seed = xxhash.xxh3_64_intdigest(lang.encode()) & 0xFFFFFFFF
        hashes = [xxhash.xxh3_64_intdigest(word, seed) for word in coded.dictionary.to_pylist()]
        self.word_hashes = np.array(hashes, np.uint64)
        self.index = ShardIndex(coded.indices.to_numpy()[1:], len(coded.dictionary), depth)

    def hashes(self, words: list[np.ndarray]) -> np.ndarray:
        """A hash of each phrase that depends on its words and their order."""
        found = self.word_hashes[words[0]]
        for column in words[1:]:
            found = (found ^ (found >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + self.word_hashes[column]
        return found ^ (found >> np.uint64(29))

    def short_hashes(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Hashes and counts of the phrases of two words up to one less than the depth, sorted by hash."""
        for length, found in enumerate(self.index.phrases(), 1):
            if length > 1:
                hashes = self.hashes(found.words)
                order = np.argsort(hashes)
                yield hashes[order], found.count[order]
            if length == self.depth - 1:
                return

    def phrases(self, frequent: np.ndarray | None) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
        """Length, phrases and counts; the empty phrase comes first. ``frequent`` is the filter, as bytes."""

        def may_be(words: list[np.ndarray]) -> np.ndarray:
            place = self.hashes(words) % np.uint64(8 * len(frequent))
            return frequent[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1 == 1

        def keep(found: Intervals) -> np.ndarray:
            words = found.words
            if len(words) < self.depth:
                return may_be(words)
            return may_be(words[1:]) & may_be(words[:-1]) if len(words) > 2 else np.ones(len(found.count), bool)

        yield 0, pa.array([b""], pa.binary()), np.array([self.index.counts[1:].sum()])
        for length, found in enumerate(self.index.phrases(None if frequent is None else keep), 1):
            for at in range(0, len(found.count), BATCH_ROWS):
                columns = [self.dictionary.take(pa.array(column[at : at + BATCH_ROWS])) for column in found.words]
                joined = columns[0] if length == 1 else pc.binary_join_element_wise(*columns, b" ")
                yield length, joined, found.count[at : at + BATCH_ROWS]


def _shards(docs: DataFrame, depth: int, shard_words: int, rows: Callable[[Shard], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``rows`` makes of each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}

        def index(lang: str) -> Iterator[pa.RecordBatch]:
            yield from rows(Shard(lang, waiting.pop(lang), depth))

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = waiting.setdefault(lang, [])
                words += words_of(text)
                if len(words) >= shard_words:
                    yield from index(lang)
            while sum(map(len, waiting.values())) > 2 * shard_words:
                yield from index(max(waiting, key=lambda lang: len(waiting[lang])))
        for lang in list(waiting):
            yield from index(lang)

    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return texts.mapInArrow(run, schema)


def frequent_filter(
    docs: DataFrame, depth: int = DEPTH, least: int = LEAST_COUNT, shard_words: int = SHARD_WORDS, bits: int = FILTER_BITS
) -> bytes:
    """``bits`` bits, of which those are set that frequent phrases shorter than the depth hash to.

    This is all that comes to the driver and goes to the executors: its size is a parameter, whatever the corpus.
    """

    def rows(shard: Shard) -> Iterator[pa.RecordBatch]:
        for hashes, count in shard.short_hashes():
            for at in range(0, len(hashes), BATCH_ROWS):
                columns = [hashes[at : at + BATCH_ROWS].view(np.int64), count[at : at + BATCH_ROWS].astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names=["hash", "f"])

    # Each shard has summed its own phrases already: another round of sums before the shuffle would only hold them again.
    sums = _shards(docs, depth, shard_words, rows, "hash long, f long").repartition("hash").groupBy("hash").agg(F.sum("f").alias("f"))
    # The place of an unsigned hash; bitmaps count places from one.
    place = F.expr(f"hash & {bits - 1}L") + 1
    pages = (
        sums.where(F.col("f") >= least)
        .select(F.bitmap_bucket_number(place).alias("page"), F.bitmap_bit_position(place).alias("at"))
        .groupBy("page")
        .agg(F.bitmap_construct_agg("at").alias("set"))
    )
    found = bytearray(bits // 8)
    for row in pages.collect():
        start = (row.page - 1) * len(row.set)
        part = bytes(row.set)[: len(found) - start]
        found[start : start + len(part)] = part
    return bytes(found)


def counted(
    docs: DataFrame,
    depth: int = DEPTH,
    least: int = LEAST_COUNT,
    shard_words: int = SHARD_WORDS,
    filter_bits: int | None = FILTER_BITS,
) -> DataFrame:
    """``lang``, ``words``, ``phrase``, ``f``: occurrences of phrases of up to ``depth`` words, and of the empty one.

    Of phrases of fewer than ``least`` occurrences some are left out, or all are there without a filter. ``filter_bits`` is a
    power of two.
    """
    frequent: Broadcast | None = None
    if filter_bits and depth > 2:
        frequent = docs.sparkSession.sparkContext.broadcast(frequent_filter(docs, depth, least, shard_words, filter_bits))

    def rows(shard: Shard) -> Iterator[pa.RecordBatch]:
        bits = None if frequent is None else np.frombuffer(frequent.value, np.uint8)
        for length, phrases, count in shard.phrases(bits):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(pa.scalar(shard.lang), len(count)),
                    pa.repeat(pa.scalar(length, pa.int32()), len(count)),
                    phrases.cast(pa.string()),
                    pa.array(count, pa.int64()),
                ],
                names=["lang", "words", "phrase", "f"],
            )

    shards = _shards(docs, depth, shard_words, rows, "lang string, words int, phrase string, f long")
    return shards.repartition("lang", "phrase").groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))


def _part(phrase: Column, first: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " ", -1), first, length), " ")


def collocations(
    docs: DataFrame,
    depth: int = DEPTH,
    least: int = LEAST_COUNT,
    first: int = FIRST,
    held_percent: int = HELD_PERCENT,
    shard_words: int = SHARD_WORDS,
    filter_bits: int | None = FILTER_BITS,
) -> DataFrame:
    """The ``first`` candidates of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    counts = checkpointed(counted(docs, depth, least, shard_words, filter_bits).where((F.col("f") >= least) | (F.col("words") == 0)))
    phrases = counts.where(F.col("words") > 0)
    candidates = phrases.where(F.col("words") > 1).withColumnRenamed("f", "a")

    longer = candidates.where(F.col("words") > 2).select(
        "lang",
        F.col("a").alias("held"),
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, words - 1), size -> transform(sequence(1, words - size + 1), "
                "at -> array_join(slice(split(phrase, ' ', -1), at, size), ' '))))"
            )
        ).alias("phrase"),
    )
    most = longer.groupBy("lang", "phrase").agg(F.max("held").alias("held"))
    apart = (
        candidates.join(most, ["lang", "phrase"], "left")
        .where(F.col("held").isNull() | (100 * F.col("held").cast("decimal(38,0)") < held_percent * F.col("a").cast("decimal(38,0)")))
        .drop("held")
    )

    # Parts of a candidate are at least as frequent as it is, so both are among the counts kept.
    cut = apart.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).withColumns(
        {
            "left": _part(F.col("phrase"), F.lit(1), F.col("k")),
            "right": _part(F.col("phrase"), F.col("k") + 1, F.col("words") - F.col("k")),
        }
    )
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    exact = {name: F.col(name).cast("decimal(19,0)") for name in ("a", "l", "r")}
    scored = (
        cut.join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .withColumns({f"{name}_": value for name, value in exact.items()})
        .withColumn("score", F.expr(f"cast(cast(a_ * a_ as decimal(32,0)) * {SCALE} as decimal(38,0)) div cast(l_ * r_ as decimal(38,0))"))
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
        .select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score")
    )

    # The first of each slice are taken before the first of all, so that no task ranks a whole language.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    slices = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(1024))).orderBy(*order)
    near = scored.withColumn("place", F.row_number().over(slices)).where(F.col("place") <= first).drop("place")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    totals = counts.where(F.col("words") == 0).select("lang", F.col("f").alias("n"))
    return ranked.where(F.col("rank") <= first).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = rf"""
WITH piece AS (
  SELECT doc_id, coalesce(lang, '{NO_LANG}') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (
  SELECT lang, [w FOR w IN string_split_regex(piece, '[ \x09]+') IF w <> ''] AS ws FROM piece),
grams AS (
  SELECT lang, size, unnest([array_to_string(ws[i:i + size - 1], ' ') FOR i IN range(1, len(ws) - size + 2)]) AS phrase
  FROM words, (VALUES (1), (2), (3)) AS sizes(size)),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT * FROM counts WHERE size > 1 AND f >= {LEAST_COUNT}),
held AS (
  SELECT lang, phrase, max(f) AS held FROM (
    SELECT lang, f, split_part(phrase, ' ', 1) || ' ' || split_part(phrase, ' ', 2) AS phrase FROM candidates WHERE size = 3
    UNION ALL
    SELECT lang, f, split_part(phrase, ' ', 2) || ' ' || split_part(phrase, ' ', 3) FROM candidates WHERE size = 3) AS inner_phrases
  GROUP BY ALL),
apart AS (
  SELECT c.* FROM candidates c LEFT JOIN held h USING (lang, phrase)
  WHERE h.held IS NULL OR 100 * h.held < {HELD_PERCENT} * c.f),
cuts AS (
  SELECT lang, phrase, f, 1 AS k, split_part(phrase, ' ', 1) AS a_part, substr(phrase, length(split_part(phrase, ' ', 1)) + 2) AS b_part FROM apart
  UNION ALL
  SELECT lang, phrase, f, 2, split_part(phrase, ' ', 1) || ' ' || split_part(phrase, ' ', 2), split_part(phrase, ' ', 3) FROM apart WHERE size = 3),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, k,
         CAST((CAST({SCALE} AS HUGEINT) * c.f * c.f) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = a_part JOIN counts y ON y.lang = c.lang AND y.phrase = b_part),
least AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM least WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {FIRST}
"""
