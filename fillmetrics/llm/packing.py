"""Texts into sequences of a fixed number of tokens: bin completion with best-fit solutions as incumbents.

A text is its token ids and a closing id; only a longer one is cut, into full sequences and a rest. Pieces are dealt by a number
of their own, whatever their ids, over shards of some thousand pieces; each shard is packed on its own, so that a task holds numbers for a bounded share. Of a
shard, no more than its last sequence can be left partly filled for want of pieces.

Bin completion packs around the largest piece left. For it, fillings are enumerated that are undominated (no left-over piece
could replace a smaller one in them and still fit), fullest first. Branch and bound stops a branch once the waste of
its closed sequences exceeds what a better solution than the incumbent could afford; ``effort`` bounds the nodes of
a search, after which the incumbent stands, and ``width`` the steps of enumerating the fillings of one branch, which ends
at the first filling without waste. The first incumbent is best-fit decreasing; where it is as good as the lower bound, nothing is
searched.

A null text is an empty one: a single piece that holds the closing id. Repeated rows are packed each.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillmetrics.llm.common import checkpointed, kept_in_worker, sliced

CAPACITY = 2048
CLOSING_ID = 0
SHARD_PIECES = 4096
EFFORT = 4000
WIDTH = 200
MOST_CACHED = 250_000
SLICE_CHARS = 1 << 19
OTHER_ROWS = 256
TRAILING = ".,;:!?|#$%&*"

# What a usual text is made of: nothing here is changed by normalising but by lower-casing, which keeps the length.
USUAL_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
USUAL_SIGNS = "".join(map(chr, range(0x21, 0x7F))) + "¡¢£¤¥¦§¨©«¬\xad®¯°±´¶·¸»¿×÷–—‘’“”„…€"
UNUSUAL = re.compile(f"[^\t\n\r {re.escape(USUAL_LETTERS + USUAL_LETTERS.upper().replace('SS', '') + USUAL_SIGNS)}]")
SPACE, LETTER, DIGIT, SIGN = range(4)
_KINDS = np.zeros(0x20AD, dtype=np.uint8)
_KINDS[[ord(c) for c in USUAL_SIGNS]] = SIGN
_KINDS[[ord(c) for c in USUAL_LETTERS]] = LETTER
_KINDS[[ord(c) for c in "0123456789"]] = DIGIT
# Of a hash of runs, modulo 2^64: a number for each character and, by its place, powers of an odd number and their inverses.
_MIXED = np.random.default_rng(42).integers(1, 1 << 64, len(_KINDS), dtype=np.uint64) * (_KINDS != SPACE)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int) -> np.ndarray:
    found = np.full(SLICE_CHARS, base, dtype=np.uint64)
    found[0] = 1
    return np.multiply.accumulate(found)


class WordIds:
    """Token ids, as little-endian 32-bit bytes, of texts, put together from remembered words.

    The tokenizer never joins text across white space, and a run of punctuation is cut off from letters before it, so
    ids of words and of trailing punctuation follow each other as they do in the whole text. A word of letters alone is a
    single unit for the tokenizer and needs none of its normalising and splitting; anything unusual is given to it as it is.
    Words are remembered in two generations: when the younger is full it becomes the older, so that frequent ones stay.

    Texts of usual characters alone are cut into the tokenizer's own units together, as arrays, and only different units are
    looked up: equal hashes make them candidates, their characters are compared.
    """

    def __init__(self, path: str | None, most: int = MOST_CACHED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a worker for each core already
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
        self.letters = Tokenizer(self.whole.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.ascii = Tokenizer(self.whole.model)
        self.ascii.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True
        self.usual = path is None  # units are cut as the installed tokenizer cuts them
        self.powers, self.inverses = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
        self.most = most
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def direct(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _units(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Words that are single units, with their ids."""
        ascii_words = [word for word in words if word.isascii()]
        others = [word for word in words if not word.isascii()]
        for tokenizer, group in ((self.ascii, ascii_words), (self.letters, others)):
            if group:
                # One text of many words, without offsets, is the cheapest to encode.
                found = tokenizer.encode_batch_fast([" ".join(group)], add_special_tokens=False)
                ids = np.array(found[0].ids, dtype="<u4")
                ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
                data = ids.tobytes()
                yield from zip(group, [data[start:end] for start, end in zip([0, *ends], ends)])

    def _learn(self, words: Iterable[str]) -> None:
        young, old = self.young, self.old
        plain, composed = [], []
        for word in words:
            found = old.get(word)
            if found is not None:
                young[word] = found
            elif word.islower() and word.isalpha() and (word.isascii() or is_normalized("NFC", word)):
                plain.append(word)
            else:
                composed.append(word)
        parts = []
        for word in composed:
            core = word.rstrip(TRAILING)
            if not core.isalpha():
                core = word
            unit = core.lower() if core.isascii() else "".join(map(str.lower, core)) if is_normalized("NFC", core) else ""
            if not unit.isalpha():
                young[word] = self.direct(word)
                continue
            tail = word[len(core) :]
            if tail and tail not in young:
                young[tail] = self.direct(tail)
            parts.append((word, unit, tail))
        plain += {unit: None for _, unit, _ in parts if unit not in young}
        if plain:
            young.update(self._units(plain))
        for word, unit, tail in parts:
            young[word] = young[unit] + young[tail]

    def of(self, text: str | None) -> bytes:
        return self.of_many([text])[0]

    def of_many(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text."""
        out: list[bytes] = [b""] * len(texts)
        usual: list[int] = []
        others: list[int] = []
        length = 0
        for k, text in enumerate(texts):
            if not text:
                continue
            if "<|" in text:
                out[k] = self.direct(text)
            elif self.usual and len(text) < SLICE_CHARS and (text.isascii() and text.isprintable() or not UNUSUAL.search(text)):
                if length + len(text) + 1 > SLICE_CHARS:
                    self._put(out, texts, usual, self._by_units)
                    usual, length = [], 0
                usual.append(k)
                length += len(text) + 1
            else:
                others.append(k)
        self._put(out, texts, usual, self._by_units)
        for at in range(0, len(others), OTHER_ROWS):
            self._put(out, texts, others[at : at + OTHER_ROWS], self._by_words)
        return out

    def _put(self, out: list[bytes], texts: Sequence[str], rows: list[int], encode: Callable[[list[str]], list[bytes]]) -> None:
        if len(self.young) > self.most:
            self.young, self.old = {"": b""}, self.young
        for k, ids in zip(rows, encode([texts[k] for k in rows]) if rows else []):
            out[k] = ids

    def _by_words(self, texts: list[str]) -> list[bytes]:
        """Words that none of the texts has been seen with are learnt in one go."""
        known = self.young.get
        split = [text.replace("\n", " ").split(" ") for text in texts]
        found = [list(map(known, words)) for words in split]
        self._learn({word for words, known_ids in zip(split, found) for word, ids in zip(words, known_ids) if ids is None})
        return [b"".join(map(self.young.__getitem__, words)) for words in split]

    def _by_units(self, texts: list[str]) -> list[bytes]:
        """Letters in a row, single digits, signs in a row and what the tokenizer cuts off behind an apostrophe."""
        text = "\n".join(texts).lower() + "\n"
        codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        kinds = _KINDS[codes]
        changes = kinds[1:] != kinds[:-1]
        digits = kinds == DIGIT
        first = kinds != SPACE
        last = first.copy()
        first[1:] &= changes | digits[1:]
        last[:-1] &= changes | digits[:-1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1

        alone = np.flatnonzero((codes[starts] == ord("'")) & (ends - starts == 1))
        alone = alone[kinds[ends[alone]] == LETTER]
        if len(alone):
            one, two = codes[ends[alone]], codes[ends[alone] + 1]
            of = lambda sign: one == ord(sign)
            cut = (of("s") | of("t") | of("m") | of("d")) + 2 * (
                ((of("r") | of("v")) & (two == ord("e"))) | (of("l") & (two == ord("l")))
            )
            ends[alone] += cut
            starts[alone + 1] += cut
            held = starts < ends
            starts, ends = starts[held], ends[held]
        if not len(starts):
            return [b""] * len(texts)

        lengths = ends - starts
        hashes = np.add.reduceat(_MIXED[codes] * self.powers[: len(codes)], starts) * self.inverses[starts]
        unit_of, _ = pd.factorize(hashes)
        example = np.empty(unit_of.max() + 1, dtype=np.int64)
        example[unit_of[::-1]] = np.arange(len(unit_of) - 1, -1, -1)
        begin, end = starts[example], ends[example]
        total = np.cumsum(lengths)
        same = np.array_equal(lengths, lengths[example][unit_of]) and np.array_equal(
            codes[kinds != SPACE], codes[np.arange(total[-1]) + np.repeat(begin[unit_of] - total + lengths, lengths)]
        )
        if not same:
            return self._by_words(texts)

        units = [text[a:b] for a, b in zip(begin.tolist(), end.tolist())]
        found = list(map(self.young.get, units))
        self._learn({unit for unit, ids in zip(units, found) if ids is None})
        young = self.young
        found = [young[unit] if ids is None else ids for unit, ids in zip(units, found)]
        ids = np.frombuffer(b"".join(found), dtype="<u4")
        number = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        place = (np.cumsum(number) - number)[unit_of]
        number = number[unit_of]
        total = np.concatenate([[0], np.cumsum(number)])
        ids = ids[np.arange(total[-1]) + np.repeat(place - total[:-1], number)].tobytes()
        edges = np.cumsum([0, *(len(text) + 1 for text in texts)])
        edges = (4 * total[np.searchsorted(starts, edges)]).tolist()
        return [ids[a:b] for a, b in zip(edges, edges[1:])]


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` of every piece.

    ``tokenizer`` is a file that every executor has; by default the installed one is asked for its path there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept_in_worker("packing", tokenizer, lambda: WordIds(tokenizer))
        closing = CLOSING_ID.to_bytes(4, "little")
        for batch in sliced(batches):
            row, piece, length, crc = [], [], [], []
            for k, ids in enumerate(words.of_many(batch.column(1).to_pylist())):
                ids += closing
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row.append(k)
                    piece.append(number)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            piece = pa.array(piece, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int32())),
                    piece,
                    pc.multiply(piece.cast(pa.int64()), capacity),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Best-fit decreasing: each length goes to the fullest sequence that still has room."""
    open_by_room: dict[int, list[list[int]]] = {}
    rooms = 0  # bit r: some sequence has room r
    packed: list[list[int]] = []
    for length in sorted(lengths, reverse=True):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            bin_ = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, bin_ = capacity, []
            packed.append(bin_)
        bin_.append(length)
        left = room - length
        if left:
            open_by_room.setdefault(left, []).append(bin_)
            rooms |= 1 << left
    return packed


def least_sequences(lengths: list[int], capacity: int = CAPACITY) -> int:
    """A lower bound: pieces over half a sequence never share one, and what they leave must hold the middling ones."""
    count = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1]
    number = np.concatenate([[0], np.cumsum(count)])  # of pieces shorter than k
    tokens = np.concatenate([[0], np.cumsum(count * np.arange(capacity + 1))])
    half = capacity // 2 + 1
    low = np.arange(capacity // 2 + 1)
    top = capacity - low + 1
    alone = number[-1] - number[top]
    large, large_tokens = number[top] - number[half], tokens[top] - tokens[half]
    middling = tokens[half] - tokens[low]
    more = np.maximum(0, -(-(middling - (large * capacity - large_tokens)) // capacity))
    return int((alone + large + more).max())


def fillings(stock: Counter, sizes: list[int], room: int, most_waste: int, width: int) -> list[list[int]]:
    """Undominated fillings of ``room`` from the stock, fullest first, none wasting more than ``most_waste``.

    ``sizes`` are the distinct lengths in stock, ascending. At most ``width`` are tried per branch.
    """
    found: list[tuple[int, list[int]]] = []

    def fill(room_left: int, top: int, chosen: list[int], tries: list[int]) -> None:
        if tries[0] <= 0:
            return
        tries[0] -= 1
        fits = bisect_right(sizes, room_left, 0, top)
        k = fits - 1
        used = chosen.count
        grew = False
        while k >= 0 and tries[0] > 0:
            size = sizes[k]
            if stock[size] > used(size):
                grew = True
                fill(room_left - size, k + 1, [*chosen, size], tries)
                if found and found[-1][0] == 0:
                    return
            k -= 1
        if not grew and room_left <= most_waste:
            # Dominated if some other piece could take the place of a chosen smaller one and still fit.
            for size in set(chosen):
                at = bisect_right(sizes, size + room_left) - 1
                while at >= 0 and sizes[at] > size:
                    if stock[sizes[at]] > used(sizes[at]):
                        return
                    at -= 1
            found.append((room_left, chosen))

    fill(room, len(sizes), [], [width])
    found.sort(key=lambda entry: (entry[0], [-size for size in entry[1]]))
    return [chosen for _, chosen in found]


def bin_completion(
    lengths: list[int], capacity: int = CAPACITY, effort: int = EFFORT, width: int = WIDTH
) -> list[list[int]]:
    """A packing into as few sequences as the search finds; never more than best-fit decreasing needs."""
    full = [[length] for length in lengths if length == capacity]
    rest = [length for length in lengths if length < capacity]
    incumbent = best_fit(rest, capacity)
    total = sum(rest)
    least = least_sequences(rest, capacity) if rest else 0
    nodes = effort
    stock = Counter(rest)
    closed: list[list[int]] = []
    # An explicit stack of iterators over the fillings of one sequence after the other.
    stack: list[tuple[Iterator[list[int]], int, int]] = []

    def branches(waste: int) -> Iterator[list[int]]:
        sizes = sorted(size for size, count in stock.items() if count)
        largest = sizes[-1]
        allowed = (len(incumbent) - 1) * capacity - total - waste
        stock[largest] -= 1
        sizes = [size for size in sizes if stock[size]]
        options = fillings(stock, sizes, capacity - largest, allowed, width)
        stock[largest] += 1
        return iter([[largest, *chosen] for chosen in options])

    if len(incumbent) > least:
        stack.append((branches(0), 0, 0))
    while stack and nodes > 0 and len(incumbent) > least:
        options, waste, depth = stack[-1]
        while len(closed) > depth:
            stock.update(closed.pop())
        chosen = next(options, None)
        if chosen is None:
            stack.pop()
            continue
        nodes -= 1
        spent = waste + capacity - sum(chosen)
        if spent > (len(incumbent) - 1) * capacity - total:
            continue
        stock.subtract(chosen)
        closed.append(chosen)
        left = [size for size, count in stock.items() for _ in range(count)] if nodes % 64 == 0 or len(closed) >= least - 1 else None
        if left is not None:
            tried = closed + best_fit(left, capacity)
            if len(tried) < len(incumbent):
                incumbent = [list(bin_) for bin_ in tried]
                continue
        if any(stock.values()):
            stack.append((branches(spent), spent, len(closed)))
    return full + incumbent


def packed(
    parts: DataFrame,
    capacity: int = CAPACITY,
    shard_pieces: int = SHARD_PIECES,
    effort: int = EFFORT,
    width: int = WIDTH,
) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    parts = checkpointed(parts)
    shards = max(1, parts.count() // shard_pieces)

    def place(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["length", "doc_id", "piece"], kind="stable").reset_index(drop=True)
        waiting: dict[int, list[int]] = {}
        for row, length in enumerate(shard["length"]):
            waiting.setdefault(int(length), []).append(row)
        sequence, offset = [0] * len(shard), [0] * len(shard)
        for number, lengths in enumerate(bin_completion([int(x) for x in shard["length"]], capacity, effort, width)):
            at = 0
            for length in lengths:
                row = waiting[length].pop()
                sequence[row], offset[row] = (int(key[0]) << 32) + number, at
                at += length
        return shard.assign(sequence_id=sequence, offset=offset).drop(columns="shard")

    kind = parts.schema["doc_id"].dataType.simpleString()
    return (
        parts.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(
            place,
            f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
        )
    )
