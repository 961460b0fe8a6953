"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is split by the tokenizer's pattern into matches, and each match is encoded on its own by the ranks of a vocabulary file.
Both steps are tree reductions: halves are done recursively, and two neighbours are joined by doing a window around the
seam anew, which grows until what lies outside it cannot change.

* Matches: the pattern looks at most two characters beyond the end of a match, so a match of the left half stands if it ends
  two characters before the seam. A match depends on nothing before its start, so the right half stands from the first
  place on where the window and the right half both begin a match.
* Tokens within a match: a sequence of tokens is the encoding of its bytes if every two neighbours alone encode to
  themselves. (Take the first merge across a token's edge: among the bytes of the two tokens at that edge the same merges were
  done before, in the same order, so it would be done in the two alone as well.) Both ends of the window are tested so.

Texts of more than ``part_bytes`` are cut into parts that Spark encodes apart; the parts of a text are then joined in one task,
which holds that one text. Decoding looks ids up and concatenates up the tree.

A null text is an empty one and has no ids. Repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillmetrics.llm.common import checkpointed, kept_in_worker

LEAF_CHARS = 8192
LEAF_BYTES = 64
LEAF_IDS = 65536
PART_BYTES = 4 << 20
LOOKS_AHEAD = 2
NO_RANK = 1 << 62
MOST_KEPT = 250_000
SLICE_ROWS = 200


def read_ranks(path: str | None) -> dict[bytes, int]:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Node:
    """An encoded stretch of text: where its matches end, its ids as little-endian 32-bit bytes, and ids per match."""

    __slots__ = ("text", "ends", "ids", "sizes")

    def __init__(self, text: str, ends: np.ndarray, ids: bytes, sizes: np.ndarray):
        self.text, self.ends, self.ids, self.sizes = text, ends, ids, sizes


class ByteBpe:
    """``pattern`` must not look back, nor more than two characters beyond a match."""

    def __init__(
        self,
        ranks: dict[bytes, int],
        pattern: str | None = None,
        leaf_chars: int = LEAF_CHARS,
        leaf_bytes: int = LEAF_BYTES,
        most_kept: int = MOST_KEPT,
    ):
        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        # White space as Unicode defines it; this library's own \s has four control characters more.
        self.matches = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.ranks = ranks
        self.token_of = {rank: token for token, rank in ranks.items()}
        self.leaf_chars, self.leaf_bytes, self.most_kept = leaf_chars, leaf_bytes, most_kept
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}

    # Tokens of one match.

    def merged(self, data: bytes) -> list[bytes]:
        """Merge bytes by the lowest rank, leftmost first, until no two neighbours make a token."""
        return self._merged_short(data) if len(data) <= self.leaf_bytes else self._merged_long(data)

    def _merged_short(self, data: bytes) -> list[bytes]:
        rank_of = self.ranks.get
        parts = [data[k : k + 1] for k in range(len(data))]
        ranks = [rank_of(data[k : k + 2], NO_RANK) for k in range(len(data) - 1)]
        while ranks:
            lowest = min(ranks)
            if lowest == NO_RANK:
                break
            k = ranks.index(lowest)
            parts[k] += parts.pop(k + 1)
            del ranks[k]
            if k < len(ranks):
                ranks[k] = rank_of(parts[k] + parts[k + 1], NO_RANK)
            if k:
                ranks[k - 1] = rank_of(parts[k - 1] + parts[k], NO_RANK)
        return parts

    def _merged_long(self, data: bytes) -> list[bytes]:
        ranks = self.ranks
        parts: list[bytes | None] = [data[k : k + 1] for k in range(len(data))]
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        waiting = []
        for k in range(len(parts) - 1):
            rank = ranks.get(data[k : k + 2])
            if rank is not None:
                waiting.append((rank, k, 2))
        heapq.heapify(waiting)
        while waiting:
            _, k, size = heapq.heappop(waiting)
            if parts[k] is None:
                continue
            right = after[k]
            if right >= len(parts) or len(parts[k]) + len(parts[right]) != size:
                continue
            parts[k] += parts[right]
            parts[right] = None
            after[k] = following = after[right]
            if following < len(parts):
                before[following] = k
                joined = parts[k] + parts[following]
                rank = ranks.get(joined)
                if rank is not None:
                    heapq.heappush(waiting, (rank, k, len(joined)))
            if before[k] >= 0:
                joined = parts[before[k]] + parts[k]
                rank = ranks.get(joined)
                if rank is not None:
                    heapq.heappush(waiting, (rank, before[k], len(joined)))
        return [part for part in parts if part is not None]

    def stable(self, left: bytes, right: bytes) -> bool:
        """Whether two tokens alone encode to themselves."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > self.most_kept:
                self.pairs = {}
            known = self.pairs[left, right] = self.merged(left + right) == [left, right]
        return known

    def joined_tokens(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The encoding of the bytes of two encodings together."""
        back = ahead = 1
        while True:
            start, end = max(0, len(left) - back), min(len(right), ahead)
            window = self.merged(b"".join(left[start:] + right[:end]))
            begins = start == 0 or self.stable(left[start - 1], window[0])
            closes = end == len(right) or self.stable(window[-1], right[end])
            if begins and closes:
                return left[:start] + window + right[end:]
            back, ahead = back if begins else 2 * back, ahead if closes else 2 * ahead

    def tokens(self, data: bytes) -> list[bytes]:
        if len(data) <= self.leaf_bytes:
            return self.merged(data)
        half = len(data) // 2
        return self.joined_tokens(self.tokens(data[:half]), self.tokens(data[half:]))

    def ids_of_match(self, match: str) -> bytes:
        """Ids, as little-endian 32-bit bytes, of one match; matches are remembered in two generations."""
        found = self.young.get(match)
        if found is not None:
            return found
        found = self.old.get(match)
        if found is None:
            data = match.encode()
            whole = self.ranks.get(data)
            ids = [whole] if whole is not None else [self.ranks[token] for token in self.tokens(data)]
            found = np.array(ids, dtype="<u4").tobytes()
        if len(match) <= self.leaf_bytes:
            if len(self.young) > self.most_kept:
                self.young, self.old = {}, self.young
            self.young[match] = found
        return found

    def _ids(self, matches: list[str]) -> list[bytes]:
        known = self.young.get
        return [known(match) or self.ids_of_match(match) for match in matches]

    # Matches of a text.

    def leaf(self, text: str) -> Node:
        matches = self.matches(text)
        ids = self._ids(matches)
        ends = np.cumsum(np.fromiter(map(len, matches), np.int64, len(matches)))
        return Node(text, ends, b"".join(ids), np.fromiter(map(len, ids), np.int64, len(ids)) // 4)

    def joined(self, left: Node, right: Node) -> Node:
        if not left.text or not right.text:
            return left if left.text else right
        seam = len(left.text)
        stands = int(np.searchsorted(left.ends, seam - LOOKS_AHEAD, "right"))
        start = int(left.ends[stands - 1]) if stands else 0
        ahead = 4
        while True:
            ahead = min(ahead, len(right.ends))
            all_of_it = ahead == len(right.ends)
            window = left.text[start:] + right.text[: int(right.ends[ahead - 1])]
            matches = self.matches(window)
            ends = start + np.cumsum(np.fromiter(map(len, matches), np.int64, len(matches)))
            sure = start + len(window) - (0 if all_of_it else LOOKS_AHEAD)
            common = np.intersect1d(ends[ends <= sure], seam + np.concatenate([[0], right.ends[:ahead]]), assume_unique=True)
            if len(common):
                break
            ahead *= 2
        meets = int(common[0])
        kept = int(np.searchsorted(ends, meets, "right"))
        rest = int(np.searchsorted(right.ends, meets - seam, "right"))
        ids = self._ids(matches[:kept])
        return Node(
            left.text + right.text,
            np.concatenate([left.ends[:stands], ends[:kept], seam + right.ends[rest:]]),
            left.ids[: 4 * int(left.sizes[:stands].sum())] + b"".join(ids) + right.ids[4 * int(right.sizes[:rest].sum()) :],
            np.concatenate([left.sizes[:stands], np.fromiter(map(len, ids), np.int64, len(ids)) // 4, right.sizes[rest:]]),
        )

    def node(self, text: str) -> Node:
        if len(text) <= self.leaf_chars:
            return self.leaf(text)
        half = len(text) // 2
        return self.joined(self.node(text[:half]), self.node(text[half:]))

    def folded(self, nodes: list[Node]) -> Node:
        if len(nodes) == 1:
            return nodes[0]
        half = len(nodes) // 2
        return self.joined(self.folded(nodes[:half]), self.folded(nodes[half:]))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(text) <= self.leaf_chars:
            return b"".join(self._ids(self.matches(text)))
        return self.node(text).ids


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that a task holds the results of few texts beside its batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def _encoder(vocabulary: str | None, pattern: str | None) -> ByteBpe:
    return kept_in_worker("byte_bpe", f"{vocabulary}\n{pattern}", lambda: ByteBpe(read_ranks(vocabulary), pattern))


def encoded(
    docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, part_bytes: int = PART_BYTES
) -> DataFrame:
    """``doc_id``, ``ids`` (little-endian 32-bit) and ``n_tokens`` of every row.

    ``vocabulary`` is a rank file that every executor has; by default the installed one is asked for its path there.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    is_long = F.coalesce(F.octet_length("text"), F.lit(0)) > part_bytes

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoder(vocabulary, pattern)
        for part in _slices(batches):
            ids = [bpe.encode(text) for text in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column(1).to_pylist()):
                for part, at in enumerate(range(0, len(text), part_bytes)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(k, 1),
                            batch.column(2).slice(k, 1),
                            pa.array([part], pa.int32()),
                            pa.array([text[at : at + part_bytes]]),
                        ],
                        names=["doc_id", "row", "part", "text"],
                    )

    def encode_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoder(vocabulary, pattern)
        for batch in batches:
            for k, text in enumerate(batch.column(3).to_pylist()):
                node = bpe.node(text)
                found = [node.ends.tobytes(), node.ids, node.sizes.tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(k, 1).columns, *[pa.array([data], pa.binary()) for data in found]],
                    names=["doc_id", "row", "part", "text", "ends", "ids", "sizes"],
                )

    def join_parts(parts: pd.DataFrame) -> pd.DataFrame:
        bpe = _encoder(vocabulary, pattern)
        parts = parts.sort_values("part")
        nodes = [
            Node(text, np.frombuffer(ends, np.int64), ids, np.frombuffer(sizes, np.int64))
            for text, ends, ids, sizes in parts[["text", "ends", "ids", "sizes"]].itertuples(index=False)
        ]
        return parts.iloc[:1][["doc_id"]].assign(ids=[bpe.folded(nodes).ids])

    short = docs.where(~is_long).mapInArrow(whole, f"doc_id {kind}, ids binary")
    # Numbers of rows must not change between attempts of a task, so the few long texts are written once.
    long = checkpointed(docs.where(is_long).withColumn("row", F.monotonically_increasing_id()))
    parts = (
        long.mapInArrow(cut, f"doc_id {kind}, row long, part int, text string")
        .repartition("row", "part")
        .mapInArrow(encode_parts, f"doc_id {kind}, row long, part int, text string, ends binary, ids binary, sizes binary")
    )
    joined = parts.groupBy("row").applyInPandas(join_parts, f"doc_id {kind}, ids binary")
    return short.unionByName(joined).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def decoded(tokens: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The rows with ``decoded``, the bytes that ``ids`` stand for (null where ``ids`` is)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _encoder(vocabulary, None).token_of

        def bytes_of(ids: np.ndarray) -> bytes:
            if len(ids) <= LEAF_IDS:
                return b"".join(map(table.__getitem__, ids.tolist()))
            half = len(ids) // 2
            return bytes_of(ids[:half]) + bytes_of(ids[half:])

        for part in _slices(batches):
            rows = part.column(part.schema.get_field_index("ids")).to_pylist()
            texts = [None if ids is None else bytes_of(np.frombuffer(ids, "<u4")) for ids in rows]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(texts, pa.binary())], names=[*part.schema.names, "decoded"]
            )

    kept = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in tokens.schema if field.name != "decoded")
    return tokens.drop("decoded").mapInArrow(run, f"{kept}, decoded binary")
