"""Personal data by patterns and a skip-chain conditional random field over what could be personal data.

Base spans are what the four patterns find, as they stand. The field adds spans where label consistency asks for them. Its nodes
are the base spans of a document, mentions that are similar to one of them, and the other tokens that hold a digit or an ``@``;
tokens without either are O for certain and need no node. Similar is a number of the same digits in another spelling, or without the
up to three digits of its country but seven at least, and an address with words for its signs. Unary potentials come from features
of the node and the word before it, chain potentials link neighbouring nodes. Skip edges join each node to the one before it, at any
distance, that is equal or similar to it. Base spans are clamped to their kind. Sum-product messages run over all edges until they
settle; a free node becomes a span if it is similar to a base span and has that label with ``CERTAIN`` probability. Short
numbers are similar to nothing, so parts of a number (a country code, the end of a card) do not spread.

All weights are log ratios of counts over a bounded sample of documents (``sample`` texts, chosen by a hash of the id), labelled by the
patterns: how often a feature comes with a label, labels follow each other, and equal nodes share a label. Null and empty
texts have no spans. A repeated or null ``doc_id`` changes nothing: rows are independent.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillmetrics.llm.common import chance, nothing_kept_in_worker

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)
LABELS = len(KINDS) + 1

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# Neither a number nor a chain of digits can match from its second digit if it does not from its first.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
MARK = re.compile(r"[0-9@]")
TOKEN = re.compile(r"\S+")
NOT_DIGIT = re.compile(r"[^0-9]+")

# Groups of digits that could be one number, and an address with words for its signs.
NUMBER = re.compile(r"[0-9]+(?:[\x20().\-/]{1,3}[0-9]+)*")
GROUP = re.compile(r"[0-9]+")
SPELT = re.compile(
    r"([A-Za-z0-9._%+-]+)\x20?[\[({]\x20?(?:at|AT|@)\x20?[\])}]\x20?"
    r"([A-Za-z0-9-]+(?:\x20?(?:[\[({]\x20?(?:dot|DOT)\x20?[\])}]|\.)\x20?[A-Za-z0-9-]+)+)"
)
SPELT_DOT = re.compile(r"\x20?(?:[\[({]\x20?(?:dot|DOT)\x20?[\])}]|\.)\x20?")

DISTINCT_DIGITS = 7
COUNTRY_DIGITS = 3
CLAMP = 12.0
CERTAIN = 0.5
SETTLED = 1e-4
SMOOTHING = 0.5

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches of local part, ``@`` and domain, looked for from each ``@`` so that long runs cost once."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARACTERS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield 0, start, domain.end()
            free = domain.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """The four kinds in order, each by start."""
    spans = list(_emails(text)) if "@" in text else []
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m.group().split(".")):
            spans.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                spans.append((3, m.start(), m.end()))
    return spans


class Node:
    """``key`` is what similar nodes share; None where nothing is similar. ``label`` is that of the base span.

    A mention shares the potentials of the spelling, ``shape``, that it is similar to; the word before it is its own.
    """

    __slots__ = ("start", "end", "text", "features", "label", "key")

    def __init__(
        self, start: int, end: int, text: str, before: str, label: int = OUTSIDE, key: str | None = None, shape: str | None = None
    ):
        self.start, self.end, self.text, self.label = start, end, text, label
        text = shape or text
        digits = NOT_DIGIT.sub("", text)
        self.key = key or (text.lower() if "@" in text else digits if len(digits) >= DISTINCT_DIGITS else None)
        self.features = (
            f"digits={min(len(digits), 20)}",
            f"at={'@' in text}",
            f"dots={min(text.count('.'), 4)}",
            f"hyphens={min(text.count('-'), 3)}",
            f"letters={sum(c.isalpha() for c in text) * 4 // len(text)}",
            f"before={before}",
        )


Mention = tuple[int, int, str, str]  # start, end, key, the base span's text


def mentions(text: str, spans: list[Span]) -> list[Mention]:
    """What is similar to a base span and none itself, by start."""
    endings: dict[str, tuple[str, str]] = {}
    addresses: dict[str, str] = {}
    for kind, start, end in spans:
        digits = NOT_DIGIT.sub("", text[start:end])
        if KINDS[kind] == "email":
            addresses[text[start:end].lower()] = text[start:end]
        elif KINDS[kind] == "card":
            endings[digits] = digits, text[start:end]
        elif KINDS[kind] == "phone":
            for dropped in range(COUNTRY_DIGITS + 1):
                if len(digits) - dropped >= DISTINCT_DIGITS:
                    endings.setdefault(digits[dropped:], (digits, text[start:end]))
    found: list[Mention] = []
    if endings:
        longest = max(map(len, endings))
        for run in NUMBER.finditer(text):
            if run.end() - run.start() < DISTINCT_DIGITS:
                continue
            groups = [(run.start() + m.start(), run.start() + m.end(), m.group()) for m in GROUP.finditer(run.group())]
            first = 0
            while first < len(groups):
                digits, best = "", None
                for last in range(first, len(groups)):
                    digits += groups[last][2]
                    if len(digits) > longest:
                        break
                    if digits in endings:
                        best = last, endings[digits]
                if best is None:
                    first += 1
                    continue
                start, end = groups[first][0], groups[best[0]][1]
                # A bracket or plus that belongs to the number.
                while start and text[start - 1] in "(+":
                    start -= 1
                found.append((start, end, *best[1]))
                first = best[0] + 1
    if addresses:
        for m in SPELT.finditer(text):
            written = f"{m.group(1)}@{SPELT_DOT.sub('.', m.group(2))}".lower()
            if written in addresses:
                found.append((m.start(), m.end(), written, addresses[written]))
    taken = sorted((start, end) for _, start, end in spans)
    at, free = 0, []
    for mention in sorted(found):
        while at < len(taken) and taken[at][1] <= mention[0]:
            at += 1
        if at == len(taken) or taken[at][0] >= mention[1]:
            free.append(mention)
    return free


def nodes_of(text: str, spans: list[Span], similar: list[Mention] | None = None) -> list[Node]:
    """Base spans (of overlapping ones the first), mentions, and other tokens with a digit or ``@`` without punctuation at their ends."""
    if similar is None:
        similar = mentions(text, spans)
    whole: list[tuple[int, int, int, str, str]] = []
    for kind, start, end in sorted(spans, key=lambda span: (span[1], span[0])):
        if not whole or whole[-1][1] <= start:
            key = text[start:end].lower() if KINDS[kind] in ("email", "ip") else NOT_DIGIT.sub("", text[start:end])
            whole.append((start, end, kind, key, text[start:end]))
    whole = sorted([*whole, *((start, end, OUTSIDE, key, shape) for start, end, key, shape in similar)])
    nodes: list[Node] = []
    before, at = "", 0
    for m in TOKEN.finditer(text):
        token, start, end = m.group(), m.start(), m.end()
        while at < len(whole) and whole[at][0] < end:
            begins, ends, label, key, shape = whole[at]
            nodes.append(Node(begins, ends, text[begins:ends], before, label, key, shape))
            at += 1
        if MARK.search(token):
            core = token.strip(".,;:!?\"'|#$%&*")
            place = start + token.index(core) if core else start
            # What a base span or a mention covers in part is no node of its own.
            inside = at and whole[at - 1][1] > start
            if core and not inside:
                nodes.append(Node(place, place + len(core), core, before))
            before = "<number>"
        else:
            before = token.lower() if len(token) < 40 else "<long>"
    return sorted(nodes, key=lambda node: node.start)


def similar_pairs(nodes: list[Node]) -> list[tuple[int, int]]:
    """Each node with the one before it that has its key."""
    pairs, last = [], {}
    for k, node in enumerate(nodes):
        if node.key is not None:
            if node.key in last:
                pairs.append((last[node.key], k))
            last[node.key] = k
    return pairs


class Field:
    """Weights, and message passing over one document."""

    def __init__(self, counts: dict[tuple[str, int], int]):
        by_label = np.full(LABELS, SMOOTHING)
        features: dict[str, np.ndarray] = defaultdict(lambda: np.full(LABELS, SMOOTHING))
        self.chain = np.full((LABELS, LABELS), SMOOTHING)
        together = SMOOTHING * (np.eye(LABELS) * 9 + 1)
        for (feature, label), count in counts.items():
            if feature == "":
                by_label[label] += count
            elif feature.startswith("~"):
                # Which of two equal nodes comes first says nothing.
                together[int(feature[1:]), label] += count / 2
                together[label, int(feature[1:])] += count / 2
            elif feature.startswith(">"):
                self.chain[int(feature[1:]), label] += count
            else:
                features[feature][label] += count
        self.prior = np.log(by_label / by_label.sum())
        self.weights = {
            feature: np.log(row / (by_label + 1)) - np.log(row.sum() / (by_label.sum() + LABELS))
            for feature, row in features.items()
        }
        self.chain = np.log(self.chain / self.chain.sum(axis=1, keepdims=True)) - self.prior
        alone = together.sum(axis=1) / together.sum()
        self.skip = np.log(together / together.sum()) - np.log(alone)[:, None] - np.log(alone)[None, :]

    def marginals(self, nodes: list[Node]) -> np.ndarray:
        unary = np.tile(self.prior, (len(nodes), 1))
        possible = _labels_by_key(nodes)
        for k, node in enumerate(nodes):
            if node.label != OUTSIDE:
                unary[k] = -CLAMP
                unary[k, node.label] = 0
            else:
                for feature in node.features:
                    unary[k] += self.weights.get(feature, 0.0)
                if node.key in possible:
                    # What is similar to a base span has its kind or none.
                    unary[k, [label for label in range(OUTSIDE) if label not in possible[node.key]]] = -CLAMP
        chain = [(k - 1, k) for k in range(1, len(nodes))]
        skip = similar_pairs(nodes)
        if not skip and not chain:
            return _softmax(unary)
        edges = np.array(chain + skip)
        potential = np.concatenate([np.tile(self.chain, (len(chain), 1, 1)), np.tile(self.skip, (len(skip), 1, 1))])
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        potential = np.exp(np.concatenate([potential, potential.transpose(0, 2, 1)]))
        back = np.roll(np.arange(len(source)), len(edges))
        messages = np.zeros((len(source), LABELS))
        # A message passes all nodes in as many rounds; damping makes loops settle, and halves what is left of a change.
        for _ in range(2 * len(nodes) + 30):
            belief = unary.copy()
            np.add.at(belief, target, messages)
            cavity = _softmax(belief[source] - messages[back])
            fresh = np.log(np.einsum("ei,eij->ej", cavity, potential) + 1e-300)
            fresh -= fresh.max(axis=1, keepdims=True)
            moved = np.abs(fresh - messages).max()
            messages = 0.5 * (messages + fresh)
            if moved < SETTLED:
                break
        belief = unary.copy()
        np.add.at(belief, target, messages)
        return _softmax(belief)

    def added_spans(self, text: str, spans: list[Span]) -> list[Span]:
        # Without something similar to a base span, no label can spread.
        similar = mentions(text, spans) if spans else []
        if not similar:
            return []
        nodes = nodes_of(text, spans, similar)
        labels = _labels_by_key(nodes)
        best = self.marginals(nodes)
        added: list[Span] = []
        for node, chances in zip(nodes, best):
            label = int(chances.argmax())
            if node.label == OUTSIDE and node.key in labels and label in labels[node.key] and chances[label] >= CERTAIN:
                added.append((label, node.start, node.end))
        return added


def _labels_by_key(nodes: list[Node]) -> dict[str, set[int]]:
    """The kinds of the base spans of each key."""
    labels: dict[str, set[int]] = defaultdict(set)
    for node in nodes:
        if node.label != OUTSIDE:
            labels[node.key].add(node.label)
    return dict(labels)


def _softmax(scores: np.ndarray) -> np.ndarray:
    odds = np.exp(scores - scores.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, sample: int = 4000) -> Field:
    """Counts of features and label pairs over about ``sample`` documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text and MARK.search(text):
                    nodes = nodes_of(text, base_spans(text), [])
                    for k, node in enumerate(nodes):
                        counts["", node.label] += 1
                        counts.update((feature, node.label) for feature in node.features)
                        if k:
                            counts[f">{nodes[k - 1].label}", node.label] += 1
                    for before, after in similar_pairs(nodes):
                        counts[f"~{nodes[before].label}", nodes[after].label] += 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([key[0] for key in counts], pa.string()),
                pa.array([key[1] for key in counts], pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names=["feature", "label", "n"],
        )

    share = min(1.0, sample / max(1, docs.count()))
    counted = (
        docs.where(chance(F.col("doc_id"), "pii sample") < share)
        .select("text")
        .mapInArrow(run, "feature string, label int, n long")
        .groupBy("feature", "label")
        .agg(F.sum("n").alias("n"))
        .where((F.col("n") > 1) | ~F.col("feature").startswith("before="))
    )
    return Field({(row.feature, row.label): row.n for row in counted.collect()})


def digest(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in sorted(spans))


def with_spans(docs: DataFrame, field: Field) -> DataFrame:
    """The rows with ``base`` and ``added``: arrays of (kind, start, end). Columns of these names are replaced."""
    kept = docs.drop("base", "added")
    place = kept.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(field)
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            base, added = [], []
            for text in batch.column(place).to_pylist():
                found = base_spans(text) if text else []
                base.append(found)
                added.append(field.added_spans(text, found) if text else [])
            columns = [
                pa.array([[{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans] for spans in many], spans_type)
                for many in (base, added)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "base", "added"])

    spans = "array<struct<kind: string, start: int, end: int>>"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), f"base {spans}, added {spans}"])
    return kept.mapInArrow(run, schema)


def spans_text(spans: str):
    """``kind:start:end`` by kind as listed, then start, comma-joined."""
    rank = F.create_map(*[F.lit(part) for k, kind in enumerate(KINDS) for part in (kind, k)])
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(rank[s["kind"]].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked_text(text: str, spans: list[Span]) -> str:
    """Each stretch covered by spans becomes the name of its first kind in brackets."""
    out, at = [], 0
    merged: list[list[int]] = []
    for kind, start, end in sorted(spans, key=lambda span: (span[1], span[0])):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join(out) + text[at:]


def masked(docs: DataFrame, field: Field) -> DataFrame:
    """The rows with personal data in ``text`` masked."""
    place = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing_kept_in_worker()
        field = shared.value
        for batch in batches:
            texts = []
            for text in batch.column(place).to_pylist():
                base = base_spans(text) if text else []
                texts.append(masked_text(text, base + field.added_spans(text, base)) if base else text)
            columns = list(batch.columns)
            columns[place] = pa.array(texts, batch.column(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
