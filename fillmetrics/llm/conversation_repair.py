"""Repair of conversations by generalised LR parsing of their roles.

The order of roles is a small grammar, ``C -> empty | P | s P``, ``P -> T | P T``, ``T -> u a`` over the initials of roles. Its LR
automaton is made from the rules. All stacks that the rows read so far allow are kept side by side in a graph-structured
stack: a stack is a state on top of another stack, and equal stacks are one node. A row is kept, given the role that a stack
can take next (rerole) or deleted, and rows may be inserted before it; every action has a cost and a letter. Where two ways lead to
equal stacks the least (cost, letters) stays. Two ways of equal cost that have read the same rows never begin with each
other, as the one with more letters has inserted more, so the least stays the least whatever follows.

A conversation may hold a third of all rows. Rows are ordered over the whole cluster by range, and cut into chunks of at most
``chunk_rows`` rows of a conversation. One that lies within a chunk is finished there. For the others, rows seen in earlier chunks
are found by digests, a chunk is parsed from every stack it can begin with, and only these transitions are strung
together, in the order of chunks, by one task per conversation; then all chunks are written out apart again.

Null ids of conversations form one conversation; null turns come first; a null role or text is one space. Rows of one turn are
ordered by role, then by a hash of the text. Repeated rows are rows. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fillmetrics.llm.common import checkpointed

START, END = "C", "$"
RULES = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "T"), ("P", "PT"), ("T", "ua"))
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
BLANK_CHARS = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = ".!?"

CHUNK_ROWS = 1000
CHUNK_CHARS = 4 << 20

Way = tuple[int, str, str]  # cost, letters of edits, roles chosen ("-" for a deleted row)


class RoleAutomaton:
    """LR states of the rules, and stacks as numbers; symbols are single letters, those without rules are initials of roles."""

    def __init__(self, rules: Sequence[tuple[str, str]] = RULES, start: str = START):
        self.rules = [("^", start), *rules]
        self.names = {left for left, _ in self.rules}
        self.initials = sorted({symbol for _, right in self.rules for symbol in right} - self.names)
        self.follow = self._follow()
        first = self._closure({(0, 0)})
        self.states = [first]
        self.goto: dict[tuple[int, str], int] = {}
        for state in self.states:
            for symbol in sorted({self.rules[r][1][at] for r, at in state if at < len(self.rules[r][1])}):
                moved = {(r, at + 1) for r, at in state if self.rules[r][1][at : at + 1] == symbol}
                after = self._closure(moved)
                if after not in self.states:
                    self.states.append(after)
                self.goto[self.states.index(state), symbol] = self.states.index(after)
        self.stacks: list[tuple[int, int]] = [(0, -1)]
        self.numbers: dict[tuple[int, int], int] = {(0, -1): 0}
        self._moves: dict[tuple[int, str], tuple[int, ...]] = {}

    def _closure(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        found = set(items)
        waiting = list(items)
        while waiting:
            rule, at = waiting.pop()
            symbol = self.rules[rule][1][at : at + 1]
            for number, (left, _) in enumerate(self.rules):
                if left == symbol and (number, 0) not in found:
                    found.add((number, 0))
                    waiting.append((number, 0))
        return frozenset(found)

    def _follow(self) -> dict[str, set[str]]:
        empty: set[str] = set()
        first: dict[str, set[str]] = {name: set() for name in self.names}
        follow: dict[str, set[str]] = {name: set() for name in self.names}
        follow["^"].add(END)

        def starts(symbols: str) -> tuple[set[str], bool]:
            found: set[str] = set()
            for symbol in symbols:
                found |= first.get(symbol, {symbol})
                if symbol not in empty:
                    return found, False
            return found, True

        def size() -> int:
            return len(empty) + sum(map(len, first.values())) + sum(map(len, follow.values()))

        before = -1
        while size() != before:
            before = size()
            for left, right in self.rules:
                found, vanishes = starts(right)
                first[left] |= found
                if vanishes:
                    empty.add(left)
                for at, symbol in enumerate(right):
                    if symbol in self.names:
                        found, vanishes = starts(right[at + 1 :])
                        follow[symbol] |= found | (follow[left] if vanishes else set())
        return follow

    def _pushed(self, stack: int, state: int) -> int:
        entry = (state, stack)
        if entry not in self.numbers:
            self.numbers[entry] = len(self.stacks)
            self.stacks.append(entry)
        return self.numbers[entry]

    def _reduced(self, stack: int, rule: int) -> int | None:
        left, right = self.rules[rule]
        for _ in right:
            stack = self.stacks[stack][1]
        state = self.goto.get((self.stacks[stack][0], left))
        return None if state is None else self._pushed(stack, state)

    def _settled(self, stack: int) -> int:
        """Reductions that no next row can prevent are done at once, so that equal futures are equal stacks."""
        while True:
            items = self.states[self.stacks[stack][0]]
            rule, at = next(iter(items))
            if len(items) > 1 or rule == 0 or at < len(self.rules[rule][1]):
                return stack
            stack = self._reduced(stack, rule)

    def _ready(self, stack: int, ahead: str) -> list[int]:
        """The stack and all that reductions make of it if ``ahead`` comes next."""
        found = [stack]
        for one in found:
            for rule, at in self.states[self.stacks[one][0]]:
                left, right = self.rules[rule]
                if rule and at == len(right) and ahead in self.follow[left]:
                    after = self._reduced(one, rule)
                    if after is not None and after not in found:
                        found.append(after)
        return found

    def moves(self, stack: int, initial: str) -> tuple[int, ...]:
        """Stacks after a row of that initial."""
        found = self._moves.get((stack, initial))
        if found is None:
            states = [(one, self.goto.get((self.stacks[one][0], initial))) for one in self._ready(stack, initial)]
            found = tuple(self._settled(self._pushed(one, state)) for one, state in states if state is not None)
            self._moves[stack, initial] = found
        return found

    def accepts(self, stack: int) -> bool:
        return any((0, 1) in self.states[self.stacks[one][0]] for one in self._ready(stack, END))


def _merge(front: dict[int, Way], stack: int, way: Way) -> bool:
    if stack in front and front[stack] <= way:
        return False
    front[stack] = way
    return True


def with_insertions(automaton: RoleAutomaton, front: dict[int, Way]) -> dict[int, Way]:
    front = dict(front)
    waiting = list(front)
    while waiting:
        stack = waiting.pop()
        cost, letters, roles = front[stack]
        for initial in ROLES:
            for after in automaton.moves(stack, initial):
                if _merge(front, after, (cost + INSERT_COST, letters + INSERT, roles + initial)):
                    waiting.append(after)
    return front


def parsed(automaton: RoleAutomaton, entry: int, rows: Sequence[tuple[str, str]]) -> dict[int, Way]:
    """The least way to every stack that can stand after the rows (initial, fault), if ``entry`` stood before them."""
    front: dict[int, Way] = {entry: (0, "", "")}
    for initial, fault in rows:
        after: dict[int, Way] = {}
        for stack, (cost, letters, roles) in with_insertions(automaton, front).items():
            _merge(after, stack, (cost + DELETE_COST, letters + DELETE, roles + "-"))
            if fault in ("blank", "duplicate"):
                continue
            kept = cost + (TRUNCATED_COST if fault else 0)
            for following in automaton.moves(stack, initial):
                _merge(after, following, (kept, letters + KEEP, roles + initial))
            for role in ROLES:
                for following in automaton.moves(stack, role):
                    _merge(after, following, (kept + REROLE_COST, letters + REROLE, roles + role))
        front = after
    return front


def least_end(automaton: RoleAutomaton, front: dict[int, Way]) -> tuple[int, int, str]:
    """Cost, stack before the last insertions, and letters of these, of the least way to an accepted end."""
    found = []
    for stack, way in front.items():
        for after, end in with_insertions(automaton, {stack: way}).items():
            if automaton.accepts(after):
                found.append((end[0], end[1], stack, end[1][len(way[1]) :], end[2][len(way[2]) :]))
    cost, _, stack, letters, roles = min(found)
    return cost, stack, roles


def faults_of(rows: Sequence[tuple[str, str]], digest: Callable, seen: set) -> list[str]:
    """The first fault of each row (role, text); ``seen`` has the digests of rows of earlier chunks."""
    known: set[tuple[str, str]] = set()
    found = []
    for row in rows:
        core = row[1].strip(BLANK_CHARS)
        if not core:
            found.append("blank")
        elif row in known or seen and digest(row) in seen:
            found.append("duplicate")
        elif core[-1] not in SENTENCE_ENDS:
            found.append("truncated")
        else:
            found.append("")
        known.add(row)
    return found


def digest_of(row: tuple[str, str]) -> bytes:
    return hashlib.sha256(f"{len(row[0])}:{row[0]}{row[1]}".encode()).digest()


def lines_of(rows: Sequence[tuple[str, str]], letters: str, roles: str) -> list[str]:
    """``role:text`` of what the edits leave."""
    found = []
    following = iter(rows)
    for letter, initial in zip(letters, roles):
        if letter == INSERT:
            found.append(f"{ROLES[initial]}:")
            continue
        role, text = next(following)
        if letter != DELETE:
            found.append(f"{ROLES[initial] if letter == REROLE else role}:{text}")
    return found


class Counts:
    """What is counted in a run of rows, so that runs which follow each other can be added up."""

    FIELDS = ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn", "first", "last")

    def __init__(self, *values):
        for name, value in zip(self.FIELDS, values or (0, 0, 0, 0, 0, None, None, None, None)):
            setattr(self, name, value)

    @staticmethod
    def of(turns: Sequence[int | None], rows: Sequence[tuple[str, str]], faults: Sequence[str]) -> Counts:
        known = [turn for turn in turns if turn is not None]
        initials = [role[:1] for role, _ in rows]
        return Counts(
            *(faults.count(fault) for fault in ("blank", "duplicate", "truncated")),
            sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            len(set(known)),
            min(known, default=None),
            max(known, default=None),
            initials[0] if initials else None,
            initials[-1] if initials else None,
        )

    def values(self) -> tuple:
        return tuple(getattr(self, name) for name in self.FIELDS)

    def add(self, after: Counts) -> None:
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + getattr(after, name))
        if after.first is not None:
            self.illegal += self.first is not None and self.last + after.first not in LEGAL
            self.first = after.first if self.first is None else self.first
            self.last = after.last
        if after.first_turn is not None:
            self.turns -= self.last_turn == after.first_turn
            self.first_turn = after.first_turn if self.first_turn is None else self.first_turn
            self.last_turn = after.last_turn

    def report(self) -> tuple[int, int, int, int, int]:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
COUNTS = ", ".join(f"{name} {'string' if name in ('first', 'last') else 'long'}" for name in Counts.FIELDS)


def _batches(rows: Iterator[dict], schema: pa.Schema, most_rows: int = 1000, most_chars: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches bounded in rows and in the characters that ``_weight`` of a row names."""
    waiting, weight = [], 0
    for row in rows:
        weight += row.pop("_weight", 0)
        waiting.append(row)
        if len(waiting) >= most_rows or weight >= most_chars:
            yield pa.RecordBatch.from_pylist(waiting, schema=schema)
            waiting, weight = [], 0
    if waiting:
        yield pa.RecordBatch.from_pylist(waiting, schema=schema)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            yield from batch.slice(at, 100).to_pylist()


def _arrow(kind: str, conv_type: pa.DataType) -> pa.Schema:
    """An Arrow schema of fields "name type, ..."; ``conv`` stands for the type of conversation ids."""
    rows = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
    ways = pa.list_(
        pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("letters", pa.string())])
    )
    steps = pa.list_(
        pa.struct([("part", pa.int32()), ("chunk", pa.int32()), ("before", pa.int32()), ("after", pa.int32()), ("added", pa.string())])
    )
    types = {
        "conv": conv_type, "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
        "rows": rows, "ways": ways, "steps": steps,
    }
    return pa.schema([(name, types[type_]) for name, type_ in (field.split() for field in kind.split(", "))])


ROWS_SQL = "array<struct<turn:bigint,role:string,text:string>>"
WAYS_SQL = "array<struct<before:int,after:int,cost:bigint,letters:string>>"
STEPS_SQL = "array<struct<part:int,chunk:int,before:int,after:int,added:string>>"


def _sql(kind: str, conv_type: str) -> str:
    types = {"conv": conv_type, "rows": ROWS_SQL, "ways": WAYS_SQL, "steps": STEPS_SQL}
    return ", ".join(f"{name} {types.get(type_, type_)}" for name, type_ in (field.split() for field in kind.split(", ")))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with the faults that the crc32 of ``conv_id:turn`` gives them; ``dropped`` ones are marked only."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(spaced("text"), SENTENCE_ENDS, "")).otherwise(spaced("text"))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"),
        text.alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


class Repair:
    """Repairs of ``rows`` (``conv_id``, ``turn``, ``role``, ``text`` and, optionally, ``dropped``: a row that is not there).

    ``report()`` has one row per ``conv_id``: counts of faults, ``cost`` and ``audit`` (the letters of all edits).
    ``texts()`` has the repaired conversations in chunks, ``role:text`` lines joined by newlines, in the order of ``part``, ``chunk``.
    """

    def __init__(self, rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS):
        self.conv_sql = rows.schema["conv_id"].dataType.simpleString()
        self.chunk_rows, self.chunk_chars = chunk_rows, chunk_chars
        self._chunks = checkpointed(self._chunked(rows))
        self._done = self._chunks.where(F.col("rows").isNull())
        parsed_chunks = checkpointed(self._parsed(self._chunks.where(F.col("rows").isNotNull())))
        self._strung = checkpointed(self._string(parsed_chunks))
        self._written = self._write(parsed_chunks)

    def _map(self, df: DataFrame, run: Callable[[Iterator[dict]], Iterator[dict]], kind: str) -> DataFrame:
        def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = next(source, None)
            if first is None:
                return

            def all_batches() -> Iterator[pa.RecordBatch]:
                yield first
                yield from source

            conv_type = first.schema.field("conv_id").type
            yield from _batches(run(_rows_of(all_batches())), _arrow(kind, conv_type))

        return df.mapInArrow(batches, _sql(kind, self.conv_sql))

    def _chunked(self, rows: DataFrame) -> DataFrame:
        """Conversations within one chunk, repaired, and chunks of the others (with their ``rows``)."""
        chunk_rows, chunk_chars = self.chunk_rows, self.chunk_chars
        dropped = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in rows.columns else F.lit(False)
        spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
        order = ["conv_id", "turn", "role", "hash", "id"]
        ordered = (
            rows.select(
                "conv_id",
                F.col("turn").cast("long").alias("turn"),
                spaced("role").alias("role"),
                spaced("text").alias("text"),
                dropped.alias("dropped"),
            )
            .withColumns({"hash": F.xxhash64("text"), "id": F.monotonically_increasing_id()})
            .repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .select("conv_id", "turn", "role", "text", "dropped")
        )

        def run(source: Iterator[dict]) -> Iterator[dict]:
            automaton = RoleAutomaton()
            part = TaskContext.get().partitionId()
            number = 0

            def finished(conv_id, rows: list[dict]) -> dict:
                kept = [(row["role"], row["text"]) for row in rows]
                faults = faults_of(kept, digest_of, set())
                counts = Counts.of([row["turn"] for row in rows], kept, faults)
                front = parsed(automaton, 0, [(role[:1], fault) for (role, _), fault in zip(kept, faults)])
                cost, stack, added = least_end(automaton, front)
                letters, roles = front[stack][1] + INSERT * len(added), front[stack][2] + added
                text = "\n".join(lines_of(kept, letters, roles))
                names = ("gaps", "blank", "duplicate", "truncated", "illegal")
                report = dict(zip(names, counts.report())) | {"cost": cost, "audit": letters}
                return {"conv_id": conv_id, "part": part, "chunk": number, "repaired": text, "_weight": len(text), **report}

            def chunk(conv_id, rows: list[dict]) -> dict:
                weight = sum(len(row["text"]) for row in rows)
                return {"conv_id": conv_id, "part": part, "chunk": number, "rows": rows, "_weight": weight}

            # A conversation at an edge of the partition may go on beyond it.
            conv_id, at_edge, cut, waiting, chars = None, True, False, [], 0
            started = False
            for row in source:
                if started and row["conv_id"] != conv_id:
                    yield (chunk if at_edge or cut else finished)(conv_id, waiting)
                    number += 1
                    at_edge, cut, waiting, chars = False, False, [], 0
                elif started and (len(waiting) >= chunk_rows or chars >= chunk_chars):
                    yield chunk(conv_id, waiting)
                    number += 1
                    cut, waiting, chars = True, [], 0
                started, conv_id = True, row["conv_id"]
                if not row["dropped"]:
                    waiting.append({name: row[name] for name in ("turn", "role", "text")})
                    chars += len(row["text"])
            if started:
                yield chunk(conv_id, waiting)

        kind = (
            "conv_id conv, part int, chunk int, rows rows, repaired string, gaps long, blank long, duplicate long, "
            "truncated long, illegal long, cost long, audit string"
        )
        return self._map(ordered, run, kind)

    def _parsed(self, chunks: DataFrame) -> DataFrame:
        """Chunks with their faults, counts, and the least way from every stack to every stack."""

        def digests(source: Iterator[dict]) -> Iterator[dict]:
            for row in source:
                for digest in {digest_of((one["role"], one["text"])) for one in row["rows"]}:
                    yield {"conv_id": row["conv_id"], "part": row["part"], "chunk": row["chunk"], "digest": digest}

        # One row per chunk and different text, so that a text repeated through a long conversation is few rows.
        held = self._map(chunks.select("conv_id", "part", "chunk", "rows"), digests, "conv_id conv, part int, chunk int, digest binary")
        place = F.struct("part", "chunk")
        first = F.min(place).over(Window.partitionBy("conv_id", "digest"))
        seen = held.withColumn("earliest", first).where(place > F.col("earliest")).groupBy("part", "chunk").agg(F.collect_list("digest").alias("seen"))

        def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = RoleAutomaton()
            entries = reachable(automaton)
            for row in source:
                kept = [(one["role"], one["text"]) for one in row["rows"]]
                faults = faults_of(kept, digest_of, set(row["seen"] or ()))
                counts = Counts.of([one["turn"] for one in row["rows"]], kept, faults)
                items = [(role[:1], fault) for (role, _), fault in zip(kept, faults)]
                ways = [
                    {"before": entry, "after": after, "cost": cost, "letters": letters}
                    for entry in entries
                    for after, (cost, letters, _) in parsed(automaton, entry, items).items()
                ]
                yield {
                    "conv_id": row["conv_id"], "part": row["part"], "chunk": row["chunk"], "rows": row["rows"],
                    "faults": ",".join(faults), "ways": ways, "_weight": sum(len(text) for _, text in kept),
                    **dict(zip(Counts.FIELDS, counts.values())),
                }

        joined = chunks.select("conv_id", "part", "chunk", "rows").join(seen, ["part", "chunk"], "left")
        return self._map(joined, run, f"conv_id conv, part int, chunk int, rows rows, faults string, ways ways, {COUNTS}")

    def _string(self, chunks: DataFrame) -> DataFrame:
        """One row per conversation of several chunks: report, and for each chunk the stacks before and after it."""
        ordered = chunks.drop("rows", "faults").repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")

        def run(source: Iterator[dict]) -> Iterator[dict]:
            automaton = RoleAutomaton()
            reachable(automaton)
            for conv_id, rows in groupby(source, key=lambda row: row["conv_id"]):
                # Of each stack: the least way, and the chain of (chunk, stack before, stack after) it came by.
                front: dict[int, tuple[int, str]] = {0: (0, "")}
                chains: dict[int, tuple | None] = {0: None}
                counts = Counts()
                for row in rows:
                    counts.add(Counts(*(row[name] for name in Counts.FIELDS)))
                    after: dict[int, tuple[int, str]] = {}
                    came: dict[int, tuple] = {}
                    for way in row["ways"]:
                        before = way["before"]
                        if before not in front:
                            continue
                        reached = (front[before][0] + way["cost"], front[before][1] + way["letters"])
                        if way["after"] not in after or reached < after[way["after"]]:
                            after[way["after"]] = reached
                            came[way["after"]] = (chains[before], (row["part"], row["chunk"], before, way["after"]))
                    front, chains = after, came
                cost, stack, added = least_end(automaton, {stack: (*way, "") for stack, way in front.items()})
                steps, chain = [], chains[stack]
                while chain is not None:
                    chain, (part, number, before, after_) = chain
                    steps.append({"part": part, "chunk": number, "before": before, "after": after_, "added": "" if steps else added})
                report = dict(zip(("gaps", "blank", "duplicate", "truncated", "illegal"), counts.report()))
                yield {"conv_id": conv_id, "cost": cost, "audit": front[stack][1] + INSERT * len(added), "steps": steps[::-1], **report}

        return self._map(ordered, run, "conv_id conv, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, steps steps")

    def _write(self, chunks: DataFrame) -> DataFrame:
        steps = self._strung.select(F.explode("steps").alias("step")).select("step.*")

        def run(source: Iterator[dict]) -> Iterator[dict]:
            automaton = RoleAutomaton()
            reachable(automaton)
            for row in source:
                kept = [(one["role"], one["text"]) for one in row["rows"]]
                items = [(role[:1], fault) for (role, _), fault in zip(kept, row["faults"].split(","))]
                _, letters, roles = parsed(automaton, row["before"], items)[row["after"]]
                lines = lines_of(kept, letters + INSERT * len(row["added"]), roles + row["added"])
                text = "\n".join(lines) if lines else None
                yield {"conv_id": row["conv_id"], "part": row["part"], "chunk": row["chunk"], "repaired": text, "_weight": len(text or "")}

        joined = chunks.select("conv_id", "part", "chunk", "rows", "faults").join(steps, ["part", "chunk"])
        return self._map(joined, run, "conv_id conv, part int, chunk int, repaired string")

    def report(self) -> DataFrame:
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        return self._done.select(*names).unionByName(self._strung.select(*names))

    def texts(self) -> DataFrame:
        """A conversation of which nothing is left has an empty text or none."""
        return self._done.select("conv_id", "part", "chunk", "repaired").unionByName(self._written)

    def digested(self) -> DataFrame:
        """The report with ``repaired_sha256``, the digest of each whole repaired conversation."""

        def run(source: Iterator[dict]) -> Iterator[dict]:
            for conv_id, rows in groupby(source, key=lambda row: row["conv_id"]):
                digest, between = hashlib.sha256(), b""
                for row in rows:
                    if row["repaired"] is not None:
                        digest.update(between)
                        digest.update(row["repaired"].encode())
                        between = b"\n"
                yield {"conv_id": conv_id, "repaired_sha256": digest.hexdigest()}

        # A digest is made in order, but of chunks and not of rows, and as a stream.
        ordered = self._written.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")
        digests = self._map(ordered, run, "conv_id conv, repaired_sha256 string")
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        done = self._done.select(*names, F.sha2(F.col("repaired").cast("binary"), 256).alias("repaired_sha256"))
        digests = digests.withColumnRenamed("conv_id", "id")
        strung = self._strung.join(digests, F.col("conv_id").eqNullSafe(F.col("id"))).select(*names, "repaired_sha256")
        return done.unionByName(strung)


def reachable(automaton: RoleAutomaton) -> list[int]:
    """All stacks that any rows can lead to, numbered alike in every task."""
    found = [0]
    for stack in found:
        for initial in automaton.initials:
            found += [after for after in automaton.moves(stack, initial) if after not in found]
    return found
