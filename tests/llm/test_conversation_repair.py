"""Conversation repair against a search over all edits, and the query against a plain remake of its contract."""

import hashlib
import random
import re
import zlib

import pytest

from fillmetrics.llm import conversation_repair as cr

ROLES = {"s": "system", "u": "user", "a": "assistant"}
NEXT = {"": {"s": "S", "u": "U"}, "S": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}


def least_edits(items):
    """Least (cost, audit, roles) over all edits, by trying everything that costs no more than the best so far."""
    best = [(2 * len(items), "D" * len(items), "-" * len(items))]

    def go(at, state, cost, audit, roles):
        if cost > best[0][0]:
            return
        if at == len(items) and state in ("", "A"):
            best[0] = min(best[0], (cost, audit, roles))
        for role, after in NEXT[state].items():
            if role != "s":
                go(at, after, cost + 5, audit + "I", roles + role)
        if at < len(items):
            initial, fault = items[at]
            go(at + 1, state, cost + 2, audit + "D", roles + "-")
            if fault not in ("blank", "duplicate"):
                more = 5 if fault else 0
                for role, after in NEXT[state].items():
                    if role == initial:
                        go(at + 1, after, cost + more, audit + "K", roles + role)
                    if role != "s":
                        go(at + 1, after, cost + more + 1, audit + "R", roles + role)

    go(0, "", 0, "", "")
    return best[0]


def test_parser_finds_the_least_edits():
    random.seed(5)
    automaton = cr.RoleAutomaton()
    for _ in range(1500):
        items = [(random.choice("suuaax"), random.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(random.randint(0, 8))]
        front = cr.parsed(automaton, 0, items)
        cost, stack, added = cr.least_end(automaton, front)
        roles = front[stack][2] + added
        assert (cost, front[stack][1] + "I" * len(added)) == least_edits(items)[:2], items
        assert re.fullmatch("(s?(ua)+)?", roles.replace("-", ""))


def test_stacks_of_another_grammar():
    """Balanced brackets need a stack; the automaton is made from the rules alone."""
    automaton = cr.RoleAutomaton((("C", ""), ("C", "CB"), ("B", "xCy")))
    random.seed(1)
    for _ in range(300):
        word = "".join(random.choices("xy", k=random.randint(0, 8)))
        stacks, depth, legal = {0}, 0, True
        for letter in word:
            stacks = {after for stack in stacks for after in automaton.moves(stack, letter)}
            depth += 1 if letter == "x" else -1
            legal &= depth >= 0
        assert any(map(automaton.accepts, stacks)) == (legal and depth == 0), word


def remade(rows):
    """One conversation's result, from its rows (turn, role, text) in order."""
    rows = [(turn, role if role is not None else " ", text if text is not None else " ") for turn, role, text in rows]
    faults, known = [], set()
    for _, role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not core else "duplicate" if (role, text) in known else "truncated" if core[-1] not in ".!?" else ""
        faults.append(fault)
        known.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    cost, audit, roles = least_edits(list(zip(initials, faults)))
    lines, following = [], iter(rows)
    for edit, initial in zip(audit, roles):
        if edit == "I":
            lines.append(ROLES[initial] + ":")
            continue
        _, role, text = next(following)
        if edit != "D":
            lines.append(f"{ROLES[initial] if edit == 'R' else role}:{text}")
    turns = [turn for turn, _, _ in rows if turn is not None]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[faults.count(fault) for fault in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def damage(rows):
    """conv_id -> rows after damage, in order of turn."""
    found = {}
    for conv, turn, role, text in rows:
        name = lambda value: " " if value is None else str(value)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = (" " if value is None else value for value in (role, text))
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        found.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    for rows_ in found.values():
        rows_.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1]))
    return found


def results(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    assert len({row.conv_id for row in rows}) == len(rows)
    return {row.conv_id: tuple(row[name] for name in names) for row in rows}


def test_query(spark, sf):
    from fillmetrics.llm import registry
    from fillmetrics.llm.common import table

    rows = [tuple(row) for row in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert results(registry.op13_conversation_repair(spark, sf)) == {conv: remade(found) for conv, found in damage(rows).items()}


SCHEMA = "conv_id long, turn long, role string, text string, audit string, rows string"


def awkward_rows(seed, number, conversations):
    random.seed(seed)
    roles = ["system", "user", "user", "assistant", "assistant", None, "", "tool"]
    rows = []
    for turn in range(number):
        text = random.choice([None, "", " \x0b", "Yes.", "No", "Yes.", f"text {turn}.", f"text {turn}! ", f"open {turn}"])
        rows.append((random.choice(conversations), random.choice([turn, turn, turn, None]), random.choice(roles), text))
    return rows


@pytest.mark.parametrize("chunk_rows", [1, 2, 3, 1000])
def test_chunks_of_any_size_give_the_same(spark, chunk_rows):
    """Nulls in every column, empty roles, one conversation with most rows, chunks of it in several partitions."""
    rows = awkward_rows(chunk_rows, 60, [1, 1, 1, 1, 2, 3, None])
    # Rows that tie in turn and role have no order but that of a hash, so each turn and role is there once.
    rows = list({(row[0], row[1], row[2] if row[2] is not None else " "): row for row in rows}.values())
    df = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA).repartition(3)
    expected = {}
    for conv in {row[0] for row in rows}:
        mine = [(turn, role if role is not None else " ", text) for c, turn, role, text in rows if c == conv]
        mine.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1]))
        expected[conv] = dp_remade(mine)
    repair = cr.Repair(df, chunk_rows=chunk_rows)
    assert results(repair.digested()) == expected
    lines = {}
    for row in sorted(repair.texts().collect(), key=lambda row: (row.part, row.chunk)):
        lines.setdefault(row.conv_id, []).extend([] if row.repaired is None else [row.repaired])
    for conv, parts in lines.items():
        assert hashlib.sha256("\n".join(parts).encode()).hexdigest() == expected[conv][-1]


def dp_remade(rows):
    """Like remade, for conversations too long to try all edits: least (cost, audit, roles) by place and state."""
    items = []
    global least_edits
    plain = least_edits

    def least_by_state(items):
        front = {"": (0, "", "")}

        def closed(front):
            for _ in range(4):
                for state, (cost, audit, roles) in list(front.items()):
                    for role, after in NEXT[state].items():
                        if role != "s":
                            way = (cost + 5, audit + "I", roles + role)
                            if after not in front or way < front[after]:
                                front[after] = way
            return front

        for initial, fault in items:
            after = {}
            for state, (cost, audit, roles) in closed(front).items():
                ways = [(state, (cost + 2, audit + "D", roles + "-"))]
                if fault not in ("blank", "duplicate"):
                    more = 5 if fault else 0
                    for role, next_state in NEXT[state].items():
                        if role == initial:
                            ways.append((next_state, (cost + more, audit + "K", roles + role)))
                        if role != "s":
                            ways.append((next_state, (cost + more + 1, audit + "R", roles + role)))
                for next_state, way in ways:
                    if next_state not in after or way < after[next_state]:
                        after[next_state] = way
            front = after
        front = closed(front)
        return min(front[state] for state in ("", "A") if state in front)

    least_edits = least_by_state
    try:
        return remade(rows)
    finally:
        least_edits = plain


def test_rows_all_dropped_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string, dropped boolean"
    df = spark.createDataFrame([(7, 1, "user", "a.", True), (7, 2, "user", "a.", True)], schema)
    empty = hashlib.sha256(b"").hexdigest()
    assert results(cr.Repair(df).digested()) == {7: (0, 0, 0, 0, 0, 0, "", empty)}
    assert results(cr.Repair(df.limit(0)).digested()) == {}
    assert results(cr.Repair(cr.damaged(df.drop("dropped").limit(0))).digested()) == {}


def test_repeated_rows_are_duplicates(spark):
    rows = [(1, 5, "user", "Same."), (1, 5, "user", "Same."), (1, 5, "user", "Same."), (1, 6, "assistant", "Fine.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for chunk_rows in (1, 2, 1000):
        row = cr.Repair(df, chunk_rows=chunk_rows).digested().first()
        assert (row.duplicate, row.audit, row.cost) == (2, "KDDK", 4)
