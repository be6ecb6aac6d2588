import random
import zlib
from collections import defaultdict
from functools import cache
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from matchstats.llm import audits, conversations

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
VALID = {"", *("s" * n + "ua" * k for n in (0, 1) for k in range(1, 40))}


def fits(initials):
    """Whether role initials can still become a valid sequence."""
    return any(v.startswith(initials) for v in VALID)


def every_audit(rows, cost_limit):
    """Costs and audits of all edits within a cost, rows being (initial, fault)."""
    found = []

    def go(at, roles, cost, audit):
        if cost > cost_limit or not fits(roles):
            return
        if at == len(rows) and roles in VALID:
            found.append((cost, audit))
        for role in "ua":
            go(at, roles + role, cost + 5, audit + "I")
        if at == len(rows):
            return
        initial, fault = rows[at]
        go(at + 1, roles, cost + 2, audit + "D")
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            go(at + 1, roles + initial, cost + more, audit + "K")
            for role in "ua":
                go(at + 1, roles + role, cost + 1 + more, audit + "R")

    go(0, "", 0, "")
    return min(found)


def plain_audit(rows):
    """The same by comparing whole audits: for each row and place in the pattern the least one."""

    @cache
    def follows(roles_state):
        return {"": "su", "s": "u", "u": "a", "a": "u"}[roles_state]

    held = {"": (0, "")}

    def inserts(held):
        for _ in range(3):
            for state, (cost, audit) in list(held.items()):
                for role in follows(state).replace("s", ""):
                    offer = (cost + 5, audit + "I")
                    held[role] = min(held.get(role, offer), offer)
        return held

    held = inserts(held)
    for initial, fault in rows:
        after = {}

        def offer(state, cost, audit, after=after):
            after[state] = min(after.get(state, (cost, audit)), (cost, audit))

        for state, (cost, audit) in held.items():
            offer(state, cost + 2, audit + "D")
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if initial in follows(state) and initial:
                offer(initial, cost + more, audit + "K")
            for role in follows(state).replace("s", ""):
                offer(role, cost + 1 + more, audit + "R")
        held = inserts(after)
    return min(held[state] for state in ("", "a") if state in held)


def damage(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        if kind == 4:
            role = "user"
        for _ in range({0: 0, 3: 2}.get(kind, 1)):
            yield conv, turn, role, text


def by_hand(rows):
    """Expected rows; those of a turn are told apart by role and text alone where they tie."""
    found, groups = [], defaultdict(list)
    for row in damage(rows):
        groups[row[0]].append(row)
    import hashlib

    for conv in {r[0] for r in rows}:
        own = sorted(groups[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text in own:
            body = text.rstrip(WHITE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "fine"
            seen.add((role, text))
            faults.append(fault)
        initials = [r[2][:1] for r in own]
        cost, audit = plain_audit(list(zip(initials, faults, strict=True)))
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        out, left = [], list(own)
        for edit in audit:
            _, _, role, text = (None, None, None, "") if edit == "I" else left.pop(0)
            if edit in "IR":
                role = "assistant" if out and out[-1][0][:1] == "u" else "user"
            if edit != "D":
                out.append((role, text))
        digest = sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        found.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(found, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def query(spark, rows, monkeypatch, piece=None, more=()):
    given = spark.createDataFrame(rows, SCHEMA)
    for name in more:
        given = given.withColumn(name, F.lit("x"))
    monkeypatch.setattr(conversations, "table", lambda *_: given.repartition(3))
    if piece:
        whole = conversations.repairs
        monkeypatch.setattr(conversations, "repairs", lambda rows: whole(rows, piece))
    return sorted((tuple(r) for r in conversations.op11_conversation_repair(spark, "").select(COLUMNS).collect()), key=str)


KINDS = {"s": 0, "u": 1, "a": 2, "x": 3}
FAULTS = {"fine": 0, "blank": 1, "duplicate": 2, "truncated": 3}


def solved(rows, pieces=1, modulus=audits._MODULUS):
    chain, size = audits.Chain(), -(-len(rows) // pieces) or 1
    for at in range(0, len(rows), size):
        part = rows[at : at + size]
        kinds, faults = bytes(KINDS[k] for k, _ in part), bytes(FAULTS[f] for _, f in part)
        chain.add({state: audits.solve(kinds, faults, state, modulus) for state in audits.STATES})
    return chain.ended()


@pytest.mark.parametrize("seed", range(60))
def test_audit_is_the_least_of_the_cheapest(seed):
    draw = random.Random(seed)
    rows = [(draw.choice("suaauux"), draw.choice(["fine"] * 5 + list(FAULTS))) for _ in range(draw.randint(0, 6))]
    wanted = plain_audit(rows)
    assert wanted == every_audit(rows, wanted[0])
    assert solved(rows) == solved(rows, 2) == solved(rows, len(rows) or 1) == wanted


@pytest.mark.parametrize("modulus", [1, 2, 5, 251, audits._MODULUS])
def test_long_audits_with_ties_and_collisions(modulus):
    for seed in range(12):
        draw = random.Random(seed)
        choice = ["x", "ua", "uuaa", "suax", "uau", "sx"][seed % 6]
        rows = [(draw.choice(choice), draw.choice(["fine"] * 8 + list(FAULTS)) if seed > 5 else "fine") for _ in range(300)]
        wanted = plain_audit(rows)
        for pieces in (1, 3, 40):
            assert solved(rows, pieces, modulus) == wanted


def test_common_prefixes():
    store, draw = audits.Audits(7), random.Random(1)
    nodes = [0]
    for _ in range(400):
        nodes.append(store.extended(draw.choice(nodes[-40:]), draw.choice("DIKR")))
    for _ in range(2000):
        a, b = draw.choice(nodes), draw.choice(nodes)
        x, y = store.text(a), store.text(b)
        same = next((n for n, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
        assert store.common(a, b) == same and store.less(a, b) == (x < y)


def odd_rows():
    draw = random.Random(5)
    said = ["Yes.", "No!", "What?", "and then", "", " ", "\n\t", "Yes.", "long " * 3000 + ".", "é。", "end.\x0b\x0c"]
    rows = []
    for conv in range(60):
        for turn in range(draw.randint(0, 9)):
            rows.append((conv, turn * draw.choice([1, 1, 1, 2]), draw.choice(["system", "user", "assistant", "user", "assistant", "tool"]), draw.choice(said)))
    rows += [(None, None, None, None), (None, None, None, None), (None, 3, "user", "Hi."), (None, 4, "assistant", None)]
    rows += [(100, None, "user", "a."), (100, None, "", "b."), (100, -5, None, "c."), (100, 2**40, "assistant", "d.")]
    rows += [(101, n, "user", "same.") for n in range(40)] + [(102, 7, "user", "same.")] * 30
    return rows


@pytest.mark.parametrize("piece", [None, 1, 2, 5])
def test_query_on_odd_conversations(spark, piece, monkeypatch):
    rows = odd_rows()
    found = query(spark, rows, monkeypatch, piece, ("audit", "cost", "_key", "a.b", "_step"))
    assert found == by_hand(rows)


def test_query_on_a_long_conversation(spark, monkeypatch):
    draw = random.Random(2)
    rows = [(1, n, draw.choice(["user", "assistant", "tool"]), draw.choice(["Yes.", "no", f"Line {n}."])) for n in range(3000)]
    rows += [(n, 0, "user", "Hm.") for n in range(2, 40)]
    assert query(spark, rows, monkeypatch, 100) == by_hand(rows)


def test_given_conversations(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = conversations.op11_conversation_repair(spark, path).select(COLUMNS).collect()
    assert sorted(map(tuple, found), key=str) == by_hand(rows)


def test_conversations_of_which_nothing_is_left(spark, monkeypatch):
    gone = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi.")]
    nothing = sha256().hexdigest()
    assert query(spark, rows, monkeypatch) == [(gone, 0, 0, 0, 0, 0, 0, "", nothing)] == by_hand(rows)


def test_no_conversations(spark, monkeypatch):
    assert query(spark, [], monkeypatch) == []
