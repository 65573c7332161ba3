"""Operator 13: repairs against a search over all edits, row by row."""

import hashlib
import random
import re
import zlib
from functools import cache

import numpy as np
import pytest

from gridspark.llm import conversation_repair, queries

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, hashlib.md5(text.encode()).digest())


def plain(rows):
    """gaps, faults, illegal, cost, audit and hash of one conversation's (turn, role, text)."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=order)
    faults, seen = [], set()
    for _, role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        kind = "blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated"
        faults.append(kind)
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    due = {"": "u", "s": "u", "u": "a", "a": "u"}

    @cache
    def straight(i, state):
        """Cost and letters from row i on, after a turn of that initial, if no insert comes next."""
        ways = [(10**9, "")]
        if i == len(rows) and state in ("", "a"):
            ways.append((0, ""))
        if i < len(rows):
            cost, letters = best(i + 1, state)
            ways.append((cost + 3, "D" + letters))
            if faults[i] in ("", "truncated"):
                more = faults[i] == "truncated"
                if initials[i] == due[state] or (initials[i] == "s" and state == ""):
                    cost, letters = best(i + 1, initials[i])
                    ways.append((cost + more, "K" + letters))
                cost, letters = best(i + 1, due[state])
                ways.append((cost + 2 + more, "R" + letters))
        return min(ways)

    @cache
    def best(i, state):
        ways, prefix = [straight(i, state)], ""
        for _ in range(3):
            state, prefix = due[state], prefix + "I"
            cost, letters = straight(i, state)
            ways.append((cost + 2 * len(prefix), prefix + letters))
        return min(ways)

    for i in range(len(rows), -1, -1):
        for state in ("", "s", "u", "a"):
            best(i, state)
    cost, audit = best(0, "")
    lines, i, state = [], 0, ""
    names = {"u": "user", "a": "assistant"}
    for letter in audit:
        if letter == "I":
            state = due[state]
            lines.append(f"{names[state]}:")
            continue
        _, role, text = rows[i]
        i += 1
        if letter == "K":
            state = role[0]
            lines.append(f"{role}:{text}")
        elif letter == "R":
            state = due[state]
            lines.append(f"{names[state]}:{text}")
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def by_conversation(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(tuple(row))
    return out


def got(spark, rows):
    schema = "conv_id long, turn long, role string, text string, conv string, part int, k int, audit string"
    found = conversation_repair.repaired(spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], schema))
    hashes = {r["conv"]: r["sha256"] for r in conversation_repair.digests(found.turns).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return {r["conv"]: (*[r[n] for n in names], hashes.get(r["conv"], empty)) for r in found.conversations.collect()}


def random_rows(rng, conv, n):
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", "User", None]
    texts = ["Yes.", "No!", "Why?", "cut", "", " \n", "tail. ", "é", None, "x" * 50 + "."]
    weights = rng.choice([None, [1, 8, 8, 8, 8, 1, 0, 0, 0]])
    return [
        (conv, rng.choice([None, i, i, i, rng.randrange(n + 1)]), rng.choices(roles, weights)[0],
         rng.choice([f"Turn {i}.", f"turn {i}", rng.choice(texts)]))
        for i in range(n)
    ]


def test_random_conversations(spark):
    rng = random.Random(11)
    rows = [r for conv in range(300) for r in random_rows(rng, conv, rng.randint(1, 14))]
    rows += random_rows(rng, None, 9) + [(-5, None, None, None), (-6, 3, "user", "Hi."), (-7, 1, "system", "Be kind.")]
    rng.shuffle(rows)
    want = {conv: plain(own) for conv, own in by_conversation(rows).items()}
    assert got(spark, rows) == want


def test_long_conversation_in_many_runs(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "RUN", 7)
    rng = random.Random(3)
    rows = [r for conv in range(4) for r in random_rows(rng, conv, (400, 1, 90, 250)[conv])]
    rows += [(9, 1, "user", "the same")] * 40
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "33")
    try:
        assert got(spark, rows) == {conv: plain(own) for conv, own in by_conversation(rows).items()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_empty_table_and_long_text(spark):
    assert got(spark, []) == {}
    rows = [(1, 0, "user", "word " * 200_000), (1, 1, "assistant", " " * 500_000 + "."), (1, 2, "user", "\n" * 300_000)]
    assert got(spark, rows) == {1: plain([r[1:] for r in rows])}


def test_runs_are_matrices():
    """Putting matrices of parts together gives the costs of the whole."""
    rng = np.random.default_rng(6)
    codes = rng.choice([0, 1, 2, 3, 9, 10, 4, 21], (50, 24)).astype(np.uint8)
    ends = np.tile(conversation_repair.AT_END, (50, 1))
    want = ends
    for at in reversed(range(24)):
        want = conversation_repair.back(want, codes[:, at])
    first, second = conversation_repair.matrices(codes[:, :10]), conversation_repair.matrices(codes[:, 10:])
    middle = (second + ends[:, :, None]).min(axis=1)
    assert ((first + middle[:, :, None]).min(axis=1) == want).all()


def damage(rows):
    out = []
    one = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            row = (conv, turn, "user" if kind == 4 else role, text)
            out += [row] * (2 if kind == 3 else 1)
    return out


@pytest.mark.parametrize("sf_dir", [SF])
def test_given_conversations(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left = by_conversation(damage(given))
    want = {conv: plain(left.get(conv, [])) for conv in {r[0] for r in given}}
    found = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op13_conversation_repair"](spark, sf_dir).collect()}
    assert found == want


def test_damage_of_nulls(spark):
    rows = [(c, t, r, x) for c in (None, 1, 7) for t in (None, *range(30)) for r, x in ((None, "A. b!"), ("user", None))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(repr, map(tuple, conversation_repair.damaged(df).collect()))) == sorted(map(repr, damage(rows)))
