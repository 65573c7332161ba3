"""Operator 11: components and sizes against all pairs."""

import random
import re

import numpy as np
import pytest

from gridspark.llm import ngram_join, queries

SF = "/root/testdata/sf0.001"


def shingles(text, size=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def all_pairs(rows, least=85):
    """Size and component of each row, in order."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if rows[i][0] is None or rows[j][0] is None or not a or not b:
                continue
            if rows[i][0] == rows[j][0] or 100 * len(a & b) >= least * len(a | b):
                parent[find(i)] = find(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[find(i)] = min(low.get(find(i), key), key)
    return sorted(((k, len(s), None if k is None else low[find(i)]) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def found(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], "doc_id long, text string, node string, columns string, root string, n int")
    return sorted((tuple(r) for r in ngram_join.joined(df, **more).collect()), key=repr)


def test_bounds_of_sizes():
    """What a linked pair of any sizes has in common in first blocks, and that it meets in the rarest."""
    for least in (85, 70, 95):
        for a in range(1, 420):
            for b in range(a, a * 100 // least + 1):
                if a == b and (a - 1) * 100 < least * (a + 1):
                    continue  # only equal sets
                out = max(n - int(ngram_join.first_block(np.array(n), least)) for n in (a, b))
                shared = ngram_join.need(a, b, least) - out
                assert shared >= max(int(ngram_join.in_common(np.array(n), least)) for n in (a, b)) or not least * b <= 100 * a


def test_components(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows = []

    def add(words):
        rows.append((len(rows) * 3 % 997 + 1000 * (len(rows) % 2), " ".join(words)))

    passage = [rng.choice(vocabulary) for _ in range(60)]
    for n in (3, 9, 10, 12, 20, 40, 90, 200):
        base = [rng.choice(vocabulary) for _ in range(n)]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, n // 40))):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 1)
            add(copy)
        add(base[: n * 9 // 10])
        add(base + passage)
    for _ in range(30):
        add([rng.choice(vocabulary) for _ in range(60)] + passage + [rng.choice(vocabulary) for _ in range(5)])
    chain = [rng.choice(vocabulary) for _ in range(300)]
    for i in range(0, 200, 6):
        add(chain[i : i + 100])
    assert found(spark, rows) == all_pairs(rows)
    assert found(spark, rows, least=70) == all_pairs(rows, 70)


def test_edges(spark):
    long = " ".join(f"x{i % 9000}" for i in range(30000))
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a"), (5, "A"), (6, "a b c"), (7, "a b c d"), (8, "a b c d"),
        (9, "a b c d"), (9, "a b c d"), (9, "other words in here today"), (10, "OTHER words in here\x1ftoday"), (11, "other\twords in HERE today"),
        (None, "a b c d"), (None, None), (12, "Ärger mit A B"), (13, "ärger mit a b"), (14, "Ärger mit a b"),
        (15, long), (16, long + " more"), (17, long), (0, ""), (18, "a b c d a b c d a b c d"),
    ]
    rows += [(40, " ".join(f"q{i}" for i in range(9))), (41, " ".join(f"q{i}" for i in range(10)))]
    assert found(spark, rows) == all_pairs(rows)
    assert found(spark, []) == []
    assert found(spark, [(1, None)]) == [(1, 0, 1)]


def test_many_copies_and_near_copies(spark):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join(base)) for i in range(0, 150)]
    for i in range(150, 300):
        copy = list(base)
        copy[rng.randrange(120)] = f"new{i}"
        rows.append((i, " ".join(copy)))
    rows += [(400 + i, " ".join([f"s{i}_{j}" for j in range(110)] + base[:30])) for i in range(40)]
    assert found(spark, rows) == all_pairs(rows)


def test_blocks_of_a_column_in_many_parts(spark, monkeypatch):
    """Copies that are no links of each other but for some, in parts of few rows."""
    monkeypatch.setattr(ngram_join, "PART_ROWS", 7)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(160):
        copy = list(base)
        for at in rng.sample(range(100), 4):
            copy[at] = f"n{i}_{at}"
        rows.append((i, " ".join(copy)))
        if i % 5 == 0:
            copy[rng.randrange(100)] = "other"
            rows.append((1000 - i, " ".join(copy)))
    assert found(spark, rows) == all_pairs(rows)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        assert found(spark, rows) == all_pairs(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.mark.parametrize("sf_dir", [SF])
def test_given_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.QUERIES["op11_ngram_join"](spark, sf_dir).collect()), key=repr)
    assert got == all_pairs(rows)
