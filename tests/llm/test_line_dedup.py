"""Operator 6 against a direct search for repeated windows, and the query against its SQL."""

import random
import re

import pytest
from compare import bag, duck

from gridspark.llm import line_dedup, queries

SF = "/root/testdata/sf0.001"
LEAST = line_dedup.MIN_WORDS


def direct(rows, least=LEAST):
    """Remaining text of each (key, text), by comparing the lines of all windows."""
    lines = [(t or "").split("\n") for _, t in rows]
    windows = []
    for d, own in enumerate(lines):
        units = [(i, len(re.findall(r"\S+", x))) for i, x in enumerate(own)]
        units = [(i, n) for i, n in units if n]
        spans = set()
        for a in range(len(units)):
            for step in (1, -1):
                b, words = a, 0
                while 0 <= b < len(units):
                    words += units[b][1]
                    if words >= least:
                        spans.add((min(a, b), max(a, b)))
                        break
                    b += step
        for a, b in spans:
            content = tuple(own[i] for i, _ in units[a : b + 1])
            windows.append((content, d, units[a][0], units[b][0]))
    first, gone = {}, [set() for _ in rows]
    for content, d, begin, end in sorted(windows, key=lambda w: w[1:]):
        if content not in first:
            first[content] = (d, end)
            continue
        of, stop = first[content]
        gone[d] |= set(range(max(begin, stop + 1) if of == d else begin, end + 1))
    return ["\n".join(x for i, x in enumerate(own) if i not in g) for own, g in zip(lines, gone, strict=True)]


def docs(spark, rows):
    return spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, n_lines int, `begin` string")


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 2, 4, 9, 12]))) for _ in range(12)]
    passages = [[rng.choice(pool) for _ in range(rng.randint(1, 6))] for _ in range(6)]
    rows = []
    for key in range(40):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(pool) + f" {key}", "", rng.choice(pool)]
        rows.append((key, "\n".join(parts)))
    got = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(docs(spark, rows)).collect()}
    assert [got[k] for k, _ in rows] == direct(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(LEAST))
    rows = [(3, long + "\nown words"), (None, long), (5, f"a\n\n{long}\n \nb"), (6, None), (7, ""), (8, "\n" * 3), (9, "short"), (10, "short"),
            (11, "\n".join([long + "!"] * 500)), (12, "漢 " * 50_000)]
    got = line_dedup.deduplicated(docs(spark, rows))
    assert sorted(got.columns) == sorted(["doc_id", "begin", "text", "n_lines", "n_removed"])
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in got.collect()}
    assert got[None] == (long, 1, 0)
    assert got[3] == ("own words", 2, 1) and got[5] == ("a\n\n \nb", 5, 1)
    assert got[6] == ("", 0, 0) and got[7] == ("", 0, 0) and got[8] == ("\n" * 3, 4, 0)
    assert got[9][0] == got[10][0] == "short"
    assert got[11] == (long + "!", 500, 499) and got[12] == ("漢 " * 50_000, 1, 0)


def test_repeated_rows_and_keys(spark):
    long = " ".join(f"w{i}" for i in range(LEAST))
    rows = [(1, long), (1, long), (1, long + "\nmore"), (2, long)]
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.deduplicated(docs(spark, rows)).collect())
    assert len(got) == 4 and got[3] == (2, "")
    assert [t for k, t in got if k == 1].count(long) in (0, 2)
    assert any(long in t for _, t in got)
    assert line_dedup.deduplicated(docs(spark, [])).collect() == []


def test_plan_is_native(spark):
    plan = line_dedup.deduplicated(docs(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_op6_and_its_sql(spark):
    df = queries.QUERIES["op6_line_dedup"](spark, SF)
    result = duck(SF).execute(queries.ORACLES["op6_line_dedup"])
    names = [c[0] for c in result.description]
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(names, result.fetchall())


def test_very_long_file(spark):
    """Time in proportion to the lines: 200,000 of them, then the same once more after other text."""
    lines = [f"line number {i} has some words of its own" for i in range(200_000)]
    rows = [(1, "\n".join(lines)), (2, "before\n" + "\n".join(lines[50_000:150_000]) + "\nbehind"), (3, "\n".join(lines[:3] * 30_000))]
    got = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(docs(spark, rows)).collect()}
    assert got == {1: rows[0][1], 2: "before\nbehind", 3: ""}
