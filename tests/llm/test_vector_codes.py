"""Operator 12: codes and codebooks against a plain k-means on Python integers."""

import math
import random

import numpy as np
import pytest

from gridspark.llm import vector_codes


def plain(rows, parts=8, entries=16, rounds=6):
    """(key, label, code, error) per kept row, and the codebooks."""
    fine = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    if not fine:
        return [], []
    sizes = [len(r[1]) for r in fine if len(r[1]) % parts == 0]
    dims = max(sorted(set(sizes)), key=sizes.count)
    fine = [r for r in fine if len(r[1]) == dims]
    step = dims // parts
    ints = [[math.floor(x * 4096) for x in r[1]] for r in fine]
    cut = [[tuple(v[p * step : (p + 1) * step]) for p in range(parts)] for v in ints]
    first = sorted(range(len(fine)), key=lambda i: (fine[i][0] is None, fine[i][0] or 0, fine[i][1]))
    first = [i for i in first if fine[i][0] is not None] or first
    books = [[cut[i][p] for i in first[:entries]] for p in range(parts)]

    def nearest(part, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), i) for i, e in enumerate(books[part]))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for v in cut:
                own.setdefault(nearest(p, v[p])[1], []).append(v[p])
            for e, members in own.items():
                books[p][e] = tuple(sum(x) // len(members) for x in zip(*members, strict=True))
    out = []
    for r, v in zip(fine, cut, strict=True):
        best = [nearest(p, v[p]) for p in range(parts)]
        out.append((r[0], r[2], bytes(i for _, i in best), sum(d for d, _ in best)))
    return out, books


def spark_rows(spark, rows, kind="float"):
    schema = f"vec_id long, embedding array<{kind}>, label int, code string, error string, key string"
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], schema)


def check(spark, rows, kind="float", **more):
    found = vector_codes.compressed(spark_rows(spark, rows, kind), **more)
    got = sorted(((r["key"], r["label"], bytes(r["code"]), r["error"]) for r in found.rows.collect()), key=repr)
    want, books = plain(rows, **more)
    assert got == sorted(want, key=repr)
    assert found.codebooks.tolist() == [[list(e) for e in part] for part in books] or not want
    return found


def test_random_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 0.2, (6, 16))
    rows = [
        (i, np.float32(centres[i % 6] + rng.normal(0, 0.05, 16)).tolist(), i % 3 if i % 7 else None)
        for i in range(400)
    ]
    check(spark, rows)
    check(spark, rows, entries=5, rounds=9)
    check(spark, rows, parts=4, entries=1, rounds=1)


def test_ties_repeats_and_rows_that_go(spark):
    rng = random.Random(2)
    grid = [[rng.choice([0.0, 0.25, -0.25, 0.125]) for _ in range(8)] for _ in range(60)]
    rows = [(i // 2, grid[i % 40], None) for i in range(90)]
    rows += [(None, grid[0], 1), (3, None, 1), (4, [], 1), (5, [0.5] * 16, 1), (6, [0.5] * 7 + [None], 1)]
    rows += [(-9, [float("nan")] + [0.0] * 7, 1), (-8, [float("inf")] + [0.0] * 7, 1), (-7, [0.5] * 7, 1)]
    check(spark, rows)
    check(spark, rows, kind="double")
    found = check(spark, rows, entries=3)
    errors = {(r["key"], bytes(r["code"])): r for r in vector_codes.label_errors(found.rows).collect()}
    none = sum(r["error"] for r in found.rows.collect() if r["label"] is None)
    assert errors[(None, bytes(plain(rows, entries=3)[0][-1][2]))]["label_error"] < none
    assert {r["label_error"] for r in errors.values() if r["key"] is not None} == {none}


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_rows(spark, n):
    rows = [(i, [i / 8.0] * 8, i) for i in range(n)]
    found = check(spark, rows)
    assert found.codebooks.shape[1] == min(n, 16)


def test_only_null_keys_and_huge_components(spark):
    rows = [(None, [float(i)] * 8, 0) for i in range(3)]
    assert vector_codes.compressed(spark_rows(spark, rows)).rows.count() == 3
    huge = vector_codes.compressed(spark_rows(spark, [(1, [3e38] * 8, 0), (2, [-3e38] * 8, 0)])).rows.collect()
    assert [r["error"] for r in huge] == [0, 0]


def test_bounds_hold_and_spare_distances():
    rng = np.random.default_rng(1)
    centres = rng.integers(-900, 900, (12, 1, 8))
    x = (centres[rng.integers(0, 12, 3000)] + rng.integers(-60, 60, (3000, 1, 8))).astype(np.int64)
    books = x[:16].transpose(1, 0, 2)
    history, state, scans = books[None], None, []
    for _ in range(7):
        state, scanned = vector_codes.assign(x, state, history)
        scans.append(scanned)
        exact = np.sqrt(vector_codes.squares(x[:, 0], history[-1][0]))
        entry = state["entry"][:, 0]
        assert (entry == exact.argmin(axis=1)).all()
        net, others = vector_codes.moves(history)
        at = np.arange(len(x))
        own = exact[at, entry]
        assert (state["upper"][:, 0] + net[state["upper_at"][:, 0], 0, entry] >= own - 1e-6).all()
        rest = exact.copy()
        rest[at, entry] = np.inf
        assert (state["lower"][:, 0] - others[state["lower_at"][:, 0], 0, entry] <= rest.min(axis=1) + 1e-6).all()
        sums = np.zeros_like(books)
        np.add.at(sums[0], entry, x[:, 0])
        books = vector_codes.averages(books, sums, np.bincount(entry, minlength=16)[None])
        history = np.concatenate([history, books[None]])
    assert scans[0] == 3000 and sum(scans[1:]) < 0.5 * 6 * 3000
    # The way from an entry's old place is at most what its single moves sum up to.
    steps = np.sqrt(((history[1:] - history[:-1]) ** 2).sum(axis=3)).sum(axis=0)
    assert (vector_codes.moves(history)[0][0] <= steps + 1e-6).all()


def test_hot_label_and_many_partitions(spark):
    rng = np.random.default_rng(8)
    rows = [(i, np.float32(rng.normal(0, 1, 8)).tolist(), 1 if i % 3 else i) for i in range(300)]
    df = spark_rows(spark, rows).repartition(23)
    got = sorted((r["key"], bytes(r["code"])) for r in vector_codes.compressed(df).rows.collect())
    assert got == sorted((k, c) for k, _, c, _ in plain(rows)[0])
