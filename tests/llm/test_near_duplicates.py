"""Operator 10: signatures estimate the similarity; classes against all pairs."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from gridspark.llm import bag_minhash, components, queries

SF = "/root/testdata/sf0.001"


def bag(text, size=5):
    words = (text or "").split()
    return Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else Counter()


def near(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def all_pairs(rows, least=0.8):
    """Class of each key: the smallest key that ties lead to."""
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "") or rows[i][0] == rows[j][0]
            if same or near(bags[i], bags[j]) >= least:
                parent[find(i)] = find(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), key), key)
    return {key: low[find(i)] for i, (key, _) in enumerate(rows)}


def test_similarity_is_estimated_without_bias():
    rng = random.Random(3)
    off = []
    for _ in range(80):
        a = [rng.choice("abcdefghijkl") for _ in range(rng.choice([6, 40, 400]))]
        b = list(a)
        for _ in range(rng.randint(0, max(1, len(a) // 20))):
            b[rng.randrange(len(b))] = rng.choice("xyz")
        hashes, of = bag_minhash.shingles([" ".join(a), " ".join(b)])
        rows = bag_minhash.signatures(hashes, of, 2)
        off.append((rows[0] == rows[1]).mean() - near(bag(" ".join(a)), bag(" ".join(b))))
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.05


@pytest.mark.parametrize("a, b", [(1000, 700), (3, 2), (5000, 4999), (64, 65)])
def test_weights_count(a, b):
    hashes = np.concatenate([np.full(a, 7, np.uint64), np.full(b, 7, np.uint64)])
    rows = bag_minhash.signatures(hashes, np.repeat([0, 1], [a, b]), 2, 1920)
    assert (rows[0] == rows[1]).mean() == pytest.approx(b / a if b < a else a / b, abs=0.05)


def test_a_signature_does_not_depend_on_its_batch():
    texts = [f"some words {i} and {i % 3} others again " * (i + 1) for i in range(20)]
    hashes, of = bag_minhash.shingles(texts)
    whole = bag_minhash.signatures(hashes, of, len(texts))
    for i, text in enumerate(texts):
        alone, one = bag_minhash.shingles([text])
        assert (bag_minhash.signatures(alone, one, 1)[0] == whole[i]).all()


def test_multisets_as_sets():
    texts = ["a b c d e " * 9, "a b c d e " * 7, "", "x", "x y", "x", None or ""]
    hashes, of = bag_minhash.shingles(texts)
    elements, owner = bag_minhash.occurrences(hashes, of)
    sets = [set(elements[owner == i].tolist()) for i in range(len(texts))]
    for i, a in enumerate(texts):
        assert len(sets[i]) == sum(bag(a).values())
        for j, b in enumerate(texts):
            assert len(sets[i] & sets[j]) == sum((bag(a) & bag(b)).values())


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in parent}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_chains_and_odd_rows(spark):
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10_000)}"
    rows = []
    for group in range(6):
        base = [word() for _ in range(rng.choice([30, 120]))]
        for _ in range(12):  # each a little further from the first: chains, not only stars
            rows.append((len(rows), " ".join(base)))
            at = rng.randrange(len(base) - 1)
            base[at : at + 1] = [word()]
    rows += [(100, None), (101, ""), (102, " "), (103, "one"), (104, "one"), (105, "one two"), (106, "rep " * 500), (107, "rep " * 480)]
    rows += [(108, "the very same words here"), (108, "something else in another row")]
    df = spark.createDataFrame([(k, t, 0) for k, t in rows], "doc_id long, text string, class_id int")
    got = bag_minhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["class_id"] for r in got} == {**all_pairs(rows), 102: 102}


def test_null_keys_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a"), (1, "a")], "doc_id long, text string")
    assert {tuple(r) for r in bag_minhash.near_duplicates(df).collect()} == {(None, None), (1, 1)}
    assert bag_minhash.near_duplicates(df.limit(0)).collect() == []


def test_op10(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: r["class_id"] for r in queries.QUERIES["op10_bag_minhash"](spark, SF).collect()}
    assert got == all_pairs(rows) and len(set(got.values())) < len(rows)


def test_a_key_of_several_texts_has_the_near_copies_of_each(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(200)) for x in "ab")
    rows = [(1, one), (1, two), (2, one + " end"), (3, two + " end"), (4, "something else altogether")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in bag_minhash.near_duplicates(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_signatures_need_little_memory():
    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, rng.integers(0, 1000, 700))) for _ in range(300)]
    hashes, doc = bag_minhash.shingles(texts)
    tracemalloc.start()
    rows = bag_minhash.signatures(hashes, doc, len(texts), bag_minhash.LONG_SLOTS)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 250 << 20
    # Each text alone is one portion.
    for i in (0, 299):
        alone, one = bag_minhash.shingles([texts[i]])
        assert (bag_minhash.signatures(alone, one, 1, bag_minhash.LONG_SLOTS)[0] == rows[i]).all()
