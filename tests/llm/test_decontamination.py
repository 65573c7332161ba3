"""Operator 5 against Sellers' algorithm on every text and item."""

import random

import pytest

from gridspark.llm import qgram_filter, queries

SF = "/root/testdata/sf0.001"


def edits(item, text):
    """Fewest edits of `item` against any part of `text`."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, x in enumerate(text):
            new.append(min(row[j] + (c != x), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_planted_with_edits():
    rng = random.Random(7)
    words = [f"w{i}o{i * i % 11}" for i in range(80)] + ["the", "of", "and"] * 10
    passage = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, passage(rng.randint(4, 40))) for i in range(25)]
    prepared = qgram_filter.items_of(items)
    texts = []
    for _ in range(80):
        chars = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, max(1, len(chars) // 7))):
            at = rng.randrange(len(chars))
            rng.choice([lambda: chars.insert(at, "x"), lambda: chars.__setitem__(at, "y"), lambda: len(chars) > 1 and chars.pop(at)])()
        texts.append(rng.choice(["", passage(30) + "\n"]) + "".join(chars).upper() + rng.choice(["", " " + passage(20)]))
    hits = qgram_filter.hits_of(texts, prepared)
    for text, found in zip(texts, hits, strict=True):
        want = {}
        for i, item in items:
            n = edits(item, qgram_filter.folded(text))
            if n <= len(item) // 10:
                want[i] = n
        best = {}
        for h in found:
            best[h["item_id"]] = min(h["edits"], best.get(h["item_id"], 99))
        assert best == want
        for h in found:
            own = qgram_filter.folded(text[h["begin"] : h["end"]])
            assert edits(dict(items)[h["item_id"]], own) == h["edits"]


@pytest.mark.parametrize("size", [*range(8, 44), 50, 57, 64, 70, 79, 80, 81, 90, 99, 100, 101, 110, 119, 120])
def test_every_length_at_the_full_budget(size):
    rng = random.Random(size)
    letters = "abcdefghijklmnopqrstuvwxyz"
    item = "".join(rng.choice(letters) for _ in range(size))
    budget = size // 10
    prepared = qgram_filter.items_of([(1, item)])
    for n in range(budget + 2):
        for _ in range(6):
            texts, spread = [], sorted(rng.sample(range(size), min(n, size)))
            for kind in ("put", "set", "pop"):
                chars = list(item)
                for at in reversed(spread):
                    if kind == "put":
                        chars.insert(at, "9")
                    elif kind == "set":
                        chars[at] = "9"
                    else:
                        chars.pop(at)
                texts.append("".join(rng.choice(letters) for _ in range(rng.choice([0, 50]))) + "".join(chars) + "zz")
            for text, found in zip(texts, qgram_filter.hits_of(texts, prepared), strict=True):
                fewest = edits(item, text)
                assert [h["edits"] for h in found] == ([fewest] if fewest <= budget else [])


def test_all_occurrences():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    short, long = " ".join(words[:3]), " ".join(words[10:40])
    prepared = qgram_filter.items_of([(1, short), (2, long), (3, "ab c")])
    gap = lambda: " ".join(rng.choice(words[50:]) for _ in range(rng.randint(3, 30)))
    text, want = "", []
    for item_id, item in [(1, short), (2, long), (1, short), (3, "ab c"), (2, long), (2, long), (1, short), (3, "ab c")]:
        text += gap() + " "
        want.append((item_id, 0, len(text), len(text) + len(item)))
        text += item + " "
    changed = long[:40] + "x" + long[42:100] + long[101:]
    text += gap() + " "
    want.append((2, edits(long, changed), len(text), len(text) + len(changed)))
    text += changed
    (found,) = qgram_filter.hits_of([text], prepared)
    assert sorted(tuple(h.values()) for h in found) == sorted(want)


def test_odd_items_and_texts():
    block = qgram_filter.items_of([(1, "cat"), (2, None), (3, "  "), (4, "exactly twelve"), (4, "exactly twelve"), (5, "ä" * 30)])
    rows = [None, "", "x", "The  CAT\nsat", "concat", "EXACTLY\ttwelve", "ä" * 5000, "exactly twelve cat"]
    hits = [sorted((h["item_id"], h["edits"], h["begin"], h["end"]) for h in x) for x in qgram_filter.hits_of(rows, block)]
    assert hits[:3] == [[], [], []]
    assert hits[3] == [(1, 0, 5, 8)] and hits[4] == []
    assert hits[5] == [(4, 0, 0, 14)] * 2
    # One word without a space: each of the occurrences side by side touches all of it.
    assert {h[0] for h in hits[6]} == {5} and {h[2:] for h in hits[6]} == {(0, 5000)}
    assert 5000 // 57 <= len(hits[6]) <= 5000 // 27
    assert [h[0] for h in hits[7]] == [1, 4, 4]


@pytest.fixture
def frames(spark):
    docs = spark.createDataFrame(
        [(1, "say: The quick brown fox jumps over it.", "h"), (1, "clean words only here", "h"), (None, "the quick brown fox jumps over it", "h"),
         (2, None, "h"), (3, "", "h"), (3, "", "h")],
        "doc_id long, text string, hits string",
    )
    items = spark.createDataFrame([(7, "the quick brown fox jumps over it"), (8, None)], "item_id long, text string")
    return docs, items


def test_rows_and_clashing_columns(frames):
    docs, items = frames
    found = qgram_filter.contaminated(docs, items).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"], r["edits"]) for r in found) == [(0, 7, 0), (1, 7, 0)]
    left = qgram_filter.clean(docs, items)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in left.collect()) == [
        (1, "clean words only here"), (2, ""), (3, ""), (3, "")]


def test_many_blocks_find_the_same(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    items = items.union(items)
    whole = sorted(map(tuple, qgram_filter.contaminated(docs, items).collect()))
    monkeypatch.setattr(qgram_filter.blocks, "__defaults__", ("item_id", "text", 2000))
    assert len(list(qgram_filter.blocks(items))) > 3
    assert sorted(map(tuple, qgram_filter.contaminated(docs, items).collect())) == whole


def test_empty_tables(frames):
    docs, items = frames
    assert qgram_filter.contaminated(docs.limit(0), items).collect() == []
    assert qgram_filter.contaminated(docs, items.limit(0)).collect() == []
    assert qgram_filter.clean(docs, items.limit(0)).count() == 6


def test_op5_finds_what_is_there_whole(spark):
    docs = {r["doc_id"]: qgram_filter.folded(r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r["item_id"]: qgram_filter.folded(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = queries.QUERIES["op5_qgram_filter"](spark, SF).collect()
    whole = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    assert whole and whole == {(r["doc_id"], r["item_id"]) for r in got if r["edits"] == 0}
    for r in got:
        assert edits(items[r["item_id"]], docs[r["doc_id"]]) == r["edits"] <= 0.1 * len(items[r["item_id"]])
