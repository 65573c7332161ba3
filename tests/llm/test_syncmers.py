"""Operator 9: what anchors are, and the query against the given documents."""

import hashlib

import pytest
from pyspark.sql import functions as F

from gridspark.llm import queries, syncmers

SF = "/root/testdata/sf0.001"


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, text string")


def anchors(spark, text, **how):
    return [tuple(a) for a in syncmers.with_anchors(docs(spark, (1, text)), "text", "found", **how).first()["found"]]


def test_anchors_do_not_depend_on_what_is_around(spark):
    inner = " ".join(f"w{i * i % 97}" for i in range(60))
    alone = anchors(spark, inner)
    placed = anchors(spark, "some other words " + inner + " and more")
    assert 0.3 < len(alone) / 56 < 0.7
    assert {(p + 3, h) for p, h in alone} <= set(placed)


@pytest.mark.parametrize("k, s", [(5, 2), (4, 1), (7, 3)])
def test_anchors_are_closed_syncmers(spark, k, s):
    words = [f"w{i * 7 % 23}" for i in range(40)]
    got = dict(anchors(spark, " ".join(words), k=k, s=s))
    # Hashes of the s-mers as Spark gives them, the choice by hand.
    own = spark.createDataFrame([(words,)], "w array<string>").select(F.transform("w", lambda w: F.xxhash64(w)).alias("h"))
    inner = own.select(syncmers._inner(F.col("h"), s)).first()[0]
    assert len(inner) == len(words) - s + 1
    for i in range(len(words) - k + 1):
        window = inner[i : i + k - s + 1]
        assert (i in got) == (min(window) in (window[0], window[-1]))


def test_short_and_unspaced_texts(spark):
    assert anchors(spark, "") == [] and anchors(spark, None) == [] and anchors(spark, " \n ") == []
    assert len(anchors(spark, "one")) == 1 and anchors(spark, "one two") != anchors(spark, "one twa")
    long = "漢字仮名交文章例示文字列" * 3
    assert len(anchors(spark, long)) > 3


def test_successors(spark):
    rows = [(5, "e"), (1, "a"), (None, "n"), (3, None), (3, "c"), (9, "i"), (9, "i")]
    for per_range in (1, 2, 100):
        got = syncmers.with_next(docs(spark, *rows), "doc_id", "text", lambda r, _: r, per_range).collect()
        found = sorted((r["doc_id"] or 0, r["text"], r["next"]["text"]) for r in got)
        assert found == [(0, "n", "a"), (1, "a", ""), (3, "", "c"), (3, "c", "e"), (5, "e", "i"), (9, "i", "i"), (9, "i", "n")]
    alone = syncmers.with_next(docs(spark, (1, "x")), "doc_id", "text", lambda r, _: r).first()
    assert alone["next"]["text"] == "x"
    assert syncmers.fingerprints(docs(spark), "doc_id").collect() == []


def test_likeness(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [3, 4, 5, 6]), ([], []), ([1], []), ([7], [7])], "a array<long>, b array<long>")
    assert [r[0] for r in df.select(syncmers.likeness(F.col("a"), F.col("b"), 64)).collect()] == [2 / 6, 1.0, 0.0, 1.0]


def test_extra_columns_and_wide_characters(spark):
    df = spark.createDataFrame([(1, "😀" * 5, "x"), (2, "abcdef", "y")], "doc_id long, text string, next string")
    got = {r["doc_id"]: r for r in syncmers.fingerprints(df, "doc_id").collect()}
    assert got[1]["n_chars"] == 5 and got[1]["edited_sha256"] == hashlib.sha256(("😀" * 3 + "ab").encode()).hexdigest()


def test_op9(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in queries.QUERIES["op9_syncmers"](spark, SF).collect()}
    assert len(got) == len(rows)
    by_text, near = {}, []
    for i, r in enumerate(rows):
        after = rows[(i + 1) % len(rows)]["text"]
        half = len(r["text"]) // 2
        edited = r["text"][: len(r["text"]) - half] + after[:half]
        own = got[r["doc_id"]]
        assert own["n_chars"] == len(r["text"])
        assert own["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(r["text"], own["fingerprint"]) == own["fingerprint"]
        near.append((own["near_edited"], own["near_next"]))
        assert 0 <= own["near_next"] <= 1 and 0 <= own["near_edited"] <= 1
    assert len(set(by_text.values())) == len(by_text)
    assert sum(a for a, _ in near) / len(near) > 0.3 > 0.1 > sum(b for _, b in near) / len(near)


def test_fingerprints_hold_every_anchor(spark):
    words = [f"w{i * i * 31 % 10007}" for i in range(4000)]
    passage = words[2000:2050]
    df = docs(spark, (1, " ".join(words)), (2, " ".join(passage)))
    got = {r["doc_id"]: r for r in syncmers.fingerprints(df, "doc_id").collect()}
    sets = {}
    for i, text in ((1, words), (2, passage)):
        print_ = got[i]["fingerprint"]
        sets[i] = {print_[at : at + 16] for at in range(0, len(print_), 16)}
        assert sets[i] == {f"{h & (1 << 64) - 1:016X}" for _, h in anchors(spark, " ".join(text))}
    assert len(sets[1]) > 1000 and len(sets[2]) > 10 and sets[2] <= sets[1]
    assert got[1]["near_next"] == got[2]["near_next"] == len(sets[2]) / len(sets[1])


def test_matches(spark):
    passage = " ".join(f"w{i * 7 % 61}" for i in range(50))
    one, two = "a b c " + passage, passage + " x y z " + passage
    rows = [(1, one, two), (1, one, two), (2, one, "other"), (3, None, None)]
    df = spark.createDataFrame(rows, "id long, one string, two string")
    got = syncmers.matches(df, "one", "two").collect()
    of_one, of_two = anchors(spark, one), anchors(spark, two)
    want = []
    for h in {h for _, h in of_one} & {h for _, h in of_two}:
        want.append((1, h, [p for p, x in of_one if x == h], [p for p, x in of_two if x == h]))
    assert len(want) > 10 and sorted(tuple(r) for r in got) == sorted(want * 2)
