"""The pipeline stage by stage against what each stage promises, from the rows of the one before."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from test_line_dedup import direct
from test_near_duplicates import all_pairs
from test_quality import Direct

import corpus_pipeline
from gridspark.llm import byte_bpe, kneser_ney, qgram_filter
from gridspark.llm.common import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"test-{name.replace(' ', '-')}")
        out.append(docs)
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(steps):
    for step in steps[:-1]:
        assert step.dtypes == steps[0].dtypes


def test_quality(spark, steps):
    docs, kept = texts(steps[0]), texts(steps[1])
    judged = {r["doc_id"]: r for r in kneser_ney.classified(steps[0], spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    model = Direct([docs[d].encode() for d, r in judged.items() if r["held_out"] is False], kneser_ney.ORDER)
    assert set(kept) == {d for d, t in docs.items() if t and model.perplexity(t.encode()) <= judged[d]["threshold"]}
    assert 0 < len(docs) - len(kept) < 0.3 * len(docs)


def test_lines(steps):
    before = sorted(texts(steps[1]).items())
    want = {k: t for (k, whole), t in zip(before, direct(before), strict=True) if t == whole or t.strip()}
    assert texts(steps[2]) == want
    assert all(r["n_chars"] == len(r["text"]) for r in steps[2].collect())


def test_near_duplicates(steps):
    before = sorted(texts(steps[2]).items())
    classes = all_pairs(before)
    assert texts(steps[3]) == {k: t for k, t in before if classes[k] == k}


def test_decontamination(spark, steps):
    items = [qgram_filter.folded(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = texts(steps[3]), texts(steps[4])
    holds = {k for k, t in before.items() if any(i in qgram_filter.folded(t) for i in items)}
    assert holds and not holds & set(after)
    assert len(set(before) - set(after) - holds) <= 2


def test_token_ids(steps):
    enc = byte_bpe.encoding(public_tokenizers.path(corpus_pipeline.RANKS), public_tokenizers.PATTERN)
    docs = texts(steps[4])
    rows = steps[5].collect()
    assert {r["doc_id"] for r in rows} == set(docs)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == enc.encode_ordinary(docs[r["doc_id"]]) and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(r["ids"]).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_odd_rows_go_through_every_stage(spark):
    good = " ".join(f"word{i}" for i in range(30))
    odd = [(1, None, "en"), (2, "", None), (3, good, "en"), (4, good, None), (None, good + " x", "en"), (5, "y " * 50_000, "zz"), (5, "z", "en")]
    docs = spark.createDataFrame([(k, t, x, None, len(t or "")) for k, t, x in odd], "doc_id long, text string, lang string, source string, n_chars long")
    for rows in (docs, docs.limit(0)):
        now = rows
        for name, stage in corpus_pipeline.STAGES:
            now = written(stage(spark, now, SF), "test-odd")
        assert now.count() <= rows.count()


def test_decisions_are_by_id_and_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = "@@##$$%%&&" * 300
    first = docs.filter("length(text) > 500").orderBy("doc_id").first()
    more = spark.createDataFrame(
        [(first["doc_id"], junk, first["lang"], "s", 3000), (None, junk, "en", "s", 3000), (None, first["text"], first["lang"], "s", 1)], docs.schema
    )
    kept = corpus_pipeline.quality(spark, docs.unionByName(more), SF).collect()
    assert not any(r["text"] == junk for r in kept)
    assert sum(r["text"] == first["text"] and r["doc_id"] in (None, first["doc_id"]) for r in kept) == 2
    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "de", "s", 11), (1, "other words of the same id", "en", "s", 26)]
    rows += [(2, "a b c d e f", "en", "s", 11), (3, "alone here", "en", "s", 10), (None, "x", "en", "s", 1), (None, "x", "en", "s", 1)]
    left = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, docs.schema), SF).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left) == [
        (0, "x"), (0, "x"), (1, "a b c d e f"), (1, "other words of the same id"), (3, "alone here")]


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {re.match(r"op(\d+)_", n)[1] for n in names if re.match(r"op\d+_", n)} == {str(i) for i in range(1, 14)}
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()
