"""Operators 1, 4 and 7 against the libraries on whole texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from gridspark.llm import byte_bpe, queries, token_counts, wavelet, word_ids

RANKS = public_tokenizers.path(queries.MULTI_RANKS)
BPE = public_tokenizers.path(queries.BPE_50K)
PATTERN = public_tokenizers.PATTERN
SF = "/root/testdata/sf0.001"

PIECES = [
    "a", " ", "  ", "\n", "é", "漢", "1", "<|endoftext|>", "the", " of", ".", "!!", "'s", "😀", "\t", "9a", "²", "\x1c",
    " ", "aaaaaaaaaaaaaaaaaaaa", "end<|end", "of",
]


def texts(n, most, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def rows_of(spark, *rows):
    """Rows with columns that are called like the operators' own."""
    return spark.createDataFrame(
        [(k, t, "x", 1) for k, t in rows], "doc_id long, text string, ids string, n_tokens int"
    )


ODD = [(1, None), (2, ""), (3, "Ünï <|endoftext|> x"), (3, "Ünï <|endoftext|> x"), (None, "a b"), (4, "ab 12" * 20_000)]
LONG = [(5, " " * 2_000_000), (6, "x" + "\n" * 2_000_000 + "y"), (7, "a" * 2_000_000)]


def test_long_texts_are_cut_where_nothing_changes():
    enc = byte_bpe.encoding(RANKS, PATTERN)
    for text in texts(400, 300, 1):
        for size in (1, 7, 50):
            assert "".join(byte_bpe.pieces(text, size)) == text
            assert byte_bpe.encode(text, enc, size).tolist() == enc.encode_ordinary(text)


def test_long_white_space():
    enc = byte_bpe.encoding(RANKS, PATTERN)
    rng = random.Random(8)
    spaces = [" ", "\n", "\t", " ", "\x0b", "\x1c", "\xa0", "\u3000", "\u2028", "\x85", "\u200b"]
    for _ in range(500):
        parts = ["".join(rng.choice(spaces[:3] if rng.random() < 0.5 else spaces) for _ in range(rng.randint(0, 30))) for _ in range(4)]
        text = "".join(x + rng.choice(["", "a", "1", ".", "'s", "é", "w x"]) for x in parts)
        assert byte_bpe.encode(text, enc, 20, 5).tolist() == enc.encode_ordinary(text)
    # As long as it gets: the ids follow from those of short runs by the same rule.
    for space, behind in (" ", "x"), ("\n", "x"), (" ", ""), ("\r\n", " x"):
        text = "a" + space * (2_000_000 // len(space)) + behind
        ids = byte_bpe.encode(text, enc)
        assert byte_bpe.decode(ids, enc) == text.encode()
        short = "a" + space * (20_000 // len(space)) + behind
        few = enc.encode_ordinary(short)
        assert ids[:1000].tolist() == few[:1000] and ids[-1000:].tolist() == few[-1000:]
        assert len(ids) == len(few) + len(set(ids[5:10])) * (len(text) - len(short)) // len(space)
    other = byte_bpe.encoding(RANKS, r"\s*[\r\n]+|\S+" + byte_bpe.LAST_SPACE_APART)
    assert byte_bpe._long_runs(other._pat_str, 5) is None
    text = "a \n  \n  b" * 50
    assert byte_bpe.encode(text, other, 20, 5).tolist() == other.encode_ordinary(text)


def test_rank_file_is_read_like_the_library_reads_it():
    import base64

    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    enc = byte_bpe.encoding(RANKS, PATTERN)
    for text in texts(100, 100, 2):
        ids = byte_bpe.encode(text, enc)
        assert ids.tolist() == plain.encode_ordinary(text)
        assert byte_bpe.decode(ids, enc) == text.encode()


def test_round_trip_of_odd_rows(spark):
    got = byte_bpe.round_trip(rows_of(spark, *ODD), RANKS, PATTERN, "doc_id").collect()
    assert sorted((r["doc_id"] or 0, bytes(r["decoded"])) for r in got) == sorted(
        (k or 0, (t or "").encode()) for k, t in ODD
    )
    enc = byte_bpe.encoding(RANKS, PATTERN)
    for row in got:
        ids = np.frombuffer(row["ids"], "<u4")
        assert ids.tolist() == enc.encode_ordinary(bytes(row["decoded"]).decode()) and row["n_tokens"] == len(ids)


def test_round_trip_of_long_rows(spark):
    got = byte_bpe.round_trip(rows_of(spark, *LONG), RANKS, PATTERN, "doc_id").collect()
    assert {r["doc_id"]: bytes(r["decoded"]) for r in got} == {k: t.encode() for k, t in LONG}


def test_decode_what_was_encoded_and_cut(spark):
    coded = byte_bpe.encode_texts(rows_of(spark, (1, "漢字"), (2, None)), RANKS, PATTERN, "doc_id")
    decoded = {r[0]: bytes(r[1]) for r in byte_bpe.decode_ids(coded, RANKS, PATTERN, "doc_id").collect()}
    assert decoded == {1: "漢字".encode(), 2: b""}
    enc = byte_bpe.encoding(RANKS, PATTERN)
    first = byte_bpe.encode("漢字", enc)[:1]
    assert "漢字".encode().startswith(byte_bpe.decode(first, enc))


def test_empty_table(spark):
    none = rows_of(spark)
    assert byte_bpe.round_trip(none, RANKS, PATTERN, "doc_id").collect() == []
    assert token_counts.count_tokens(none, BPE, "doc_id").collect() == []


def test_op1(spark):
    import hashlib

    enc = byte_bpe.encoding(RANKS, PATTERN)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op1_byte_bpe"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = np.array(enc.encode_ordinary(docs[r["doc_id"]]), "<u4")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


@pytest.mark.parametrize("chunk, overlap", [(40, 13), (64, 20), (150, 5)])
def test_spliced_chunks_count_like_the_whole(library, chunk, overlap):
    loaded = word_ids.tokenizer(BPE)
    for text in [*texts(250, 300, 3), "a" * 700, " " * 700, "漢" * 700, "<|endoftext|>" * 30]:
        whole = len(library.encode(text, add_special_tokens=False).ids)
        assert token_counts.spliced(text, loaded, chunk, overlap) == whole


def test_counts_of_odd_rows(spark, library):
    got = token_counts.count_tokens(rows_of(spark, *ODD), BPE, "doc_id", chunk=1000, overlap=30, limit=4).collect()
    want = [
        (k or 0, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 4)
        for k, t in ODD
    ]
    assert sorted((r[0] or 0, *r[1:]) for r in got) == sorted(want)


def test_counts_by_sentencepiece(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_counts.count_tokens(rows_of(spark, (1, "one two"), (2, None)), path, "doc_id").collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {1: len(model.encode("one two")), 2: 0}


def test_op4(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op4_token_counts"](spark, SF).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got} == {
        k: (len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 512)
        for k, t in docs.items()
    }


def test_words_give_the_library_s_ids(library):
    words = word_ids.WordIds(BPE)
    for group in (texts(300, 40, 4), texts(300, 6, 5), ["", " ", "\n", "a ", " a", "a\n", "\nThe, the.\nx!", ", a", "É,é.x", "a's,b", "\x01,", "a\x02b"]):
        for text, ids in zip(group, words.encode(pa.array(group)), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
    for text in ("once more, with care", "again; once", "once again, The."):  # after forgetting the rest
        ids = words.encode(pa.array(["x", text]).slice(1))[0].tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        words._trim(np.arange(0, len(words.words), 2))
    assert words.encode(pa.array([], pa.string())) == []


@pytest.mark.parametrize("n, most", [(0, 1), (1, 1), (7, 2), (513, 300), (5000, 50_257), (3000, 70_000)])
def test_matrix_access_count_select(n, most):
    ids = np.random.default_rng(n).integers(0, most, n).astype("<u4")
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.of(ids).to_bytes())
    assert matrix.ids().tolist() == ids.tolist()
    for at in range(0, n, max(1, n // 40)):
        assert matrix.access(at) == ids[at]
    for token in {*ids[:5].tolist(), 0, most + 5, 1 << 20}:
        places = np.flatnonzero(ids == token)
        assert matrix.count(token) == len(places)
        assert matrix.count(token, n // 3, n // 2) == ((places >= n // 3) & (places < n // 2)).sum()
        assert matrix.positions(token) == places.tolist()
    with pytest.raises(IndexError):
        matrix.access(n)
    with pytest.raises(IndexError):
        matrix.select(0, n + 1)


@pytest.mark.parametrize("shards, per_matrix", [(3, 1 << 18), (5, 5), (None, 50)])
def test_shards_of_odd_rows(spark, library, tmp_path, shards, per_matrix):
    rows = [*ODD, (-5, "first"), (9, "x y"), (8, "z" * 300)]
    path = str(tmp_path / "shards")
    wavelet.write_shards(rows_of(spark, *rows), path, BPE, shards=shards, matrix_tokens=per_matrix)
    got = sorted(wavelet.read_shards(spark, path).collect(), key=lambda r: r["start"])
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r["doc_id"] for r in got] == [k for k, _ in order]
    start = 0
    for row, (_, text) in zip(got, order, strict=True):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    # Looking a token up in the files gives the places that going through all ids gives.
    whole = [(k, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for k, t in rows]
    for token in (0, whole[3][1][0], 49_999):
        want = sorted((str(k), at) for k, ids in whole for at, x in enumerate(ids) if x == token)
        assert sorted((str(r["doc_id"]), r["position"]) for r in wavelet.occurrences(spark, path, token).collect()) == want


def test_rows_of_one_key_and_sums_in_levels(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(wavelet, "SHARDS_TOGETHER", 2)
    rows = [(7, f"text {i:03d}") for i in range(60)] + [(3, "before"), (9, "behind")]
    path = str(tmp_path / "one-key")
    wavelet.write_shards(rows_of(spark, *rows).repartition(5), path, BPE, shards=9, matrix_tokens=4)
    shards = spark.read.parquet(path).selectExpr("shard", "size(keys) AS n").groupBy("shard").sum("n").collect()
    assert len(shards) > 4 and max(r["sum(n)"] for r in shards) < 40
    got = sorted(wavelet.read_shards(spark, path).collect(), key=lambda r: r["start"])
    lengths = [len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in sorted(rows)]
    assert [r["n_tokens"] for r in got] == lengths
    assert [r["start"] for r in got] == [sum(lengths[:i]) for i in range(len(lengths))]
    text_keys = spark.createDataFrame([("b", "x"), ("a", "y z"), (None, "w")], "doc_id string, text string")
    wavelet.write_shards(text_keys, str(tmp_path / "text"), BPE)
    assert [r["doc_id"] for r in sorted(wavelet.read_shards(spark, str(tmp_path / "text")).collect(), key=lambda r: r["start"])] == [None, "a", "b"]


def test_no_shards(spark, tmp_path):
    wavelet.write_shards(rows_of(spark), str(tmp_path / "none"), BPE)
    assert wavelet.read_shards(spark, str(tmp_path / "none")).collect() == []


def test_op7(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = {r["doc_id"]: tuple(r[1:]) for r in queries.QUERIES["op7_wavelet_shards"](spark, SF).collect()}
    start = 0
    for r in docs:
        ids = np.array([*library.encode(r["text"], add_special_tokens=False).ids, 0], "<u4")
        assert got[r["doc_id"]] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
