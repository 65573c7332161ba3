"""Operator 2: quality classifier, an interpolated modified Kneser-Ney model over bytes.

The model counts runs of `ORDER` bytes in trusted text. Counts, contexts and probabilities are tables
sharded by run of bytes and joined; there is no copy of the model in one place. Texts are dealt out
in blocks. A block asks for the probability of each distinct run it holds, once, and sums them up
over its texts, so what is shuffled grows with the distinct runs of a block, not with its bytes.

A text is kept if its perplexity, less an allowance for short texts, is at most the threshold of its
language: a quantile of the same figure of trusted texts of that language that were held out of the
counts, steadied by those of all languages, with some slack.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm.common import for_workers, written

ORDER = 4
#: Documents and bytes of a block, about; a block has more only where one document has.
DOCS_PER_BLOCK = 4096
BYTES_PER_BLOCK = 64 << 20
#: Share of trusted texts that set the thresholds, one in so many.
HELD_OUT = 5
#: The slack is the smallest of 1, 1.03, 1.05 and 1.1 with which thresholds from one half of the
#: held-out trusted texts keep 99 % of the other half (sf0.1, mean of 60 random halves).
QUANTILE, SLACK = 0.99, 1.03
#: The mean of few bytes varies more: n bytes may lie this many nats / sqrt(n) above the threshold.
SHORT = 2.0
#: What is known from all languages together counts as so many held-out texts of each: what a
#: language with few of them has as its 99 % quantile is their maximum.
HELD_OUT_OF_ALL = 400
# Fixed value: the seed of Spark's xxhash64.
SPARK_SEED = 42
#: Bytes that a task gathers before it packs them, and runs it looks at together.
PACK_BYTES = 8 << 20
RUNS = 1 << 20

_PACKED = "block long, sizes array<long>, keys array<long>, langs array<string>, payload binary"


def spread_keys(df: DataFrame, key: str, docs: int = DOCS_PER_BLOCK) -> DataFrame | None:
    """`key`, `parts` for keys that more rows have than a block takes: into how many they are dealt.
    None if there are no such keys."""
    often = df.groupBy(F.col(key).cast("long").alias("key")).agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / docs).cast("long")
    often = written(often.where((F.col("n") > docs) & F.col("key").isNotNull()).select("key", parts.alias("parts")), "often")
    return None if often.isEmpty() else often


def _parts_of(rows: DataFrame, often: DataFrame | None) -> DataFrame:
    """`rows` with `parts`, into how many those of a `key` are dealt."""
    if often is None:
        return rows.withColumn("parts", F.lit(1).cast("long"))
    return rows.join(often, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))


def block_of(key: Column, part: Column, blocks: int) -> Column:
    """Block of a document from its key and, of a key that many rows have, the part."""
    return F.pmod(F.xxhash64(key, part), F.lit(blocks))


def packed(df: DataFrame, key: str, text: str, lang: str, blocks: int, often: DataFrame | None) -> DataFrame:
    """Texts in compressed packs, each of one block; repeated and null keys and null texts stay.

    Rows without a key, and those of keys that are in `often`, are dealt out by their texts.
    """
    for_workers(df.sparkSession)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("block", pa.int64()), ("sizes", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())),
            ("langs", pa.list_(pa.string())), ("payload", pa.binary()),
        ])
        press = zstandard.ZstdCompressor(level=3)
        held: dict[int, list] = {}
        size = 0

        def flushed():
            rows = [
                {
                    "block": block, "sizes": [len(t) for *_, t in rows], "keys": [k for k, *_ in rows],
                    "langs": [x for _, x, _ in rows], "payload": press.compress(b"".join(t for *_, t in rows)),
                }
                for block, rows in held.items()
            ]
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for frame in frames:
            columns = (frame.column(i) for i in range(4))
            for block, k, x, t in zip(*columns, strict=True):
                data = t.as_py()
                held.setdefault(block.as_py(), []).append((k.as_py(), x.as_py(), data))
                size += len(data)
                if size >= PACK_BYTES:
                    yield flushed()
                    held.clear()
                    size = 0
        if held:
            yield flushed()

    rows = df.select(
        F.col(key).cast("long").alias("key"),
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    own = F.xxhash64("text")
    part = F.when(F.col("key").isNull(), own).otherwise(F.pmod(own, "parts"))
    rows = _parts_of(rows, often).select(block_of(F.col("key"), part, blocks).alias("block"), "key", "lang", "text")
    return rows.mapInArrow(run, _PACKED).repartition(blocks, "block")


def documents(packs: pa.Table) -> Iterator[tuple[int | None, str, bytes]]:
    """Key, language and text of each document of a block's packs."""
    for row in range(packs.num_rows):
        sizes, keys, langs = (packs.column(c)[row].as_py() for c in ("sizes", "keys", "langs"))
        data = zstandard.ZstdDecompressor().decompress(packs.column("payload")[row].as_py()) if sum(sizes) else b""
        at = 0
        for key, lang, size in zip(keys, langs, sizes, strict=True):
            yield key, lang, data[at : at + size]
            at += size


def runs(texts: list[bytes], order: int = ORDER) -> np.ndarray:
    """Code of the run of `order` bytes that ends at each byte; before a text there are zero bytes."""
    gap = bytes(order - 1)
    data = np.frombuffer(gap + gap.join(texts), np.uint8)
    n = len(data) - order + 1
    if n <= 0 or not texts:
        return np.empty(0, np.int64)
    codes = np.zeros(n, np.int64)
    for j in range(order):
        codes <<= 8
        codes |= data[j : j + n]
    # Runs that end in a gap belong to no text.
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + order - 1) - sizes - order + 1
    own = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    return codes[own]


def _portions(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    group, held = [], 0
    for t in texts:
        group.append(t)
        held += len(t)
        if held >= RUNS:
            yield group
            group, held = [], 0
    if group:
        yield group


def _distinct(texts: Iterator[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of the texts and how often each occurs."""
    codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for group in _portions(texts):
        some, many = np.unique(runs(group, order), return_counts=True)
        every = np.concatenate([codes, some])
        codes, inverse = np.unique(every, return_inverse=True)
        counts = np.bincount(inverse, np.concatenate([counts, many]), len(codes)).astype(np.int64)
    return codes, counts


def _shard(codes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each run; a run's neighbours in the order of codes go to different ones."""
    return ((codes * np.int64(0x9E3779B97F4A7C15 - (1 << 64))) >> np.int64(33)) % shards


def asked(packs: DataFrame, trusted: DataFrame, shards: int, order: int = ORDER) -> DataFrame:
    """`shard`, `block`, `run`, `count`: the distinct runs of each block, and how often the trusted texts
    in it that are counted hold them; `trusted` has `block`, `key`, `held_out`."""

    def block(packs: pa.Table, labels: pa.Table) -> pa.Table:
        held = labels.column("held_out").to_pylist()
        chosen = {k for k, h in zip(labels.column("key").to_pylist(), held, strict=True) if not h}
        inside, counts = _distinct((t for k, _, t in documents(packs) if k in chosen), order)
        outside, _ = _distinct((t for k, _, t in documents(packs) if k not in chosen), order)
        outside = np.setdiff1d(outside, inside, assume_unique=True)
        codes = np.concatenate([inside, outside])
        counts = np.concatenate([counts, np.zeros(len(outside), np.int64)])
        # A block may have labels only.
        number = np.full(len(codes), packs.column("block")[0].as_py() if packs.num_rows else 0, np.int64)
        return pa.table({"shard": _shard(codes, shards), "block": number, "run": codes, "count": counts})

    both = packs.groupBy("block").cogroup(trusted.groupBy("block"))
    return both.applyInArrow(block, "shard long, block long, run long, count long")


def counted(questions: DataFrame) -> DataFrame:
    """`shard`, `run`, `count`: each run that some block asks for, once, counted over all blocks."""

    def added(part: pa.Table) -> pa.Table:
        codes, inverse = np.unique(part.column("run").to_numpy(), return_inverse=True)
        counts = np.bincount(inverse, part.column("count").to_numpy(), len(codes)).astype(np.int64)
        number = np.full(len(codes), part.column("shard")[0].as_py(), np.int64)
        return pa.table({"shard": number, "run": codes, "count": counts})

    return questions.groupBy("shard").applyInArrow(added, "shard long, run long, count long")


def answered(questions: DataFrame, p: DataFrame) -> DataFrame:
    """`block`, `run`, `p` for each question, shard by shard."""

    def shard(questions: pa.Table, found: pa.Table) -> pa.Table:
        codes = found.column("run").to_numpy()
        order = np.argsort(codes)
        runs = questions.column("run").to_numpy()
        p = found.column("p").to_numpy()[order[np.searchsorted(codes[order], runs)]] if len(runs) else []
        return pa.table({"block": questions.column("block"), "run": runs, "p": pa.array(p, pa.float64())})

    both = questions.groupBy("shard").cogroup(p.groupBy("shard"))
    return both.applyInArrow(shard, "block long, run long, p double")


def _discounts(table: DataFrame) -> DataFrame:
    """The three discounts of each order `k`, from its counts of counts.

    Orders with too few counts to estimate them get 0.5, 1 and 1.5.
    """
    n = [F.sum((F.col("count") == i).cast("double")).alias(f"n{i}") for i in range(1, 5)]
    y = F.expr("try_divide(n1, n1 + 2 * n2)")

    def bounded(found: Column, i: int) -> Column:
        return F.when((found > 0) & (found < i), found).otherwise(i / 2)

    return table.groupBy("k").agg(*n).select(
        "k", *[bounded(i - (i + 1) * y * F.expr(f"try_divide(n{i + 1}, n{i})"), i).alias(f"d{i}") for i in (1, 2, 3)]
    )


def probabilities(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """`counts` with `p`, the probability of the last byte of each `run` after the bytes before it.

    `counts` has each `run` once, with its `count` in the highest order: 0 for one that is only asked
    for. Lower orders count in how many ways a run is continued to the left. Bytes are the vocabulary:
    below order 1 all are alike. The orders `k` are rows of one table, dealt out by the last `k` bytes of
    the runs and by context, the bytes before the last: one table for each would repeat in the plan all
    that `counts` is made of.
    """

    def last(k: int) -> Column:
        return F.col("run").bitwiseAND((1 << 8 * k) - 1)

    orders = range(1, order + 1)
    ends = [F.struct(F.lit(k).alias("k"), last(k).alias("end")) for k in orders]
    longer = [
        F.struct(
            F.lit(k).alias("k"), last(k).alias("end"), last(min(k + 1, order)).alias("longer"),
            (F.col("count") if k == order else F.least("count", F.lit(1).cast("long"))).alias("count"),
        )
        for k in orders
    ]
    table = counts.select(F.inline(F.array(*longer)))
    table = table.groupBy("k", "end", "longer").agg(F.max("count").alias("count"))
    table = table.groupBy("k", "end").agg(F.sum("count").alias("count"))
    # A row of three numbers for each order goes to every task.
    cut = F.expr("least(count, CASE WHEN count = 1 THEN d1 WHEN count = 2 THEN d2 ELSE d3 END)")
    cuts = table.join(F.broadcast(_discounts(table)), "k").withColumn("cut", cut)
    # A context has no more rows than there are bytes.
    context = Window.partitionBy("k", F.shiftright("end", 8))
    known = cuts.select(
        "k", "end", (F.col("count") - F.col("cut")).alias("above"),
        F.sum("count").over(context).alias("total"), F.sum("cut").over(context).alias("mass"),
    )
    known = known.select(
        "k", "end", F.try_divide("above", "total").alias("own"), F.try_divide("mass", "total").alias("rest")
    )
    out = counts.select("*", F.inline(F.array(*ends))).join(known, ["k", "end"])
    each = [F.max(F.when(F.col("k") == k, F.col(x))).alias(f"{x}{k}") for k in orders for x in ("own", "rest")]
    out = out.groupBy(*counts.columns).agg(*each)
    p = F.lit(1 / 256)
    for k in orders:
        # Contexts that were never counted have no total.
        out = out.withColumn(f"p{k}", F.coalesce(F.col(f"own{k}") + F.col(f"rest{k}") * p, p))
        p = F.col(f"p{k}")
    return out.select(*counts.columns, p.alias("p"))


def scored(packs: DataFrame, answers: DataFrame, order: int = ORDER) -> DataFrame:
    """`key`, `version` (Spark's xxhash64 of the text), `lang`, `n_bytes`, `log_p` per text; `answers` has
    `block`, `run`, `p`."""

    def block(packs: pa.Table, answers: pa.Table) -> pa.Table:
        codes = answers.column("run").to_numpy()
        logs = np.log(answers.column("p").to_numpy())
        by_code = np.argsort(codes)
        codes, logs = codes[by_code], logs[by_code]
        keys, versions, langs, sizes, sums = [], [], [], [], []
        group, held = [], 0

        def summed():
            found = runs(group, order)
            each = np.array([len(t) for t in group], np.int64)
            total = np.concatenate([[0.0], np.cumsum(logs[np.searchsorted(codes, found)])])
            ends = np.cumsum(each)
            sizes.extend(each.tolist())
            sums.extend((total[ends] - total[ends - each]).tolist())

        for key, lang, text in documents(packs):
            keys.append(key)
            versions.append(xxhash.xxh64_intdigest(text, SPARK_SEED))
            langs.append(lang)
            group.append(text)
            held += len(text)
            if held >= RUNS:
                summed()
                group, held = [], 0
        if group:
            summed()
        return pa.table({
            "key": pa.array(keys, pa.int64()), "version": pa.array(np.array(versions, np.uint64).view(np.int64)),
            "lang": pa.array(langs, pa.string()),
            "n_bytes": pa.array(sizes, pa.int64()), "log_p": pa.array(sums, pa.float64()),
        })

    both = packs.groupBy("block").cogroup(answers.groupBy("block"))
    return both.applyInArrow(block, "key long, version long, lang string, n_bytes long, log_p double")


def perplexities(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", order: int = ORDER
) -> DataFrame:
    """One row per row of `df`: `key`, `version` (xxhash64 of its text), `lang`, `n_bytes`, `perplexity` (null for an empty text) and
    `held_out` (true for trusted texts outside the counts, false for those inside, else null).

    Trusted are the documents that `labels` (`key`, `quality`, `toxic`) calls good and not toxic. Null
    texts count as empty, a null language as the language ''. Without trusted texts every byte is
    equally likely. Only the named columns are read.
    """
    size = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // DOCS_PER_BLOCK), -(-size["bytes"] // BYTES_PER_BLOCK))
    often = spread_keys(df, key)
    number = F.col(key).cast("long")
    trusted = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0 AND " + f"`{key}` IS NOT NULL").select(
        number.alias("key"), (F.pmod(F.xxhash64(number, F.lit("held out")), F.lit(HELD_OUT)) == 0).alias("held_out"),
    ).distinct()
    # The label of a key that is dealt out goes to each of its blocks.
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    labelled = _parts_of(trusted, often).select("key", "held_out", parts.alias("part"))
    labelled = labelled.select(block_of(F.col("key"), F.col("part"), blocks).alias("block"), "key", "held_out").distinct()
    packs = packed(df, key, text, lang, blocks, often)
    shards = max(blocks, 16)
    questions = asked(packs, labelled, shards, order)
    answers = answered(questions, probabilities(counted(questions), order))
    # Written: the thresholds and the decisions both read it.
    sums = written(scored(packs, answers, order).join(trusted, "key", "left"), "perplexity")
    return sums.select(
        F.col("key").alias(key), "version", F.col("lang").alias(lang), "n_bytes",
        F.when(F.col("n_bytes") > 0, F.exp(-F.col("log_p") / F.col("n_bytes"))).alias("perplexity"), "held_out",
    )


def _allowance() -> Column:
    """What the perplexity of a text of `n_bytes` may be a multiple of its threshold by."""
    return F.exp(SHORT / F.sqrt(F.greatest("n_bytes", F.lit(1))))


def thresholds(found: DataFrame, lang: str = "lang", quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """`lang`, `threshold` for the languages with held-out texts, and one row for all (null).

    They are for texts so long that they need no allowance; it is taken off the held-out ones, too. A
    language's quantile is drawn, the more the fewer held-out texts it has, towards its median plus the
    quantile of what texts of all languages lie above the median of their own.
    """
    known = found.filter("held_out AND perplexity IS NOT NULL")
    known = known.select(F.coalesce(lang, F.lit("")).alias(lang), F.log(F.col("perplexity") / _allowance()).alias("x"))
    each = known.groupBy(lang).agg(
        F.percentile_approx("x", 0.5, 10_000).alias("middle"), F.percentile_approx("x", quantile, 10_000).alias("own"),
        F.count("*").alias("n"),
    )
    above = known.join(each, lang).agg(F.percentile_approx(F.col("x") - F.col("middle"), quantile, 10_000).alias("above"))
    of_all = F.col("middle") + F.col("above")
    drawn = (F.col("n") * F.col("own") + HELD_OUT_OF_ALL * of_all) / (F.col("n") + HELD_OUT_OF_ALL)
    # A single row goes to every task.
    each = each.join(F.broadcast(above)).select(lang, (F.exp(drawn) * slack).alias("threshold"))
    every = known.agg((F.exp(F.percentile_approx("x", quantile, 10_000)) * slack).alias("threshold"))
    return each.unionByName(every.select(F.lit(None).cast("string").alias(lang), "threshold"))


def classified(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    quantile: float = QUANTILE, slack: float = SLACK,
) -> DataFrame:
    """`perplexities` with `threshold` and `keep`.

    A text is kept if its perplexity is at most its language's threshold, which `threshold` gives with
    the allowance for the text's length. Where there is no trusted text at all, every text with a
    perplexity is kept. Empty texts are not.
    """
    found = perplexities(df, labels, key, text, lang)
    limits = written(thresholds(found, lang, quantile, slack), "thresholds")
    own = limits.filter(F.col(lang).isNotNull())
    every = limits.filter(F.col(lang).isNull()).select(F.col("threshold").alias("of_all"))
    # One row goes to every task; the thresholds do if Spark finds them small.
    judged = found.join(own, lang, "left").join(F.broadcast(every))
    limit = F.coalesce("threshold", "of_all") * _allowance()
    keep = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= limit, F.lit(True))
    return judged.select(key, "version", lang, "n_bytes", "perplexity", limit.alias("threshold"), "held_out", keep.alias("keep"))
