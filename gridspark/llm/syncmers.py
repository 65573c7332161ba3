"""Operator 9: document fingerprints from closed syncmers.

A text is a sequence of tokens: words, and single characters of scripts without spaces. A k-mer is k
tokens in a row, its s-mers the s tokens in a row inside it. A k-mer is a closed syncmer if the
smallest hash of its s-mers is that of its first or its last one. Whether it is follows from the
k-mer alone, not from what stands around it, so equal passages give equal anchors wherever they are.

The fingerprint is the set of all distinct anchor hashes, so it grows with the text. `matches` gives
the places of the anchors that two texts have in common. Everything is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm.common import range_bounds, range_of, text_or_empty

K, S = 5, 2
#: Rows of a range of documents whose successors are found in one task.
DOCS_PER_RANGE = 1024

# Scripts that put no spaces between words.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def tokens(text: Column) -> Column:
    """Words, or characters of unspaced scripts."""
    found = F.split(text, rf"\s+|(?<={UNSPACED})|(?={UNSPACED})")
    return F.array_remove(found, "")


def _inner(words: Column, s: int) -> Column:
    """Hash of the s-mer that begins at each token hash but the last s - 1."""
    if s == 1:
        return words
    last = F.size(words) - s
    return F.when(
        last >= 0,
        F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(s)])),
    ).otherwise(F.array().cast("array<bigint>"))


def with_anchors(df: DataFrame, text: str, to: str, k: int = K, s: int = S) -> DataFrame:
    """`df` with the closed syncmers of `text` in `to`: array of (position, hash), in text order.

    Positions count tokens from 0. Null counts as empty. A text without tokens has no anchors; one
    with fewer than k tokens has one, the hash of all of them at 0.
    """
    if not 0 < s < k:
        raise ValueError("0 < s < k")
    window = k - s + 1
    words, inner = f"__{to}_words", f"__{to}_inner"
    out = df.withColumn(words, F.transform(tokens(text_or_empty(text)), lambda w: F.xxhash64(w)))
    out = out.withColumn(inner, _inner(F.col(words), s))
    at = lambda i, j: F.get(F.col(inner), i + j)

    def closed(i: Column) -> Column:
        middle = F.least(*[at(i, j) for j in range(window)])
        return (middle == at(i, 0)) | (middle == at(i, window - 1))

    # A k-mer is its non-overlapping s-mers and what they leave over at its end.
    cover = [*range(0, k - s + 1, s)] + ([k - s] if k % s else [])

    def anchor(i: Column) -> Column:
        return F.struct(i.alias("position"), F.xxhash64(*[at(i, j) for j in cover]).alias("hash"))

    starts = F.sequence(F.lit(0), F.size(words) - k)
    short = F.array(
        F.struct(F.lit(0).alias("position"), F.xxhash64(F.col(words)).alias("hash"))
    )
    found = (
        F.when(F.size(words) >= k, F.transform(F.filter(starts, closed), anchor))
        .when(F.size(words) > 0, short)
        .otherwise(F.array().cast("array<struct<position:int,hash:bigint>>"))
    )
    return out.withColumn(to, found).drop(words, inner)


def hashes(anchors: Column) -> Column:
    """The distinct hashes, ascending."""
    return F.sort_array(F.array_distinct(F.transform(anchors, lambda a: a["hash"])))


def as_text(found: Column) -> Column:
    """16 hex digits for each hash."""
    return F.array_join(F.transform(found, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def likeness(a: Column, b: Column, size: int | None = None) -> Column:
    """Share of the distinct hashes of two texts that both have; with `size`, among the `size` smallest
    of both. Two empty sets are alike, an empty and another not."""
    if size is None:
        both, every = F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)
        return F.when(every == 0, F.lit(1.0)).otherwise(both / (every - both))
    smallest = F.slice(F.array_sort(F.array_union(a, b)), 1, size)
    both = F.size(F.array_intersect(F.array_intersect(a, b), smallest))
    return F.when(F.size(smallest) == 0, F.lit(1.0)).otherwise(both / F.size(smallest))


def matches(df: DataFrame, one: str, two: str, k: int = K, s: int = S) -> DataFrame:
    """The anchors that the texts `one` and `two` of a row have in common: a row for each hash, with
    the other columns of `df`, `hash`, and its `positions` in `one` and `other_positions` in `two`,
    ascending.

    Each position of the one list matches each of the other; they are not paired, so a passage that
    both repeat costs no square. Texts without a common anchor give no rows; rows of `df` that are
    alike each give their own.
    """
    kept = [c for c in df.columns if c not in (one, two)]
    rows = df.select(
        F.monotonically_increasing_id().alias("__row"), F.struct(F.lit(0), *[F.col(f"`{c}`") for c in kept]).alias("__kept"),
        F.col(f"`{one}`").alias("__one"), F.col(f"`{two}`").alias("__two"),
    )
    for side in ("__one", "__two"):
        rows = with_anchors(rows, side, f"{side}_anchors", k, s)

    def tagged(anchors: str, own: bool) -> Column:
        return F.transform(
            anchors, lambda a: F.struct(F.lit(own).alias("own"), a["position"].alias("position"), a["hash"].alias("hash"))
        )

    every = F.explode(F.concat(tagged("__one_anchors", True), tagged("__two_anchors", False)))
    found = rows.select("__row", "__kept", every.alias("a")).groupBy("__row", F.col("a.hash").alias("__hash"))
    places = [
        F.sort_array(F.collect_list(F.when(side, F.col("a.position")))).alias(name)
        for side, name in ((F.col("a.own"), "positions"), (~F.col("a.own"), "other_positions"))
    ]
    both = found.agg(F.first("__kept").alias("__kept"), *places)
    both = both.filter((F.size("positions") > 0) & (F.size("other_positions") > 0))
    own = [F.col("__kept").getField(c).alias(c) for c in kept]
    return both.select(*own, F.col("__hash").alias("hash"), "positions", "other_positions")


def with_next(df: DataFrame, key: str, text: str, derive, per_range: int = DOCS_PER_RANGE) -> DataFrame:
    """`key`, `text`, what `derive` adds to a row of these two, and in `next` a struct of all but the
    key for the row with the next key; after the last row comes the first.

    Null keys come first, null texts count as empty; equal keys follow each other by text. The rows
    are dealt out by ranges of the key, each with a copy of the first row of the range after it, so
    no task holds more than a range. A single row is its own successor.
    """
    rows = df.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    bounds = range_bounds(rows.select("key"), "key", per_range)
    ranged = rows.withColumn("range", range_of(F.col("key"), bounds))
    # The first key of each range, found without reading texts: a row for each range.
    firsts = ranged.groupBy("range").agg(F.min(F.struct(F.col("key").isNotNull(), "key")).alias("first"))
    whole = Window.orderBy("range")
    everything = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select(
        F.col("range").alias("of"),
        F.coalesce(F.lag("range").over(whole), F.max("range").over(everything)).alias("before"),
        F.col("first.key").alias("first_key"),
    )
    # `range_bounds` gives at most 8192 ranges, so this side has no more rows than that.
    is_first = (F.col("range") == F.col("of")) & F.col("key").eqNullSafe(F.col("first_key"))
    copies = ranged.join(F.broadcast(firsts), is_first).groupBy("before").agg(F.min("text").alias("text"))
    copies = copies.select(
        F.lit(None).cast(rows.schema["key"].dataType).alias("key"), "text",
        F.col("before").alias("range"), F.lit(True).alias("copy"),
    )
    both = ranged.select("key", "text", "range", F.lit(False).alias("copy")).unionByName(copies)
    full = derive(both.repartition("range"), "text")
    added = [c for c in full.columns if c not in ("key", "range", "copy")]
    order = Window.partitionBy("range").orderBy("copy", F.col("key").asc_nulls_first(), "text")
    full = full.withColumn("next", F.lead(F.struct(*added)).over(order)).filter(~F.col("copy"))
    own = [F.col(c) for c in added if c != "text"]
    return full.select(F.col("key").alias(key), F.col("text").alias(text), *own, "next")


def edited(text: Column, following: Column) -> Column:
    """`text` with its last half (rounded down, in code points) replaced by as many characters of
    the beginning of `following`, or all of them."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def fingerprints(df: DataFrame, key: str, text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """One row per row of `df`: `key`, the fingerprints of its text and of its edited text, and how
    like its own is to the edited text's and to the next document's.

    Null texts count as empty. Repeated rows stay. Only the two named columns are read.
    """

    def hashed(rows: DataFrame, name: str, to: str) -> DataFrame:
        return with_anchors(rows, name, to, k, s).withColumn(to, hashes(F.col(to)))

    rows = with_next(df, key, text, lambda r, name: hashed(r, name, "own"))
    rows = rows.withColumn("edited_text", edited(F.col(text), F.col("next.text")))
    rows = hashed(rows, "edited_text", "edited")
    return rows.select(
        key,
        F.char_length(text).cast("long").alias("n_chars"),
        F.sha2("edited_text", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next.own")).alias("near_next"),
    )
