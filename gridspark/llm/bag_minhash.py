"""Operator 10: near-duplicates by weighted Jaccard similarity of word shingles, with BagMinHash.

A text is the multiset of its runs of five words. For each shingle a Poisson process scatters points
over time and weight: the weight axis is cut into dyadic layers (0, 1], (1, 2], (2, 4], ..., each with
a process of its own whose rate is the layer's length; inside a layer each point has a place, and a
shingle that occurs w times keeps the points at places up to w. So texts share the points of what
they have in common, and no work goes into copies that are not there. Each point falls into one of
the signature's slots, where the earliest one stays: two slots are equal with the probability of the
weighted Jaccard similarity.

Slots are banded. Texts of a bucket are compared with its centre, the text that meets most others in
all its buckets (of many copies, the one they were made from, if it is there). Pairs that a longer
signature cannot rule out are decided by the exact overlap of the two multisets. Links tie texts into
classes. Buckets that then still hold several classes are compared pair by pair between classes, so a
group of n copies costs n comparisons, not n², unless most of them are too far from each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import for_workers, text_or_empty, written
from gridspark.llm.components import components

SHINGLE, LEAST = 5, 0.8
BANDS, ROWS = 32, 6
SLOTS = BANDS * ROWS
#: Slots of the longer signature of texts that meet others, two bits of each.
LONG_SLOTS = 1536
#: Characters of the texts that are hashed together.
GROUP_CHARS = 1 << 20

#: Time is counted in these parts.
SECOND = 2.0**40
NEVER = np.iinfo(np.int64).max

_BASE = 0x9E3779B97F4A7C15 | 1
_WORD = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit integers whose output looks random (splitmix64)."""
    x = x + _WORD(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _WORD(30))) * _WORD(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _WORD(27))) * _WORD(0x94D049BB133111EB)
    return x ^ (x >> _WORD(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _WORD(base & (2**64 - 1)), _WORD)
    out[0] = 1
    return np.multiply.accumulate(out)


def shingles(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `size` words of each text, and the number of the text of each.

    Words are what white space parts. A text with fewer words has one shingle, all of it; one
    without words has none.
    """
    split = [t.split() for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    if not counts.sum():
        return np.empty(0, _WORD), np.empty(0, np.int64)
    data = np.frombuffer((" ".join(w for words in split for w in words) + " ").encode(), np.uint8)
    ends = np.flatnonzero(data == 32)
    begins = np.concatenate([[0], ends[:-1] + 1])
    # Words as polynomials in an odd base, from one running sum over the whole text.
    inverse = pow(_BASE, -1, 2**64)
    sums = np.concatenate([[_WORD(0)], np.cumsum(data * _powers(_BASE, len(data)))])
    words = _mix((sums[ends] - sums[begins]) * _powers(inverse, len(data))[begins] + (ends - begins).astype(_WORD))
    each = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    doc = np.repeat(np.arange(len(texts)), each)
    first = np.repeat(np.cumsum(counts) - counts - np.cumsum(each) + each, each) + np.arange(each.sum())
    padded = np.concatenate([words, np.zeros(size, _WORD)])
    total = np.zeros(len(first), _WORD)
    room = np.repeat(np.cumsum(counts), each) - first  # words from here to the text's end
    for j, factor in enumerate(_powers(_BASE, size + 1)[1:]):
        total += np.where(j < room, padded[first + j], _WORD(j)) * factor
    return _mix(total), doc


def weighted(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts: hashes, texts, weights."""
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return hashes[at], doc[at], np.diff(np.append(at, len(hashes)))


def occurrences(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The multisets as sets: the k-th occurrence of a shingle in a text as an element of its own."""
    distinct, of, weight = weighted(hashes, doc)
    ends = np.cumsum(weight)
    k = np.arange(len(hashes)) - np.repeat(ends - weight, weight)
    return _mix(np.repeat(distinct, weight) ^ _mix(k.astype(_WORD))), np.repeat(of, weight)


def signatures(hashes: np.ndarray, doc: np.ndarray, docs: int, slots: int = SLOTS) -> np.ndarray:
    """A row of `slots` arrival times for each text; `NEVER` for a text without shingles.

    Times are whole numbers of 2^-40, so sums do not depend on what else is in the batch.
    """
    element, of, weight = weighted(hashes, doc)
    out = np.full((docs, slots), NEVER)
    total = np.bincount(of, weight, docs)
    # The layers of an element: number 0 up to 1, number j from 2^(j-1) up to 2^j.
    layers = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64), 0) + 1
    element, of, weight = (np.repeat(x, layers) for x in (element, of, weight))
    ends = np.cumsum(layers)
    layer = np.arange(len(element)) - np.repeat(ends - layers, layers)
    low = np.where(layer > 0, 2.0 ** (layer - 1), 0.0)
    length = np.where(layer > 0, low, 1.0)
    seed = _mix(element ^ _mix(layer.astype(_WORD) + _WORD(1)))
    # In this time about seven of eight texts get all their slots.
    horizon = ((np.log(slots) + 2) * slots / np.maximum(total, 1) * SECOND).astype(np.int64)
    todo = np.arange(len(element))
    while len(todo):
        _arrivals(out, seed[todo], of[todo], weight[todo], low[todo], length[todo], horizon)
        # Texts with slots that no point has reached look further.
        open_docs = (out == NEVER).any(axis=1) & (total > 0)
        todo = todo[open_docs[of[todo]]]
        horizon = horizon * 2
    return out


def _arrivals(out, seed, of, weight, low, length, horizon) -> None:
    """Put the points up to each text's horizon into its slots."""
    slots = out.shape[1]
    flat = out.reshape(-1)
    time, count = np.zeros(len(seed), np.int64), np.zeros(len(seed), np.int64)
    while len(seed):
        left = (horizon[of] - time) / SECOND * length
        number = np.ceil(left).astype(np.int64) + 2
        # Huge processes in portions, so that a batch stays small.
        number = np.minimum(number, max(8, (1 << 20) // len(seed)))
        ends = np.cumsum(number)
        which = np.repeat(np.arange(len(seed)), number)
        k = np.arange(ends[-1]) - np.repeat(ends - number, number) + count[which]
        random = _mix(seed[which] + k.astype(_WORD) * _WORD(_BASE))
        uniform = ((random >> _WORD(11)).astype(np.float64) + 0.5) * 2.0**-53
        step = (np.log(uniform) * (-SECOND / length[which])).astype(np.int64) + 1
        run = np.cumsum(step)
        run -= np.repeat(run[ends - number] - step[ends - number], number)
        at = time[which] + run
        last = at[ends - 1]
        place = _mix(random)
        # 32 bits for the slot, 32 for the place in the layer.
        slot = ((place >> _WORD(32)) * _WORD(slots)) >> _WORD(32)
        inside = low[which] + length[which] * ((place & _WORD(0xFFFFFFFF)).astype(np.float64) + 1) * 2.0**-32
        good = (at <= horizon[of][which]) & (inside <= weight[which])
        np.minimum.at(flat, of[which][good] * slots + slot[good].astype(np.int64), at[good])
        more = last < horizon[of]
        time, count = last[more], (count + number)[more]
        seed, of, weight, low, length = (x[more] for x in (seed, of, weight, low, length))


def bands(rows: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A hash for each band of a signature."""
    bits = rows.view(_WORD).reshape(len(rows), bands, -1)
    mixed = np.broadcast_to(np.arange(1, bands + 1, dtype=_WORD), (len(rows), bands)).copy()
    for j in range(bits.shape[2]):
        mixed = _mix(mixed ^ bits[:, :, j])
    return mixed.view(np.int64)


def short_slots(rows: np.ndarray) -> np.ndarray:
    """Two hashed bits of each slot, 32 slots to an integer."""
    two = (_mix(rows.view(_WORD)) & _WORD(3)).reshape(len(rows), -1, 32)
    shifted = two << (np.arange(32, dtype=_WORD) * _WORD(2))
    return np.bitwise_or.reduce(shifted, axis=2).view(np.int64)


def _groups(frame: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `GROUP_CHARS` characters of its last column."""
    sizes = np.cumsum(pa.compute.binary_length(frame.column(frame.num_columns - 1)).to_numpy(zero_copy_only=False))
    at = 0
    while at < frame.num_rows:
        before = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, before + GROUP_CHARS, "right")))
        yield frame.slice(at, to - at)
        at = to


def signed(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """`id`, `digest` of the text, `n` shingles and `bands` for rows of `id`, `text`."""
    for_workers(docs.sparkSession)

    def run(frames):
        import pyarrow.compute  # noqa: F401

        for frame in frames:
            for part in _groups(frame):
                texts = part.column(2).to_pylist()
                hashes, doc = shingles(texts, size)
                rows = signatures(hashes, doc, len(texts))
                n = np.bincount(doc, minlength=len(texts))
                flat = bands(rows).reshape(-1)
                some = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, BANDS, np.int32), flat)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), some],
                    names=["id", "digest", "n", "bands"],
                )

    given = docs.select("id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), "text")
    return given.mapInArrow(run, "id long, digest binary, n long, bands array<long>")


def refined(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """`id`, `n` shingles, `slots` (the longer signature, short) and `elements` (occurrences of
    shingles, see `occurrences`) for rows of `id`, `text`."""
    for_workers(docs.sparkSession)
    step = LONG_SLOTS // 32

    def run(frames):
        import pyarrow.compute  # noqa: F401

        for frame in frames:
            for part in _groups(frame):
                texts = part.column(1).to_pylist()
                hashes, doc = shingles(texts, size)
                found, of = occurrences(hashes, doc)
                number = np.bincount(of, minlength=len(texts))
                ends = np.concatenate([[0], np.cumsum(number)])
                lists = pa.ListArray.from_arrays(ends.astype(np.int32), found.view(np.int64))
                flat = short_slots(signatures(hashes, doc, len(texts), LONG_SLOTS)).reshape(-1)
                slots = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, step, np.int32), flat)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(number, pa.int64()), slots, lists],
                    names=["id", "n", "slots", "elements"],
                )

    return docs.select("id", "text").mapInArrow(run, "id long, n long, slots array<long>, elements array<long>")


def _unlike(a: str, b: str) -> str:
    """SQL for the number of slots in which two longer signatures differ."""
    def one(i: int) -> str:
        other = f"({a}.slots[{i}] ^ {b}.slots[{i}])"
        return f"bit_count(({other} | shiftrightunsigned({other}, 1)) & 6148914691236517205)"

    return " + ".join(one(i) for i in range(LONG_SLOTS // 32))


def _most_unlike(least: float) -> int:
    """Differing slots that a pair at the threshold exceeds with a chance of one in ten million.

    Two bits are alike by chance one time in four.
    """
    p = (1 - least) * 0.75
    return int(LONG_SLOTS * p + 5.2 * (LONG_SLOTS * p * (1 - p)) ** 0.5) + 1


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`pairs` (`a`, `b`) with the exact weighted Jaccard similarity `near` of their multisets."""
    one = sets.select(F.col("id").alias("b"), F.col("elements").alias("of_b"))
    two = sets.select(F.col("id").alias("a"), F.col("elements").alias("of_a"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    near = both / (F.size("of_a") + F.size("of_b") - both)
    return pairs.join(one, "b").join(two, "a").select("a", "b", near.alias("near"))


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST, size: int = SHINGLE
) -> DataFrame:
    """One row per row of `df`: `key` and `class_id`, the smallest key of its class.

    Texts are tied if the weighted Jaccard similarity of their shingles is `least` or more, and
    copies of a text always are; a class is all that ties connect. Null texts count as empty; a text
    without words is tied to its copies only. Keys are integers; rows with the same key are one document of several
    texts and end in one class, a null key is kept with a null class. Only the two columns are read.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), text_or_empty(text).alias("text"))
    keyed = rows.filter("id IS NOT NULL")
    seen = written(signed(keyed, size), "signatures")
    # Copies: one document stands for all with the same text. Texts have numbers of their own, fixed by
    # being written, as a document may stand for several texts.
    stands = seen.groupBy("digest").agg(F.min("id").alias("of"))
    stands = written(stands.withColumn("node", F.monotonically_increasing_id()), "stands")
    copies = written(seen.select("id", "digest").join(stands, "digest").select("id", "of"), "copies")
    own = seen.withColumnRenamed("id", "of").join(stands, ["digest", "of"])
    own = own.filter("n > 0").dropDuplicates(["digest"]).select(
        F.col("node").alias("id"), "of", F.xxhash64("digest").alias("hash"), F.explode("bands").alias("bucket")
    )
    sizes = own.groupBy("bucket").agg(F.count("*").alias("members"))
    rows_of = written(own.join(sizes.filter("members > 1"), "bucket"), "buckets")
    meets = rows_of.groupBy("id").agg(F.sum("members").alias("met"))
    centres = rows_of.join(meets, "id").groupBy("bucket").agg(
        F.max(F.struct("met", (-F.col("of")).alias("low"), "hash", "id")).alias("best")
    )
    centres = centres.select("bucket", F.col("best.id").alias("first"))
    buckets = written(rows_of.select("bucket", "id").join(centres, "bucket"), "centres")

    ids_met = buckets.select("id").distinct()
    met = stands.join(ids_met.withColumnRenamed("id", "node"), "node")
    texts = keyed.select(F.col("id").alias("of"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), "text")
    texts = texts.join(met, ["digest", "of"]).select(F.col("node").alias("id"), "text")
    known_of = written(refined(texts, size).dropDuplicates(["id"]), "refined")
    light, sets = known_of.select("id", "n", "slots"), known_of.select("id", "elements")
    near_enough = (
        f"least(x.n, y.n) >= {least} * greatest(x.n, y.n) AND {_unlike('x', 'y')} <= {_most_unlike(least)}"
    )
    pairs = buckets.filter("first <> id").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    stars = pairs.join(light.alias("x"), F.col("a") == F.col("x.id"))
    stars = stars.join(light.alias("y"), (F.col("b") == F.col("y.id")) & F.expr(near_enough)).select("a", "b")
    checked = written(_verified(stars, sets), "checked")
    ties = checked.filter(F.col("near") >= least).select("a", "b")
    known = components(ties)

    # What the centre of a bucket has not tied together: pairs of different classes. Distance is a
    # metric, so two texts whose distances to the centre differ by more than 1 - least are no pair.
    placed = buckets.join(known.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.select("bucket", "first", "id", F.coalesce("root", "id").alias("root"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members"))
    mixed = mixed.filter("low < high AND members > 2").select("bucket")
    rest = placed.join(mixed, "bucket", "left_semi").filter("first <> id")
    rest = rest.join(checked.select(F.col("a").alias("first"), F.col("b").alias("id"), "near"), ["first", "id"], "left")
    # Texts that share several buckets are compared in the first of them only.
    shared = rest.groupBy("id").agg(F.collect_set("bucket").alias("buckets"))
    rest = rest.join(light, "id").join(shared, "id")
    # Written: its large partitions can be split in the join with itself.
    rest = written(rest.select("bucket", "id", "root", "n", "slots", "near", "buckets"), "rest")
    crossed = rest.alias("x").join(
        rest.alias("y"),
        F.expr(
            "x.bucket = y.bucket AND x.id < y.id AND x.root <> y.root AND "
            f"abs(coalesce(x.near - y.near, 0)) <= {1 - least + 1e-9} AND {near_enough} "
            "AND x.bucket = array_min(array_intersect(x.buckets, y.buckets))"
        ),
    )
    crossed = crossed.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    further = _verified(crossed, sets).filter(F.col("near") >= least).select("a", "b")
    same_key = copies.filter("id <> of").select(F.col("id").alias("a"), F.col("of").alias("b"))
    # From texts to the documents that stand for them.
    tied = ties.union(further)
    for side in ("a", "b"):
        tied = tied.join(stands.select(F.col("node").alias(side), F.col("of").alias(f"{side}_of")), side)
    tied = tied.select(F.col("a_of").alias("a"), F.col("b_of").alias("b"))
    classes = components(tied.union(same_key)).select(F.col("node").alias("id"), "root")
    ids = rows.select("id")
    out = ids.join(classes, "id", "left")
    return out.select(F.col("id").alias(key), F.coalesce("root", "id").alias("class_id"))
