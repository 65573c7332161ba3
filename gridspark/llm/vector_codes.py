"""Operator 12: vectors as short codes, by a codebook for each part, with norm-of-sum bounds.

A vector is cut into equal parts and each part is named by the nearest entry of its own codebook,
which rounds of assigning and averaging have fitted. All arithmetic that decides is on integers.

Each part of a vector carries two bounds between rounds: one from above on the distance to its own
entry, one from below on the distance to all others, and with each the round in which it was exact.
The codebooks of all rounds are kept, so a bound is brought up to date by how far an entry lies now
from where it was in that round: the norm of the sum of its moves, which is at most, and as entries
turn back mostly well below, the sum of their norms. If the two bounds are apart, the entry stays
without any distance; if they are not, the distance to the own entry is taken exactly; only if that
does not part them either, all entries are gone through.

A round is one pass over the rows. It writes rows with their bounds and, for each task, one row of
sums; these are added up by Spark and only the new entries, whose number is fixed, go to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gridspark.llm.common import for_workers, forgotten, written
from gridspark.session import scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components are cut to this range, within which no square or sum overflows (±32,768 before scaling).
MOST = 1 << 27
#: What float rounding may add to a bound, relative and absolute.
MARGIN = 1e-9

#: What is known of one part of a vector: its entry, and a bound from above and one from below, each
#: with the round in which it was exact.
BOUNDS = np.dtype([("entry", "u1"), ("upper", "<f4"), ("upper_at", "u1"), ("lower", "<f4"), ("lower_at", "u1")])


class Compressed(NamedTuple):
    """`rows`: key, label, `code` (one byte for each part), `error`; `codebooks`: part, entry, position."""

    rows: DataFrame
    codebooks: np.ndarray


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of `x` to each entry."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for j in range(x.shape[1]):
        apart = x[:, j, None] - entries[None, :, j]
        out += apart * apart
    return out


def moves(history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By round, part and entry: how far the entry lies now from its place in that round, and the
    same for the one of the other entries that lies farthest."""
    net = np.sqrt(((history - history[-1]).astype(np.float64) ** 2).sum(axis=3))
    if net.shape[2] == 1:
        return net, np.zeros_like(net)
    ranked = np.sort(net, axis=2)
    most, second = ranked[:, :, -1:], ranked[:, :, -2:-1]
    first = np.arange(net.shape[2]) == net.argmax(axis=2)[:, :, None]
    return net, np.where(first, second, most)


def assign(x: np.ndarray, state: np.ndarray | None, history: np.ndarray) -> tuple[np.ndarray, int]:
    """Bounds after this round for the parts `x` (row, part, position), and how many parts had to be
    held against all entries. `history` has the codebooks of all rounds up to this one."""
    now, books = len(history) - 1, history[-1]
    rescans = 0
    out = np.zeros(x.shape[:2], BOUNDS) if state is None else state.copy()
    net, others = moves(history)
    for part in range(x.shape[1]):
        mine = out[:, part]
        open_rows = np.arange(len(x))
        if state is not None:
            entry = mine["entry"].astype(np.int64)
            upper = mine["upper"].astype(np.float64) + net[mine["upper_at"], part, entry]
            lower = mine["lower"].astype(np.float64) - others[mine["lower_at"], part, entry]
            close = upper * (1 + MARGIN) + MARGIN >= lower
            near = np.flatnonzero(close)
            apart = x[near, part] - books[part, entry[near]]
            exact = np.sqrt((apart * apart).sum(axis=1).astype(np.float64))
            mine["upper"][near] = _up(exact)
            mine["upper_at"][near] = now
            open_rows = near[exact * (1 + MARGIN) + MARGIN >= lower[near]]
        if not len(open_rows):
            continue
        rescans += len(open_rows)
        all_of = squares(x[open_rows, part], books[part])
        best = all_of.argmin(axis=1)
        at = np.arange(len(open_rows))
        mine["entry"][open_rows] = best
        mine["upper"][open_rows] = _up(np.sqrt(all_of[at, best].astype(np.float64)))
        all_of[at, best] = np.iinfo(np.int64).max
        mine["lower"][open_rows] = _down(np.sqrt(all_of.min(axis=1).astype(np.float64)))
        mine["upper_at"][open_rows] = mine["lower_at"][open_rows] = now
    return out, rescans


def _up(distance: np.ndarray) -> np.ndarray:
    return np.nextafter(distance.astype(np.float32), np.float32(np.inf))


def _down(distance: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter(distance.astype(np.float32), np.float32(-np.inf)), np.float32(0))


def averages(books: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The next codebooks: means, cut down to whole numbers; entries without parts stay."""
    used = counts > 0
    means = np.floor_divide(sums, np.maximum(counts, 1)[:, :, None])
    return np.where(used[:, :, None], means, books)


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and has finite components only."""
    fine = F.forall(
        F.col(vector),
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)),
    )
    return df.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & fine)


def whole(values: np.ndarray) -> np.ndarray:
    """Components as integers."""
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -MOST, MOST).astype(np.int64)


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    """The bytes of a binary column without nulls whose values are all `width` long."""
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int32, 1, column.offset * 4)[0]
    return np.frombuffer(data, np.uint8, len(column) * width, first).reshape(len(column), width)


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value for each row of bytes."""
    flat = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * flat.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def _pass(rows: DataFrame, history: np.ndarray, dims: int, first: bool) -> DataFrame:
    """A round: rows with new bounds and errors, and a row of sums for each task."""
    for_workers(rows.sparkSession)
    parts, entries = history.shape[1:3]
    key, label = rows.schema.fields[:2]
    kinds = [to_arrow_type(key.dataType), to_arrow_type(label.dataType)]
    shape = pa.schema([
        ("key", kinds[0]), ("label", kinds[1]), ("ints", pa.binary()), ("bounds", pa.binary()),
        ("error", pa.int64()), ("sums", pa.list_(pa.int64())),
    ])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = history[-1]
        sums = np.zeros((parts, entries, dims // parts), np.int64)
        counts = np.zeros((parts, entries), np.int64)
        for frame in frames:
            if not frame.num_rows:
                continue
            state = None
            if first:
                x = whole(frame.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))
                ints = _binary(x.astype("<i4"))
            else:
                ints = frame.column(2)
                x = _fixed(ints, dims * 4).copy().view("<i4").astype(np.int64)
                state = _fixed(frame.column(3), parts * BOUNDS.itemsize).copy().view(BOUNDS)
            x = x.reshape(len(x), parts, -1)
            bounds, _ = assign(x, state, history)
            error = np.zeros(len(x), np.int64)
            for part in range(parts):
                entry = bounds["entry"][:, part]
                apart = x[:, part] - books[part, entry]
                error += (apart * apart).sum(axis=1)
                np.add.at(sums[part], entry, x[:, part])
                counts[part] += np.bincount(entry, minlength=entries)
            yield pa.RecordBatch.from_arrays(
                [
                    frame.column(0), frame.column(1), ints, _binary(bounds.view(np.uint8)), pa.array(error),
                    pa.nulls(len(x), pa.list_(pa.int64())),
                ],
                schema=shape,
            )
        if counts.any():
            found = np.concatenate([sums.ravel(), counts.ravel()])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind) for kind in list(shape.types)[:5]] + [pa.array([found], pa.list_(pa.int64()))],
                schema=shape,
            )

    kind = [f"{name} {field.dataType.simpleString()}" for name, field in (("key", key), ("label", label))]
    return rows.mapInArrow(run, f"{', '.join(kind)}, ints binary, bounds binary, error long, sums array<long>")


def _added(table: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of all tasks: as many numbers as the codebooks have."""
    each = table.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "x"))
    found = np.zeros(books.size + books.shape[0] * books.shape[1], np.int64)
    for row in each.groupBy("at").agg(F.sum("x").alias("x")).collect():
        found[row["at"]] = row["x"]
    return found[: books.size].reshape(books.shape), found[books.size :].reshape(books.shape[:2])


def compressed(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> Compressed:
    """Codes of the vectors of `df` and the codebooks.

    Rows whose vector is null or empty, or holds null or non-finite components, go; of the others
    those stay whose number of components is the most frequent one that `parts` divides (of equally
    frequent ones the least), since all vectors are cut alike. A component x counts as
    floor(4096 x), cut to ±2^27. The codebooks begin as the parts of the rows with the smallest keys
    (of rows with the same key the smaller vector first; null keys only if there is no other); with fewer rows than
    `entries` they have as many entries as there are rows, and without any row there is no result.
    Distances tie to the lower entry. Rows with a null key or label are coded like any other, repeated
    rows stay. Only the three named columns are read, whatever others are called.
    """
    if not 1 <= entries <= 256 or not 1 <= rounds <= 255:
        raise ValueError("entries must be 1 to 256, rounds 1 to 255")
    spark = df.sparkSession
    good = usable(df.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector")), "vector")
    by_size = good.groupBy(F.size("vector").alias("dims")).count().where(F.col("dims") % parts == 0)
    most = by_size.orderBy(F.desc("count"), "dims").first()
    dims = most["dims"] if most else parts
    rows = good.where(F.size("vector") == dims)
    # As many rows as a codebook has entries.
    seeds = rows.where("key IS NOT NULL").orderBy("key", "vector").limit(entries).select("vector").collect()
    if not seeds:
        seeds = rows.orderBy("vector").limit(entries).select("vector").collect()
    if not seeds:
        empty = rows.select("key", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
        return Compressed(empty, np.zeros((parts, 0, dims // parts), np.int64))
    books = whole(np.array([seed["vector"] for seed in seeds])).reshape(len(seeds), parts, -1).transpose(1, 0, 2)
    history, table, path = books[None], rows, None
    for turn in range(rounds + 1):
        after = scratch_path(spark, "codes")
        made = _pass(table, history, dims, turn == 0)
        made.write.option("compression", "zstd").parquet(after)
        # The round before is not read again: its copy goes.
        forgotten(spark, path)
        path, table = after, spark.read.schema(made.schema).parquet(after)
        if turn < rounds:
            sums, counts = _added(table, books)
            books = averages(books, sums, counts)
            history = np.concatenate([history, books[None]])
        table = table.where("ints IS NOT NULL")
    entry_of = [F.substring("bounds", 1 + part * BOUNDS.itemsize, 1) for part in range(parts)]
    return Compressed(table.select("key", "label", F.concat(*entry_of).alias("code"), "error"), books)


def label_errors(rows: DataFrame) -> DataFrame:
    """`rows` with `label_error`, the sum of `error` over rows of the same label, nulls together.

    The sums are written first, so that Spark knows their size and sends them to all tasks only if it
    is small; else it splits the large partitions of a frequent label.
    """
    sums = written(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    same = rows["label"].eqNullSafe(sums["label"])
    return rows.join(sums, same, "left").select(rows["key"], rows["code"], rows["error"], "label_error")


def decimal_text(books: np.ndarray) -> str:
    """All components by part, entry and position, comma-joined."""
    return ",".join(str(x) for x in books.ravel().tolist())


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same in DuckDB's SQL over `embeddings`, each round a pair of common table expressions."""
    steps = [f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, [CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT) FOR x IN embedding] AS ints
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), parts AS MATERIALIZED (
    SELECT vec_id, p, ints[p * len(ints) // {parts} + 1 : (p + 1) * len(ints) // {parts}] AS v
    FROM kept, (SELECT unnest(range({parts})) AS p)
), c0 AS MATERIALIZED (
    SELECT p, i - 1 AS e, v
    FROM (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id) AS i FROM parts) WHERE i <= {entries}
)"""]
    for turn in range(rounds + 1):
        steps.append(f"""a{turn} AS MATERIALIZED (
    SELECT vec_id, p, any_value(v) AS v, min({{'d': d, 'e': e}}) AS best FROM (
        SELECT a.vec_id, a.p, a.v, c.e,
               list_sum([(a.v[i] - c.v[i]) * (a.v[i] - c.v[i]) FOR i IN range(1, len(a.v) + 1)]) AS d
        FROM parts a JOIN c{turn} c ON a.p = c.p)
    GROUP BY vec_id, p
)""")
        if turn < rounds:
            steps.append(f"""c{turn + 1} AS MATERIALIZED (
    SELECT c.p, c.e, coalesce(m.v, c.v) AS v FROM c{turn} c LEFT JOIN (
        SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
            SELECT p, best.e AS e, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
            FROM (SELECT p, best, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{turn}) GROUP BY ALL)
        GROUP BY p, e) m ON c.p = m.p AND c.e = m.e
)""")
    steps.append(f"""coded AS (
    SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
    FROM a{rounds} GROUP BY vec_id
), digest AS (
    SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest""")
    return ", ".join(steps)
