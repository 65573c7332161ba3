"""Operator 11: exact Jaccard join of word n-gram sets by a blocked sparse matrix product.

Rows of the matrix are documents, columns are n-grams, and the product of the matrix with itself
transposed has the size of each pair's intersection. Only pairs with
inter >= need = ceil(t (n_a + n_b) / (1 + t)) are wanted, so the product is taken block by block:

* Columns. The first block of a document are the k of its n n-grams with the smallest hashes. What of
  an intersection lies outside of both first blocks is at most max(n_a - k_a, n_b - k_b), so a linked
  pair has at least need - max(...) of these columns in common; k is chosen so that this is a twentieth
  of a document. Of these columns again the rarest are enough to meet in at least one: columns of
  one document fall out, and what many documents share (a license, a passage) comes last and is not
  looked at unless a document consists of it.
* Rows. The product only takes pairs of documents whose sizes allow a link.
* Counts. All columns are also folded into 2,048, in which a document has the parity of its n-grams.
  Where two parities differ, some n-gram is in one of the sets only, so these places, counted, bound the
  overlap of the pair from above; a pair below what its sizes need is discarded. For the rest the
  product runs over all columns.

Equal sets are one row. Rows of a column are first held against one of them, so that a group of copies
is tied together by as many pairs as it has members; the product then skips columns whose documents
are all tied together, and pairs that are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import for_workers, groups, text_or_empty, written
from gridspark.llm.components import components

SHINGLE = 4
#: Jaccard similarity of a link, in hundredths.
LEAST = 85
#: Columns that all others are folded into.
FOLDED = 2048
#: Rows of a part of a column; a block of the product has two parts.
PART_ROWS = 512
#: Bytes of the texts that are hashed together.
GROUP_BYTES = 1 << 20

_WORD = np.uint64
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 2**64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit integers whose output looks random."""
    x = (x ^ (x >> _WORD(32))) * _WORD(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _WORD(32))) * _WORD(0xD6E8FEB86659FD93)
    return x ^ (x >> _WORD(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _WORD(base), _WORD)
    out[:1] = 1
    return np.multiply.accumulate(out)


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word: runs of bytes other than space and 9 to 13, A-Z as a-z."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    if not len(data):
        return np.empty(0, _WORD), np.empty(0, np.int64)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begins, ends = edges[::2], edges[1::2]
    # Polynomials in an odd base, from one running sum over all bytes.
    sums = np.concatenate([[_WORD(0)], np.cumsum((data + _WORD(1)) * _powers(_BASE, len(data)))])
    own = (sums[ends] - sums[begins]) * _powers(_INVERSE, len(data))[begins]
    starts = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
    return _mix(own + (ends - begins).astype(_WORD)), np.searchsorted(starts, begins, "right") - 1


def sets(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of each text, ascending, and how many each text has.

    A text with fewer words has one, the whole sequence; one without words has none.
    """
    hashes, doc = words(texts)
    counts = np.bincount(doc, minlength=len(texts))
    each = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    of = np.repeat(np.arange(len(texts)), each)
    first = np.arange(len(of)) + np.repeat(np.cumsum(counts) - counts - np.cumsum(each) + each, each)
    left = np.repeat(np.cumsum(counts), each) - first
    padded = np.concatenate([hashes, np.zeros(size, _WORD)])
    total = np.zeros(len(of), _WORD)
    for j, factor in enumerate(_powers(_INVERSE, size + 1)[1:]):
        total += np.where(j < left, padded[first + j], _WORD(j)) * factor
    total = _mix(total)
    order = np.lexsort((total, of))
    total, of = total[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (total[1:] != total[:-1]) | (of[1:] != of[:-1])
    return total[new], np.bincount(of[new], minlength=len(texts))


def first_block(n, least: int = LEAST):
    """Columns of the first block of a set of n; none for sets that have no link but equal ones."""
    return np.where(n * (100 - least) >= least, n * (100 - least) // 100 + n // 20 + 1, 0)


def in_common(n, least: int = LEAST):
    """What a set of n has in common with any linked one in both first blocks, at least."""
    return np.maximum(n // 20, 1)


def need(n_a, n_b, least: int = LEAST):
    """Size that the intersection of a linked pair has at least."""
    return -(-least * (n_a + n_b) // (100 + least))


def incidence(docs: DataFrame, whole: bool, size: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """`id`, `n`, two hashes `d1`, `d2` of the set and its `columns` (the first block; if `whole` all,
    and the parities `folded`) for rows of `id`, `text`."""
    for_workers(docs.sparkSession)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for part in groups(frame, GROUP_BYTES):
                found, n = sets(pc.cast(part.column(1), pa.binary()).to_pylist(), size)
                ends = np.cumsum(n)
                digests = []
                for seed in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
                    sums = np.concatenate([[_WORD(0)], np.cumsum(_mix(found ^ _WORD(seed)))])
                    digests.append(pa.array((sums[ends] - sums[ends - n]).view(np.int64)))
                taken = n if whole else first_block(n, least)
                stops = np.concatenate([[0], np.cumsum(taken)])
                at = np.arange(stops[-1]) + np.repeat(ends - n - stops[:-1], taken)
                lists = pa.ListArray.from_arrays(stops.astype(np.int32), found[at].view(np.int64))
                out = [part.column(0), pa.array(n, pa.int64()), *digests, lists]
                if whole:
                    flat = parities(found, np.repeat(np.arange(len(n)), n), len(n)).ravel().view(np.int64)
                    out.append(pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, FOLDED // 64, np.int32), flat))
                yield pa.RecordBatch.from_arrays(out, names=names)

    shape = "id long, n long, d1 long, d2 long, columns array<long>" + (", folded array<long>" if whole else "")
    names = [field.split()[0] for field in shape.split(", ")]
    return docs.select("id", "text").mapInArrow(run, shape)


def _rarest(shared: DataFrame, least: int) -> DataFrame:
    """`node`, `column`: of each first block the rarest columns, one of which a link needs to meet in.

    `shared` has `node`, `n`, `df`, `column` for the columns that several documents have; the others
    come before them in the order of rarity.
    """
    k = F.expr(f"n * {100 - least} div 100 + n div 20 + 1")
    wanted = k - F.greatest(F.expr("n div 20"), F.lit(1)) + 1
    by_node = shared.groupBy("node", "n").agg(F.sort_array(F.collect_set(F.struct("df", "column"))).alias("found"))
    left = (wanted - (k - F.size("found"))).cast("int")
    by_node = by_node.withColumn("left", left).where("left > 0")
    return by_node.select("node", F.explode(F.slice("found", 1, F.col("left"))["column"]).alias("column"))


def _alike(a: str, b: str, least: int) -> Column:
    """Sizes that allow a link."""
    return F.expr(f"100 * least({a}, {b}) >= {least} * greatest({a}, {b})")


def parities(hashes: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """For each text the parities of its n-grams in the folded columns, 64 of them to an integer."""
    column = (_mix(hashes ^ _WORD(0x8CB92BA72F3D8DD7)) % _WORD(FOLDED)).astype(np.int64)
    out = np.zeros(docs * FOLDED // 64, _WORD)
    np.bitwise_xor.at(out, doc * (FOLDED // 64) + column // 64, _WORD(1) << (column % 64).astype(_WORD))
    return out.reshape(docs, -1)


def _enough(a: str, b: str, least: int) -> Column:
    """That the folded columns leave an overlap of at least `need` possible."""
    differ = " + ".join(f"bit_count({a}.folded[{i}] ^ {b}.folded[{i}])" for i in range(FOLDED // 64))
    needed = f"({least} * ({a}.n + {b}.n) + {99 + least}) div {100 + least}"
    return F.expr(f"{a}.n + {b}.n - ({differ}) >= 2 * ({needed})")


def _linked(pairs: DataFrame, of: DataFrame, least: int) -> DataFrame:
    """The pairs (`a`, `b`) that are links: the product over all columns, for these pairs only."""
    one = of.select(F.col("node").alias("b"), F.col("columns").alias("of_b"))
    two = of.select(F.col("node").alias("a"), F.col("columns").alias("of_a"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - both
    return pairs.join(one, "b").join(two, "a").where(100 * both >= least * union).select("a", "b")


def starts(*keys: np.ndarray) -> np.ndarray:
    """Where rows of another key begin."""
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def block_pairs(
    order: np.ndarray, n: np.ndarray, root: np.ndarray, folded: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a block's rows that may be links, the one of lower `order` first: numbers of rows."""
    found = [], []
    for low in range(0, len(order), 256):
        x = slice(low, low + 256)
        may = (order[x, None] < order[None]) & (root[x, None] != root[None])
        small, large = np.minimum(n[x, None], n[None]), np.maximum(n[x, None], n[None])
        a, b = np.nonzero(may & (100 * small >= least * large))
        a += low
        for at in range(0, len(a), 1 << 16):
            i, j = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
            differ = np.bitwise_count(folded[i] ^ folded[j]).sum(axis=1, dtype=np.int64)
            good = n[i] + n[j] - differ >= 2 * need(n[i], n[j], least)
            found[0].append(i[good])
            found[1].append(j[good])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *found[0]]), np.concatenate([none, *found[1]])


def first_met(a: np.ndarray, b: np.ndarray, columns: list[np.ndarray], column: int) -> np.ndarray:
    """Which pairs (numbers of rows) have no smaller column in common than this one."""
    used = np.unique(np.concatenate([a, b]))
    lists = [columns[row][columns[row] < column] for row in used]
    row = np.repeat(used, [len(x) for x in lists])
    found, at, often = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    several = np.flatnonzero(often > 1)
    place = np.full(len(found), -1)
    place[several] = np.arange(len(several))
    has = np.zeros((len(columns), len(several)), bool)
    shared = place[at] >= 0
    has[row[shared], place[at][shared]] = True
    bits = np.packbits(has, axis=1)
    return np.concatenate([~(bits[a[i : i + 65536]] & bits[b[i : i + 65536]]).any(axis=1) for i in range(0, len(a), 65536)])


def _product(placed: DataFrame, light: DataFrame, least: int) -> DataFrame:
    """Pairs of different classes that meet in a column and may have the overlap that a link needs.

    `placed` has `node`, `root`, `column`; `light` has `node`, `n`, `folded`. Columns become numbers of
    32 bits; where two become one, more pairs meet than must. The rows of a column are dealt into parts
    of bounded size, and each two parts are a block of the product. A pair comes out in the first
    column it meets in.
    """
    numbers = placed.groupBy("node", "root").agg(F.collect_set(F.hash("column")).alias("columns"))
    each = numbers.select("node", "root", F.explode("columns").alias("column"))
    mixed = each.groupBy("column").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members")
    )
    mixed = written(mixed.where("low < high").select("column", "members"), "mixed")
    lists = each.join(mixed, "column").groupBy("node", "root").agg(
        F.collect_list(F.struct("column", "members")).alias("met")
    )
    rows = lists.join(light, "node").withColumn("columns", F.col("met.column")).withColumn("x", F.explode("met"))
    parts = F.ceil(F.col("x.members") / PART_ROWS).cast("int")
    rows = rows.withColumn("parts", parts).withColumn("column", F.col("x.column"))
    rows = rows.withColumn("side", F.pmod(F.xxhash64("node", "column"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select(
        "column", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"),
        "node", "n", "root", "side", "folded", "columns",
    )
    rows = rows.repartition("column", "i", "j").sortWithinPartitions("column", "i", "j")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def pairs(table: pa.Table) -> pa.RecordBatch:
            column, i, j, node, n, root, side = (table.column(c).to_numpy() for c in range(7))
            folded = table.column(7).combine_chunks().flatten().to_numpy().view(_WORD).reshape(len(node), -1)
            lists = table.column(8).combine_chunks()
            met, ends = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
            edges = starts(column, i, j)
            found: tuple[list, list] = ([], [])
            for low, high in zip(edges, np.append(edges[1:], len(node)), strict=True):
                if high - low > 1:
                    own = slice(low, high)
                    # Of two parts only pairs across, else each pair once.
                    order = side[own] if i[low] != j[low] else node[own]
                    a, b = block_pairs(order, n[own], root[own], folded[own], least)
                    if len(a):
                        good = first_met(a, b, [met[ends[r] : ends[r + 1]] for r in range(low, high)], column[low])
                        a, b = node[own][a[good]], node[own][b[good]]
                        found[0].append(np.minimum(a, b))
                        found[1].append(np.maximum(a, b))
            none = np.empty(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *x])) for x in found], names=["a", "b"])

        for frame in frames:
            if not frame.num_rows:
                continue
            # The last block of a batch may go on in the next one.
            cut = int(starts(*(frame.column(c).to_numpy() for c in range(3)))[-1])
            if cut:
                yield pairs(pa.Table.from_batches([*held, frame.slice(0, cut)]))
                held = []
            held.append(frame.slice(cut))
        if held:
            yield pairs(pa.Table.from_batches(held))

    return rows.mapInArrow(run, "a long, b long")


def joined(
    df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, size: int = SHINGLE
) -> DataFrame:
    """One row per row of `df`: `key`, `n_shingles` and `component_id`, the smallest key reachable.

    Two documents are linked if 100 * inter >= `least` * union of their sets of `size`-word n-grams
    (by hashes of 64 bits; words are runs of characters other than space, tab, line ends, form feed
    and vertical tab, A-Z count as a-z). Null texts count as empty; empty sets are linked with nothing. Keys are
    integers; rows that share a key are one document whose texts are tied together. A null key has a
    null component. Repeated rows stay; only the two columns are read.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), text_or_empty(text).alias("text"))
    seen = written(incidence(rows, False, size, least), "incidence")
    # Equal sets: one number stands for them, fixed by being written.
    keyed = seen.where("n > 0 AND id IS NOT NULL")
    same = keyed.groupBy("n", "d1", "d2").agg(F.min("id").alias("of"))
    nodes = written(same.withColumn("node", F.monotonically_increasing_id()), "nodes")

    # Any order of the columns will do that is the same for all; copies may count.
    often = keyed.select(F.explode("columns").alias("column")).groupBy("column").agg(F.count("*").alias("df"))
    standing = keyed.withColumnRenamed("id", "of").join(nodes, ["of", "n", "d1", "d2"])
    entries = standing.select("node", "n", F.explode("columns").alias("column"))
    shared = entries.join(often.where("df > 1"), "column")
    column = written(_rarest(shared, least), "chosen")

    members = column.groupBy("column").agg(F.count("*").alias("members")).where("members > 1")
    column = written(column.join(members, "column"), "columns")
    met = column.groupBy("node").agg(F.sum("members").alias("met"))
    centre = column.join(met, "node").groupBy("column").agg(F.max(F.struct("met", "node")).alias("best"))
    centre = centre.select("column", F.col("best.node").alias("a"))
    stars = column.join(centre, "column").where(F.col("node") != F.col("a")).select("a", F.col("node").alias("b")).distinct()

    # The sets of the documents that meet others, whole.
    wanted = column.select("node").distinct().join(nodes, "node")
    again = rows.join(wanted.select(F.col("of").alias("id")).distinct(), "id", "left_semi")
    full = incidence(again, True, size, least).withColumnRenamed("id", "of").join(wanted, ["of", "n", "d1", "d2"])
    full = written(full.select("node", "n", "columns", "folded").dropDuplicates(["node"]), "sets")
    light = full.select("node", "n", "folded")
    stars = stars.join(light.alias("x"), F.col("a") == F.col("x.node")).join(
        light.alias("y"), (F.col("b") == F.col("y.node")) & _alike("x.n", "y.n", least) & _enough("x", "y", least)
    ).select("a", "b")

    ties = written(_linked(stars, full, least), "ties")
    known = components(ties)
    placed = column.join(known, "node", "left").withColumn("root", F.coalesce("root", "node"))
    further = _linked(written(_product(placed, light, least), "pairs"), full, least)

    # Texts of one key are tied together.
    own = keyed.join(nodes, ["n", "d1", "d2"]).select("id", "node")
    several = own.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z")
    of_key = own.join(several, "id").where("node > a").select("a", F.col("node").alias("b"))
    classes = components(ties.union(further).union(of_key))
    tied = nodes.select("n", "d1", "d2", "of", "node").join(classes, "node", "left")
    tied = tied.withColumn("root", F.coalesce("root", "node"))
    smallest = tied.groupBy("root").agg(F.min("of").alias("component_id"))
    tied = tied.join(smallest, "root").select("n", "d1", "d2", "component_id")
    out = seen.join(tied, ["n", "d1", "d2"], "left")
    return out.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), "id")).alias("component_id"),
    )


#: The query's result in DuckDB's SQL over `documents`, all pairs that share an n-gram.
SQL = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), grams AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE [array_to_string(words[i : i + 3], ' ') FOR i IN range(1, len(words) - 2)] END) AS gram
    FROM docs
), sizes AS (
    SELECT d.doc_id, count(gram) AS n FROM docs d LEFT JOIN grams g USING (doc_id) GROUP BY d.doc_id
), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
    SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * shared >= 85 * (a.n + b.n - shared)
), ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
    SELECT doc_id, doc_id AS root FROM sizes
    UNION
    SELECT y, root FROM reached JOIN ways ON x = doc_id
)
SELECT doc_id, n AS n_shingles, component_id
FROM sizes JOIN (SELECT doc_id, min(root) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""
