"""Operator 5: benchmark decontamination by the q-gram lemma and banded alignment.

An item of m characters that occurs in a text with at most k edits shares at least
m - q + 1 - k·q of its q-grams with it, and all of them lie on k + 1 neighbouring diagonals (place
in the text less place in the item). Shared q-grams are counted in bands of 2(k + 1) diagonals that
overlap by half, so one of them holds the whole occurrence; bands that reach the bound are aligned,
inside the band, and kept if the edits are within the budget.

The bound must leave one q-gram at the least, so short items take shorter ones: q is at most m / (k + 1).

Items are taken in blocks of bounded size; each block is held against all texts, in a pass of its own
whose result is written before the next one.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.llm.common import for_workers, written

Q, EDITS = 8, 0.1
#: Characters of the items of a block, and of the texts that are searched together.
BLOCK_CHARS = 1 << 20
GROUP_CHARS = 1 << 20
TABLE_BITS = 22
_FACTOR = np.uint32(0x9E3779B1)
HIT = "array<struct<item_id:bigint,edits:int,begin:int,end:int>>"


class Block(NamedTuple):
    """Items that are found by q-grams of one length, with the table of these."""

    q: int
    ids: list[int]
    items: list[np.ndarray]
    budgets: np.ndarray  # k of each item
    bounds: np.ndarray  # shared q-grams that an occurrence has at least
    flags: np.ndarray  # which table places a q-gram of an item has
    grams: np.ndarray  # distinct q-grams, ascending
    begins: np.ndarray  # of each q-gram's occurrences
    owners: np.ndarray  # item of each occurrence
    places: np.ndarray  # place in the item of each occurrence


class Items(NamedTuple):
    blocks: list[Block]
    short: list[tuple[int, str]]  # items of fewer than q characters, searched as they are


def folded(text: str) -> str:
    """Lower case, each run of white space one space: what is compared."""
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def gram_hashes(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """A hash for the q-gram at each place; equal q-grams have equal ones."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.empty(0, np.uint32)
    out = np.zeros(n, np.uint32)
    for j in range(q):
        out *= _FACTOR
        out += chars[j : j + n]
    out *= np.uint32(0x85EBCA6B)
    out ^= out >> np.uint32(15)
    return out * np.uint32(0xC2B2AE35)


def budget_of(size: int, rate: float = EDITS) -> int:
    """Edits that an occurrence of an item of `size` characters may have."""
    return int(size * rate + 1e-9)


def items_of(items: list[tuple[int, str | None]], q: int = Q, rate: float = EDITS) -> Items:
    """Items by the length of the q-grams that find them. Null and blank ones take no part."""
    texts = [(i, folded(t)) for i, t in items if t is not None and t.strip()]
    by_q: dict[int, list[tuple[int, str]]] = {}
    for i, t in texts:
        if len(t) >= q:
            by_q.setdefault(max(1, min(q, len(t) // (budget_of(len(t), rate) + 1))), []).append((i, t))
    return Items([_block(own, size, rate) for size, own in sorted(by_q.items())], [(i, t) for i, t in texts if len(t) < q])


def _block(texts: list[tuple[int, str]], q: int, rate: float) -> Block:
    long = [(i, codes(t)) for i, t in texts]
    sizes = np.array([len(c) for _, c in long], np.int64)
    budgets = np.array([budget_of(len(c), rate) for _, c in long], np.int64)
    hashes = [gram_hashes(c, q) for _, c in long]
    every = np.concatenate(hashes)
    owners = np.repeat(np.arange(len(long)), [len(h) for h in hashes])
    places = np.concatenate([np.arange(len(h)) for h in hashes])
    order = np.argsort(every, kind="stable")
    grams, begins = np.unique(every[order], return_index=True)
    flags = np.zeros(1 << TABLE_BITS, bool)
    flags[grams >> np.uint32(32 - TABLE_BITS)] = True
    bounds = np.maximum(sizes - q + 1 - budgets * q, 1)
    return Block(
        q, [i for i, _ in long], [c for _, c in long], budgets, bounds, flags,
        grams, np.append(begins, len(every)), owners[order], places[order],
    )


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, starts: np.ndarray | None = None) -> np.ndarray:
    """Edits of the best alignment of `item` that stays on diagonals `low` to `high` and ends there.

    Entry d is for the diagonal `low + d`. The alignment may begin on any diagonal for free, or at
    the costs `starts`. Places outside the text match nothing.
    """
    width = high - low + 1
    padded = np.full(len(item) + width, 0xFFFFFFFF, np.uint32)
    a, b = max(low, 0), min(low + len(padded), len(text))
    if b > a:
        padded[a - low : b - low] = text[a:b]
    steps = np.arange(width)
    costs = np.zeros(width, np.int64) if starts is None else starts
    for i, char in enumerate(item):
        after = costs + (padded[i : i + width] != char)
        np.minimum(after[:-1], costs[1:] + 1, out=after[:-1])
        costs = np.minimum.accumulate(after - steps) + steps
    return costs


def occurrence(item: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """Edits, begin and end of the best occurrence on the diagonals, if within the budget."""
    m = len(item)
    a = max(low, 0)
    exact = text[a : high + m].tobytes().find(item.tobytes())
    if exact >= 0 and exact % 4 == 0:
        return 0, a + exact // 4, a + exact // 4 + m
    costs = align(item, text, low, high)
    best = int(costs.argmin())
    edits, end = int(costs[best]), low + best + m
    if edits > budget or not 0 < end <= len(text):
        inside = [int(c) for d, c in enumerate(costs) if 0 < low + d + m <= len(text)]
        if not inside or min(inside) > budget:
            return None
        edits = min(inside)
        end = next(low + d + m for d, c in enumerate(costs) if c == edits and 0 < low + d + m <= len(text))
    # Backwards from the end, which is now known, to the begin.
    back, reach = text[:end][::-1], edits
    only = np.full(2 * reach + 1, 1 << 40, np.int64)
    only[reach] = 0
    costs = align(item[::-1], back, -reach, reach, np.minimum.accumulate(only - np.arange(len(only))) + np.arange(len(only)))
    begin = end - (m - reach + int(costs.argmin()))
    return edits, max(begin, 0), end


def promising(candidates: list[tuple[np.ndarray, np.ndarray, int, int]]) -> np.ndarray:
    """Which candidates (item, text, lowest diagonal, budget) can be aligned within their budget on
    the 2(budget + 1) diagonals from there: all side by side, each dropped once it costs too much."""
    out = np.zeros(len(candidates), bool)
    if not candidates:
        return out
    order = sorted(range(len(candidates)), key=lambda c: -len(candidates[c][0]))
    width = max(2 * (c[3] + 1) for c in candidates)
    longest = len(candidates[order[0]][0])
    texts = np.full((len(order), longest + width), 0xFFFFFFFF, np.uint32)
    items = np.zeros((len(order), longest), np.uint32)
    for row, c in enumerate(order):
        item, text, low, _ = candidates[c]
        a, b = max(low, 0), min(low + len(item) + width, len(text))
        if b > a:
            texts[row, a - low : b - low] = text[a:b]
        items[row, : len(item)] = item
    which = np.array(order, np.int64)
    sizes = np.array([len(candidates[c][0]) for c in order], np.int64)
    budgets = np.array([candidates[c][3] for c in order], np.int32)
    steps = np.arange(width, dtype=np.int32)
    costs = np.zeros((len(order), width), np.int32)
    for i in range(longest):
        if i % 16 == 0 or i == sizes[-1]:
            over = sizes <= i
            within = costs.min(axis=1) <= budgets
            out[which[over & within]] = True
            go = within & ~over
            texts, items, which, sizes, budgets, costs = (x[go] for x in (texts, items, which, sizes, budgets, costs))
            if not len(which):
                return out
        after = costs + (texts[:, i : i + width] != items[:, i : i + 1])
        np.minimum(after[:, :-1], costs[:, 1:] + 1, out=after[:, :-1])
        costs = np.minimum.accumulate(after - steps, axis=1) + steps
    out[which[costs.min(axis=1) <= budgets]] = True
    return out


def search(texts: list[str], block: Block) -> list[dict[int, list[tuple[int, int, int]]]]:
    """For each folded text, the block's items (by number) that occur in it, and the edits, begin and
    end of occurrences that do not overlap, such that every other one overlaps one of them."""
    found: list[dict[int, list[tuple[int, int, int]]]] = [{} for _ in texts]
    if texts:
        q = block.q
        chars = codes("\n".join(texts))
        ends = np.cumsum([len(t) + 1 for t in texts])
        begins = ends - [len(t) + 1 for t in texts]
        hashes = gram_hashes(chars, q)
        at = np.flatnonzero(block.flags[hashes >> np.uint32(32 - TABLE_BITS)])
        rank = np.searchsorted(block.grams, hashes[at])
        rank[rank == len(block.grams)] = 0
        real = block.grams[rank] == hashes[at]
        at, rank = at[real], rank[real]
        number = block.begins[rank + 1] - block.begins[rank]
        many = np.cumsum(number)
        which = np.repeat(block.begins[rank] - many + number, number) + np.arange(many[-1] if len(many) else 0)
        item = block.owners[which]
        diagonal = np.repeat(at, number) - block.places[which]
        width = block.budgets[item] + 1
        shift = len(chars) + 2  # diagonals may be negative; keeps the band numbers positive
        band = (diagonal + shift) // width
        keys = item * (4 * shift) + band
        bands, counts = np.unique(np.concatenate([keys, keys - 1]), return_counts=True)
        owner = bands // (4 * shift)
        kept = counts >= block.bounds[owner]
        places, candidates = [], []
        for i, b in zip(owner[kept].tolist(), (bands[kept] % (4 * shift)).tolist(), strict=True):
            step = int(block.budgets[i]) + 1
            low = b * step - shift
            high = low + 2 * step - 1
            first = int(np.searchsorted(ends, max(low, 0), "right"))
            last = int(np.searchsorted(begins, high + len(block.items[i]), "left"))
            for d in range(first, min(last, len(texts))):
                if not len(texts[d]):
                    continue
                at_doc = int(begins[d])
                places.append((d, i, low - at_doc, high - at_doc))
                candidates.append((block.items[i], chars[at_doc : int(ends[d]) - 1], low - at_doc, step - 1))
        bands_of: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for c in np.flatnonzero(promising(candidates)).tolist():
            d, i, low, high = places[c]
            bands_of.setdefault((d, i), []).append((low, high))
        for (d, i), own in bands_of.items():
            text = chars[int(begins[d]) : int(ends[d]) - 1]
            hits = _occurrences(block.items[i], text, own, int(block.budgets[i]))
            if hits:
                found[d][i] = hits
    return found


def _occurrences(item: np.ndarray, text: np.ndarray, bands: list[tuple[int, int]], budget: int) -> list[tuple[int, int, int]]:
    """The best occurrences of the bands; where one is better than what overlaps it, the band of the
    other is searched again in what is left of the text."""
    kept: list[tuple[int, int, int]] = []
    while bands:
        hits = {band: hit for band in bands if (hit := occurrence(item, text, *band, budget))}
        hits = {b: h for b, h in hits.items() if all(h[2] <= k[1] or k[2] <= h[1] for k in kept)}
        chosen = _disjoint(set(hits.values()))
        bands = [band for band, hit in hits.items() if hit not in chosen]
        kept += chosen
        if bands:
            text = text.copy()
            for _, begin, end in chosen:
                text[begin:end] = 0xFFFFFFFE
    return sorted(kept, key=lambda hit: hit[1])


def _disjoint(hits: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of overlapping hits the one with fewest edits, then the first; in the order of the text."""
    kept: list[tuple[int, int, int]] = []
    begins: list[int] = []
    for hit in sorted(hits):
        at = bisect(begins, hit[1])
        if (at == 0 or kept[at - 1][2] <= hit[1]) and (at == len(kept) or hit[2] <= begins[at]):
            kept.insert(at, hit)
            begins.insert(at, hit[1])
    return kept


def _places(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code points of `text` of the words that spans of its folded form touch."""
    if not spans:
        return []
    words = [(m.start(), m.end(), len(m[0].lower())) for m in re.finditer(r"\S+", text)]
    ends = np.cumsum([size + 1 for *_, size in words])  # in the folded form, with the space behind
    out = []
    for begin, end in spans:
        first = int(np.searchsorted(ends, begin + 1, "right"))
        last = int(np.searchsorted(ends, end, "left"))
        out.append((words[min(first, len(words) - 1)][0], words[min(last, len(words) - 1)][1]))
    return out


def hits_of(texts: list[str | None], items: Items) -> list[list[dict]]:
    """For each text its occurrences of items: item_id, edits, begin and end in its code points."""
    forms = [folded(t or "") for t in texts]
    found: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
    for block in items.blocks:
        for own, hits in zip(found, search(forms, block), strict=True):
            own += [(block.ids[i], *hit) for i, several in sorted(hits.items()) for hit in several]
    for form, own in zip(forms, found, strict=True):
        spaced = f" {form} "
        for item_id, short in items.short:
            begin = spaced.find(f" {short} ")
            while begin >= 0:
                own.append((item_id, 0, begin, begin + len(short)))
                begin = spaced.find(f" {short} ", begin + len(short))
    out: list[list[dict]] = []
    for text, own in zip(texts, found, strict=True):
        spans = _places(text or "", [(begin, end) for *_, begin, end in own])
        out.append([
            {"item_id": item_id, "edits": edits, "begin": first, "end": last}
            for (item_id, edits, _, _), (first, last) in zip(own, spans, strict=True)
        ])
    return out


def blocks(items: DataFrame, key: str = "item_id", text: str = "text", size: int = BLOCK_CHARS) -> Iterator[list]:
    """The distinct items in blocks of about `size` characters; only one is on the driver at a time."""
    rows = items.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).filter(
        F.length(F.trim("text")) > 0
    ).distinct()
    total = rows.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    parts = -(-total // size)
    for part in range(parts):
        own = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part)
        yield [(r["id"], r["text"]) for r in own.collect()]


def with_hits(
    df: DataFrame, items: DataFrame, text: str = "text", to: str = "hits", q: int = Q, rate: float = EDITS
) -> DataFrame:
    """`df` with the benchmark items that each text holds in `to`: array of (item_id, edits, begin,
    end), all occurrences that do not overlap, begin and end in code points of the text.

    An item occurs if it can be aligned with a part of the text with at most `rate` edits a character
    (case and white space do not count). Items of fewer than `q` characters must occur as whole words.
    Null and empty texts and items have no hits; repeated items count once. All columns and rows of
    `df` stay; a column called like `to` is replaced.
    """
    for_workers(df.sparkSession)
    hit_type = T.StructType.fromDDL(f"hits {HIT}")["hits"].dataType
    out, passes = df.drop(to).withColumn(to, F.array().cast(hit_type)), 0
    for rows in blocks(items):
        # Written between blocks: a plan holds the items of one.
        out = _pass(written(out, "hits") if passes else out, rows, text, to, q, rate)
        passes += 1
    return out


def _pass(df: DataFrame, rows: list, text: str, to: str, q: int, rate: float) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = df.schema
    shape = to_arrow_schema(schema)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = items_of(rows, q, rate)
        at, old = shape.get_field_index(text), shape.get_field_index(to)
        for frame in frames:
            texts = frame.column(at).to_pylist()
            earlier = frame.column(old).to_pylist()
            low = 0
            while low < len(texts):
                high, held = low, 0
                while high < len(texts) and (high == low or held + len(texts[high] or "") <= GROUP_CHARS):
                    held += len(texts[high] or "")
                    high += 1
                hits = [a + b for a, b in zip(earlier[low:high], hits_of(texts[low:high], items), strict=True)]
                columns = list(frame.slice(low, high - low).columns)
                columns[old] = pa.array(hits, shape.field(old).type)
                yield pa.RecordBatch.from_arrays(columns, names=shape.names)
                low = high

    return df.mapInArrow(run, schema)


def contaminated(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document and occurrence of an item in it: `key`, `item_id`, `edits`, `begin`, `end`."""
    hits = with_hits(df.select(key, text), items, text).select(key, F.explode("hits").alias("hit"))
    return hits.select(key, "hit.*")


def clean(df: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `df` that hold no benchmark item, with their columns."""
    return with_hits(df, items, text, "__hits").filter(F.size("__hits") == 0).drop("__hits")
