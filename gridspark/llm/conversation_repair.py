"""Operator 13: cheapest repair of conversations, by dynamic programming with square-root checkpoints.

The turns that are left must read, by the first letters of their roles, `(s?(ua)+)?`. Each turn is
kept, given another role or deleted, and empty turns may be inserted. The costs of what is still to
come, one for each of the four states of that pattern, are worked out backwards from the end; the
walk forward then takes, of the edits that stay on a cheapest way, the one whose letter comes first.

Backwards only every √n-th vector of costs is kept. Walking forward, the vectors of a block are worked
out again from the one at its end, so that a run of n turns needs 2√n vectors at a time and each of
them twice.

Turns are dealt out by range of (conversation, turn), so a long conversation is many runs in many
tasks. What a run does to any vector of costs is a matrix of four by four (minimum of sums), and how
it is walked through depends on four possible states at its begin: only these go from run to run of a
conversation. Equal turns are one row with a count, whose copies after the first are deleted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gridspark.llm.common import for_workers, written

# Costs of the edits, their letters, and white space.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
D, I, K, R = b"DIKR"
SPACE = " \t\n\x0b\x0c\r"
#: Turns of a run at most.
RUN = 512
#: Turns that are walked through side by side.
CELLS = 1 << 17

# States: nothing yet, after system, after user, after assistant. Where a user or an assistant turn,
# whichever is due, leads; where a kept turn leads by its initial (s, u, a, other; 4: nowhere).
DUE = np.array([2, 2, 3, 2])
KEPT = np.array([[1, 2, 4, 4], [4, 2, 4, 4], [4, 4, 3, 4], [4, 2, 4, 4]])
#: Cost at the end of a conversation, and inserts that are left to make.
AT_END, INSERTS_AT_END = np.array([0, 4, 2, 0]), np.array([0, 2, 1, 0])
NEVER = 1 << 40

# A turn in a byte: initial, must go, ends without a stop, and why it must go.
MUST_GO, CUT_OFF, BLANK = 4, 8, 16
PAD = MUST_GO | 3


def back(after: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Costs before a turn from those after it, one row for each conversation."""
    initial, cut = codes & 3, ((codes & CUT_OFF) > 0)[:, None] * TRUNCATED
    wide = np.concatenate([after, np.full((len(after), 1), NEVER)], axis=1)
    kept = np.take_along_axis(wide, KEPT.T[initial], axis=1) + cut
    out = np.minimum(np.minimum(kept, after[:, DUE] + REROLE + cut), after + DELETE)
    # Inserts before the turn: one leads from user to assistant and back, two suffice.
    user, assistant = out[:, 2].copy(), out[:, 3].copy()
    out[:, 2] = np.minimum(user, assistant + INSERT)
    out[:, 3] = np.minimum(assistant, user + INSERT)
    out[:, 0] = np.minimum(out[:, 0], out[:, 2] + INSERT)
    out[:, 1] = np.minimum(out[:, 1], out[:, 2] + INSERT)
    return np.where(((codes & MUST_GO) > 0)[:, None], after, out)


def matrices(codes: np.ndarray) -> np.ndarray:
    """For each run (row of `codes`) the least cost from each state at its begin (last axis) to each
    state at its end, without what must be deleted."""
    now = np.tile(np.where(np.eye(4, dtype=bool), 0, NEVER), (len(codes), 1))
    for at in reversed(range(codes.shape[1])):
        now = back(now, np.repeat(codes[:, at], 4))
    return np.minimum(now, NEVER).reshape(-1, 4, 4)


class Walk(NamedTuple):
    """By run and turn: inserts before it (behind the last turn in a further column), the letter, the
    state in which that is chosen and the state before the inserts; the state at the end by run."""

    inserts: np.ndarray
    letters: np.ndarray
    chosen: np.ndarray
    begun: np.ndarray
    left: np.ndarray


def walk(codes: np.ndarray, ends: np.ndarray, states: np.ndarray) -> Walk:
    """The cheapest edits with the least letters, of each run from its state to its costs at the end."""
    runs, n = codes.shape
    every = max(1, isqrt(n))
    marks, now = {n: ends}, ends
    for at in reversed(range(n)):
        now = back(now, codes[:, at])
        if at % every == 0:
            marks[at] = now
    inserts = np.zeros((runs, n + 1), np.int64)
    letters = np.full((runs, n), D, np.uint8)
    chosen, begun = np.zeros((runs, n), np.int64), np.zeros((runs, n + 1), np.int64)
    states = states.copy()
    for low in range(0, n, every):
        high = min(low + every, n)
        inside = [marks[high]]
        for at in reversed(range(low, high)):
            inside.append(back(inside[-1], codes[:, at]))
        for at in range(low, high):
            before, after = inside[high - at], inside[high - at - 1]
            begun[:, at] = states
            left = np.flatnonzero((codes[:, at] & MUST_GO) == 0)
            while len(left):
                state, code = states[left], codes[left, at]
                here, cut = before[left, state], ((code & CUT_OFF) > 0) * TRUNCATED
                wide = np.concatenate([after[left], np.full((len(left), 1), NEVER)], axis=1)
                row = np.arange(len(left))
                delete = here == wide[row, state] + DELETE
                insert = ~delete & (here == before[left, DUE[state]] + INSERT)
                to = KEPT[state, code & 3]
                keep = ~delete & ~insert & (here == wide[row, to] + cut)
                letters[left, at] = np.where(delete, D, np.where(keep, K, R))
                chosen[left, at] = state
                inserts[left, at] += insert
                states[left] = np.where(delete, state, np.where(keep, to, DUE[state]))
                left = left[insert]
    begun[:, n] = states
    return Walk(inserts, letters, chosen, begun, states)


def _side_by_side(codes: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Numbers of runs of about the same length, their codes padded to one length, their lengths."""
    sizes = np.array([len(c) for c in codes], np.int64)
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and sizes[order[to]] * (to + 1 - at) <= CELLS and sizes[order[to]] <= 2 * sizes[order[at]] + 4:
            to += 1
        own = order[at:to]
        padded = np.full((len(own), sizes[own[-1]]), PAD, np.uint8)
        for row, number in enumerate(own):
            padded[row, : sizes[number]] = np.frombuffer(codes[number], np.uint8)
        yield own, padded, sizes[own]
        at = to


def _turns(rows: DataFrame) -> DataFrame:
    """Distinct turns with their number of copies, what is known of the text and a digest of it."""
    given = rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    trimmed = F.rtrim("text", F.lit(SPACE))
    blank = trimmed == ""
    initial = F.position(F.substring("role", 1, 1), F.lit("sua")) - 1
    initial = F.when((F.col("role") == "") | (initial < 0), 3).otherwise(initial)
    return given.select(
        "*", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), initial.alias("initial"), blank.alias("blank"),
        (~blank & ~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )


def _with_repeats(given: DataFrame) -> DataFrame:
    """The turns without their texts, in a byte each; later ones of equal role and text must go."""
    light = given.select("conv", "turn", "role", "digest", "copies", "initial", "blank", "cut")
    null = F.col("turn").isNull()
    several = light.groupBy("conv", "role", "digest").agg(
        F.count("*").alias("n"), F.min("turn").alias("least"), F.bool_or(null).alias("has_null")
    ).where("n > 1")
    # Written: Spark knows its size, and can split a text that a conversation repeats without end.
    several = written(several.drop("n"), "repeats").alias("s")
    same = (
        F.col("l.conv").eqNullSafe(F.col("s.conv")) & (F.col("l.role") == F.col("s.role"))
        & (F.col("l.digest") == F.col("s.digest"))
    )
    first = F.when(F.col("has_null"), F.col("l.turn").isNull()).otherwise(F.col("l.turn") == F.col("least"))
    later = F.col("least").isNotNull() & ~first
    code = (
        F.col("l.initial") + F.when(F.col("l.blank") | later, MUST_GO).otherwise(0)
        + F.when(F.col("l.cut"), CUT_OFF).otherwise(0) + F.when(F.col("l.blank"), BLANK).otherwise(0)
    )
    joined = light.alias("l").join(several, same, "left")
    return joined.select("l.conv", "l.turn", "l.role", "l.digest", "l.copies", code.cast("tinyint").alias("code"))


def _runs(turns: DataFrame) -> DataFrame:
    """Turns in order, as runs of one conversation: `part`, `k` (their order), `whole` (the
    conversation has no other run), a byte, copies, turn, role and digest of each, and the matrix."""
    kind = turns.schema["conv"].dataType
    ordered = turns.repartitionByRange("conv", "turn", "role", "digest").sortWithinPartitions("conv", "turn", "role", "digest")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for frame in frames:
            n = frame.num_rows
            if not n:
                continue
            conv = frame.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
            new = np.flatnonzero(np.diff(conv, prepend=conv[0] - 1))
            lengths = np.diff(np.append(new, n))
            number = -(-lengths // RUN)
            of = np.repeat(np.arange(len(new)), number)
            starts = new[of] + RUN * (np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number))
            whole = (number == 1)[of]
            whole[0] = whole[-1] = False
            ends = np.append(starts, n).astype(np.int32)
            codes = frame.column(5).to_numpy().astype(np.uint8)
            packed = [codes[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            loose = np.flatnonzero(~whole)
            found: list = [None] * len(starts)
            for own, padded, _ in _side_by_side([packed[i] for i in loose]):
                for i, matrix in zip(own, matrices(padded), strict=True):
                    found[loose[i]] = matrix.ravel().tolist()
            lists = [pa.ListArray.from_arrays(pa.array(ends), frame.column(i)) for i in (4, 1, 2, 3)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(starts), part, np.int32)), pa.array(np.arange(k, k + len(starts))),
                    frame.column(0).take(pa.array(starts)), pa.array(whole), pa.array(packed, pa.binary()), *lists,
                    pa.array(found, pa.list_(pa.int64())),
                ],
                names=["part", "k", "conv", "whole", "codes", "copies", "turns", "roles", "digests", "matrix"],
            )
            k += len(starts)

    return ordered.mapInArrow(
        run,
        f"part int, k long, conv {kind.simpleString()}, whole boolean, codes binary, copies array<long>, "
        "turns array<long>, roles array<string>, digests array<binary>, matrix array<long>",
    )


def _costs_at_ends(loose: DataFrame) -> DataFrame:
    """`part`, `k`, `costs` at the end of each run, whether it is the `last` of its conversation and
    the initial before it (-1: none). A conversation sends one matrix for each run."""

    def one(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("part", "ascending"), ("k", "ascending")])
        matrix = np.array(rows.column("matrix").to_pylist(), np.int64).reshape(-1, 4, 4)
        now, costs = AT_END, []
        for m in matrix[::-1]:
            costs.append(now.tolist())
            now = np.minimum((m + now[:, None]).min(axis=0), NEVER)
        ends = [-1, *rows.column("final").to_pylist()[:-1]]
        return pa.table({
            "part": rows.column("part"), "k": rows.column("k"), "costs": pa.array(costs[::-1], pa.list_(pa.int64())),
            "last": pa.array([i == len(costs) - 1 for i in range(len(costs))]), "before": pa.array(ends, pa.int32()),
        })

    final = F.conv(F.hex(F.substring("codes", F.length("codes"), 1)), 16, 10).cast("int").bitwiseAND(3)
    light = loose.select("conv", "part", "k", "matrix", final.alias("final"))
    return light.groupBy("conv").applyInArrow(one, "part int, k long, costs array<long>, last boolean, before int")


def _states_at_begins(loose: DataFrame, costs: DataFrame) -> DataFrame:
    """`part`, `k`, `state` at the begin of each run: each is walked through from all four states, and
    a conversation's runs are put together."""

    def four(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            codes = frame.column(3).to_pylist()
            ends = np.array(frame.column(4).to_pylist(), np.int64).reshape(-1, 4)
            left: list = [None] * len(codes)
            for own, padded, _ in _side_by_side(codes):
                times = np.repeat(np.arange(len(own)), 4)
                done = walk(padded[times], ends[own][times], np.tile(np.arange(4), len(own)))
                for i, states in zip(own, done.left.reshape(-1, 4).tolist(), strict=True):
                    left[i] = states
            yield pa.RecordBatch.from_arrays(
                [*frame.columns[:3], pa.array(left, pa.list_(pa.int64()))], names=["conv", "part", "k", "left"]
            )

    def one(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("part", "ascending"), ("k", "ascending")])
        state, states = 0, []
        for left in rows.column("left").to_pylist():
            states.append(state)
            state = left[state]
        return pa.table({"part": rows.column("part"), "k": rows.column("k"), "state": pa.array(states, pa.int32())})

    kind = loose.schema["conv"].dataType.simpleString()
    with_costs = loose.select("conv", "part", "k", "codes").join(costs.select("part", "k", "costs"), ["part", "k"])
    each = with_costs.select("conv", "part", "k", "codes", "costs").mapInArrow(
        four, f"conv {kind}, part int, k long, left array<long>"
    )
    return each.groupBy("conv").applyInArrow(one, "part int, k long, state int")


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")
_EDITED = (
    ", ".join(f"{name} long" for name in _COUNTS) + ", audit string, letters array<string>, turns array<long>, "
    "sources array<string>, digests array<binary>, roles array<string>"
)


def _edited(runs: DataFrame) -> DataFrame:
    """Each run with its counts, its letters (`audit`), and the turns that come out of it: letter, turn,
    role and digest of where they come from (null for inserts), and role."""
    kind = runs.schema["conv"].dataType

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            codes = frame.column(3).to_pylist()
            ends = np.array([AT_END if c is None else c for c in frame.column(8).to_pylist()], np.int64).reshape(-1, 4)
            last = frame.column(9).fill_null(True).to_numpy(zero_copy_only=False)
            before = frame.column(10).fill_null(-1).to_numpy(zero_copy_only=False)
            states = frame.column(11).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for own, padded, sizes in _side_by_side(codes):
                picked = frame.take(pa.array(own))
                done = walk(padded, ends[own], states[own])
                done.inserts[:, -1] = np.where(last[own], INSERTS_AT_END[done.left], 0)
                yield _described(picked, padded, sizes, done, before[own])

    return runs.mapInArrow(run, f"part int, k long, conv {kind.simpleString()}, {_EDITED}")


def _described(frame: pa.RecordBatch, padded: np.ndarray, sizes: np.ndarray, done: Walk, before: np.ndarray) -> pa.RecordBatch:
    n = padded.shape[1]
    there = np.arange(n) < sizes[:, None]
    copies = np.zeros(padded.shape, np.int64)
    copies[there] = frame.column(4).flatten().to_numpy()
    must = (padded & MUST_GO) > 0
    blank = (padded & BLANK) > 0
    cut = there & ((padded & CUT_OFF) > 0) & ~must
    initial = (padded & 3).astype(np.int64)
    earlier = np.concatenate([before[:, None], initial[:, :-1]], axis=1)
    legal = (earlier == 0) & (initial == 1) | (earlier == 1) & (initial == 2) | (earlier == 2) & (initial == 1)
    illegal = (copies - there) + (there & ~legal & (earlier >= 0))
    kept = there & ~must & (done.letters != D)
    more = copies - (there & ~must)  # copies that go
    cost = (
        more * DELETE + (there & ~must & (done.letters == D)) * DELETE + (kept & (done.letters == R)) * REROLE + (kept & cut) * TRUNCATED
    ).sum(axis=1) + done.inserts.sum(axis=1) * INSERT
    counts = [np.where(blank, copies, 0).sum(axis=1), np.where(blank, 0, more).sum(axis=1), cut.sum(axis=1), illegal.sum(axis=1), cost]

    # Letters of a turn: its inserts, its own unless it must go, then its copies.
    wide = np.zeros((len(padded), n + 1, 3), np.int64)
    wide[:, :, 0], wide[:, :n, 1], wide[:, :n, 2] = done.inserts, there & ~must, more
    which = np.zeros(wide.shape, np.uint8)
    which[:, :, 0], which[:, :n, 1], which[:, :n, 2] = I, done.letters, D
    letters = np.repeat(which.ravel(), wide.ravel())
    stops = np.concatenate([[0], np.cumsum(wide.sum(axis=(1, 2)))]).astype(np.int32)
    audit = pa.StringArray.from_buffers(len(padded), pa.py_buffer(stops), pa.py_buffer(np.append(letters, np.uint8(0))))

    # Turns that come out: the inserts before a turn, then the turn if it stays.
    stays = np.concatenate([kept, np.zeros((len(kept), 1), bool)], axis=1).ravel()
    number = done.inserts.ravel() + stays
    cell = np.repeat(np.arange(len(number)), number)
    inside = np.arange(len(cell)) - np.repeat(np.cumsum(number) - number, number)
    inserted = inside < done.inserts.ravel()[cell]
    run_of, at = cell // (n + 1), cell % (n + 1)
    stop = np.minimum(at, n - 1)
    letter = np.where(inserted, I, done.letters[run_of, stop])
    source = pa.array((np.cumsum(sizes) - sizes)[run_of] + stop, mask=inserted)
    assistant = np.where(inserted, (done.begun[run_of, at] == 2) ^ (inside % 2 == 1), done.chosen[run_of, stop] == 2)
    own = frame.column(6).flatten().take(source)
    named = pa.array(np.where(assistant, "assistant", "user"))
    role = pc.if_else(pa.array(letter == K), own, named)
    ends = np.concatenate([[0], np.cumsum(number.reshape(len(padded), -1).sum(axis=1))]).astype(np.int32)
    texts = pa.array(np.array([chr(c) for c in range(128)])[letter], pa.string())
    values = [texts, frame.column(5).flatten().take(source), own, frame.column(7).flatten().take(source), role]
    lists = [pa.ListArray.from_arrays(pa.array(ends), v) for v in values]
    return pa.RecordBatch.from_arrays(
        [*frame.columns[:3], *[pa.array(c, pa.int64()) for c in counts], audit, *lists],
        names=["part", "k", "conv", *_COUNTS, "audit", "letters", "turns", "sources", "digests", "roles"],
    )


class Repaired(NamedTuple):
    """`turns`: conv, part, k, at (together their order), edit, turn, role, text; `conversations`: conv,
    gaps, blank, duplicate, truncated, illegal, cost, audit."""

    turns: DataFrame
    conversations: DataFrame


def repaired(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """Conversations after the cheapest repair, and what it took.

    Turns come in the order of `turn` (nulls first); of the same one by role and a digest of the text.
    A turn is blank if it has nothing but white space, else a duplicate if an earlier one of its
    conversation has the same role and text, else truncated if it does not end in `.`, `!` or `?`.
    Blank ones and duplicates are deleted. Null roles and texts count as one space, rows with a null
    conversation as one conversation, repeated rows as duplicates. Only the four columns are read.
    """
    for_workers(df.sparkSession)
    rows = df.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    given = written(_turns(rows), "turns")
    runs = written(_runs(_with_repeats(given)), "runs")
    loose = runs.where("NOT whole")
    costs = written(_costs_at_ends(loose), "costs")
    states = written(_states_at_begins(loose, costs), "states")
    known = runs.join(costs.join(states, ["part", "k"]), ["part", "k"], "left")
    known = known.select(
        "part", "k", "conv", "codes", "copies", "turns", "roles", "digests", "costs", "last", "before", "state"
    )
    edited = written(_edited(known), "edits")

    pieces = F.sort_array(F.collect_list(F.struct("part", "k", "audit")))["audit"]
    summed = edited.groupBy("conv").agg(*[F.sum(name).alias(name) for name in _COUNTS], F.array_join(pieces, "").alias("audit"))
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = given.groupBy("conv").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps")).withColumnRenamed("conv", "of")
    conversations = summed.join(gaps, F.col("conv").eqNullSafe(F.col("of"))).drop("of")

    found = F.arrays_zip("letters", "turns", "sources", "digests", "roles")
    out = edited.select("conv", "part", "k", F.posexplode(found).alias("at", "x"))
    out = out.select(
        "conv", "part", "k", "at", F.col("x.letters").alias("edit"), F.col("x.turns").alias("turn"),
        F.col("x.sources").alias("source"), F.col("x.digests").alias("digest"), F.col("x.roles").alias("role"),
    )
    texts = given.select("conv", "turn", F.col("role").alias("source"), "digest", "text").alias("g")
    stay = out.where("edit <> 'I'").alias("o").join(
        texts,
        F.col("o.conv").eqNullSafe(F.col("g.conv")) & F.col("o.turn").eqNullSafe(F.col("g.turn"))
        & (F.col("o.source") == F.col("g.source")) & (F.col("o.digest") == F.col("g.digest")),
    )
    names = ["conv", "part", "k", "at", "edit", "turn", "role"]
    stay = stay.select(*[f"o.{name}" for name in names], "g.text")
    return Repaired(stay.unionByName(out.where("edit = 'I'").select(*names, F.lit("").alias("text"))), conversations)


def digests(turns: DataFrame) -> DataFrame:
    """`conv`, `sha256` of `role:text` of its turns, newline-joined; they pass through one by one."""
    for_workers(turns.sparkSession)
    kind = turns.schema["conv"].dataType
    rows = turns.select("conv", "part", "k", "at", F.concat("role", F.lit(":"), "text").alias("line"))
    rows = rows.repartition("conv").sortWithinPartitions("conv", "part", "k", "at")
    shape = pa.schema([("conv", to_arrow_type(kind)), ("sha256", pa.string())])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for frame in frames:
            done = []
            for conv, line in zip(frame.column(0).to_pylist(), frame.column(4).to_pylist(), strict=True):
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = conv, hashlib.sha256(line.encode())
                else:
                    state.update(f"\n{line}".encode())
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(shape.names, x, strict=True)) for x in done], schema=shape)
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv": now, "sha256": state.hexdigest()}], schema=shape)

    return rows.mapInArrow(run, f"conv {kind.simpleString()}, sha256 string")


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with faults, by a checksum of conversation and turn: one turn in twenty each is
    lost, emptied, stripped of its stops, doubled or ascribed to the user. Nulls count as a space."""
    one = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", one(conv), one(turn)).cast("binary")) % 20
    rows = df.select(F.col(conv), F.col(turn), one(role).alias(role), one(text).alias(text), kind.alias("__kind"))
    rows = rows.where("__kind <> 0")
    other = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.regexp_replace(text, "[.!?]", ""))
    rows = rows.withColumns({
        text: other.otherwise(F.col(text)),
        role: F.when(F.col("__kind") == 4, "user").otherwise(F.col(role)),
        "__copy": F.explode(F.when(F.col("__kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    })
    return rows.drop("__kind", "__copy")


#: The query's result in DuckDB's SQL over `conversations`: costs by a recursion from the last turn to
#: the first, the walk by one that adds a letter at a time.
SQL = r"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce(list_concat([n], range(8)),
                            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS of
    FROM range(256) AS t(n)
), hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(4294967295, list_reduce(
               list_concat([CAST(4294967295 AS BIGINT)],
                           [CAST(unicode(x) AS BIGINT) FOR x IN string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')]),
               lambda c, b: xor(c >> 8, crc.of[CAST((xor(c, b) & 255) + 1 AS INTEGER)]))) % 20 AS kind
    FROM conversations, crc
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM hashed WHERE kind <> 0
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
           rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS words
    FROM damaged
), marked AS (
    SELECT *, left(role, 1) AS initial, words = '' AS blank,
           words <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM ordered
), turns AS MATERIALIZED (
    SELECT *, blank OR again AS must, NOT (blank OR again) AND right(words, 1) NOT IN ('.', '!', '?') AS cut FROM marked
), sums AS (
    SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
           count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM turns GROUP BY conv_id
), costs AS (
    SELECT conv_id, n + 1 AS i, [0, 4, 2, 0] AS b FROM sums
    UNION ALL
    SELECT conv_id, i, CASE WHEN must THEN [x + 3 FOR x IN b] ELSE
        [least(n0, n2 + 2, n3 + 4), least(n1, n2 + 2, n3 + 4), least(n2, n3 + 2), least(n3, n2 + 2)] END
    FROM (
        SELECT t.conv_id, t.i, must, b,
               least(b[1] + 3, b[3] + 2 + cut, CASE initial WHEN 's' THEN b[2] + cut WHEN 'u' THEN b[3] + cut END) AS n0,
               least(b[2] + 3, b[3] + 2 + cut, CASE initial WHEN 'u' THEN b[3] + cut END) AS n1,
               least(b[3] + 3, b[4] + 2 + cut, CASE initial WHEN 'a' THEN b[4] + cut END) AS n2,
               least(b[4] + 3, b[3] + 2 + cut, CASE initial WHEN 'u' THEN b[3] + cut END) AS n3
        FROM costs c JOIN (SELECT * REPLACE (CAST(cut AS INTEGER) AS cut) FROM turns) t ON t.conv_id = c.conv_id AND t.i = c.i - 1)
), known AS MATERIALIZED (
    SELECT c.conv_id, c.i, c.b, d.b AS after, t.role, t.text, t.initial, CAST(t.cut AS INTEGER) AS cut
    FROM costs c LEFT JOIN costs d ON d.conv_id = c.conv_id AND d.i = c.i + 1
    LEFT JOIN turns t ON t.conv_id = c.conv_id AND t.i = c.i
), walk AS (
    SELECT conv_id, CAST(1 AS BIGINT) AS i, 0 AS s, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM sums
    UNION ALL
    SELECT conv_id, CASE letter WHEN 'I' THEN i ELSE i + 1 END, CASE letter WHEN 'D' THEN s WHEN 'K' THEN kept ELSE due END,
           audit || letter,
           CASE letter WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
                WHEN 'R' THEN list_append(lines, who || ':' || text) ELSE list_append(lines, who || ':') END
    FROM (
        SELECT *, CASE WHEN role IS NULL THEN CASE WHEN s IN (1, 2) THEN 'I' END
                       WHEN b[s + 1] = after[s + 1] + 3 THEN 'D' WHEN b[s + 1] = b[due + 1] + 2 THEN 'I'
                       WHEN b[s + 1] = after[kept + 1] + cut THEN 'K' ELSE 'R' END AS letter
        FROM (
            SELECT w.*, k.* EXCLUDE (conv_id, i), CASE s WHEN 2 THEN 3 ELSE 2 END AS due, CASE s WHEN 2 THEN 'assistant' ELSE 'user' END AS who,
                   CASE WHEN s = 0 AND initial = 's' THEN 1 WHEN s = 2 AND initial = 'a' THEN 3
                        WHEN s <> 2 AND initial = 'u' THEN 2 END AS kept
            FROM walk w JOIN known k ON k.conv_id = w.conv_id AND k.i = w.i))
    WHERE letter IS NOT NULL
), done AS (
    SELECT w.conv_id, audit, sha256(array_to_string(lines, chr(10))) AS repaired_sha256
    FROM walk w JOIN sums s ON s.conv_id = w.conv_id AND w.i = s.n + 1 AND w.s IN (0, 3)
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(c.b[1], 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN sums USING (conv_id) LEFT JOIN done USING (conv_id)
LEFT JOIN costs c ON c.conv_id = a.conv_id AND c.i = 1
"""
