"""Operator 1: byte-level BPE with a local rank file, encoded and decoded.

The rank file and the split pattern are parameters. Merges never cross a match of the pattern, so a
long text is cut where a match ends for certain, and the pieces are encoded one after the other;
ids are the same as for the text as a whole. Long runs of white space, which the library's search by
pattern has no stack for, are cut out by the pattern's own rule.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import for_workers, text_or_empty

#: Texts above so many characters are encoded in pieces of about this size.
PIECE_CHARS = 200_000
#: Rows of a batch are handed on when their results reach this size.
BATCH_BYTES = 4 << 20

#: Ends of matches that no pattern of this family crosses: white space after something else, and
#: between an ASCII letter and an ASCII digit.
SAFE = re.compile(r"(?<=\S)(?=[ \t\r\n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")

#: Runs of white space from this length on are not given to the search by pattern.
RUN_CHARS = 50_000
# Fixed value: what \s matches in the library's patterns (the Unicode property White_Space).
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Fixed value: the end of patterns that treat white space as one match up to the last character.
LAST_SPACE_APART = r"|\s+(?!\S)|\s+"


@cache
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """`text` in order, cut at the first safe boundary at or after each `size` characters."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


@cache
def _long_runs(pattern: str, run: int) -> re.Pattern | None:
    """Finds long runs of white space, if the pattern's rule for them is known: all of a run is one
    match, but for its last character where something else follows."""
    rest = pattern.removesuffix(LAST_SPACE_APART)
    if rest == pattern or r"\s" in rest.replace(r"[^\s", "") or r"\n" in rest or r"\r" in rest:
        return None
    return re.compile(f"[{WHITE_SPACE}]{{{run},}}")


def encode(text: str, enc: tiktoken.Encoding, size: int = PIECE_CHARS, run: int = RUN_CHARS) -> np.ndarray:
    """Ids of `text` as little-endian unsigned 32-bit integers; no special tokens.

    Texts of any length, white space of any length in them if the pattern ends in `LAST_SPACE_APART`.
    """
    runs = _long_runs(enc._pat_str, run) if len(text) >= run else None
    parts, at = [], 0
    for found in runs.finditer(text) if runs else ():
        stop = found.end() - (found.end() < len(text))
        parts += [enc.encode_ordinary(piece) for piece in pieces(text[at : found.start()], size)]
        parts.append(enc._encode_single_piece(text[found.start() : stop].encode()))
        at = stop
    parts += [enc.encode_ordinary(piece) for piece in pieces(text[at:], size)]
    return np.concatenate([np.array(part, dtype="<u4") for part in parts])


def decode(ids: np.ndarray, enc: tiktoken.Encoding) -> bytes:
    """The raw bytes of `ids`; a cut inside a character gives an incomplete character, no error."""
    return enc.decode_bytes(ids.tolist())


def batches(
    frames: Iterator[pa.RecordBatch],
    row: Callable[[str], tuple],
    schema: pa.Schema,
    key: str,
    limit: int = BATCH_BYTES,
) -> Iterator[pa.RecordBatch]:
    """Apply `row` to the column `text`, text by text, next to the column `key`."""
    keys: list = []
    rows: list[tuple] = []
    held = 0

    def packed() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(keys, schema.field(0).type)]
        arrays += [pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for frame in frames:
        names = frame.schema.names
        texts = frame.column(names.index("text"))
        for k, text in zip(frame.column(names.index(key)), texts, strict=True):
            keys.append(k.as_py())
            rows.append(row(text.as_py()))
            held += sum(len(x) for x in rows[-1] if isinstance(x, (bytes, str))) + 64
            if held >= limit:
                yield packed()
                keys, rows, held = [], [], 0
    if rows:
        yield packed()


def encode_texts(df: DataFrame, rank_file: str, pattern: str, key: str, text: str = "text") -> DataFrame:
    """One row per row of `df`: `key`, `n_tokens` and `ids` (binary, 32-bit little-endian).

    Null texts count as empty: no tokens, empty ids. Repeated rows stay. Only the two named columns
    are read, whatever others are called.
    """
    for_workers(df.sparkSession)
    field = df.schema[key]

    def run(frames):
        enc = encoding(rank_file, pattern)

        def row(value: str) -> tuple:
            ids = encode(value, enc)
            return len(ids), ids.tobytes()

        schema = pa.schema([(key, _arrow(field)), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        return batches(frames, row, schema, key)

    picked = df.select(F.col(key), text_or_empty(text).alias("text"))
    return picked.mapInArrow(run, f"`{key}` {field.dataType.simpleString()}, n_tokens long, ids binary")


def decode_ids(df: DataFrame, rank_file: str, pattern: str, key: str, ids: str = "ids") -> DataFrame:
    """One row per row of `df`: `key` and `decoded`, the raw bytes of the ids. Null: empty."""
    for_workers(df.sparkSession)
    field = df.schema[key]

    def run(frames):
        enc = encoding(rank_file, pattern)
        schema = pa.schema([(key, _arrow(field)), ("decoded", pa.binary())])
        return batches(
            frames, lambda value: (decode(np.frombuffer(value, dtype="<u4"), enc),), schema, key
        )

    picked = df.select(F.col(key), F.coalesce(F.col(ids), F.lit(b"")).alias("text"))
    return picked.mapInArrow(run, f"`{key}` {field.dataType.simpleString()}, decoded binary")


def round_trip(df: DataFrame, rank_file: str, pattern: str, key: str, text: str = "text") -> DataFrame:
    """Encode and decode in one pass: `key`, `n_tokens`, `ids`, `decoded`."""
    for_workers(df.sparkSession)
    field = df.schema[key]

    def run(frames):
        enc = encoding(rank_file, pattern)

        def row(value: str) -> tuple:
            ids = encode(value, enc)
            return len(ids), ids.tobytes(), decode(ids, enc)

        schema = pa.schema(
            [(key, _arrow(field)), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())]
        )
        return batches(frames, row, schema, key)

    picked = df.select(F.col(key), text_or_empty(text).alias("text"))
    kind = field.dataType.simpleString()
    return picked.mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids binary, decoded binary")


def _arrow(field):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


def digests(coded: DataFrame, key: str) -> DataFrame:
    """`round_trip` rows as digests: the ids and the decoded bytes by their SHA-256."""
    return coded.select(
        key,
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
