"""Operator 7: token ids as wavelet matrices, one compressed file for a range of documents.

A matrix keeps a sequence of ids as bit planes, from the highest bit down. At each plane the ids are
split, in order, into those with a 0 and those with a 1. With the number of ones before every 512th
bit, `access`, `rank` and `select` take time in proportion to the bits of an id, and a token is
counted or found without unpacking the rest.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm.common import for_workers, groups, text_or_empty
from gridspark.llm.word_ids import word_ids

MAGIC = b"WMX1"
BLOCK = 512
#: Tokens after which a shard's file gets a further matrix, and shards whose sizes are added up together.
MATRIX_TOKENS = 1 << 18
SHARDS_TOGETHER = 1024
#: Bytes of the texts whose words are looked up together.
GROUP_BYTES = 8 << 20


class WaveletMatrix:
    """Bit planes of a sequence of ids, with counts for rank and select."""

    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray]):
        self.n, self.zeros, self.planes = n, zeros, planes
        self._ones: dict[int, np.ndarray] = {}

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        rest = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        zeros, planes = [], []
        for level in range(bits):
            ones = (rest & rest.dtype.type(1 << (bits - 1 - level))) != 0
            planes.append(np.packbits(ones, bitorder="little"))
            low = np.compress(~ones, rest)
            zeros.append(len(low))
            rest = np.concatenate([low, np.compress(ones, rest)])
        return cls(len(ids), zeros, planes)

    def ids(self) -> np.ndarray:
        """The whole sequence, plane by plane from the last."""
        bits = len(self.planes)
        rest = np.zeros(self.n, np.uint16 if bits <= 16 else np.uint32)
        for level in reversed(range(bits)):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            whole = np.empty_like(rest)
            one = rest.dtype.type(1 << (bits - 1 - level))
            whole[np.flatnonzero(~ones)] = rest[: self.zeros[level]]
            whole[np.flatnonzero(ones)] = rest[self.zeros[level] :] | one
            rest = whole
        return rest.astype("<u4")

    def _counts(self, level: int) -> np.ndarray:
        """Ones before each block of a plane."""
        if level not in self._ones:
            per_byte = np.bitwise_count(self.planes[level]).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(per_byte)])
            self._ones[level] = ends[:: BLOCK // 8]
        return self._ones[level]

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at >> 3]) >> (at & 7) & 1

    def _ones_before(self, level: int, at: int) -> int:
        block = at // BLOCK
        tail = self.planes[level][block * BLOCK // 8 : (at + 7) // 8]
        ones = int(self._counts(level)[block])
        if len(tail):
            ones += int(np.bitwise_count(tail).sum())
            if at & 7:
                ones -= (int(tail[-1]) >> (at & 7)).bit_count()
        return ones

    def _step(self, level: int, bit: int, at: int) -> int:
        ones = self._ones_before(level, at)
        return self.zeros[level] + ones if bit else at - ones

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for level in range(len(self.planes)):
            bit = self._bit(level, at)
            value = value << 1 | bit
            at = self._step(level, bit, at)
        return value

    def _range(self, token: int, begin: int, end: int) -> tuple[int, int]:
        bits = len(self.planes)
        if token >> bits:
            return 0, 0
        for level in range(bits):
            bit = token >> (bits - 1 - level) & 1
            begin, end = self._step(level, bit, begin), self._step(level, bit, end)
        return begin, end

    def count(self, token: int, begin: int = 0, end: int | None = None) -> int:
        """How often an id occurs at positions from `begin` up to `end`."""
        first, last = self._range(token, begin, self.n if end is None else end)
        return last - first

    def select(self, token: int, k: int) -> int:
        """Position of the occurrence number `k` (from 0) of an id."""
        first, last = self._range(token, 0, self.n)
        if not 0 <= k < last - first:
            raise IndexError(k)
        at = first + k
        bits = len(self.planes)
        for level in reversed(range(bits)):
            if token >> (bits - 1 - level) & 1:
                at = self._nth(level, at - self.zeros[level], 1)
            else:
                at = self._nth(level, at, 0)
        return at

    def _nth(self, level: int, k: int, bit: int) -> int:
        """Position of the bit number `k` (from 0) of a kind in a plane."""
        ones = self._counts(level)
        # The last block with at most `k` such bits before it.
        block, above = 0, len(ones)
        while above - block > 1:
            middle = (block + above) // 2
            before = int(ones[middle]) if bit else middle * BLOCK - int(ones[middle])
            block, above = (middle, above) if before <= k else (block, middle)
        before = int(ones[block]) if bit else block * BLOCK - int(ones[block])
        begin = block * BLOCK
        part = np.unpackbits(
            self.planes[level][begin // 8 : (begin + BLOCK) // 8],
            count=min(BLOCK, self.n - begin), bitorder="little",
        )
        return begin + int(np.flatnonzero(part == bit)[k - before])

    def positions(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def to_bytes(self) -> bytes:
        """Magic, length, planes; for each plane its zeros, its bits and its block counts."""
        out = [MAGIC, struct.pack("<QB", self.n, len(self.planes))]
        for level, plane in enumerate(self.planes):
            counts = self._counts(level).astype("<u4").tobytes()
            out += [struct.pack("<QQQ", self.zeros[level], len(plane), len(counts)), plane.tobytes(), counts]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        n, bits = struct.unpack_from("<QB", data, 4)
        at, zeros, planes, counts = 13, [], [], {}
        for level in range(bits):
            zero, size, more = struct.unpack_from("<QQQ", data, at)
            at += 24
            zeros.append(zero)
            planes.append(np.frombuffer(data, np.uint8, size, at))
            counts[level] = np.frombuffer(data, "<u4", more // 4, at + size).astype(np.int64)
            at += size + more
        made = cls(n, zeros, planes)
        made._ones = counts
        return made


def write_shards(
    df: DataFrame,
    path: str,
    tokenizer_file: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    shards: int | None = None,
    matrix_tokens: int = MATRIX_TOKENS,
) -> None:
    """Encode `text`, append `end_id` to each document, write in ascending order of `key` below `path`.

    Each shard is a range of keys and texts, as many as Spark cuts the rows into or `shards`, and holds
    matrices of about `matrix_tokens` ids, more only where one document is longer; documents are not cut. Null texts count as empty (the end id alone). Null
    keys come first. Rows with the same key follow each other in the order of their texts. The files
    are Parquet with one matrix per row: `shard`, `part`, `keys`, `lengths`, `matrix`.
    """
    for_workers(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    # By the beginning of the text as well, so that rows of one key are split; Spark samples these
    # values to find the ranges. Partitions are numbered in the order of the ranges.
    ranges = [F.col("key").asc_nulls_first(), F.substring("text", 1, 32)]
    spread = rows.repartitionByRange(*([] if shards is None else [shards]), *ranges)
    spread = spread.sortWithinPartitions(F.col("key").asc_nulls_first(), "text")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_file)
        shard, part, held = TaskContext.get().partitionId(), 0, 0
        keys: list = []
        ids: list[np.ndarray] = []

        def packed():
            matrix = WaveletMatrix.of(np.concatenate(ids)).to_bytes()
            row = {"shard": shard, "part": part, "keys": keys, "lengths": [len(x) for x in ids], "matrix": matrix}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([
            ("shard", pa.int32()), ("part", pa.int32()), ("keys", pa.list_(key_type)),
            ("lengths", pa.list_(pa.int64())), ("matrix", pa.binary()),
        ])
        for frame in frames:
            for piece in groups(frame, GROUP_BYTES):
                found = words.encode(piece.column(1))
                for k, own in zip(piece.column(0).to_pylist(), found, strict=True):
                    if keys and held >= matrix_tokens:
                        yield packed()
                        part, keys, ids, held = part + 1, [], [], 0
                    keys.append(k)
                    ids.append(np.append(own, np.uint32(end_id)))
                    held += len(own) + 1
        if keys:
            yield packed()

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(df.schema[key].dataType)
    made = spread.mapInArrow(
        run, f"shard int, part int, keys array<{kind}>, lengths array<long>, matrix binary"
    )
    made.write.option("compression", "zstd").mode("overwrite").parquet(path)


def ids_before(files: DataFrame) -> DataFrame:
    """`shard`, `part`, `before`: ids in all matrices before each one.

    Sums over sums: matrices of a shard, shards of a group, groups. Only the groups, one for each
    1,024 shards, meet in one task.
    """
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)
    sizes = files.select("shard", "part", total.alias("size"))
    inside = F.sum("size").over(Window.partitionBy("shard").orderBy("part")) - F.col("size")
    group = F.floor(F.col("shard") / SHARDS_TOGETHER).alias("group")
    shards = sizes.groupBy("shard").agg(F.sum("size").alias("size")).select("shard", group, "size")
    of_shard = F.sum("size").over(Window.partitionBy("group").orderBy("shard")) - F.col("size")
    each = shards.groupBy("group").agg(F.sum("size").alias("size"))
    of_group = F.sum("size").over(Window.orderBy("group")) - F.col("size")
    above = shards.select("shard", "group", of_shard.alias("of_shard")).join(each.select("group", of_group.alias("of_group")), "group")
    return sizes.withColumn("inside", inside).join(above, "shard").select(
        "shard", "part", (F.col("of_group") + F.col("of_shard") + F.col("inside")).alias("before")
    )


def occurrences(spark, path: str, token: int, key: str = "doc_id") -> DataFrame:
    """Where a token occurs in the files below `path`: `key` and `position` in the document, by rank
    and select in each matrix, without unpacking it."""
    for_workers(spark)
    files = spark.read.parquet(path)
    kind = files.schema["keys"].dataType.elementType

    def run(frames):
        for frame in frames:
            for row in range(frame.num_rows):
                lengths, data = frame.column(1)[row].as_py(), frame.column(2)[row].as_py()
                at = np.array(WaveletMatrix.from_bytes(data).positions(token), np.int64)
                ends = np.cumsum(np.array(lengths, np.int64))
                doc = np.searchsorted(ends, at, "right")
                yield pa.RecordBatch.from_arrays(
                    [frame.column(0)[row].values.take(pa.array(doc)), pa.array(at - (ends - lengths)[doc])], names=[key, "position"]
                )

    picked = files.select("keys", "lengths", "matrix")
    return picked.mapInArrow(run, f"`{key}` {kind.simpleString()}, position long")


def read_shards(spark, path: str, key: str = "doc_id") -> DataFrame:
    """One row per document of the files below `path`: `key`, `start`, `n_tokens`, `ids_crc32`.

    `start` counts the ids of all documents before it. The matrices are unpacked one at a time.
    """
    for_workers(spark)
    files = spark.read.parquet(path)
    kind = files.schema["keys"].dataType.elementType
    before = ids_before(files)

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(kind)

    def run(frames):
        for frame in frames:
            for row in range(frame.num_rows):
                shard, part, keys, lengths, data = (frame.column(c)[row].as_py() for c in range(5))
                ids = WaveletMatrix.from_bytes(data).ids()
                ends = np.cumsum(np.array(lengths, np.int64))
                begins = ends - lengths
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends, strict=True)]
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * n, pa.int32()), pa.array([part] * n, pa.int32()),
                        pa.array(keys, key_type), pa.array(begins, pa.int64()),
                        pa.array(lengths, pa.int64()), pa.array(crc, pa.int64()),
                    ],
                    names=["shard", "part", key, "inside", "n_tokens", "ids_crc32"],
                )

    picked = files.select("shard", "part", "keys", "lengths", "matrix")
    docs = picked.mapInArrow(
        run,
        f"shard int, part int, `{key}` {kind.simpleString()}, inside long, n_tokens long, ids_crc32 long",
    )
    return docs.join(before, ["shard", "part"]).select(
        key, (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
