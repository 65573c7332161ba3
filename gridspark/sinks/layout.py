"""How rows are laid out in files, and which partitions a batch touches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from gridspark.session import freed_shuffles, session_conf


def for_files(
    df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = ()
) -> DataFrame:
    """Bring a partition's rows together so that it gets few files, without one task per partition.

    The rebalance hint lets AQE split a partition that holds much of the data and merge small ones.
    Rows are sorted by partition and then by key, which is the order a partitioned write needs
    anyway, and gives each file narrow key ranges for row-group skipping. Without partition columns
    rows stay in the tasks they are in.
    """
    order = [*partition_by, *[name for name in sort_by if name not in partition_by]]
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    return df.sortWithinPartitions(*order) if order else df


@contextmanager
def all_cores(spark: SparkSession) -> Iterator[None]:
    """For a partitioned write: AQE may leave a core less than the megabyte that it takes otherwise.

    What takes time there is making files, one per partition, however few rows they hold.
    """
    with session_conf(spark, spark__sql__adaptive__coalescePartitions__minPartitionSize="16k"):
        yield


def write_files(rows: DataFrame, folder: str, partition_by: Sequence[str]) -> None:
    """Write rows that are laid out (`for_files`) to a folder that is not there yet."""
    spark, writer = rows.sparkSession, rows.write
    with freed_shuffles(spark):
        if not partition_by:
            writer.parquet(folder)
            return
        with all_cores(spark):
            writer.partitionBy(*partition_by).parquet(folder)


def not_before(columns: Sequence[str], values: Sequence, *, strict: bool = False) -> Column:
    """The columns, read as one value from left to right, are at least `values`.

    Plain comparisons of single columns, which a file index and a metastore can prune by.
    """
    first, value = F.col(f"`{columns[0]}`"), values[0]
    if len(columns) == 1:
        return first > value if strict else first >= value
    return (first > value) | ((first == value) & not_before(columns[1:], values[1:], strict=strict))


def not_after(columns: Sequence[str], values: Sequence) -> Column:
    return ~not_before(columns, values, strict=True)


def touched_rows(existing: DataFrame, incoming: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of `existing` in the partitions that `incoming` has rows in.

    The scan is cut to the range of those partitions by comparisons of the partition columns; a semi
    join with the partitions themselves, which Spark also uses to prune the scan, does the rest. One
    row goes to the driver: the ends of the range.
    """
    kinds = dict(existing.dtypes)
    parts = incoming.select(
        *[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in columns]
    ).distinct()
    place = F.struct(*[F.col(f"`{c}`") for c in columns])
    unknown = reduce(Column.__or__, [F.col(f"`{c}`").isNull() for c in columns])
    ends = parts.agg(
        F.min(F.when(~unknown, place)).alias("low"),
        F.max(F.when(~unknown, place)).alias("high"),
        F.coalesce(F.bool_or(unknown), F.lit(False)).alias("nulls"),
    ).first()
    if ends.low is None and not ends.nulls:
        return existing.limit(0)
    near = F.lit(False) if ends.low is None else not_before(columns, ends.low) & not_after(columns, ends.high)
    if ends.nulls:
        near = near | unknown
    rows = existing.where(near)
    if not ends.nulls:
        return rows.join(parts, list(columns), "left_semi").select(*existing.columns)
    same = [F.col(f"e.`{c}`").eqNullSafe(F.col(f"i.`{c}`")) for c in columns]
    return rows.alias("e").join(parts.alias("i"), same, "left_semi")


def between_ends(incoming: DataFrame, keys: Sequence[str]) -> Column:
    """Comparisons that hold for every row whose key `incoming` has, one range for each column.

    Row groups whose statistics lie outside are not read. One row goes to the driver.
    """
    plain = [f.name for f in incoming.schema if f.name in keys and isinstance(f.dataType, AtomicType)]
    if not plain:
        return F.lit(True)
    ends = incoming.agg(
        *[f(f"`{name}`").alias(f"{label}_{i}") for i, name in enumerate(plain) for f, label in ((F.min, "low"), (F.max, "high"))],
        *[F.bool_or(F.col(f"`{name}`").isNull()).alias(f"null_{i}") for i, name in enumerate(plain)],
    ).first()
    ranges = [F.lit(True)]
    for i, name in enumerate(plain):
        if not ends[f"null_{i}"] and ends[f"low_{i}"] is not None:
            ranges.append(F.col(f"`{name}`").between(F.lit(ends[f"low_{i}"]), F.lit(ends[f"high_{i}"])))
    return reduce(Column.__and__, ranges)


def day_rounds(df: DataFrame, at: str, size: Column, most: int) -> list[Column]:
    """Conditions that share out the rows by the day of `at`, in turn, some days a round.

    A round has `most` at most by the sum of `size`, unless a single day has more. Rows without a day
    are a round of their own; there is at least one round. A row a day goes to the driver.
    """
    day = F.unix_date(F.to_date(at))
    sizes = df.groupBy(day.alias("day")).agg(F.sum(size).alias("size")).collect()
    rounds, left = [], 0
    for row in sorted((row for row in sizes if row["day"] is not None), key=lambda row: row["day"]):
        if row["size"] > left or not rounds:
            rounds.append([row["day"], row["day"]])
            left = most
        rounds[-1][1] = row["day"]
        left -= row["size"]
    conditions = [day.between(first, last) for first, last in rounds]
    if not rounds or any(row["day"] is None for row in sizes):
        conditions.append(day.isNull())
    return conditions


def partitions_follow_keys(partition_by: Sequence[str], keys: Sequence[str]) -> bool:
    """True if a key can only ever lie in one partition.

    Partition columns are keys themselves, or the date parts of a key `datetime` or `dt`.
    """
    parts = {"dt", "year", "month", "day"} if {"datetime", "dt"} & set(keys) else set()
    return bool(partition_by) and set(partition_by) <= parts | set(keys)
