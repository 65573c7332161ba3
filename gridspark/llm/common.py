"""What the operators share: reading the tables, the shared folder, Python on the workers."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder, read back: cuts the lineage.

    What is built on it does not repeat the work below, also after an executor is lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forgotten(spark: SparkSession, path: str | None) -> None:
    """Delete a written copy that nothing reads any more."""
    if path is not None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def for_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Needed where the driver put the folder on `sys.path` itself; on a cluster the package is
    installed on the workers, or sent with `--py-files`, and this changes nothing there.
    """
    root = str(Path(__file__).resolve().parents[2])
    shipped = spark.sparkContext.environment
    known = [p for p in shipped.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        shipped["PYTHONPATH"] = os.pathsep.join([*known, root])


def range_bounds(df: DataFrame, key: str, per_bucket: int, most: int = 8192) -> list:
    """Upper bounds of ranges of `key` with about `per_bucket` rows each (`most` ranges at most).

    The bounds only spread the work; a row's range follows from them exactly (`range_of`).
    """
    rows = df.count()
    n = min(most, -(-rows // per_bucket))
    if n < 2:
        return []
    cuts = F.percentile_approx(F.col(key), [i / n for i in range(1, n)], 20 * n)
    return sorted(set(df.agg(cuts.alias("cuts")).first().cuts or []))


def range_of(key: Column, bounds: list) -> Column:
    """Number of bounds below `key`: ascending with it, 0 for null. Looks at about 2√n bounds."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    every = F.array(*[F.lit(b) for b in bounds])
    coarse = F.array(*[F.lit(b) for b in bounds[step - 1 :: step]] or [F.lit(bounds[-1])])
    below = F.size(F.filter(coarse, lambda b: b < key)) * step
    rest = F.slice(every, below + 1, step)
    return (below + F.size(F.filter(rest, lambda b: b < key))).cast("int")


def groups(frame: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `size` bytes of its last column each, one row at least."""
    sizes = pc.binary_length(frame.column(frame.num_columns - 1)).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < frame.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield frame.slice(at, to - at)
        at = to
