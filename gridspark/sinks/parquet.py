"""Parquet directories: overwrite and keyed upsert."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import nullcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridspark.functions import keys_match
from gridspark.operators.checks import assert_kept, assert_unique, observed
from gridspark.operators.upsert import upsert
from gridspark.session import staged
from gridspark.sinks.evolution import SCHEMA_FILE, evolved, fitted, keep_schema, plain, read_as, widened
from gridspark.sinks.files import Files
from gridspark.sinks.layout import between_ends, for_files, partitions_follow_keys, touched_rows, write_files
from gridspark.sinks.lease import Lease
from gridspark.sinks.swap import replacing, replacing_files, writing
from gridspark.sources.silver import read_parquet
from gridspark.spec import ColumnSpec


def overwrite_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    *,
    sort_by: Sequence[str] = (),
    only_touched: bool = False,
    gone: Callable[[str], bool] = lambda unit: False,
    lease: Lease | None = None,
    contract: Sequence[ColumnSpec] = (),
) -> None:
    """Replace a directory, or with `only_touched` just the partitions that `df` has rows in, and
    those that `gone` names (by `a=1/b=2`) although it has none.

    The new files are written once, next to the old ones, and take their place when they are whole.
    `df` may read the directory itself. With `only_touched` the other partitions stay readable next to
    it, whatever columns it has. A second writer is refused; `lease` is that of the caller, if it has it.
    NULLs in columns that `contract` declares non-null are counted while the files are written, and
    fail the write before any of them is in place.
    """
    if only_touched and not partition_by:
        raise ValueError("only_touched needs partition columns")
    spark = df.sparkSession
    with nullcontext(lease) if lease else writing(spark, path) as lease:
        files = Files(spark, path)
        if only_touched:
            df = ready_for(df, path, partition_by, lease)
        elif files.exists(SCHEMA_FILE):
            # Until the new files are all in place, readers look at what the files have.
            files.delete(SCHEMA_FILE)
        with replacing(spark, path, len(partition_by) if only_touched else 0, gone, lease) as folder:
            rows, counts = observed(for_files(df, partition_by, sort_by), contract)
            write_files(rows, folder, partition_by)
            assert_kept(counts)
        if not only_touched:
            _keep(files, plain(df.schema), partition_by)


def ready_for(df: DataFrame, path: str, partition_by: Sequence[str], lease: Lease) -> DataFrame:
    """`df` with the columns that rows of the directory have from now on (`evolution.py`).

    Columns that `df` lacks stay away. The directory notes its columns, and is rewritten before where
    readers cannot widen a type.
    """
    spark, files = df.sparkSession, Files(df.sparkSession, path)
    existing = read_parquet(spark, path)
    if existing is None:
        return df
    # Partition columns are text in the names of folders, whatever type rows have there.
    parts = set(files.partition_columns()) | set(partition_by)
    rest = lambda schema: StructType([f for f in schema if f.name not in parts])
    stored = rest(plain(existing.schema))
    now = evolved(stored, rest(plain(df.schema)))
    kinds = {field.name: field.dataType for field in now}
    if not all(read_as(f.dataType, kinds[f.name]) for f in stored):
        old = StructType([f if f.name in parts else StructField(f.name, kinds[f.name]) for f in existing.schema])
        overwrite_parquet(fitted(existing, old), path, files.partition_columns(), lease=lease)
    elif len(now) > len(stored) or widened(stored, now) or not files.exists(SCHEMA_FILE):
        # Before the files: the wider columns hold for the old ones as well.
        _keep(files, now, files.partition_columns())
    own = {f.name.lower(): f for f in df.schema}
    columns = [f for f in now if f.name.lower() in own] + [f for f in df.schema if f.name in parts]
    return fitted(df, StructType(columns))


def _keep(files: Files, schema: StructType, partition_by: Sequence[str]) -> None:
    """Note the columns, so that no reader has to look into every file for them."""
    rest = [f for f in schema if f.name not in partition_by]
    keep_schema(files, StructType([*rest, *[StructField(name, StringType()) for name in partition_by]]))


def append_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), *, contract: Sequence[ColumnSpec] = (), laid_out: bool = False
) -> None:
    """Add rows to a directory; with a `contract` none is in place before all of them are checked."""
    spark = df.sparkSession
    with writing(spark, path) as lease:
        if read_parquet(spark, path) is None:
            overwrite_parquet(df, path, partition_by, lease=lease, contract=contract)
            return
        rows = ready_for(df, path, partition_by, lease)
        with replacing_files(spark, path, [], lease) as folder:
            rows, counts = observed(rows if laid_out else for_files(rows, partition_by), contract)
            write_files(rows, folder, partition_by)
            assert_kept(counts)


def upsert_parquet(
    incoming: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    *,
    guard: Sequence[str] | None = None,
    schema: StructType | None = None,
    unique: bool = False,
    ready: bool = False,
) -> None:
    """Upsert into a Parquet directory.

    Where a key can lie in one partition only, just the partitions that `incoming` touches are read
    and rewritten, otherwise the whole directory is. Every column that is stored stays, whichever
    files have it; columns that only `schema` declares are NULL.

    `unique=True` skips the check that `incoming` holds each key once. `ready` says that `incoming`
    is only read, not computed, so that no copy of it is needed.
    """
    spark = incoming.sparkSession
    keys = list(keys)
    with writing(spark, path) as lease:
        existing = read_parquet(spark, path, schema)
        if existing is None and unique:
            overwrite_parquet(incoming, path, partition_by, sort_by=keys, lease=lease)
            return
        # Read below for its keys, its partitions and its rows: computed once.
        with nullcontext(incoming) if ready else staged(incoming, "incoming") as incoming:
            if not unique:
                assert_unique(incoming, keys)
            if existing is None:
                overwrite_parquet(incoming, path, partition_by, sort_by=keys, lease=lease)
                return
            incoming = ready_for(incoming, path, partition_by, lease)
            existing = read_parquet(spark, path, schema)
            only_touched = partitions_follow_keys(partition_by, keys)
            if only_touched:
                existing = touched_rows(existing, incoming, partition_by)
            merged = upsert(existing, incoming, keys, guard)
            overwrite_parquet(merged, path, partition_by, sort_by=keys, only_touched=only_touched, lease=lease)


def upsert_files(
    incoming: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    *,
    guard: Sequence[str] | None = None,
    schema: StructType | None = None,
    unique: bool = False,
    ready: bool = False,
) -> int:
    """The same outcome as `upsert_parquet`, but only files that hold a key of `incoming` are rewritten;
    new rows go to files of their own. Returns how many files were replaced.

    Files are found by a semi join of the stored keys with the incoming ones; the scan of the keys is
    cut before to the partitions and the range of keys that come. The names of these files, not their
    rows, go through the driver. `unique` and `ready` are those of `upsert_parquet`.
    """
    spark = incoming.sparkSession
    keys = list(keys)
    with writing(spark, path) as lease, nullcontext(incoming) if ready else staged(incoming, "incoming") as incoming:
        if not unique:
            assert_unique(incoming, keys)
        if read_parquet(spark, path, schema) is None:
            overwrite_parquet(incoming, path, partition_by, sort_by=keys, lease=lease)
            return 0
        incoming = ready_for(incoming, path, partition_by, lease)
        existing = read_parquet(spark, path, schema)
        stored = existing.select("*", F.col("_metadata.file_path").alias("__file"))
        if partitions_follow_keys(partition_by, keys):
            stored = touched_rows(stored, incoming, partition_by)
        stored = stored.where(between_ends(incoming, keys))
        hit = stored.alias("t").join(
            incoming.select(*[F.col(f"`{key}`") for key in keys]).alias("s"), keys_match(keys, "t", "s"), "left_semi"
        )
        found = [row["__file"] for row in hit.select("__file").distinct().collect()]
        rows = existing.where(F.col("_metadata.file_path").isin(found)) if found else existing.limit(0)
        merged = upsert(rows, incoming, keys, guard)
        files = Files(spark, path)
        with replacing_files(spark, path, [files.inside(uri) for uri in found], lease) as folder:
            write_files(for_files(merged, partition_by, keys), folder, partition_by)
        return len(found)
