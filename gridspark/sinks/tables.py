"""Catalog tables: create, append, overwrite, merge."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions import keys_match
from gridspark.operators.checks import ContractViolation, assert_kept, assert_unique, contract_violations, observed
from gridspark.operators.latest import ranks_before, require_columns
from gridspark.operators.upsert import upsert
from gridspark.session import freed_shuffles, staged
from gridspark.sinks.evolution import add_table_columns, evolved, fitted, plain, widened
from gridspark.sinks.layout import all_cores, for_files, partitions_follow_keys, touched_rows, write_files
from gridspark.sinks.lease import Lease, leased
from gridspark.sinks.parquet import append_parquet, overwrite_parquet, upsert_files
from gridspark.sinks.swap import replacing
from gridspark.sources.silver import read_parquet
from gridspark.spec import ColumnSpec, PipelineSpec

# Table formats with row-level writes of their own; DataFrame.mergeInto goes to them, and they
# replace a table's rows in one step by themselves.
ROW_LEVEL_FORMATS = {"delta", "iceberg"}

# Ends of the names of a table that is being built and of one that is being replaced.
BUILDING, REPLACED = "__building_", "__replaced"


def quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").collect()
    return {row[0]: row[1] for row in rows}


def table_format(spark: SparkSession, table: str) -> str:
    return _described(spark, table).get("Provider", "parquet").lower()


def table_parts(spark: SparkSession, table: str) -> list[str]:
    """Partition columns of a table, as the catalog has them."""
    return [c.name for c in spark.catalog.listColumns(quoted(table)) if c.isPartition]


@contextmanager
def writing_table(spark: SparkSession, table: str) -> Iterator[Lease]:
    """The lease of a table, whether it exists or not, after what an earlier writer left is put in order.

    The file lies in the folder of the database. Writers of files in the table's folder take that
    folder's lease besides.
    """
    database, _, name = table.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    location = spark.catalog.getDatabase(database).locationUri
    with leased(spark, f"{location.rstrip('/')}/table-{name}") as lease:
        recover_table(spark, table)
        yield lease


def create_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    *,
    sort_by: Sequence[str] = (),
    format: str = "parquet",
    buckets: tuple[int, Sequence[str]] | None = None,
    laid_out: bool = False,
    lease: Lease | None = None,
    contract: Sequence[ColumnSpec] = (),
) -> None:
    """Create the table, or replace its rows and its schema.

    The new table is built under a name of its own, once, and then takes the old one's name; the old
    table goes last. `df` may read the table itself. A second writer is refused; `lease` is that of the
    caller, if it has the table's. NULLs in columns that `contract` declares non-null are counted while
    the table is built, and fail the write before it takes the old one's place.
    """
    spark = df.sparkSession
    if lease is None:
        with writing_table(spark, table) as lease:
            create_table(
                df, table, partition_by, sort_by=sort_by, format=format, buckets=buckets, laid_out=laid_out, lease=lease,
                contract=contract,
            )
        return
    exists = spark.catalog.tableExists(table)
    in_place = not exists or format in ROW_LEVEL_FORMATS
    target = table if in_place else table + BUILDING + uuid.uuid4().hex[:8]
    rows, counts = observed(df if laid_out else for_files(df, partition_by, sort_by), contract)
    writer = rows.write.format(format).mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        count, names = buckets
        writer = writer.bucketBy(count, *names).sortBy(*names)
    try:
        with freed_shuffles(spark), all_cores(spark) if partition_by else nullcontext():
            writer.saveAsTable(target)
        assert_kept(counts)
    except BaseException:
        if target != table or not exists:
            spark.sql(f"DROP TABLE IF EXISTS {quoted(target)}")
        raise
    if target != table:
        lease.check()
        # A catalog that lists partitions may still list them where they were before the rename;
        # dropping the table would then delete what has taken that place.
        spark.sql(f"ALTER TABLE {quoted(table)} RENAME TO {quoted(table + REPLACED)}")
        _sync_partitions(spark, table + REPLACED)
        spark.sql(f"ALTER TABLE {quoted(target)} RENAME TO {quoted(table)}")
        _sync_partitions(spark, table)
        spark.sql(f"DROP TABLE {quoted(table + REPLACED)}")


def recover_table(spark: SparkSession, table: str) -> None:
    """Undo a replacement that was cut short between its two renames, drop what one left behind."""
    if spark.catalog.tableExists(table + REPLACED):
        if spark.catalog.tableExists(table):
            _sync_partitions(spark, table)
            _sync_partitions(spark, table + REPLACED)
            spark.sql(f"DROP TABLE {quoted(table + REPLACED)}")
        else:
            spark.sql(f"ALTER TABLE {quoted(table + REPLACED)} RENAME TO {quoted(table)}")
            _sync_partitions(spark, table)


def _sync_partitions(spark: SparkSession, table: str) -> None:
    """Tell a catalog that keeps a list of partitions which there are now."""
    if _described(spark, table).get("Partition Provider", "").lower() == "catalog":
        spark.sql(f"MSCK REPAIR TABLE {quoted(table)} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def table_from_parquet(
    spark: SparkSession,
    table: str,
    path: str,
    partition_by: Sequence[str] = (),
    *,
    replace: bool = False,
    format: str = "parquet",
) -> None:
    """CREATE TABLE ... AS SELECT from a Parquet directory; partition values stay text."""
    if not replace and spark.catalog.tableExists(table):
        raise ValueError(f"table {table} exists already")
    rows = read_parquet(spark, path)
    if rows is None:
        raise FileNotFoundError(path)
    create_table(rows, table, partition_by, format=format)


def replace_partitions(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] | None = None,
    *,
    sort_by: Sequence[str] = (),
    gone: Callable[[str], bool] = lambda unit: False,
    lease: Lease | None = None,
) -> None:
    """Replace the partitions of a Parquet table that `df` has rows in, and those that `gone` names.

    The partition columns are the table's; a caller that names others is refused, since readers would
    not find its files. Columns that the table lacks are added to it, those that `df` lacks are NULL,
    and types widen (`evolution.py`). As with directories, files are written apart and moved in when
    they are whole. No session option is involved, so other jobs of the session do not matter.
    """
    spark = df.sparkSession
    if lease is None:
        with writing_table(spark, table) as lease:
            replace_partitions(df, table, partition_by, sort_by=sort_by, gone=gone, lease=lease)
        return
    parts = table_parts(spark, table)
    if partition_by is not None and list(partition_by) != parts:
        raise ValueError(f"table {table} is partitioned by {parts}, not by {list(partition_by)}")
    if not parts:
        raise ValueError(f"table {table} has no partitions to replace")
    rows = evolve_table(df, table, lease)
    with replacing(spark, _described(spark, table)["Location"], len(parts), gone) as folder:
        write_files(for_files(rows, parts, sort_by), folder, parts)
    _sync_partitions(spark, table)


def evolve_table(df: DataFrame, table: str, lease: Lease) -> DataFrame:
    """`df` with the columns that the table has from now on.

    New columns are added in the catalog, old rows read NULL there. A plain Parquet table cannot change
    a column's type in place; it is rewritten once, as wide as needed.
    """
    spark = df.sparkSession
    stored = plain(spark.table(table).schema)
    now = evolved(stored, plain(df.schema))
    parts = table_parts(spark, table)
    changed = widened(stored, now)
    if set(changed) & set(parts):
        raise TypeError(f"{table}: partition columns keep their types: {sorted(set(changed) & set(parts))}")
    if changed:
        old = fitted(spark.table(table), type(now)([*[f for f in now if f.name not in parts], *[f for f in now if f.name in parts]]))
        create_table(old, table, parts, format=table_format(spark, table), lease=lease)
    else:
        add_table_columns(spark, table, list(now)[len(stored) :])
    return fitted(df, type(now)([{f.name: f for f in now}[name] for name in spark.table(table).columns]))


def merge_table(
    incoming: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    *,
    guard: Sequence[str] | None = None,
    unique: bool = False,
    format: str = "parquet",
    ready: bool = False,
    by_file: bool = False,
) -> None:
    """Upsert into a table: matched keys are replaced, others inserted, nothing is deleted.

    A missing table is created. Formats with row-level writes get a MERGE. Of a plain Parquet table the
    touched partitions are rewritten, as for a directory, or with `by_file` only the files that hold a
    key of `incoming`: for few rows in large partitions, or tables without any.
    """
    spark = incoming.sparkSession
    keys = list(keys)
    require_columns(incoming, keys, "keys")
    with writing_table(spark, table) as lease:
        exists = spark.catalog.tableExists(table)
        if not exists and unique:
            create_table(incoming, table, partition_by, sort_by=keys, format=format, lease=lease)
            return
        if exists and table_format(spark, table) in ROW_LEVEL_FORMATS:
            _merge_rows(incoming, table, keys, guard)
            return
        with nullcontext(incoming) if ready else staged(incoming, "incoming") as incoming:
            if not unique:
                assert_unique(incoming, keys)
            if not exists:
                create_table(incoming, table, partition_by, sort_by=keys, format=format, lease=lease)
                return
            incoming = evolve_table(incoming, table, lease)
            parts = table_parts(spark, table)
            if by_file:
                upsert_files(
                    incoming, _described(spark, table)["Location"], keys, parts,
                    guard=guard, schema=spark.table(table).schema, unique=True,
                )
                _sync_partitions(spark, table)
            elif partitions_follow_keys(parts, keys):
                touched = touched_rows(spark.table(table), incoming, parts)
                replace_partitions(upsert(touched, incoming, keys, guard), table, sort_by=keys, lease=lease)
            else:
                create_table(upsert(spark.table(table), incoming, keys, guard), table, parts, sort_by=keys, lease=lease)


def _merge_rows(incoming: DataFrame, table: str, keys, guard) -> None:
    """MERGE with the tie rule of `upsert`: of equally new rows the one that ranks first stays."""
    name = table.split(".")[-1]
    merge = incoming.alias("s").mergeInto(table, keys_match(list(keys), name, "s"))
    if guard:
        merge = merge.whenMatched(ranks_before(incoming, "s", name, keys, guard)).updateAll()
    else:
        merge = merge.whenMatched().updateAll()
    merge.whenNotMatched().insertAll().withSchemaEvolution().merge()


def mirror_table(
    spark: SparkSession,
    table: str,
    path: str,
    partition_by: Sequence[str] = (),
    *,
    sort_by: Sequence[str] = (),
    only: Callable[[DataFrame], DataFrame] | None = None,
    gone: Callable[[str], bool] = lambda unit: False,
) -> None:
    """Export a table to a Parquet directory.

    With `only` just the partitions that it leaves rows of are exported again, and those that `gone`
    names removed; a directory that is not there yet gets the whole table.
    """
    rows = spark.table(table)
    if only is not None and partition_by and read_parquet(spark, path) is not None:
        overwrite_parquet(only(rows), path, partition_by, sort_by=sort_by, only_touched=True, gone=gone)
    else:
        overwrite_parquet(rows, path, partition_by, sort_by=sort_by)


def write_bronze(
    df: DataFrame,
    spec: PipelineSpec,
    *,
    keys: Sequence[str] = (),
    buckets: int | None = None,
    backfill: bool = False,
    checked: bool = True,
) -> None:
    """Write bronze rows by the spec's disposition: append, replace, or merge on `keys`.

    NULLs in columns that the spec declares non-null fail the write, before a row of it is in the
    table; they are counted by the write itself (not where a format, a merge or buckets do the writing:
    there `contract_violations` is run before). `checked=False` leaves it to the caller.

    Declared column comments and the table comment are kept. Rows are sorted by the spec's cluster
    columns inside each partition, so that files can be skipped by them; `buckets` makes the table
    bucketed by them as well. The payloads are not shuffled, since a batch was ingested at one time
    and goes to one partition; a `backfill` spans many and is dealt out by partition first.
    """
    spark = df.sparkSession
    bronze = spec.bronze
    table = bronze.qualified
    declared = spec.bronze_schema()
    if declared.fields:
        require_columns(df, declared.names, "declared columns")
        df = df.select(
            *[
                F.col(f"`{f.name}`").cast(f.dataType).alias(f.name, metadata=f.metadata)
                for f in declared
            ]
        )
    parts = list(bronze.partition_by)
    if backfill:
        rows = for_files(df, parts, bronze.cluster)
    else:
        rows = df.sortWithinPartitions(*parts, *bronze.cluster) if bronze.cluster else df
    bucketing = (buckets, bronze.cluster) if bronze.cluster and buckets else None
    existed = spark.catalog.tableExists(table)
    contract = [c for c in spec.columns if not c.nullable] if checked else []
    appending = bronze.write_disposition == "append" and existed
    if contract and (bronze.write_disposition == "merge" or (appending and bucketing)):
        found = {r["column_name"]: r["violations"] for r in contract_violations(df, contract).collect()}
        if any(found.values()):
            raise ContractViolation(found)
    if bronze.write_disposition == "merge":
        if not keys:
            raise ValueError("merging bronze needs keys")
        merge_table(df, table, keys, parts)
    elif appending and bucketing:
        writer = rows.write.format("parquet").mode("append").partitionBy(*parts)
        writer.bucketBy(buckets, *bronze.cluster).sortBy(*bronze.cluster).saveAsTable(table)
        return
    elif appending:
        with writing_table(spark, table) as lease:
            rows = evolve_table(rows, table, lease)
            append_parquet(rows, _described(spark, table)["Location"], parts, contract=contract, laid_out=True)
            _sync_partitions(spark, table)
        return
    else:
        create_table(rows, table, parts, buckets=bucketing, laid_out=True, contract=contract)
    if bronze.table_comment:
        text = bronze.table_comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {quoted(table)} IS '{text}'")
