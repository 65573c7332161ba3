"""Landing area: stamped JSON-lines drops of raw snapshots."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions import landing_stamp, past_retention, utc

# Lines of a landed file at most, since a compressed file is read by one task.
FILE_LINES = 100_000


def landing_name(prefix: str, now: datetime | None = None) -> str:
    stamp = (now or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%SZ")
    return f"{prefix}_{stamp}.jsonl"


def write_landing(
    payloads: DataFrame, root: str, prefix: str, now: datetime | None = None
) -> str:
    """Write `payload` as JSON lines below `root/prefix`; returns the stamped directory.

    The name stands on the directory, the tasks write their part files into it, compressed.
    """
    path = f"{root.rstrip('/')}/{prefix}/{landing_name(prefix, now)}"
    writer = payloads.select("payload").write.mode("overwrite")
    writer.option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES).text(path)
    return path


def drop_name(path: Column) -> Column:
    """Name of the drop that a landed file belongs to, from its full path."""
    return F.regexp_extract(path, r"(?i)([^/]+\.jsonl(?:\.gz)?)(?:/[^/]*)?$", 1)


def landing_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, name, stamp, length) of every landed file; lists, does not open them."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    ).select("path", "length", drop_name(F.col("path")).alias("name"))
    return files.select("path", "name", landing_stamp("name").alias("stamp"), "length")


def expired_files(files: DataFrame, now: datetime | Column, days: int) -> DataFrame:
    """Files past retention. Deleting them is up to the caller."""
    return files.where(past_retention("name", utc(now), days))


def read_landing(
    spark: SparkSession,
    root: str,
    *,
    now: datetime | Column | None = None,
    days: int | None = None,
) -> DataFrame:
    """Landed snapshots (`payload`, `path`, `stamp`), without expired drops if `days` is given."""
    lines = spark.read.option("recursiveFileLookup", "true").text(root)
    rows = landed_lines(lines)
    if days is None:
        return rows
    now = F.current_timestamp() if now is None else now
    return rows.where(~past_retention(drop_name(F.col("path")), utc(now), days))


def landed_lines(lines: DataFrame) -> DataFrame:
    """The same columns from a text relation, batch or stream."""
    path = F.col("_metadata.file_path")
    return lines.select(F.col("value").alias("payload"), path.alias("path")).withColumn(
        "stamp", landing_stamp(drop_name(F.col("path")))
    )
