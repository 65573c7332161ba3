"""Reading bronze, and turning landed snapshots into bronze rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions import instant, request_url, utc
from gridspark.schemas import BRONZE, ENVELOPE
from gridspark.session import use_utc
from gridspark.sinks.layout import not_before
from gridspark.spec import PipelineSpec, SourceSpec

INGEST_PARTS = ("year", "month", "day")


def ingested_since(bronze: DataFrame, since: str | None) -> DataFrame:
    """Rows ingested on or after the day `since` (yyyy-MM-dd); prunes y/m/d partitions."""
    if since is None:
        return bronze
    day = datetime.strptime(since, "%Y-%m-%d")
    if set(INGEST_PARTS) <= set(bronze.columns):
        return bronze.where(not_before(INGEST_PARTS, day.strftime("%Y %m %d").split()))
    at = F.col("extracted_at")
    is_text = dict(bronze.dtypes)["extracted_at"] == "string"
    return bronze.where((instant(at) if is_text else at) >= utc(day))


def read_bronze(
    spark: SparkSession,
    spec: PipelineSpec | None = None,
    *,
    path: str | None = None,
    format: str | None = None,
    since: str | None = None,
) -> DataFrame:
    """Bronze rows from the spec's table, or from `path`.

    Formats of a path: `parquet`, and lines of text, where `json` has one envelope per line, `raw`
    one API object (or whatever the poll brought) per line, and `lines` either: each line that is an
    object with a `payload` is an envelope, every other is wrapped. Without a format, a path
    that ends in `.parquet` is Parquet and any other is `lines`.
    """
    use_utc(spark)
    if path is None:
        if spec is None:
            raise ValueError("read_bronze needs a spec or a path")
        return ingested_since(spark.table(spec.bronze.qualified), since)
    if format is None:
        format = "parquet" if path.rstrip("/").endswith(".parquet") else "lines"
    if format == "parquet":
        frame = spark.read.schema(_stored_envelope(spark, path)).parquet(path)
    elif format == "json":
        frame = spark.read.schema(ENVELOPE).json(path)
    elif format == "raw":
        frame = read_raw(spark, path)
    elif format == "lines":
        frame = opened(read_raw(spark, path))
    else:
        raise ValueError(f"unknown bronze format {format!r}")
    return ingested_since(frame, since)


def _stored_envelope(spark: SparkSession, path: str):
    """The bronze columns that the files have, with the types they were written with.

    The year, month and day of the directories stay text; left to inference, `09` becomes 9.
    """
    stored = {field.name: field for field in spark.read.parquet(path).schema}
    fields = [
        field if field.name in INGEST_PARTS else stored[field.name]
        for field in BRONZE
        if field.name in stored
    ]
    return type(BRONZE)(fields)


def opened(lines: DataFrame) -> DataFrame:
    """Raw rows with the envelopes among them opened, row by row.

    An object with a key `payload` is an envelope: its fields take the place of the row's.
    """
    keys = F.json_object_keys(F.when(F.col("payload").startswith("{"), F.col("payload")))
    is_envelope = F.coalesce(F.array_contains(keys, "payload"), F.lit(False))
    read = lines.withColumn("envelope", F.when(is_envelope, F.from_json("payload", ENVELOPE)))

    def field(name: str) -> Column:
        own = F.col(name).cast("string")
        return F.when(F.col("envelope").isNotNull(), F.col(f"envelope.{name}")).otherwise(own).alias(name)

    return read.select(*[field(name) for name in ENVELOPE.names])


def read_raw(spark: SparkSession, path: str, extracted_at: Column | None = None) -> DataFrame:
    """Raw JSON lines in the envelope; the text is kept as it is, the file is the source."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.where(F.trim("value") != "").select(
        (F.current_timestamp() if extracted_at is None else extracted_at).alias("extracted_at"),
        F.col("_metadata.file_path").alias("source_url"),
        F.col("value").alias("payload"),
    )


def snapshot_url(source: SourceSpec, payload: Column) -> Column:
    """Request URL of a snapshot: the spec's endpoint with the zone that the payload names."""
    zone = F.get_json_object(payload, "$.zone")
    return request_url(source.base_url, source.path, {**source.static_params(), "zone": zone})


def bronze_rows(
    snapshots: DataFrame,
    source_url: Column,
    extracted_at: datetime | Column | None = None,
) -> DataFrame:
    """One bronze row per snapshot (`payload`), dated by ingest time in UTC.

    A naive `extracted_at` is taken as UTC; without one it is the time the job runs.
    """
    if extracted_at is None:
        extracted_at = F.current_timestamp()
    return snapshots.select(
        utc(extracted_at).alias("extracted_at"),
        source_url.alias("source_url"),
        F.col("payload"),
    ).select(
        "*",
        F.date_format("extracted_at", "yyyy").alias("year"),
        F.date_format("extracted_at", "MM").alias("month"),
        F.date_format("extracted_at", "dd").alias("day"),
    )
