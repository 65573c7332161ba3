"""Incremental jobs. Each call works off what has arrived and stops; call again for more.

Bronze and silver are the spec's catalog tables unless a path is given, so that stream and batch jobs
read each other's tables. A bronze table is filled either by the stream or by batches: the stream
keeps a log of its own files in the table's folder, and readers go by that log.
"""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridspark.operators.daily import add_shares, energy_by_day, label_mix
from gridspark.operators.facts import MIX_KEYS, mix_rows, newest_facts
from gridspark.operators.latest import CLOCKS, RECENCY
from gridspark.plans.pipeline import fact_output, write_output
from gridspark.plans.progress import ProgressLog
from gridspark.plans.registry import FACTS, RECEIVED
from gridspark.schemas import BRONZE
from gridspark.session import even_tasks, session_conf, staged, use_utc
from gridspark.sinks.layout import day_rounds
from gridspark.sinks.parquet import upsert_parquet
from gridspark.sources.bronze import INGEST_PARTS, bronze_rows, snapshot_url
from gridspark.sources.landing import landed_lines
from gridspark.sources.silver import STORED
from gridspark.spec import PipelineSpec

# Stored bytes, of bronze or of a copy of its rows, that silver works off at once.
ROUND_BYTES = 256 << 20

# State stores on disk, and of each batch only what changed written to the checkpoint.
STATE_ON_DISK = {
    "spark__sql__streaming__stateStore__providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled": "true",
}


def _files(spark: SparkSession, max_files: int | None):
    use_utc(spark)
    reader = spark.readStream
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)


def stream_bronze(
    spark: SparkSession,
    spec: PipelineSpec,
    landing: str,
    bronze: str | None,
    checkpoint: str,
    *,
    max_files: int | None = None,
) -> StreamingQuery:
    """New landing files to bronze, each file once; ingest time is the stamp of its drop.

    `bronze` is a path, or None for the spec's table.
    """
    lines = _files(spark, max_files).option("recursiveFileLookup", "true").text(landing)
    snapshots = landed_lines(lines).where(F.trim("payload") != "")
    rows = bronze_rows(
        snapshots,
        snapshot_url(spec.source, F.col("payload")),
        F.coalesce("stamp", F.current_timestamp()),
    )
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy(*INGEST_PARTS)
        .option("compression", "zstd")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    with even_tasks(spark):
        if bronze is None:
            return writer.toTable(spec.bronze.qualified)
        return writer.option("path", bronze).start()


def read_bronze_stream(
    spark: SparkSession,
    bronze: str | None,
    max_files: int | None = None,
    *,
    spec: PipelineSpec | None = None,
) -> DataFrame:
    reader = _files(spark, max_files)
    if bronze is None:
        if spec is None:
            raise ValueError("a bronze stream needs a path or a spec")
        return reader.table(spec.bronze.qualified)
    return reader.schema(BRONZE).parquet(bronze)


def stream_silver(
    spark: SparkSession,
    spec: PipelineSpec,
    bronze: str | None,
    silver: str | None,
    checkpoint: str,
    *,
    max_files: int | None = None,
    progress: str | None = None,
) -> StreamingQuery:
    """New bronze rows to the silver fact; a path, or None for the spec's table, on either side.

    Each batch is reduced to its newest rows and upserted only where it is newer than what is
    stored. The outcome does not depend on how the input is cut into batches, on their order, or on
    a batch being run again. With `progress`, a shared folder, each batch notes the days it touches
    before it writes; `run_etl(layer="gold", progress=...)` recomputes them, once each.

    A large batch is opened once into a copy, of which days of data are worked off some at a time, so
    that what is shuffled at once does not grow with the batch. That is for silver that is merged and
    partitioned by days or months of a key; elsewhere a round would rewrite what the one before wrote.
    """
    layer = spec.layer("silver")
    output = fact_output(spec)
    build = FACTS[output.table]
    keys = list(output.merge_keys or spec.business_keys)
    parts = layer.partitions(output)
    merging = silver is not None or layer.write_disposition == "merge"
    by_day = merging and "datetime" in keys and bool(parts) and set(parts) <= {"dt", *INGEST_PARTS}

    def merge(batch: DataFrame, _: int) -> None:
        if not by_day or _stored_bytes(batch) <= ROUND_BYTES:
            upsert(build(batch, keys))
            return
        with staged(RECEIVED[output.table](batch), "received") as received:
            rounds = -(-_stored_bytes(received) // ROUND_BYTES)
            most = -(-received.count() // rounds)
            for days in day_rounds(received, "datetime", F.lit(1), most):
                upsert(newest_facts(received.where(days), keys))

    def upsert(rows: DataFrame) -> None:
        with ExitStack() as copies:
            if progress is not None:
                rows = copies.enter_context(staged(rows, "batch"))
                days = [row["dt"] for row in rows.select("dt").where("dt IS NOT NULL").distinct().collect()]
                ProgressLog(spark, progress).touched(spec.name, days)
            known = {"guard": RECENCY, "unique": True, "ready": progress is not None}
            if silver is None:
                write_output(rows, layer, output, merge_keys=keys, **known)
            else:
                schema = STORED.get(output.table)
                upsert_parquet(rows, silver, keys, parts, schema=schema, **known)

    writer = (
        read_bronze_stream(spark, bronze, max_files, spec=spec)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    with even_tasks(spark):
        return writer.start()


def _stored_bytes(df: DataFrame) -> int:
    """Size of the files that are read, as Spark's planner knows it; very large if it does not."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _newest(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The first row per key in the order of `keep_latest`, as an aggregate that can stream.

    Ranks as one struct whose least value wins: the clocks turned round, with a missing one last,
    then the other columns. Map tasks hand on one row per key, and so does the state.
    """
    others = [name for name in rows.columns if name not in (*keys, *RECENCY)]

    def turned(name: str) -> Column:
        return F.coalesce(-F.unix_micros(name), F.lit(2**63 - 1)).alias(f"_{name}")

    rank = F.struct(*[turned(name) for name in RECENCY], *others, *RECENCY)
    best = rows.groupBy(*keys).agg(F.min(rank).alias("best"))
    kept = [name for name in rows.columns if name not in keys]
    return best.select(*keys, *[F.col(f"best.{name}").alias(name) for name in kept])


def daily_mix_stream(bronze: DataFrame, delay: str) -> DataFrame:
    """Daily mix of a bronze stream; a day comes out once the watermark has passed its end.

    Of all versions of a (zone, interval) that arrive in time the newest counts, by the rules of the
    batch job; rows later than `delay` are dropped by the watermark. One row per open interval is
    kept as state.
    """
    rows = mix_rows(bronze)
    for name in CLOCKS:
        rows = rows.withColumn(name, F.date_trunc("second", name))
    newest = _newest(rows.withWatermark("datetime", delay), MIX_KEYS)
    daily = energy_by_day(newest, F.window("datetime", "1 day").alias("day"))
    return label_mix(add_shares(daily).withColumn("dt", F.to_date("day.start")))


def daily_mix_stream_of_firsts(bronze: DataFrame, delay: str) -> DataFrame:
    """The same of a feed that repeats snapshots but never corrects them: of an interval the version
    that arrives first counts.

    The state of the dedupe is the keys of open intervals, without their values, and goes with the
    watermark; the daily sums are the only values kept.
    """
    rows = mix_rows(bronze)
    for name in CLOCKS:
        rows = rows.withColumn(name, F.date_trunc("second", name))
    firsts = rows.withWatermark("datetime", delay).dropDuplicatesWithinWatermark([*MIX_KEYS])
    daily = energy_by_day(firsts, F.window("datetime", "1 day").alias("day"))
    return label_mix(add_shares(daily).withColumn("dt", F.to_date("day.start")))


def stream_daily_mix(
    spark: SparkSession,
    bronze: str | None,
    gold: str,
    checkpoint: str,
    *,
    spec: PipelineSpec | None = None,
    delay: str = "2 days",
    max_files: int | None = None,
    state_partitions: int | None = None,
    corrected: bool = True,
) -> StreamingQuery:
    """Closed days of the daily mix, appended to a Parquet directory partitioned by `dt`.

    `bronze` is a path, or None for the table of `spec`.

    With `corrected=False` the feed is one that only repeats itself, and the state is smaller
    (`daily_mix_stream_of_firsts`); a checkpoint stays with the form it began with.

    `state_partitions` is the number of state stores, by default the session's shuffle partitions;
    it is fixed when a checkpoint is first used, and AQE does not adjust it. Open intervals are kept in
    RocksDB, on the executors' disks: in the heap, all of them would have to fit into the memory of
    a few executors. A checkpoint that was begun with another store stays with it.
    """
    daily = daily_mix_stream if corrected else daily_mix_stream_of_firsts
    writer = (
        daily(read_bronze_stream(spark, bronze, max_files, spec=spec), delay)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("dt")
        .option("path", gold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    partitions = state_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    with even_tasks(spark), session_conf(spark, spark__sql__shuffle__partitions=str(partitions), **STATE_ON_DISK):
        return writer.start()
