"""Bronze snapshots derived from the given tables.

The tables hold no power data. `events` become generation-mix snapshots and the orders with their
line items become cross-border-flow snapshots; both grow with the tables. Every snapshot is
delivered three times - an older version, the current one and a late exact repeat - together with
the junk an API poll can bring: an error page, an empty body, items without a usable time.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions import request_url
from gridspark.schemas import GRANULARITY_HOURS, ZONES
from gridspark.session import even_tasks, freed_shuffles, scratch_path, use_utc
from gridspark.spec import (
    BronzeSpec,
    ColumnSpec,
    LandingSpec,
    LayerSpec,
    OutputSpec,
    PipelineSpec,
    SourceSpec,
)

BASE_URL = "https://grid.example.org/api/"
ITEMS_PER_SNAPSHOT = 256
ZONE_CODES = [zone[0] for zone in ZONES]
# The last two stand for a granularity that is unknown and one that is missing.
GRANULARITIES = [*GRANULARITY_HOURS, "weekly", None]

ENVELOPE_COLUMNS = (
    ColumnSpec("extracted_at", "timestamp", False, "Time of ingest, UTC."),
    ColumnSpec("source_url", "text", False, "Request the snapshot came from."),
    ColumnSpec("payload", "text", False, "Snapshot as received."),
    ColumnSpec("year", "text", False, "Year of ingest."),
    ColumnSpec("month", "text", False, "Month of ingest, two digits."),
    ColumnSpec("day", "text", False, "Day of ingest, two digits."),
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def pick(values: list[str | None], index: Column) -> Column:
    """`values[index]`, counted from 0."""
    return F.array(*[F.lit(v) for v in values])[index.cast("int")]


def iso(ts: Column, pattern: str = "yyyy-MM-dd'T'HH:mm:ss'Z'") -> Column:
    return F.date_format(ts, pattern)


def hours(count: Column | int) -> Column:
    return F.make_dt_interval(hours=F.lit(count) if isinstance(count, int) else count.cast("int"))


def event_zone(user: Column) -> Column:
    """Two fifths of the users stand for the ten known zones, every other is a zone of its own."""
    code = user % 25
    return F.when(code < 10, pick(ZONE_CODES, code)).otherwise(
        F.concat(F.lit("U"), user.cast("string"))
    )


def nation_zone(nation: Column) -> Column:
    """Nations 0 to 9 are the known zones, the others have codes outside the dimension."""
    return F.when(nation < 10, pick(ZONE_CODES, nation)).otherwise(
        F.concat(F.lit("N"), nation.cast("string"))
    )


def _snapshot(data: Column) -> Column:
    return F.to_json(
        F.struct(
            "zone",
            F.col("granularity").alias("temporalGranularity"),
            F.lit("MW").alias("unit"),
            data.alias("data"),
        )
    )


def _deliveries(
    snapshots: DataFrame, path: str, current: Column, older: Column, untimed: Column
) -> DataFrame:
    """Six bronze rows per snapshot; `fetched` is when the current version was ingested.

    Texts and URL are made once per snapshot, before the rows: what an explode is given is evaluated
    as often as it is named.
    """
    texts = snapshots.select(
        "zone",
        "fetched",
        request_url(BASE_URL, path, {"zone": F.col("zone")}).alias("source_url"),
        *[_snapshot(data).alias(name) for name, data in (("now", current), ("before", older), ("never", untimed))],
    )
    fetched = F.col("fetched")
    rows = [
        (fetched - hours(1), F.col("before")),
        (fetched, F.col("now")),
        (fetched + hours(6), F.col("now")),
        (fetched + hours(7), F.col("never")),
        (fetched + hours(8), F.concat(F.lit("<html>502 for "), "zone", F.lit("</html>"))),
        (fetched + hours(9), F.lit("")),
    ]
    delivery = F.explode(
        F.array(*[F.struct(at.alias("extracted_at"), body.alias("payload")) for at, body in rows])
    )
    day = F.col("ingested")
    return (
        texts.select("source_url", delivery.alias("d"))
        .select("d.extracted_at", "source_url", "d.payload", F.date_format("d.extracted_at", "yyyy MM dd").alias("ingested"))
        .select(
            "extracted_at",
            "source_url",
            "payload",
            F.substring_index(day, " ", 1).alias("year"),
            F.substring(day, -5, 2).alias("month"),
            F.substring(day, -2, 2).alias("day"),
        )
    )


# Event type -> generation source.
EVENT_SOURCES = {
    "click": "wind",
    "view": "solar",
    "purchase": "nuclear",
    "signup": "gas",
    "error": "coal",
}


def _mix_item(event: Column, updated: Column, scale: float) -> Column:
    """One `data[]` item of an event; megawatts are whole numbers, so sums of them are exact."""
    power = F.floor(F.round(event.value * 100) * scale).cast("double")
    sources = [
        F.when(event.event_type == kind, power).alias(name)
        for kind, name in EVENT_SOURCES.items()
    ]
    return F.struct(
        iso(F.date_trunc("hour", event.ts)).alias("datetime"),
        iso(updated, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("updatedAt"),
        event.event_type.alias("breakdownType"),
        (event.user_id % 2 == 0).alias("isEstimated"),
        F.when(event.event_id % 3 == 0, F.lit("MODEL")).alias("estimationMethod"),
        F.struct(
            *sources,
            (event.event_id % 1000).cast("double").alias("hydro"),
            (event.user_id % 7).cast("double").alias("unknown"),
            F.struct((event.event_id % 11).cast("double").alias("charge")).alias(
                "hydro storage"
            ),
            F.struct((event.user_id % 5).cast("double").alias("discharge")).alias(
                "battery storage"
            ),
            F.struct(
                (event.event_id % 13).cast("double").alias("imports"),
                (event.event_id % 17).cast("double").alias("exports"),
            ).alias("flows"),
        ).alias("mix"),
    )


def mix_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix snapshots of a zone: up to 256 consecutive events of a day in `data[]`."""
    ts = F.col("ts").cast("timestamp")
    events = read(spark, sf_dir, "events").withColumns(
        {
            "ts": ts,
            "zone": event_zone(F.col("user_id")),
            "date": F.to_date(ts),
            "batch": F.floor(F.col("event_id") / ITEMS_PER_SNAPSHOT),
        }
    )
    # A group holds at most 256 events whatever the data, since `batch` numbers them off. The events
    # are shuffled as they are; the items of both versions, ten times as wide, are made of them after.
    snapshots = (
        events.groupBy("zone", "date", "batch")
        .agg(F.collect_list(F.struct("ts", "event_type", "value", "user_id", "event_id")).alias("events"))
        .withColumns(
            {
                "current": F.sort_array(F.transform("events", lambda e: _mix_item(e, e.ts, 1.0))),
                "older": F.sort_array(F.transform("events", lambda e: _mix_item(e, e.ts - hours(2), 0.5))),
                "fetched": F.col("date").cast("timestamp") + hours(F.col("batch") % 20 + 24),
                "granularity": pick(GRANULARITIES, F.col("batch") % len(GRANULARITIES)),
            }
        )
    )
    untimed = F.concat(
        F.transform("current", lambda item: item.withField("datetime", F.lit("soon"))),
        F.transform("current", lambda item: item.withField("datetime", F.lit(None).cast("string"))),
    )
    return _deliveries(snapshots, "mix/latest", F.col("current"), F.col("older"), untimed)


def flow_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow snapshots: one per order, odd lines imports and even lines exports per supplier nation.

    A sum that is a multiple of 13 stands for an unknown power. Lines of the zone's own nation are
    left out, which leaves some maps out as well, and so do orders without lines.
    """
    suppliers = read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("neighbor")
    )
    # Dealt out by order once: sums, maps and the join with the orders stay in these partitions.
    lines = (
        read(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")
        .join(suppliers, "l_suppkey")
        .select("l_orderkey", "neighbor", (F.col("l_linenumber") % 2 == 1).alias("odd"), "l_quantity")
        .repartition("l_orderkey")
        .groupBy("l_orderkey", "neighbor", "odd")
        .agg(F.sum("l_quantity").alias("power"))
    )
    customers = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation")
    )
    orders = (
        read(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("date"))
        .join(customers, "o_custkey")
    )
    foreign = F.col("neighbor") != F.col("nation")
    found = F.struct("odd", "neighbor", "power")

    def flows(odd: bool) -> Column:
        own = F.filter("found", lambda line: line.odd == F.lit(odd))
        entries = F.transform(
            own, lambda line: F.struct(nation_zone(line.neighbor), F.when(line.power % 13 != 0, line.power.cast("double")))
        )
        return F.when(F.size(own) > 0, F.map_from_entries(F.sort_array(entries)))

    # Collected per order: at most one entry per nation and direction, summed before.
    snapshots = (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .groupBy("o_orderkey", "o_custkey", "date", "nation")
        .agg(F.collect_list(F.when(foreign, found)).alias("found"))
        .withColumns({"import": flows(True), "export": flows(False)})
        .withColumns(
            {
                "zone": nation_zone(F.col("nation")),
                "granularity": pick(GRANULARITIES, F.col("o_orderkey") % len(GRANULARITIES)),
                "datetime": F.col("date") + hours(F.col("o_orderkey") % 24),
                "second": F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)")),
                "fetched": F.col("date") + hours(F.col("o_custkey") % 24 + 48),
            }
        )
    )

    def data(updated: Column, time: Column, factor: float) -> Column:
        def scaled(name: str) -> Column:
            if factor == 1.0:
                return F.col(name)
            return F.transform_values(name, lambda _, power: power * factor).alias(name)

        return F.array(
            F.struct(
                time.alias("datetime"),
                iso(updated, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("updatedAt"),
                scaled("import"),
                scaled("export"),
            )
        )

    time = iso(F.col("datetime"))
    updated = F.col("date") + hours(24) + F.col("second")
    return _deliveries(
        snapshots,
        "flows/latest",
        data(updated, time, 1.0),
        data(updated - hours(24), time, 0.5),
        data(updated, F.lit("soon"), 1.0),
    )


def _write(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    with even_tasks(df.sparkSession), freed_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return path


@cache
def mix_bronze_path(spark: SparkSession, sf_dir: str) -> str:
    """The mix snapshots as a Parquet directory, written once per session."""
    return _write(mix_bronze(spark, sf_dir), "mix-bronze")


@cache
def flow_bronze_path(spark: SparkSession, sf_dir: str) -> str:
    return _write(flow_bronze(spark, sf_dir), "flow-bronze")


def _silver(schema: str, fact: str, keys: tuple[str, ...], parts: tuple[str, ...]) -> LayerSpec:
    return LayerSpec(
        schema=schema,
        table=fact,
        partition_by=parts,
        write_disposition="merge",
        tables=(
            OutputSpec(fact, "fact", merge_keys=keys),
            OutputSpec("dim_zone", partition_by=(), merge_keys=("zone",)),
            OutputSpec("dim_date", partition_by=(), merge_keys=("dt",)),
        ),
    )


def mix_spec(suffix: str = "") -> PipelineSpec:
    """Spec of the mix feed; `suffix` sets its databases apart."""
    return PipelineSpec(
        name="grid_mix",
        bronze=BronzeSpec("mix_latest", schema=f"bronze{suffix}", table_comment="Mix snapshots."),
        silver=_silver(
            f"silver{suffix}",
            "fact_electricity_mix",
            ("zone", "datetime"),
            ("year", "month", "day"),
        ),
        gold=LayerSpec(
            schema=f"gold{suffix}", table="electricity_mix_daily_relative", partition_by=("dt",)
        ),
        columns=ENVELOPE_COLUMNS,
        source=SourceSpec(BASE_URL, "mix/latest"),
        landing=LandingSpec("mix_latest"),
    )


def flow_spec(
    suffix: str = "", partition_by: tuple[str, ...] = ("year", "month", "day")
) -> PipelineSpec:
    """Spec of the flow feed."""
    keys = ("zone", "datetime", "neighbor_zone", "flow_direction")
    return PipelineSpec(
        name="grid_flows",
        bronze=BronzeSpec(
            "flows_latest",
            schema=f"bronze{suffix}",
            partition_by=partition_by,
            table_comment="Flow snapshots.",
        ),
        silver=_silver(f"silver{suffix}", "fact_electricity_flows", keys, partition_by),
        gold=LayerSpec(
            schema=f"gold{suffix}",
            partition_by=("dt",),
            tables=(
                OutputSpec("electricity_flows_fr_imports_daily", "france_imports"),
                OutputSpec("electricity_flows_fr_exports_daily", "france_exports"),
            ),
        ),
        business_keys=keys,
        columns=ENVELOPE_COLUMNS,
        source=SourceSpec(BASE_URL, "flows/latest"),
        landing=LandingSpec("flows_latest"),
    )
