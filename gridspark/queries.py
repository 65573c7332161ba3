"""The registered queries: every operator over whole tables or what Spark derives from them."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark import testbed
from gridspark.functions import date_parts, interval_hours, request_url
from gridspark.operators import daily
from gridspark.operators.checks import ContractViolation, contract_violations
from gridspark.operators.dimensions import dim_date, dim_zone, join_neighbor, join_zone, widen
from gridspark.operators.facts import add_date_parts, flow_fact, flow_rows, mix_fact, mix_rows
from gridspark.operators.latest import keep_latest
from gridspark.operators.payload import judged_payloads, opened_payloads, payload_items
from gridspark.operators.upsert import upsert
from gridspark.plans.pipeline import run_etl, run_gold, run_silver, run_table
from gridspark.schemas import (
    BRONZE,
    FOCAL_IMPORTS,
    FOCAL_ZONE,
    GENERATION_SOURCES,
    MIX_DAILY,
    MIX_FACT,
    MIX_MEASURES,
    MIX_PAYLOAD,
    NESTED_MEASURES,
)
from gridspark.session import scratch_path, use_utc
from gridspark.sinks.parquet import overwrite_parquet, upsert_files, upsert_parquet
from gridspark.sinks.tables import (
    create_table,
    merge_table,
    mirror_table,
    replace_partitions,
    table_from_parquet,
    write_bronze,
)
from gridspark.sources.bronze import bronze_rows, read_bronze, snapshot_url
from gridspark.sources.landing import (
    expired_files,
    landing_files,
    read_landing,
    write_landing,
)
from gridspark.sources.silver import STORED, read_parquet, read_silver
from gridspark.streaming.jobs import stream_bronze, stream_daily_mix, stream_silver

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its name; a leading `_` keeps it apart from the operator it runs."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _ntz(fn(use_utc(spark), sf_dir))

    QUERIES[fn.__name__.removeprefix("_")] = run
    return fn


def _ntz(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f"`{name}`").cast("timestamp_ntz").alias(name)
            if kind == "timestamp"
            else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


# ---- inputs that several queries share, written once per session ----


def _mix_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(BRONZE).parquet(testbed.mix_bronze_path(spark, sf_dir))


def _flow_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(BRONZE).parquet(testbed.flow_bronze_path(spark, sf_dir))


def _specs(suffix: str = ""):
    # Orders reach back years; months keep the number of folders in proportion to the rows. The
    # contract's days are what `etl_by_table` writes.
    return testbed.mix_spec(suffix), testbed.flow_spec(suffix, ("year", "month"))


_IN_STORE = {"write_tables": False}


@cache
def _store_root(spark: SparkSession, sf_dir: str) -> str:
    """Root of what both feeds store, Parquet only; the zones are there from the start."""
    root = scratch_path(spark, "store")
    run_table(spark, "dim_zone", specs=_specs(), output_root=root, **_IN_STORE)
    return root


@cache
def _stored_silver(spark: SparkSession, sf_dir: str, feed: int) -> dict[str, DataFrame]:
    """Fact and zones of one feed; a query of one does not wait for the other, nor for gold."""
    spec, root = _specs()[feed], _store_root(spark, sf_dir)
    path = (testbed.mix_bronze_path, testbed.flow_bronze_path)[feed](spark, sf_dir)
    run_silver(spark, spec, bronze_path=path, bronze_format="parquet", output_root=root, **_IN_STORE)
    return read_silver(spark, spec, root=root, include={"fact", "dim_zone"})


@cache
def _dated_store(spark: SparkSession, sf_dir: str) -> str:
    """Silver of both feeds with the dates that they share."""
    root = _store_root(spark, sf_dir)
    for feed in (0, 1):
        _stored_silver(spark, sf_dir, feed)
    run_table(spark, "dim_date", specs=_specs(), output_root=root, **_IN_STORE)
    return root


@cache
def _store(spark: SparkSession, sf_dir: str) -> str:
    """Root of a full run of both feeds, gold included."""
    root = _dated_store(spark, sf_dir)
    for spec in _specs():
        run_gold(spark, spec, output_root=root, **_IN_STORE)
    return root


def _silver(spark: SparkSession, sf_dir: str, feed: int) -> dict[str, DataFrame]:
    return dict(_stored_silver(spark, sf_dir, feed))


def _databases(spark: SparkSession) -> str:
    """Suffix of a fresh set of bronze, silver and gold databases in the scratch folder."""
    suffix = "_" + uuid.uuid4().hex[:8]
    for layer in ("bronze", "silver", "gold"):
        spark.sql(
            f"CREATE DATABASE {layer}{suffix} LOCATION '{scratch_path(spark, layer)}'"
        )
    return suffix


@cache
def _bronze_tables(spark: SparkSession, sf_dir: str) -> str:
    suffix = _databases(spark)
    write_bronze(_mix_bronze(spark, sf_dir), testbed.mix_spec(suffix))
    return suffix


@cache
def _landed(spark: SparkSession, sf_dir: str, feed: int = 0) -> str:
    """Landing root: a feed's snapshots in four drops, by the quarter of the day of ingest."""
    root = scratch_path(spark, "landing")
    bronze = (_mix_bronze, _flow_bronze)[feed](spark, sf_dir)
    prefix = _specs()[feed].landing.prefix
    quarter = F.floor(F.hour("extracted_at") / 6)
    for drop in range(4):
        write_landing(bronze.where(quarter == drop), root, prefix, datetime(2024, 3, 1 + drop, 12))
    return root


# ---- sources ----


def _kind() -> Column:
    """What a poll brought: an object, an error page or nothing."""
    payload = F.col("payload")
    return F.when(payload == "", "blank").when(payload.startswith("<html>"), "page").otherwise("json")


def _described(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "extracted_at",
        "source_url",
        *[name for name in ("year", "month", "day") if name in bronze.columns],
        _kind().alias("kind"),
    )


@query
def _bronze_scan(spark, sf_dir):
    spec = testbed.mix_spec(_bronze_tables(spark, sf_dir))
    return _described(read_bronze(spark, spec))


@query
def bronze_since(spark, sf_dir):
    spec = testbed.mix_spec(_bronze_tables(spark, sf_dir))
    return _described(read_bronze(spark, spec, since="2024-01-15"))


@query
def bronze_parquet(spark, sf_dir):
    path = testbed.flow_bronze_path(spark, sf_dir)
    return _described(read_bronze(spark, path=path, format="parquet"))


def _payload_facts(bronze: DataFrame) -> DataFrame:
    payload = F.col("payload")
    return bronze.select(
        _kind().alias("kind"),
        F.get_json_object(payload, "$.zone").alias("zone"),
        F.get_json_object(payload, "$.temporalGranularity").alias("granularity"),
        F.get_json_object(payload, "$.data[0].updatedAt").alias("first_update"),
        F.json_array_length(F.get_json_object(payload, "$.data")).cast("long").alias("items"),
    )


@query
def bronze_jsonl(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    text = F.date_format("extracted_at", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    _flow_bronze(spark, sf_dir).withColumn("extracted_at", text).select(
        "extracted_at", "source_url", "payload"
    ).write.json(path)
    return _payload_facts(read_bronze(spark, path=path, format="json"))


@query
def bronze_mixed(spark, sf_dir):
    """A folder with envelopes, raw objects and error pages, read without naming a format."""
    path = scratch_path(spark, "mixed")
    bronze = _flow_bronze(spark, sf_dir)
    first = F.col("month") < "07"
    bronze.where(first).select("extracted_at", "source_url", "payload").write.json(f"{path}/envelopes")
    bronze.where(~first).select("payload").write.text(f"{path}/raw")
    rows = read_bronze(spark, path=path)
    return rows.select(
        _kind().alias("kind"),
        F.get_json_object("payload", "$.zone").alias("zone"),
        F.col("source_url").startswith(testbed.BASE_URL).alias("enveloped"),
    )


@query
def _bronze_rewrap(spark, sf_dir):
    path = scratch_path(spark, "raw")
    _flow_bronze(spark, sf_dir).select("payload").write.text(path)
    return _payload_facts(read_bronze(spark, path=path, format="raw"))


@query
def bronze_from_landing(spark, sf_dir):
    spec = testbed.mix_spec()
    snapshots = read_landing(spark, _landed(spark, sf_dir))
    rows = bronze_rows(
        snapshots, snapshot_url(spec.source, F.col("payload")), datetime(2026, 9, 16, 12)
    )
    return rows.select(
        "extracted_at",
        "source_url",
        "year",
        "month",
        "day",
        F.get_json_object("payload", "$.zone").alias("zone"),
    )


@query
def source_url(spark, sf_dir):
    orders = testbed.read(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        request_url(
            testbed.BASE_URL,
            "/flows/latest",
            {"priority": F.col("o_orderpriority"), "status": F.col("o_orderstatus"), "q": "a&b~c"},
        ).alias("url"),
        request_url("https://grid.example.org/api", "flows", {}).alias("bare_url"),
    )


@query
def silver_products(spark, sf_dir):
    products = read_silver(
        spark, _specs()[0], root=_dated_store(spark, sf_dir), include={"fact", "dim_date"}
    )
    fact, dates = products["fact"], products["dim_date"]
    per_day = fact.groupBy("dt").agg(F.count("*").alias("facts"))
    return dates.join(per_day, "dt", "left").withColumn(
        "products", F.lit(",".join(sorted(products)))
    )


# ---- payloads and facts ----


@query
def parsed_payloads(spark, sf_dir):
    parsed = opened_payloads(_mix_bronze(spark, sf_dir), MIX_PAYLOAD)
    return parsed.select(
        "extracted_at",
        "source_url",
        "zone",
        "unit",
        F.size("data").cast("long").alias("items"),
    ).withColumn("items", F.when(F.col("zone").isNotNull(), F.col("items")))


@query
def _payload_items(spark, sf_dir):
    rows = payload_items(_mix_bronze(spark, sf_dir), MIX_PAYLOAD)
    return rows.select(
        "extracted_at",
        "zone",
        "temporal_granularity",
        F.col("datetime").alias("datetime_text"),
        F.col("updatedAt").alias("updated_text"),
    )


@query
def payload_rejected(spark, sf_dir):
    """Dead letters of a silver run over damaged snapshots, which comes twice, and what was accepted."""
    hour, text = F.hour("extracted_at") % 5, F.col("payload")
    payload = (
        F.when(hour == 1, F.substr(text, F.lit(1), F.length(text) - 9))
        .when(hour == 2, F.regexp_replace(text, '"zone":"[^"]*",', ""))
        .when(hour == 3, F.replace(text, F.lit('"data":'), F.lit('"rows":')))
        .otherwise(text)
    )
    source, root = scratch_path(spark, "damaged"), scratch_path(spark, "rejected")
    bronze = _mix_bronze(spark, sf_dir).withColumn("payload", payload)
    bronze.write.option("compression", "zstd").parquet(source)
    mix = testbed.mix_spec()
    for _ in range(2):
        run_silver(
            spark, mix, bronze_path=source, bronze_format="parquet", output_root=root, write_tables=False,
            dead_letters=f"{root}/dead",
        )
    dead = read_parquet(spark, f"{root}/dead/{mix.name}")
    taken = judged_payloads(read_bronze(spark, path=source, format="parquet"), MIX_PAYLOAD).where("reason IS NULL")
    rows = dead.select("extracted_at", "source_url", "reason", "copies").unionByName(
        taken.select("extracted_at", "source_url", F.lit("accepted").alias("reason"), F.lit(1).cast("long").alias("copies"))
    )
    return rows.groupBy("extracted_at", "source_url", "reason").agg(F.sum("copies").alias("row_count"))


@query
def mix_received(spark, sf_dir):
    return mix_rows(_mix_bronze(spark, sf_dir)).select(
        "zone", "datetime", "updated_at", "extracted_at", *MIX_MEASURES
    )


@query
def flow_received(spark, sf_dir):
    return flow_rows(_flow_bronze(spark, sf_dir)).select(
        "zone",
        "neighbor_zone",
        "flow_direction",
        "power_mw",
        "datetime",
        "updated_at",
        "extracted_at",
    )


@query
def _mix_fact(spark, sf_dir):
    return mix_fact(_mix_bronze(spark, sf_dir))


@query
def _flow_fact(spark, sf_dir):
    return flow_fact(_flow_bronze(spark, sf_dir))


@query
def _keep_latest(spark, sf_dir):
    lines = testbed.read(spark, sf_dir, "lineitem")
    return keep_latest(lines, ["l_orderkey", "l_linenumber"], by=["l_shipdate"])


@query
def latest_by_clock(spark, sf_dir):
    events = testbed.read(spark, sf_dir, "events").select(
        F.nullif("event_type", F.lit("error")).alias("zone"),
        "user_id",
        F.col("ts").cast("timestamp").alias("updated_at"),
        F.when(F.col("value") > 10, F.col("ts").cast("timestamp")).alias("extracted_at"),
        "event_id",
        "value",
    )
    return keep_latest(events, ["zone", "user_id"])


@query
def latest_without_clock(spark, sf_dir):
    lines = testbed.read(spark, sf_dir, "lineitem")
    return keep_latest(lines.select("l_suppkey", "l_partkey", "l_quantity"), ["l_suppkey"])


@query
def _date_parts(spark, sf_dir):
    orders = testbed.read(spark, sf_dir, "orders")
    ts = F.col("o_orderdate").cast("timestamp") + testbed.hours(F.col("o_orderkey") % 24)
    return add_date_parts(orders.select("o_orderkey", ts.alias("datetime")))


@query
def hours_by_granularity(spark, sf_dir):
    fact = _silver(spark, sf_dir, 0)["fact"]
    return fact.groupBy("temporal_granularity").agg(
        F.count("*").alias("intervals"), F.round(F.sum(interval_hours()), 6).alias("hours")
    )


# ---- dimensions ----


@query
def _dim_zone(spark, sf_dir):
    stored = _silver(spark, sf_dir, 1)
    uses = stored["fact"].groupBy("zone").agg(F.count("*").alias("facts"))
    return dim_zone(spark).join(uses, "zone", "left")


@query
def _dim_date(spark, sf_dir):
    facts = [_silver(spark, sf_dir, feed)["fact"] for feed in (0, 1)]
    return dim_date(*facts)


@query
def zone_join(spark, sf_dir):
    fact = _silver(spark, sf_dir, 0)["fact"].select("zone", "datetime", "mix_hydro")
    return join_zone(join_zone(fact))


@query
def neighbor_join(spark, sf_dir):
    fact = _silver(spark, sf_dir, 1)["fact"].select(
        "zone", "neighbor_zone", "flow_direction", "datetime", "power_mw"
    )
    return join_neighbor(fact)


@query
def wide_flows(spark, sf_dir):
    silver = _silver(spark, sf_dir, 1)
    silver["fact"] = silver["fact"].drop("source_url", "year", "month", "day")
    return widen(silver)


# ---- daily products ----


def _rounded(df: DataFrame) -> DataFrame:
    """Without the run time, and sums to six decimals, as their last bits depend on the order."""
    return df.drop("computed_at").select(
        *[
            F.round(F.col(name), 6).alias(name) if name.endswith("_mwh") else F.col(name)
            for name in df.columns
            if name != "computed_at"
        ]
    )


@query
def mix_daily(spark, sf_dir):
    return _rounded(daily.mix_daily(_silver(spark, sf_dir, 0)))


@query
def mix_daily_from_wide(spark, sf_dir):
    return _rounded(daily.mix_daily(widen(_silver(spark, sf_dir, 0))))


@query
def mix_daily_from_bronze(spark, sf_dir):
    return _rounded(daily.mix_daily(mix_fact(_mix_bronze(spark, sf_dir))))


@query
def net_flow_daily(spark, sf_dir):
    return _rounded(daily.net_flow_daily(_silver(spark, sf_dir, 1)))


@query
def net_flow_daily_from_wide(spark, sf_dir):
    return _rounded(daily.net_flow_daily(widen(_silver(spark, sf_dir, 1))))


@query
def net_flow_daily_other_zone(spark, sf_dir):
    return _rounded(daily.net_flow_daily(_silver(spark, sf_dir, 1), focal="N17"))


@query
def focal_imports(spark, sf_dir):
    return _rounded(daily.focal_imports(daily.net_flow_daily(_silver(spark, sf_dir, 1))))


@query
def focal_exports(spark, sf_dir):
    return _rounded(daily.focal_exports(daily.net_flow_daily(_silver(spark, sf_dir, 1))))


# ---- writes ----


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = testbed.read(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.col("o_orderdate").cast("timestamp").alias("datetime"),
    )
    parts = date_parts("datetime")
    return orders.withColumns({"year": parts["year"], "month": parts["month"]})


def _old_and_new(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders up to 1999, and those from mid 1998 on with another price."""
    changed = (F.col("o_totalprice") * 2).alias("o_totalprice")
    new = orders.where("datetime >= timestamp'1998-07-01'").withColumn("o_totalprice", changed)
    return orders.where("datetime < timestamp'1999-01-01'"), new


@query
def upserted(spark, sf_dir):
    old, new = _old_and_new(_orders(spark, sf_dir))
    return upsert(old, new, ["o_orderkey"])


@query
def _upsert_parquet(spark, sf_dir):
    path = scratch_path(spark, "upsert")
    old, new = _old_and_new(_orders(spark, sf_dir))
    keys, parts = ["o_orderkey", "datetime"], ["year", "month"]
    overwrite_parquet(old, path, parts)
    for _ in range(2):
        upsert_parquet(new, path, keys, parts)
    return read_parquet(spark, path)


@query
def _upsert_files(spark, sf_dir):
    """The same file by file: the rows lie in files by key, and only those with a new row are replaced."""
    path = scratch_path(spark, "upsert")
    old, new = _old_and_new(_orders(spark, sf_dir))
    old.repartitionByRange(16, "o_orderkey").write.partitionBy("year", "month").parquet(path)
    for _ in range(2):
        upsert_files(new, path, ["o_orderkey", "datetime"], ["year", "month"])
    return read_parquet(spark, path)


@query
def merge_files(spark, sf_dir):
    table = f"silver{_databases(spark)}.orders"
    old, new = _old_and_new(_orders(spark, sf_dir))
    merge_table(old, table, ["o_orderkey"])
    merge_table(new, table, ["o_orderkey"], by_file=True)
    return spark.table(table)


def _in_two_types(spark: SparkSession, sf_dir: str, price: str) -> tuple[DataFrame, DataFrame]:
    """Old rows with narrower types and fewer fields than new ones."""
    old, new = _old_and_new(_orders(spark, sf_dir))
    narrow = F.struct(F.col("o_custkey").cast("int").alias("customer")).alias("detail")
    wide = F.struct((F.col("o_custkey") + F.lit(5_000_000_000)).alias("customer"), F.lit("new").alias("note")).alias("detail")
    kept = ["o_orderkey", "datetime", "year", "month"]
    old = old.select(*kept, narrow, F.col("o_custkey").cast("int").alias("number"), F.floor("o_totalprice").cast(price).alias("price"))
    return old, new.select(*kept, wide, F.col("o_custkey").alias("number"), F.col("o_totalprice").alias("price"))


def _opened(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "datetime", "year", "month", "number", "price", "detail.customer", "detail.note")


@query
def evolve_widened(spark, sf_dir):
    """Columns become wider by an upsert; the files of other partitions stay as they are."""
    path = scratch_path(spark, "widened")
    old, new = _in_two_types(spark, sf_dir, "int")
    keys, parts = ["o_orderkey", "datetime"], ["year", "month"]
    upsert_parquet(old, path, keys, parts)
    upsert_parquet(new, path, keys, parts)
    return _opened(read_parquet(spark, path))


@query
def evolve_rewritten(spark, sf_dir):
    """A wider type that files cannot be read as: directory and table are rewritten once."""
    path, table = scratch_path(spark, "rewritten"), f"silver{_databases(spark)}.orders"
    old, new = _in_two_types(spark, sf_dir, "bigint")
    keys, parts = ["o_orderkey", "datetime"], ["year", "month"]
    for side in (old, new):
        upsert_parquet(side, path, keys, parts)
        merge_table(side, table, keys, parts)
    both = [_opened(df).withColumn("run", F.lit(i)) for i, df in enumerate([read_parquet(spark, path), spark.table(table)])]
    return both[0].unionByName(both[1])


@query
def upsert_moved(spark, sf_dir):
    path = scratch_path(spark, "upsert")
    old, new = _old_and_new(_orders(spark, sf_dir))
    overwrite_parquet(old, path, ["o_orderstatus"])
    upsert_parquet(
        new.withColumn("o_orderstatus", F.lit("X")), path, ["o_orderkey"], ["o_orderstatus"]
    )
    return read_parquet(spark, path)


@query
def upsert_null_keys(spark, sf_dir):
    path = scratch_path(spark, "upsert")
    nullable = F.nullif(F.col("o_custkey") % 7, F.lit(0))
    old, new = _old_and_new(_orders(spark, sf_dir).withColumn("o_custkey", nullable))
    overwrite_parquet(old, path)
    upsert_parquet(new, path, ["o_custkey", "o_orderkey"])
    return read_parquet(spark, path)


@query
def _upsert_evolve(spark, sf_dir):
    path = scratch_path(spark, "upsert")
    old, new = _old_and_new(_orders(spark, sf_dir))
    keys, parts = ["o_orderkey", "datetime"], ["year", "month"]
    overwrite_parquet(old.drop("o_custkey"), path, parts)
    upsert_parquet(new.withColumn("note", F.lit("new")), path, keys, parts)
    return read_parquet(spark, path)


@query
def upsert_evolve_partly(spark, sf_dir):
    """A column that some stored partitions have stays through an upsert that does not know it."""
    root, mix = scratch_path(spark, "evolved"), testbed.mix_spec()
    first, rest = _halves(spark, sf_dir)
    options = {"bronze_format": "parquet", "output_root": root, "write_tables": False, "newest_wins": True}
    run_silver(spark, mix, bronze_path=first, **options)
    output = mix.silver.outputs()[0]
    path, parts = mix.silver.location(output, root), mix.silver.partitions(output)
    day = read_parquet(spark, path, MIX_FACT).where("dt = date'2024-01-14'").withColumn("note", F.lit("kept"))
    upsert_parquet(day, path, list(output.merge_keys), parts, schema=MIX_FACT)
    run_silver(spark, mix, bronze_path=rest, **options)
    return read_silver(spark, mix, root=root, include={"fact"})["fact"]


@query
def upsert_guard_ties(spark, sf_dir):
    """Of equally new rows the same one stays, whichever comes first, in directories and tables."""
    sides = [side.withColumn("version", F.lit(1)) for side in _old_and_new(_orders(spark, sf_dir))]
    keys, parts = ["o_orderkey", "datetime"], ["year", "month"]
    suffix, found = _databases(spark), []
    for order in (sides, sides[::-1]):
        path, table = scratch_path(spark, "upsert"), f"silver{suffix}.orders{len(found)}"
        for side in order:
            upsert_parquet(side, path, keys, parts, guard=["version"])
            merge_table(side, table, keys, parts, guard=["version"])
        found += [read_parquet(spark, path), spark.table(table)]
    return reduce(DataFrame.unionByName, [df.withColumn("run", F.lit(i)) for i, df in enumerate(found)])


@query
def upsert_guarded(spark, sf_dir):
    path = scratch_path(spark, "upsert")
    orders = _orders(spark, sf_dir).withColumn("version", F.col("o_orderkey") % 3)
    old, new = _old_and_new(orders)
    new = new.withColumn("version", F.lit(1).cast("long"))
    keys, parts = ["o_orderkey", "datetime"], ["year", "month"]
    overwrite_parquet(old, path, parts)
    for _ in range(2):
        upsert_parquet(new, path, keys, parts, guard=["version"])
    return read_parquet(spark, path)


@query
def gold_days_replaced(spark, sf_dir):
    path = scratch_path(spark, "gold")
    mix = _silver(spark, sf_dir, 0)["fact"]
    product = daily.mix_daily(mix)
    overwrite_parquet(product, path, ["dt"])
    late = product.where("dt >= date'2024-01-20'").withColumn("grain", F.lit("again"))
    overwrite_parquet(late, path, ["dt"], only_touched=True)
    return _rounded(read_parquet(spark, path, MIX_DAILY))


@query
def gold_days_evolved(spark, sf_dir):
    """Days of a table replaced by rows with a new column and without an old one."""
    table = f"gold{_databases(spark)}.mix"
    product = daily.mix_daily(_silver(spark, sf_dir, 0)["fact"])
    create_table(product, table, ["dt"])
    late = product.where("dt >= date'2024-01-20'").drop("unit_share").withColumn("note", F.lit("again"))
    replace_partitions(late, table, ["dt"])
    return _rounded(spark.table(table))


@cache
def _emptied(spark: SparkSession, sf_dir: str, suffix: str) -> str:
    """Both flow products, then a correction: from 2000 on the focal zone imported nothing."""
    root, flows = scratch_path(spark, "emptied"), testbed.flow_spec(suffix, ("year", "month"))
    options = {"output_root": root, "write_tables": bool(suffix)}
    source = {"bronze_format": "parquet", "newest_wins": True, **options}
    if suffix:
        spark.sql(f"CREATE DATABASE silver{suffix} LOCATION '{scratch_path(spark, 'silver')}'")
        spark.sql(f"CREATE DATABASE gold{suffix} LOCATION '{scratch_path(spark, 'gold')}'")
    bronze = testbed.flow_bronze_path(spark, sf_dir)
    run_silver(spark, flows, bronze_path=bronze, write_shared_dims=bool(suffix), **source)
    run_gold(spark, flows, **options)
    imports = _silver(spark, sf_dir, 1)["fact"].where(
        f"zone = '{FOCAL_ZONE}' AND flow_direction = 'import' AND dt >= date'2000-01-01'"
    )
    item = F.struct(
        testbed.iso(F.col("datetime")).alias("datetime"),
        testbed.iso(F.col("updated_at") + testbed.hours(1)).alias("updatedAt"),
        F.map_from_arrays(F.array("neighbor_zone"), F.array(F.lit(0.0))).alias("import"),
    )
    payload = F.to_json(
        F.struct("zone", F.col("temporal_granularity").alias("temporalGranularity"), F.array(item).alias("data"))
    )
    late = scratch_path(spark, "correction")
    imports.select(
        (F.col("extracted_at") + testbed.hours(1)).alias("extracted_at"), "source_url",
        payload.alias("payload"), "year", "month", "day",
    ).write.parquet(late)
    days = run_silver(spark, flows, bronze_path=late, **source).days
    run_gold(spark, flows, days=days, **options)
    return root


@query
def gold_days_emptied(spark, sf_dir):
    """Days that a correction leaves without rows lose those they had."""
    flows = testbed.flow_spec()
    path = flows.gold.location(flows.gold.outputs()[0], _emptied(spark, sf_dir, ""))
    return _rounded(read_parquet(spark, path, FOCAL_IMPORTS))


@query
def gold_days_emptied_in_tables(spark, sf_dir):
    suffix = "_" + uuid.uuid4().hex[:8]
    flows = testbed.flow_spec(suffix)
    _emptied(spark, sf_dir, suffix)
    return _rounded(spark.table(flows.gold.qualified(flows.gold.outputs()[0])))


@query
def _merge_table(spark, sf_dir):
    table = f"silver{_databases(spark)}.orders"
    old, new = _old_and_new(_orders(spark, sf_dir))
    keys, parts = ["o_orderkey", "datetime"], ["year", "month"]
    merge_table(old.drop("o_custkey"), table, keys, parts)
    for _ in range(2):
        merge_table(new, table, keys, parts)
    return spark.table(table)


@query
def _merge_table_unpartitioned(spark, sf_dir):
    table = f"silver{_databases(spark)}.orders"
    old, new = _old_and_new(_orders(spark, sf_dir))
    merge_table(old, table, ["o_orderkey"])
    merge_table(new, table, ["o_orderkey"])
    return spark.table(table)


@query
def table_ctas(spark, sf_dir):
    suffix, path = _databases(spark), scratch_path(spark, "ctas")
    overwrite_parquet(_orders(spark, sf_dir), path, ["year", "month"])
    for _ in range(2):
        table_from_parquet(
            spark, f"silver{suffix}.orders", path, ["year", "month"], replace=True
        )
    return spark.table(f"silver{suffix}.orders")


@query
def _table_overwrite(spark, sf_dir):
    table = f"gold{_databases(spark)}.orders"
    old, new = _old_and_new(_orders(spark, sf_dir))
    create_table(old.drop("o_custkey"), table, ["year"])
    create_table(new, table, ["year", "month"])
    return spark.table(table)


@query
def table_mirrored(spark, sf_dir):
    suffix, path = _databases(spark), scratch_path(spark, "mirror")
    create_table(_orders(spark, sf_dir), f"gold{suffix}.orders", ["year"])
    mirror_table(spark, f"gold{suffix}.orders", path, ["year", "month"])
    return read_parquet(spark, path)


@query
def _bronze_append(spark, sf_dir):
    spec = testbed.mix_spec(_databases(spark))
    bronze = _mix_bronze(spark, sf_dir)
    for _ in range(3):
        write_bronze(bronze, spec)
    return (
        read_bronze(spark, spec)
        .groupBy("source_url", "year", "month", "day")
        .agg(F.count("*").alias("row_count"))
    )


@query
def landing_expired(spark, sf_dir):
    events = testbed.read(spark, sf_dir, "events")
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd'T'HHmmss'Z'")
    kind = F.col("event_type")
    suffix = (
        F.when(kind == "click", ".jsonl.gz")
        .when(kind == "view", ".JSONL")
        .when(kind == "error", ".csv")
        .otherwise(".jsonl")
    )
    name = F.concat(F.lit("mix_"), stamp, suffix)
    return expired_files(events.select("event_id", name.alias("name")), datetime(2024, 1, 20), 7)


@query
def landing_kept(spark, sf_dir):
    root = _landed(spark, sf_dir)
    rows = read_landing(spark, root, now=datetime(2024, 3, 9, 18), days=7)
    listed = landing_files(spark, root).select("stamp").distinct()
    return (
        rows.groupBy("stamp")
        .agg(F.count("*").alias("row_count"))
        .join(listed, "stamp", "left_semi")
    )


@query
def _contract_violations(spark, sf_dir):
    bronze = _mix_bronze(spark, sf_dir).withColumns(
        {
            "payload": F.nullif("payload", F.lit("")),
            "source_url": F.when(F.col("payload").startswith("{"), F.col("source_url")),
        }
    )
    return contract_violations(bronze, testbed.ENVELOPE_COLUMNS)


@query
def contract_observed(spark, sf_dir):
    """The same counts, taken by an append that they stop, and what is stored after it."""
    spec = testbed.mix_spec(_databases(spark))
    bronze = _mix_bronze(spark, sf_dir)
    write_bronze(bronze, spec)
    broken = bronze.withColumns(
        {
            "payload": F.nullif("payload", F.lit("")),
            "source_url": F.when(F.col("payload").startswith("{"), F.col("source_url")),
        }
    )
    try:
        write_bronze(broken, spec)
        counts = {}
    except ContractViolation as found:
        counts = found.counts
    stored = read_bronze(spark, spec).agg(F.count("*").alias("stored"))
    return spark.createDataFrame(list(counts.items()), "column_name string, violations long").join(stored)


# ---- jobs ----


# Outputs of both feeds that the jobs' queries compare, by the end of their names: feed, layer, name.
_OUTPUTS = {
    "": (0, "gold", "electricity_mix_daily_relative"),
    "_mix_fact": (0, "silver", "fact"),
    "_flow_fact": (1, "silver", "fact"),
    "_dim_zone": (1, "silver", "dim_zone"),
    "_dim_date": (1, "silver", "dim_date"),
    "_imports": (1, "gold", "france_imports"),
    "_exports": (1, "gold", "france_exports"),
}


def _output(spark: SparkSession, specs, end: str, root: str | None) -> DataFrame:
    feed, kind, name = _OUTPUTS[end]
    layer = specs[feed].layer(kind)
    output = next(o for o in layer.outputs() if o.key == name)
    if root is None:
        frame = spark.table(layer.qualified(output))
    else:
        frame = read_parquet(spark, layer.location(output, root), STORED[output.table])
    return _rounded(frame)


def _compared(name: str, done: Callable, ends) -> None:
    """Register a query for each output of a job; `done` runs it once and says where it wrote."""
    for end in ends:

        def run(spark, sf_dir, end=end):
            specs, root = done(spark, sf_dir)
            return _output(spark, specs, end, root)

        run.__name__ = name + end
        query(run)


@cache
def _etl_tables(spark: SparkSession, sf_dir: str):
    """Everything through catalog tables, bronze included, and a second run of recent snapshots."""
    suffix = _databases(spark)
    mix, flows = specs = _specs(suffix)
    write_bronze(_mix_bronze(spark, sf_dir), mix, backfill=True)
    write_bronze(_flow_bronze(spark, sf_dir), flows, backfill=True)
    run_etl(spark, specs=[flows, mix])
    run_etl(spark, specs=[mix], since="2024-01-20")
    return specs, None


_compared("etl_tables", _etl_tables, _OUTPUTS)


@cache
def _etl_by_table(spark: SparkSession, sf_dir: str):
    """The same one table at a time, Parquet only, flows by day as in the contract."""
    root = scratch_path(spark, "tables")
    mix, flows = specs = testbed.mix_spec(), testbed.flow_spec()
    paths = {
        mix.name: testbed.mix_bronze_path(spark, sf_dir),
        flows.name: testbed.flow_bronze_path(spark, sf_dir),
    }
    tables = "fact_electricity_flows fact_electricity_mix dim_zone dim_date".split()
    tables += "france_imports france_exports electricity_mix_daily_relative".split()
    for table in tables:
        run_table(
            spark,
            table,
            specs=[flows, mix],
            bronze_paths=paths,
            bronze_format="parquet",
            output_root=root,
            write_tables=False,
        )
    return specs, root


_compared("etl_by_table", _etl_by_table, _OUTPUTS)


# Days of ingest from which on mix and flow snapshots belong to the second of two steps.
_SECOND_STEP = ("20240116", "19980701")


def _steps(bronze: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    early = F.concat("year", "month", "day") < day
    return bronze.where(early), bronze.where(~early)


def _cut(spark: SparkSession, bronze: DataFrame, day: str) -> tuple[str, str]:
    paths = scratch_path(spark, "first"), scratch_path(spark, "rest")
    for rows, path in zip(_steps(bronze, day), paths, strict=True):
        rows.write.option("compression", "zstd").parquet(path)
    return paths


@cache
def _halves(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Mix snapshots ingested before 16 January, and from then on."""
    return _cut(spark, _mix_bronze(spark, sf_dir), _SECOND_STEP[0])


@cache
def _flow_halves(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return _cut(spark, _flow_bronze(spark, sf_dir), _SECOND_STEP[1])


@cache
def _etl_incremental(spark: SparkSession, sf_dir: str):
    """Both feeds in two steps of ingest; in the second gold recomputes the days silver touched."""
    root = scratch_path(spark, "incremental")
    mix, flows = specs = _specs()
    halves = zip(_halves(spark, sf_dir), _flow_halves(spark, sf_dir), strict=True)
    for since, (mix_path, flow_path) in zip((None, "1990-01-01"), halves, strict=True):
        run_etl(
            spark,
            specs=specs,
            bronze_paths={mix.name: mix_path, flows.name: flow_path},
            bronze_format="parquet",
            since=since,
            newest_wins=True,
            output_root=root,
            write_tables=False,
        )
    return specs, root


_compared("etl_incremental", _etl_incremental, _OUTPUTS)


@cache
def _etl_resumed(spark: SparkSession, sf_dir: str):
    """Snapshots come in two steps into the bronze folders. The second run is lost after silver; the
    third finds nothing new and brings gold up to date."""
    root, progress = scratch_path(spark, "resumed"), scratch_path(spark, "progress")
    specs = _specs()
    sources = {spec.name: scratch_path(spark, f"bronze-{spec.name}") for spec in specs}
    # Straight from the snapshots: halves of their own would be one more copy of all payloads.
    feeds = zip((_mix_bronze, _flow_bronze), _SECOND_STEP, strict=True)
    halves = [_steps(bronze(spark, sf_dir), day) for bronze, day in feeds]
    steps = [dict(zip(sources, frames, strict=True)) for frames in zip(*halves, strict=True)]
    for arrived, layer in ((steps[0], "all"), (steps[1], "silver"), ({}, "all")):
        for name, rows in arrived.items():
            rows.write.mode("append").option("compression", "zstd").parquet(sources[name])
        run_etl(
            spark, layer=layer, specs=specs, bronze_paths=sources, bronze_format="parquet", newest_wins=True,
            output_root=root, write_tables=False, progress=progress,
        )
    return specs, root


_compared("etl_resumed", _etl_resumed, ("", "_mix_fact", "_flow_fact", "_dim_date", "_imports", "_exports"))


@query
def merge_replaces(spark, sf_dir):
    """The same two steps by plain merge: the second batch replaces whatever is stored."""
    root, mix = scratch_path(spark, "replaced"), _specs()[0]
    for path in _halves(spark, sf_dir):
        run_silver(
            spark,
            mix,
            bronze_path=path,
            bronze_format="parquet",
            output_root=root,
            write_tables=False,
        )
    return read_silver(spark, mix, root=root, include={"fact"})["fact"]


@cache
def _streamed_bronze(spark: SparkSession, sf_dir: str) -> str:
    bronze = scratch_path(spark, "stream-bronze")
    checkpoint = scratch_path(spark, "checkpoint")
    for _ in range(2):
        stream_bronze(
            spark, testbed.mix_spec(), _landed(spark, sf_dir), bronze, checkpoint
        ).awaitTermination()
    return bronze


@query
def _stream_bronze(spark, sf_dir):
    rows = spark.read.schema(BRONZE).parquet(_streamed_bronze(spark, sf_dir))
    return rows.groupBy("extracted_at", "source_url", "year", "month", "day").agg(
        F.count("*").alias("row_count")
    )


@query
def _stream_silver(spark, sf_dir):
    silver, checkpoint = scratch_path(spark, "stream-silver"), scratch_path(spark, "checkpoint")
    bronze = _streamed_bronze(spark, sf_dir)
    for _ in range(2):
        stream_silver(
            spark, testbed.mix_spec(), bronze, silver, checkpoint, max_files=8
        ).awaitTermination()
    return read_parquet(spark, silver, MIX_FACT)


@query
def stream_gold(spark, sf_dir):
    """Silver by a stream, some files at a time; gold takes the days that it notes, after each round."""
    root, progress = scratch_path(spark, "stream-etl"), scratch_path(spark, "progress")
    bronze, checkpoint = scratch_path(spark, "stream-bronze"), scratch_path(spark, "checkpoint")
    mix = _specs()[0]
    silver = mix.silver.location(mix.silver.outputs()[0], root)
    for half in _halves(spark, sf_dir):
        spark.read.schema(BRONZE).parquet(half).coalesce(4).write.mode("append").parquet(bronze)
        stream_silver(spark, mix, bronze, silver, checkpoint, max_files=3, progress=progress).awaitTermination()
        dim_zone(spark).write.mode("overwrite").parquet(mix.silver.location(mix.silver.outputs()[1], root))
        run_etl(spark, layer="gold", specs=[mix], output_root=root, write_tables=False, progress=progress)
    return _rounded(read_parquet(spark, mix.gold.location(mix.gold.outputs()[0], root), MIX_DAILY))


@cache
def _streamed_tables(spark: SparkSession, sf_dir: str, feed: int) -> str:
    """Landing to bronze to silver, all in catalog tables."""
    suffix = _databases(spark)
    spec = _specs(suffix)[feed]
    checks = [scratch_path(spark, "checkpoint") for _ in range(2)]
    for _ in range(2):
        stream_bronze(spark, spec, _landed(spark, sf_dir, feed), None, checks[0]).awaitTermination()
        stream_silver(spark, spec, None, None, checks[1]).awaitTermination()
    return spec.silver.qualified(spec.silver.outputs()[0])


@query
def stream_tables(spark, sf_dir):
    return spark.table(_streamed_tables(spark, sf_dir, 0))


@query
def stream_flows(spark, sf_dir):
    return spark.table(_streamed_tables(spark, sf_dir, 1))


def _heartbeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of a later time, which moves the watermark past the last day."""
    return _silver(spark, sf_dir, 0)["fact"].agg(F.max("datetime").alias("last")).select(
        F.current_timestamp().alias("extracted_at"),
        F.lit("heartbeat").alias("source_url"),
        F.to_json(
            F.struct(
                F.lit("heartbeat").alias("zone"),
                F.array(
                    F.struct(testbed.iso(F.col("last") + testbed.hours(24 * 9)).alias("datetime"))
                ).alias("data"),
            )
        ).alias("payload"),
        *[F.lit("0").alias(name) for name in ("year", "month", "day")],
    )


@query
def _stream_daily(spark, sf_dir):
    """All deliveries in two drops, the second with corrections that come weeks too late, then a
    heartbeat that closes the last day."""
    source, gold = scratch_path(spark, "stream-source"), scratch_path(spark, "stream-gold")
    checkpoint = scratch_path(spark, "checkpoint")
    run = {"state_partitions": spark.sparkContext.defaultParallelism}
    first, rest = (spark.read.schema(BRONZE).parquet(path) for path in _halves(spark, sf_dir))
    first.write.parquet(source)
    stream_daily_mix(spark, source, gold, checkpoint, **run).awaitTermination()
    old = first.where("day <= '06' AND payload LIKE '{%'")
    changed = F.regexp_replace("payload", '"updatedAt":"2024-01', '"updatedAt":"2024-03')
    late = old.withColumn("payload", changed)
    rest.unionByName(late).write.mode("append").parquet(source)
    stream_daily_mix(spark, source, gold, checkpoint, **run).awaitTermination()
    _heartbeat(spark, sf_dir).write.mode("append").parquet(source)
    stream_daily_mix(spark, source, gold, checkpoint, **run).awaitTermination()
    return _rounded(read_parquet(spark, gold, MIX_DAILY))


def _uncorrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of a feed without corrections: the stored facts as snapshots of a zone's day."""
    fact = _silver(spark, sf_dir, 0)["fact"]
    groups: dict[str, list[Column]] = {}
    for group, name, measure in NESTED_MEASURES:
        groups.setdefault(group, []).append(F.col(f"mix_{measure}").alias(name))
    mix = F.struct(
        *[F.col(f"mix_{name}").alias(name) for name in GENERATION_SOURCES],
        *[F.struct(*fields).alias(group) for group, fields in groups.items()],
    )
    item = F.struct(
        testbed.iso(F.col("datetime")).alias("datetime"), testbed.iso(F.col("updated_at")).alias("updatedAt"), mix.alias("mix")
    )
    snapshots = fact.groupBy("zone", "dt", "temporal_granularity", "unit").agg(
        F.sort_array(F.collect_list(item)).alias("data"), F.max("extracted_at").alias("extracted_at")
    )
    payload = F.to_json(F.struct("zone", F.col("temporal_granularity").alias("temporalGranularity"), "unit", "data"))
    return snapshots.select(
        "extracted_at", F.lit("repeated").alias("source_url"), payload.alias("payload"),
        *[F.date_format("dt", form).alias(name) for name, form in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))],
    )


@query
def stream_daily_deduped(spark, sf_dir):
    """A feed that repeats its snapshots, some of them a drop later, with the state of keys alone."""
    source, gold = scratch_path(spark, "stream-source"), scratch_path(spark, "stream-gold")
    checkpoint = scratch_path(spark, "checkpoint")
    run = {"state_partitions": spark.sparkContext.defaultParallelism, "corrected": False}
    snapshots = _uncorrected(spark, sf_dir)
    first, rest = snapshots.where("day < '16'"), snapshots.where("day >= '15'")
    for drop in (first.unionByName(first), rest, _heartbeat(spark, sf_dir)):
        drop.write.mode("append").parquet(source)
        stream_daily_mix(spark, source, gold, checkpoint, **run).awaitTermination()
    return _rounded(read_parquet(spark, gold, MIX_DAILY))
