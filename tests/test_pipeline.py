import dataclasses
import json
from datetime import datetime

import pytest
from conftest import bronze_of, flow_payload, mix_payload

from gridspark import testbed
from gridspark.plans.pipeline import (
    find_output,
    run_etl,
    run_gold,
    run_silver,
    run_table,
    transform_gold,
    transform_silver,
)
from gridspark.schemas import BRONZE, FOCAL_IMPORTS, MIX_DAILY
from gridspark.session import scratch_root, session_conf, use_utc
from gridspark.sinks.tables import write_bronze
from gridspark.sources.bronze import bronze_rows
from gridspark.sources.landing import write_landing
from gridspark.sources.silver import read_parquet, read_silver
from gridspark.spec import LayerSpec, OutputSpec, PipelineSpec, BronzeSpec
from gridspark.streaming.jobs import stream_bronze, stream_daily_mix, stream_silver

MIX, FLOWS = testbed.mix_spec(), testbed.flow_spec()
AT = "2026-04-16T13:00:00Z"


def mix_bronze(spark, wind=60.0, day=16, at=AT, updated="12:05"):
    return bronze_of(
        spark,
        (
            at,
            mix_payload(
                datetime=f"2026-04-{day:02d}T12:00:00Z",
                updatedAt=f"2026-04-{day:02d}T{updated}:00Z",
                mix={"wind": wind, "coal": 40.0},
            ),
        ),
    )


def flow_bronze(spark):
    return bronze_of(spark, (AT, flow_payload({"DE": 40.0, "ES": 10.0}, {"DE": 5.0, "IT": 20.0})))


def saved(df, path):
    df.write.mode("overwrite").parquet(str(path))
    return str(path)


@pytest.fixture
def paths(spark, tmp_path):
    return {
        MIX.name: saved(mix_bronze(spark), tmp_path / "mix"),
        FLOWS.name: saved(flow_bronze(spark), tmp_path / "flows"),
    }


def test_registry_errors(spark, tmp_path):
    bronze = mix_bronze(spark)
    unknown = PipelineSpec("n", BronzeSpec("t"), LayerSpec(table="fact_other"))
    with pytest.raises(ValueError, match="no fact job"):
        transform_silver(bronze, unknown)
    gold = PipelineSpec("n", BronzeSpec("t"), MIX.silver, LayerSpec(table="other_daily"))
    with pytest.raises(ValueError, match="no gold job"):
        transform_gold(transform_silver(bronze, MIX), gold)
    odd = PipelineSpec(
        "n", BronzeSpec("t"), LayerSpec(tables=(*MIX.silver.tables, OutputSpec("odd")))
    )
    with pytest.raises(ValueError, match="no product 'odd'"):
        path = saved(bronze, tmp_path / "in")
        run_silver(spark, odd, bronze_path=path, bronze_format="parquet", write_tables=False)


def test_lazy_products(spark):
    silver = transform_silver(flow_bronze(spark), FLOWS)
    assert set(silver) == {"fact", "dim_zone", "dim_date"}
    gold = transform_gold(silver, FLOWS)
    assert set(gold) == {"france_imports", "france_exports"}
    assert {r.source_zone for r in gold["france_imports"].collect()} == {"DE", "ES"}


def test_find_output():
    specs = [FLOWS, MIX]
    assert find_output(specs, "dim_zone")[:2] == (FLOWS, "silver")
    spec, kind, output = find_output(specs, "electricity_flows_fr_imports_daily")
    assert (spec, kind, output.name) == (FLOWS, "gold", "france_imports")
    assert find_output(specs, "electricity_mix_daily_relative")[0] is MIX
    with pytest.raises(ValueError):
        find_output(specs, "nothing")


def test_single_table_layer_gets_the_fact(spark, tmp_path):
    spec = PipelineSpec(
        "n", BronzeSpec("t"), LayerSpec(schema="s", table="fact_electricity_mix"), MIX.gold
    )
    path = saved(mix_bronze(spark), tmp_path / "in")
    options = {"output_root": str(tmp_path / "out"), "write_tables": False}
    run_silver(spark, spec, bronze_path=path, bronze_format="parquet", **options)
    run_gold(spark, spec, **options)
    gold = read_parquet(spark, f"{tmp_path}/out/gold/electricity_mix_daily_relative", MIX_DAILY)
    assert [r.wind_pct for r in gold.collect()] == [60.0]


def test_etl_to_parquet(spark, tmp_path, paths):
    root = str(tmp_path / "out")
    run = dict(specs=[FLOWS, MIX], bronze_paths=paths, bronze_format="parquet", output_root=root)
    for _ in range(2):
        run_etl(spark, write_tables=False, **run)
    silver = read_silver(spark, MIX, root=root)
    assert {k: v.count() for k, v in silver.items()} == {"fact": 1, "dim_zone": 10, "dim_date": 1}
    assert dict(silver["fact"].dtypes)["month"] == "string"
    assert read_silver(spark, FLOWS, root=root, include={"dim_date"}).keys() == {"dim_date"}
    gold = read_parquet(spark, f"{root}/gold/electricity_flows_fr_imports_daily", FOCAL_IMPORTS)
    assert {(r.source_zone, r.net_import_mwh) for r in gold.collect()} == {("DE", 35), ("ES", 10)}
    with pytest.raises(ValueError, match="layer"):
        run_etl(spark, layer="bronze", specs=[MIX])


def test_etl_through_tables(spark, tmp_path):
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"CREATE DATABASE {layer}_t LOCATION '{tmp_path}/{layer}_t'")
    mix, flows = testbed.mix_spec("_t"), testbed.flow_spec("_t")

    def land(df, spec):
        url, at = df.source_url, df.extracted_at.cast("timestamp")
        write_bronze(bronze_rows(df, url, at), spec)

    land(mix_bronze(spark), mix)
    land(flow_bronze(spark), flows)
    root = str(tmp_path / "mirror")
    run_etl(spark, specs=[flows, mix], output_root=root, mirror=True)
    assert spark.table("silver_t.dim_date").count() == 1
    assert spark.table("gold_t.electricity_flows_fr_exports_daily").count() == 2
    land(mix_bronze(spark, wind=160.0, day=17), mix)
    run_table(spark, "fact_electricity_mix", specs=[flows, mix], since="2026-04-16")
    run_table(spark, "dim_date", specs=[flows, mix])
    run_table(spark, "electricity_mix_daily_relative", specs=[flows, mix])
    assert spark.table("silver_t.dim_date").count() == 2
    shares = {str(r.dt): r.wind_pct for r in spark.table("gold_t.electricity_mix_daily_relative").collect()}
    assert shares == {"2026-04-16": 60.0, "2026-04-17": 80.0}
    mirrored = read_silver(spark, mix, root=root)
    assert mirrored["fact"].count() == 1 and mirrored["dim_zone"].count() == 10


def test_table_by_table_needs_its_inputs(spark, tmp_path, paths):
    root = str(tmp_path / "out")
    run = dict(
        specs=[FLOWS, MIX],
        bronze_paths=paths,
        bronze_format="parquet",
        output_root=root,
        write_tables=False,
    )
    with pytest.raises(RuntimeError, match="stored facts"):
        run_table(spark, "dim_date", **run)
    with pytest.raises(RuntimeError, match="stored fact"):
        run_table(spark, "france_exports", **run)
    with pytest.raises(RuntimeError, match="stored fact"):
        run_gold(spark, MIX, output_root=root, write_tables=False)
    for table in ("dim_zone", "fact_electricity_flows", "dim_date", "france_exports"):
        run_table(spark, table, **run)
    path = f"{root}/gold/electricity_flows_fr_exports_daily"
    assert {r.dest_zone for r in read_parquet(spark, path).collect()} == {"DE", "IT"}


@pytest.mark.parametrize("newest_wins, wind", [(False, 1.0), (True, 60.0)])
def test_replay_of_older_snapshots(spark, tmp_path, newest_wins, wind):
    root = str(tmp_path / "out")
    options = {"bronze_format": "parquet", "output_root": root, "write_tables": False}
    new = saved(mix_bronze(spark), tmp_path / "new")
    old = saved(mix_bronze(spark, wind=1.0, updated="12:01"), tmp_path / "old")
    run_silver(spark, MIX, bronze_path=new, **options)
    run_silver(spark, MIX, bronze_path=old, newest_wins=newest_wins, **options)
    assert [r.mix_wind for r in read_silver(spark, MIX, root=root)["fact"].collect()] == [wind]


def test_gold_since_keeps_older_days(spark, tmp_path):
    root = {"output_root": str(tmp_path / "out"), "write_tables": False}
    first = saved(mix_bronze(spark, day=15).union(mix_bronze(spark, day=16)), tmp_path / "1")
    run_silver(spark, MIX, bronze_path=first, bronze_format="parquet", **root)
    run_gold(spark, MIX, **root)
    second = saved(mix_bronze(spark, wind=0.0, day=16, updated="12:30"), tmp_path / "2")
    run_silver(spark, MIX, bronze_path=second, bronze_format="parquet", **root)
    run_gold(spark, MIX, since="2026-04-16", **root)
    gold = read_parquet(spark, f"{tmp_path}/out/gold/electricity_mix_daily_relative", MIX_DAILY)
    assert {str(r.dt): r.wind_pct for r in gold.collect()} == {"2026-04-15": 60, "2026-04-16": 0}
    unpartitioned = dataclasses.replace(
        MIX, gold=LayerSpec(schema="gold", table="electricity_mix_daily_relative")
    )
    with pytest.raises(ValueError, match="since"):
        run_gold(spark, unpartitioned, since="2026-04-16", **root)


def test_gold_since_in_tables(spark, tmp_path):
    for layer in ("silver", "gold"):
        spark.sql(f"CREATE DATABASE {layer}_s LOCATION '{tmp_path}/{layer}_s'")
    mix = testbed.mix_spec("_s")

    source = {"bronze_format": "parquet"}
    first = saved(mix_bronze(spark, day=15).union(mix_bronze(spark, day=16)), tmp_path / "1")
    run_silver(spark, mix, bronze_path=first, write_shared_dims=True, **source)
    run_gold(spark, mix, since="2026-04-01")
    spark.sql("INSERT OVERWRITE silver_s.dim_zone VALUES ('DE', 'Changed', 'x', 'y')")
    second = saved(mix_bronze(spark, wind=0.0, day=16, updated="12:30"), tmp_path / "2")
    run_silver(spark, mix, bronze_path=second, **source)
    run_gold(spark, mix, since="2026-04-16")
    table = spark.table("gold_s.electricity_mix_daily_relative")
    got = {str(r.dt): (r.wind_pct, r.zone_name) for r in table.collect()}
    assert got == {"2026-04-15": (60.0, "Germany"), "2026-04-16": (0.0, "Changed")}


def test_stream_from_landing_to_silver(spark, tmp_path):
    landing, bronze, silver = (str(tmp_path / n) for n in ("landing", "bronze", "silver"))
    checks = [str(tmp_path / f"check{n}") for n in range(2)]

    def drop(day, hour, *payloads):
        rows = spark.createDataFrame([(json.dumps(p),) for p in payloads], "payload string")
        write_landing(rows, landing, "mix_latest", datetime(2026, 4, day, hour))

    def version(wind, minute):
        return mix_payload(updatedAt=f"2026-04-16T12:{minute:02d}:00Z", mix={"wind": wind})

    def run():
        stream_bronze(spark, MIX, landing, bronze, checks[0]).awaitTermination()
        stream_silver(spark, MIX, bronze, silver, checks[1]).awaitTermination()
        return [(r.mix_wind, r.extracted_at.hour) for r in read_parquet(spark, silver).collect()]

    drop(16, 13, version(5.0, 30), version(1.0, 5))
    assert [w for w, _ in run()] == [5.0]
    drop(16, 14, version(3.0, 20))
    assert [w for w, _ in run()] == [5.0]
    drop(16, 15, version(9.0, 40))
    assert [w for w, _ in run()] == [9.0]
    assert [w for w, _ in run()] == [9.0]
    rows = spark.read.schema(BRONZE).parquet(bronze)
    assert rows.count() == 4
    assert {r.source_url for r in rows.collect()} == {
        "https://grid.example.org/api/mix/latest?zone=DE"
    }
    batch = transform_silver(rows, MIX)["fact"].collect()
    assert [r.mix_wind for r in batch] == [9.0]


def test_stream_daily_mix_emits_closed_days(spark, tmp_path):
    source, gold, check = (str(tmp_path / n) for n in ("source", "gold", "check"))

    def land(*rows):
        df = bronze_of(spark, *rows).selectExpr(
            "timestamp(extracted_at) extracted_at", "source_url", "payload",
            "'2026' year", "'04' month", "'16' day",
        )
        df.write.mode("append").parquet(source)
        stream_daily_mix(spark, source, gold, check, delay="1 day").awaitTermination()

    def item(day, hour, wind, zone="DE"):
        when = f"2026-04-{day:02d}T{hour:02d}:00:00Z"
        return (AT, mix_payload(zone, datetime=when, mix={"wind": wind, "coal": 10.0}))

    land(item(16, 1, 10.0), item(16, 1, 10.0), item(16, 2, 20.0), item(17, 1, 1.0))
    land(item(18, 12, 1.0))
    got = {(str(r.dt), r.wind_mwh, r.zone_name) for r in read_parquet(spark, gold, MIX_DAILY).collect()}
    assert got == {("2026-04-16", 30.0, "Germany")}
    land(item(30, 12, 1.0))
    days = {str(r.dt) for r in read_parquet(spark, gold, MIX_DAILY).collect()}
    assert days == {"2026-04-16", "2026-04-17", "2026-04-18"}


def test_session_helpers(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    assert use_utc(spark).conf.get("spark.sql.session.timeZone") == "UTC"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session_conf(spark, spark__sql__shuffle__partitions="3"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_command_line(spark, tmp_path):
    from gridspark.__main__ import main

    raw = tmp_path / "mix.jsonl"
    raw.write_text(json.dumps(mix_payload(mix={"wind": 60, "coal": 40})) + "\n")
    spec = {
        "name": "feed",
        "bronze": {"table": "mix_latest"},
        "layers": {
            "silver": {
                "schema": "silver",
                "table": "fact_electricity_mix",
                "write_disposition": "merge",
            },
            "gold": {
                "schema": "gold",
                "table": "electricity_mix_daily_relative",
                "partition_by": ["dt"],
            },
        },
    }
    (tmp_path / "feed.json").write_text(json.dumps(spec))
    common = ["--specs", str(tmp_path / "feed.json"), "--output-root", str(tmp_path / "out")]
    common += ["--no-tables", "--bronze", f"feed={raw}"]
    main(common)
    main([*common, "--table", "electricity_mix_daily_relative"])
    gold = read_parquet(spark, f"{tmp_path}/out/gold/electricity_mix_daily_relative", MIX_DAILY)
    assert [r.wind_pct for r in gold.collect()] == [60.0]


def test_run_lost_before_gold_is_made_up_for(spark, tmp_path, monkeypatch):
    from gridspark.plans import pipeline

    bronze, root, log = str(tmp_path / "bronze"), str(tmp_path / "out"), str(tmp_path / "progress")
    options = {
        "specs": [MIX], "bronze_paths": {MIX.name: bronze}, "bronze_format": "parquet", "newest_wins": True,
        "output_root": root, "write_tables": False, "progress": log,
    }
    gold = MIX.gold.location(MIX.gold.outputs()[0], root)

    def shares():
        return {(str(r.dt), r.wind_mwh) for r in read_parquet(spark, gold, MIX_DAILY).collect()}

    saved(mix_bronze(spark), bronze)
    assert [d.day for d in run_etl(spark, **options)[MIX.name]] == [16]
    later = {"at": "2026-04-18T13:00:00Z", "updated": "13:05"}
    mix_bronze(spark, wind=80.0, **later).unionByName(mix_bronze(spark, wind=5.0, day=17, **later)).write.mode("append").parquet(bronze)
    monkeypatch.setattr(pipeline.Run, "gold", lambda *_, **__: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_etl(spark, **options)
    monkeypatch.undo()
    assert shares() == {("2026-04-16", 60.0)}
    # Nothing new: what came at the newest time is read again, the days come from the log.
    run_etl(spark, **options)
    assert shares() == {("2026-04-16", 80.0), ("2026-04-17", 5.0)}
    assert run_etl(spark, layer="gold", **options) == {}
    with pytest.raises(ValueError, match="not from both"):
        run_etl(spark, since="2026-04-16", **options)
