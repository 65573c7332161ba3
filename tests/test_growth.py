"""What keeps the jobs in proportion to their input: narrow shuffles, writes on all cores, no spare copies."""

import time
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridspark import queries, testbed
from gridspark.functions import instant
from gridspark.operators.latest import keep_latest
from gridspark.operators.payload import judged_payloads, payload_items
from gridspark.plans.pipeline import run_silver, transform_silver
from gridspark.plans.progress import ProgressLog
from gridspark.schemas import BRONZE, MIX_PAYLOAD
from gridspark.session import staged
from gridspark.sinks import dead_letters
from gridspark.sinks.parquet import overwrite_parquet
from gridspark.sinks.tables import create_table
from gridspark.sources import landing
from gridspark.sources.landing import landing_files, read_landing, write_landing
from gridspark.streaming import jobs
from gridspark.streaming.jobs import stream_bronze, stream_daily_mix, stream_silver


def _tables(spark, root) -> str:
    """Two orders, one without lines, and three events of one zone."""
    day = datetime(1998, 5, 1)
    at = datetime(2024, 1, 1, 3, 4, 5, 678000)
    frames = {
        "supplier": ([(1, 3), (2, 4)], "s_suppkey long, s_nationkey int"),
        "customer": ([(7, 4)], "c_custkey long, c_nationkey int"),
        "orders": ([(10, 7, day), (11, 7, day)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "lineitem": (
            [(10, 1, 1, 5.0), (10, 1, 3, 6.0), (10, 1, 2, 13.0), (10, 2, 5, 9.0)],
            "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double",
        ),
        "events": (
            [(i, at + timedelta(seconds=10 - i), 5, kind, 2.5) for i, kind in enumerate(["view", "click", "error"])],
            "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
        ),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_snapshots_are_collected_once(spark, tmp_path):
    tables = _tables(spark, tmp_path)
    for bronze in (testbed.mix_bronze, testbed.flow_bronze):
        assert _plan(bronze(spark, tables)).count("collect_list(") == 1


def test_snapshots_of_both_feeds(spark, tmp_path):
    tables = _tables(spark, tmp_path)
    flows = [r.payload for r in testbed.flow_bronze(spark, tables).where("payload LIKE '{%'").collect()]
    # Eleven on odd lines; thirteen on the even one is an unknown power; line 5 is the zone's own.
    current = [p for p in flows if ":11.0}" in p and '"soon"' not in p]
    zone = testbed.ZONE_CODES[3]
    assert len(current) == 2 and f'"import":{{"{zone}":11.0}}' in current[0] and f'"export":{{"{zone}":null}}' in current[0]
    assert len(flows) == 8 and sum('"import"' not in p and '"export"' not in p for p in flows) == 4
    mix = [r.payload for r in testbed.mix_bronze(spark, tables).where("payload LIKE '{%'").collect()]
    times = [p.count('"updatedAt":"2024-01-01T03:04') for p in mix]
    assert sorted(times) == [0, 3, 3, 6]
    ordered = next(p for p in mix if p.count('"updatedAt":"2024-01-01T03:04') == 3)
    assert ordered.index('"error"') < ordered.index('"click"') < ordered.index('"view"')


def _writers(folder) -> set[str]:
    return {path.name.split("-")[1] for path in Path(folder).rglob("part-*.parquet")}


def test_many_small_partitions_are_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(400).select((F.col("id") % 40).alias("dt"), F.concat(*[F.sha2(F.concat("id", F.lit(i)), 256) for i in range(8)]).alias("v"))
    overwrite_parquet(rows, f"{tmp_path}/days", ["dt"])
    assert len(_writers(tmp_path / "days")) > 1
    spark.sql(f"CREATE DATABASE growth LOCATION '{tmp_path}/db'")
    create_table(rows, "growth.days", ["dt"])
    assert len(_writers(tmp_path / "db")) > 1
    assert spark.read.parquet(f"{tmp_path}/days").count() == spark.table("growth.days").count() == 400
    spark.sql("DROP DATABASE growth CASCADE")


def test_text_without_the_signs_of_a_time_is_not_parsed(spark):
    texts = ["soon", None, "", "2024-01-02T03:04Z", "2024-01-02T03:04+02", "2024-01-02T03:04:05Z", "T-:-"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(instant("t").cast("string").alias("at"))
    stored = spark.range(3).select(instant(F.col("id").cast("string")).alias("at"))
    assert "LIKE" in _plan(stored)
    assert [r.at for r in df.collect()] == [
        None, None, None, "2024-01-02 03:04:00", "2024-01-02 01:04:00", "2024-01-02 03:04:05", None
    ]


def test_resumed_run_keeps_no_halves(spark, tmp_path, monkeypatch):
    tables, cut = _tables(spark, tmp_path), []
    monkeypatch.setattr(queries, "_cut", lambda *of: cut.append(of))
    ran = []
    monkeypatch.setattr(queries, "run_etl", lambda *_, bronze_paths, **__: ran.append(
        {name: spark.read.parquet(path).count() for name, path in bronze_paths.items()}
    ))
    queries._etl_resumed.__wrapped__(spark, tables)
    assert not cut
    # Twelve flow snapshots of May 1998 and six mix snapshots of January 2024, all of the first step.
    assert [sorted(counts.values()) for counts in ran] == [[6, 12]] * 3


def test_payloads_are_opened_without_counting_their_characters(spark):
    texts = [' \t\n{"zone":"A","data":[{"datetime":"2024-01-02T03:04:05Z"}]}', '{"zone":"B","data":[{}, null]}', "  ", "", None, "<html>"]
    bronze = spark.createDataFrame([("2024-01-02T00:00:00Z", "u", t) for t in texts], "extracted_at string, source_url string, payload string")
    rows = payload_items(bronze, MIX_PAYLOAD)
    plan = _plan(rows)
    assert "length(" not in plan and "StartsWith(payload" in plan
    assert sorted(r.zone for r in rows.collect()) == ["A", "B"]


def test_snapshot_texts_are_made_once(spark, tmp_path):
    tables = _tables(spark, tmp_path)
    for bronze in (testbed.mix_bronze, testbed.flow_bronze):
        plan = _plan(bronze(spark, tables))
        assert plan.count("StructsToJsonEvaluator") + plan.count("to_json(") == 3
        generate = next(line for line in plan.splitlines() if "Generate explode" in line)
        assert "ToJson" not in generate and "to_json(" not in generate


def test_copies_are_made_by_several_tasks_a_core(spark, tmp_path):
    spark.range(64).repartition(64).write.parquet(f"{tmp_path}/many")
    with staged(spark.read.parquet(f"{tmp_path}/many"), "even") as copy:
        assert len(copy.inputFiles()) > 2 * spark.sparkContext.defaultParallelism
        assert copy.count() == 64
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_newest_rows_are_sorted_by_narrow_keys_first(spark):
    at = datetime(2024, 1, 1)
    rows = [("A", at, i, at + timedelta(hours=i)) for i in range(3)] + [("B", at, 7, None), (None, at, 8, at)]
    df = spark.createDataFrame(rows, "zone string, datetime timestamp, n int, updated_at timestamp")
    latest = keep_latest(df, ["zone", "datetime"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "Sort [datetime" in plan and "Sort [zone" not in plan
    assert sorted((r.zone, r.n) for r in latest.collect()) == [("A", 2), ("B", 7)]


def test_open_intervals_are_kept_on_disk(spark, tmp_path):
    item = '{"datetime":"2024-01-0%dT02:00:00Z","updatedAt":"2024-01-0%dT03:00:00Z","mix":{"wind":%d.0}}'
    payloads = ['{"zone":"FR","data":[%s]}' % (item % (1, 1 + i, i)) for i in range(3)] + ['{"zone":"FR","data":[%s]}' % (item % (9, 9, 1))]
    rows = [(datetime(2024, 1, 9), "u", p, "2024", "01", "09") for p in payloads]
    for corrected in (True, False):
        source, gold, check = (f"{tmp_path}/{corrected}-{name}" for name in ("source", "gold", "check"))
        spark.createDataFrame(rows[: 4 if corrected else 1] + rows[3:], BRONZE).write.parquet(source)
        stream_daily_mix(spark, source, gold, check, state_partitions=2, corrected=corrected).awaitTermination()
        assert "RocksDBStateStoreProvider" in Path(check, "offsets", "0").read_text()
        found = spark.read.parquet(gold).select("dt", "wind_mwh").collect()
        assert [(str(r.dt), r.wind_mwh) for r in found] == [("2024-01-01", 2.0 if corrected else 0.0)]
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_a_query_of_one_feed_builds_only_that_feed(spark, tmp_path, monkeypatch):
    tables, built = _tables(spark, tmp_path), []
    for name in ("mix_bronze_path", "flow_bronze_path"):
        made = getattr(testbed, name)
        monkeypatch.setattr(testbed, name, lambda *of, name=name, made=made: built.append(name) or made(*of))
    hours = queries.QUERIES["hours_by_granularity"](spark, tables).collect()
    assert built == ["mix_bronze_path"] and sum(r.intervals for r in hours) == 1
    dates = queries.QUERIES["silver_products"](spark, tables).collect()
    assert built == ["mix_bronze_path", "flow_bronze_path"]
    # Two orders of one day, of which one has lines, and a day of events.
    assert sorted((str(r.dt), r.facts) for r in dates) == [("1998-05-01", None), ("2024-01-01", 1)]


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def _size(spark, name: str) -> int:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return manager.getFile(name).length()


def _left(spark, before: set[str]) -> set[str]:
    """Shuffle files that are new; they are deleted in the background."""
    until = time.time() + 10
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return left


def test_shuffles_of_a_write_go_with_it(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") % 5).alias("dt"), "id").repartition(3, "id")
    spark.sql(f"CREATE DATABASE freed LOCATION '{tmp_path}/db'")
    before = _shuffle_files(spark)
    with staged(rows, "freed") as copy:
        assert copy.count() == 1000
        overwrite_parquet(rows, f"{tmp_path}/days", ["dt"])
        create_table(rows, "freed.days", ["dt"])
    # The counts are no writes; each leaves one row a task.
    assert not {name for name in _left(spark, before) if _size(spark, name) > 1000}
    spark.sql("DROP DATABASE freed CASCADE")


def _damaged(spark, path, days, copies=1) -> str:
    text = {"blank": "", "no object": "<html>", "no zone": '{"data":[{"datetime":"2024-01-01T00:00:00Z"}]}'}
    good = '{"zone":"A","data":[{"datetime":"2024-01-01T00:00:00Z"}]}'
    rows = [(at, "u", t) for at in days for t in [*text.values(), good] for _ in range(copies)]
    spark.createDataFrame(rows, "extracted_at timestamp, source_url string, payload string").write.parquet(path)
    return path


def _bury(spark, tmp_path, source) -> dict[str, set[str]]:
    root = f"{tmp_path}/out"
    run_silver(
        spark, testbed.mix_spec(), bronze_path=source, bronze_format="parquet", output_root=root, write_tables=False,
        dead_letters=f"{root}/dead",
    )
    files: dict[str, set[str]] = {}
    for path in Path(root, "dead").rglob("part-*.parquet"):
        files.setdefault(path.parent.name, set()).add(path.name)
    return files


def _letters(spark, tmp_path) -> list[tuple]:
    rows = spark.read.parquet(f"{tmp_path}/out/dead/grid_mix").select("extracted_at", "reason", "payload", "copies").collect()
    return sorted(((r.extracted_at, r.reason, r.payload, r.copies) for r in rows), key=str)


def test_dead_letters_are_taken_some_days_at_a_time_and_written_once(spark, tmp_path, monkeypatch):
    days = [datetime(2024, 1, 1, 5), datetime(2024, 1, 2, 5), None, datetime(2024, 1, 4, 5)]
    taken = []
    upsert = dead_letters.upsert_files
    monkeypatch.setattr(dead_letters, "upsert_files", lambda df, *a, **b: taken.append(df.count()) or upsert(df, *a, **b))
    monkeypatch.setattr(dead_letters, "ROUND_BYTES", 2000)
    first = _bury(spark, tmp_path, _damaged(spark, f"{tmp_path}/first", days))
    assert taken == [6, 3, 3]
    assert len(first) == 4 and all(".zstd." in name for names in first.values() for name in names)
    letters = _letters(spark, tmp_path)
    assert [row[1:] for row in letters[:3]] == [
        ("blank", "", 1), ("no object", "<html>", 1), ("no zone", '{"data":[{"datetime":"2024-01-01T00:00:00Z"}]}', 1)
    ]
    assert len(letters) == 12
    # All of them again: nothing is written. Then a new day, and one on which each comes twice.
    assert _bury(spark, tmp_path, f"{tmp_path}/first") == first and len(taken) == 3
    more = _bury(spark, tmp_path, _damaged(spark, f"{tmp_path}/more", [datetime(2024, 1, 5)]))
    twice = _bury(spark, tmp_path, _damaged(spark, f"{tmp_path}/twice", [datetime(2024, 1, 2, 5)], 2))
    assert {d: more[d] for d in first} == first and len(more) == 5
    assert {d for d in more if twice[d] != more[d]} == {"dt=2024-01-02"}
    found = _letters(spark, tmp_path)
    assert len(found) == 15 and [r[3] for r in found if str(r[0]) == "2024-01-02 05:00:00"] == [2, 2, 2]


def test_part_of_a_round_is_new(spark, tmp_path):
    day, later = datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 6)
    _bury(spark, tmp_path, _damaged(spark, f"{tmp_path}/first", [day]))
    _bury(spark, tmp_path, _damaged(spark, f"{tmp_path}/both", [day, later]))
    assert [(r[0], r[3]) for r in _letters(spark, tmp_path)] == [(day, 1)] * 3 + [(later, 1)] * 3


def test_no_dead_letters_leave_a_directory_that_can_be_read(spark, tmp_path):
    good = spark.createDataFrame([("2024-01-01", "u", '{"zone":"A","data":[]}')], "extracted_at string, source_url string, payload string")
    with staged(judged_payloads(good, MIX_PAYLOAD), "judged") as rows:
        dead_letters.keep_dead_letters(rows, f"{tmp_path}/dead")
    assert dead_letters.read_parquet(spark, f"{tmp_path}/dead").count() == 0


def test_landed_text_and_streamed_bronze_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "FILE_LINES", 2)
    texts = ['{"zone":"A","data":[]}', "<html>", "", '{"zone":"\u00e9","data":null}', "  "]
    rows = spark.createDataFrame([(t,) for t in texts], "payload string").coalesce(1)
    root, bronze = f"{tmp_path}/landing", f"{tmp_path}/bronze"
    drop = write_landing(rows, root, "mix", datetime(2026, 4, 16, 12))
    files = [path.name for path in Path(drop).glob("part-*")]
    assert len(files) == 3 and all(name.endswith(".txt.gz") for name in files)
    assert {str(r.stamp) for r in landing_files(spark, root).collect()} == {"2026-04-16 12:00:00"}
    landed = [(r.payload, str(r.stamp)) for r in read_landing(spark, root).collect()]
    assert sorted(landed) == sorted((t, "2026-04-16 12:00:00") for t in texts)
    for _ in range(2):
        stream_bronze(spark, testbed.mix_spec(), root, bronze, f"{tmp_path}/check").awaitTermination()
    assert all(".zstd." in path.name for path in Path(bronze).rglob("part-*.parquet"))
    streamed = spark.read.schema(BRONZE).parquet(bronze).collect()
    assert sorted((r.payload, str(r.extracted_at), r.day) for r in streamed) == sorted(
        (t, "2026-04-16 12:00:00", "16") for t in texts if t.strip()
    )


def _flow_snapshots(spark, path, days, updated: str) -> None:
    item = '{"datetime":"%s","updatedAt":"%s","import":{"DE":%d.0,"BE":null},"export":{"DE":1.0}}'
    payloads = ["<html>", ""] + [
        '{"zone":"%s","data":[%s]}' % (zone, item % (at, updated, n)) for n, at in enumerate([*days, "soon"]) for zone in ("FR", "ES")
    ]
    rows = [(datetime(2024, 3, 1), "u", p, "2024", "03", "01") for p in [*payloads, *payloads]]
    spark.createDataFrame(rows, BRONZE).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("stored", ["path", "table", "unpartitioned"])
def test_a_large_batch_is_worked_off_some_days_at_a_time(spark, tmp_path, monkeypatch, stored):
    parts = () if stored == "unpartitioned" else ("year", "month")
    spec = testbed.flow_spec(f"_rounds_{stored}", parts)
    bronze, check, progress = (f"{tmp_path}/{name}" for name in ("bronze", "check", "progress"))
    silver = None if stored == "table" else f"{tmp_path}/silver"
    if silver is None:
        spark.sql(f"CREATE DATABASE silver_rounds_table LOCATION '{tmp_path}/db'")
    taken = []
    newest = jobs.newest_facts
    monkeypatch.setattr(jobs, "newest_facts", lambda rows, keys: taken.append(rows.count()) or newest(rows, keys))
    monkeypatch.setattr(jobs, "ROUND_BYTES", 600)

    def run() -> None:
        stream_silver(spark, spec, bronze, silver, check, progress=progress).awaitTermination()

    days = [f"2024-01-{day:02d}T05:00:00Z" for day in (1, 2, 31)] + ["2024-02-01T00:00Z", "1998-02-03T23:59:59Z"]
    _flow_snapshots(spark, bronze, days, "2024-02-02T00:00:00Z")
    run()
    # Corrections of two days, of which the one is too old.
    _flow_snapshots(spark, bronze, days[1:2], "2024-02-03T00:00:00Z")
    _flow_snapshots(spark, bronze, days[2:3], "2024-02-01T00:00:00Z")
    run()
    rounds = len(taken)
    assert rounds == 0 if stored == "unpartitioned" else rounds > 3 and sum(taken) == 12 * (5 + 2)
    fact = spark.table(spec.silver.qualified(spec.silver.outputs()[0])) if silver is None else spark.read.parquet(silver)
    want = transform_silver(spark.read.schema(BRONZE).parquet(bronze), spec)["fact"]
    names = [name for name in want.columns if name not in ("year", "month", "day")]
    rows = sorted(map(str, fact.select(names).collect()))
    assert rows == sorted(map(str, want.select(names).collect())) and len(rows) == 30
    assert len(ProgressLog(spark, progress).read(spec.name).pending) == 5
    if silver is None:
        spark.sql("DROP DATABASE silver_rounds_table CASCADE")
