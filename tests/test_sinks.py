import os
import random
import time
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from gridspark.functions import keys_match
from gridspark.operators.checks import ContractViolation, observed
from gridspark.operators.latest import ranks_before
from gridspark.operators.upsert import upsert
from gridspark.plans.pipeline import write_output
from gridspark.plans.progress import Progress, ProgressLog
from gridspark.sinks import lease as lease_module
from gridspark.sinks import tables
from gridspark.sinks.files import Files
from gridspark.sinks.layout import touched_rows
from gridspark.sinks.lease import Busy, leased
from gridspark.sinks.parquet import append_parquet, overwrite_parquet, upsert_files, upsert_parquet
from gridspark.sinks.swap import recover, replacing
from gridspark.sinks.tables import (
    create_table,
    merge_table,
    mirror_table,
    replace_partitions,
    table_from_parquet,
    write_bronze,
    writing_table,
)
from gridspark.sources.silver import read_parquet
from gridspark.spec import BronzeSpec, ColumnSpec, LayerSpec, PipelineSpec

KEYS = ["zone", "datetime"]
PARTS = ["year", "month", "day"]
COLUMNS = "zone string, datetime string, mix_wind double, year string, month string, day string"

FIRST = [("NL", "2026-04-16T10:00:00", 1.0, "2026", "04", "16")]
SECOND = [
    ("NL", "2026-04-16T10:00:00", 8.5, "2026", "04", "16"),
    ("BE", "2026-04-16T11:00:00", 3.5, "2026", "04", "16"),
]
OTHER_DAY = [("XX", "2026-04-01T10:00:00", 7.0, "2026", "04", "01")]


def frame(spark, rows, schema=COLUMNS):
    return spark.createDataFrame(rows, schema)


def winds(df):
    return {(r.zone, r.mix_wind) for r in df.collect()}


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "target")


@pytest.fixture
def db(spark, tmp_path):
    name = "db_" + tmp_path.name.replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    return name


def test_upsert_replaces_adds_and_replays(spark, path):
    for rows in (FIRST + OTHER_DAY, SECOND, SECOND):
        upsert_parquet(frame(spark, rows), path, KEYS, PARTS)
    stored = read_parquet(spark, path)
    assert winds(stored) == {("NL", 8.5), ("BE", 3.5), ("XX", 7.0)}
    assert dict(stored.dtypes)["month"] == "string"
    assert {r.month for r in stored.collect()} == {"04"}


def test_untouched_partitions_keep_their_files(spark, path):
    upsert_parquet(frame(spark, FIRST + OTHER_DAY), path, KEYS, PARTS)

    def files(day):
        return set(read_parquet(spark, path).where(f"day = '{day}'").inputFiles())

    before = {day: files(day) for day in ("01", "16")}
    upsert_parquet(frame(spark, SECOND), path, KEYS, PARTS)
    after = {day: files(day) for day in ("01", "16")}
    assert {f for f in after["01"] if "day=01" in f} == {f for f in before["01"] if "day=01" in f}
    assert {f for f in after["16"] if "day=16" in f} != {f for f in before["16"] if "day=16" in f}


def test_upsert_adds_columns(spark, path):
    upsert_parquet(frame(spark, FIRST + OTHER_DAY), path, KEYS, PARTS)
    upsert_parquet(frame(spark, SECOND).withColumn("note", F.lit("n")), path, KEYS, PARTS)
    rows = {r.zone: r.note for r in read_parquet(spark, path).collect()}
    assert rows == {"NL": "n", "BE": "n", "XX": None}


def test_null_keys_are_replaced(spark, path):
    schema = "k int, j int, v int"
    upsert_parquet(frame(spark, [(None, 1, 1), (2, 1, 2)], schema), path, ["k", "j"])
    upsert_parquet(frame(spark, [(None, 1, 9)], schema), path, ["k", "j"])
    assert {tuple(r) for r in read_parquet(spark, path).collect()} == {(None, 1, 9), (2, 1, 2)}


def test_key_that_moves_between_partitions(spark, path):
    schema = "k int, v int, part string"
    upsert_parquet(frame(spark, [(1, 1, "a"), (2, 2, "b")], schema), path, ["k"], ["part"])
    upsert_parquet(frame(spark, [(1, 5, "b")], schema), path, ["k"], ["part"])
    assert {tuple(r) for r in read_parquet(spark, path).collect()} == {(1, 5, "b"), (2, 2, "b")}


def test_null_partition_value(spark, path):
    schema = "k string, v int"
    upsert_parquet(frame(spark, [(None, 1), ("a", 1)], schema), path, ["k"], ["k"])
    upsert_parquet(frame(spark, [(None, 2)], schema), path, ["k"], ["k"])
    assert {(r.k, r.v) for r in read_parquet(spark, path).collect()} == {(None, 2), ("a", 1)}


def test_repeated_incoming_key_is_refused(spark, path):
    with pytest.raises(ValueError, match="repeat the key"):
        upsert_parquet(frame(spark, FIRST + FIRST), path, KEYS, PARTS)
    assert read_parquet(spark, path) is None
    upsert_parquet(frame(spark, FIRST), path, KEYS, PARTS)
    with pytest.raises(ValueError, match="repeat the key"):
        upsert_parquet(frame(spark, SECOND + SECOND), path, KEYS, PARTS)
    assert winds(read_parquet(spark, path)) == {("NL", 1.0)}


def test_failed_write_leaves_the_data(spark, path):
    upsert_parquet(frame(spark, FIRST), path, KEYS, PARTS)
    broken = frame(spark, SECOND).withColumn(
        "mix_wind", F.when(F.col("zone") == "BE", F.raise_error(F.lit("boom"))).otherwise(1.0)
    )
    with pytest.raises(Exception, match="boom"):
        upsert_parquet(broken.withColumn("mix_wind", F.col("mix_wind").cast("double")), path, KEYS, PARTS)
    assert winds(read_parquet(spark, path)) == {("NL", 1.0)}


def test_failed_overwrite_leaves_the_data(spark, path, db):
    overwrite_parquet(frame(spark, FIRST), path, PARTS)
    create_table(frame(spark, FIRST), f"{db}.t", PARTS)
    broken = frame(spark, SECOND).withColumn(
        "mix_wind",
        F.when(F.col("zone") == "BE", F.raise_error(F.lit("boom"))).cast("double"),
    )
    with pytest.raises(Exception, match="boom"):
        overwrite_parquet(broken, path, PARTS)
    with pytest.raises(Exception, match="boom"):
        create_table(broken, f"{db}.t", PARTS)
    assert winds(read_parquet(spark, path)) == {("NL", 1.0)}
    assert winds(spark.table(f"{db}.t")) == {("NL", 1.0)}


def test_read_errors_are_raised(spark, tmp_path):
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)footer|parquet"):
        upsert_parquet(frame(spark, FIRST), str(bad), KEYS, PARTS)
    assert (bad / "x.parquet").exists()


def test_broadcast_anti_join_is_safe(spark, path):
    upsert_parquet(frame(spark, FIRST + OTHER_DAY), path, KEYS, PARTS)
    upsert_parquet(F.broadcast(frame(spark, SECOND)), path, KEYS, PARTS)
    assert len(winds(read_parquet(spark, path))) == 3


def test_guard_ignores_older_rows_in_any_order(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, rng.randrange(4), rng.randrange(100)) for k in range(12) for _ in range(5)]

    def batches(order):
        path = str(tmp_path / str(order))
        mine = rows[:]
        random.Random(order).shuffle(mine)
        for start in range(0, len(mine), 20):
            newest = {}
            for k, version, v in mine[start : start + 20]:
                newest[k] = max(newest.get(k, (-1, 0)), (version, -v))
            part = [(k, version, -v) for k, (version, v) in newest.items()]
            upsert_parquet(
                frame(spark, part, "k int, version int, v int"), path, ["k"], guard=["version"]
            )
        return {tuple(r) for r in read_parquet(spark, path).collect()}

    assert batches(1) == batches(2)


def test_upsert_twice_is_upsert_once(spark):
    rng = random.Random(9)

    def side():
        keys = rng.sample([None, *range(9)], 6)
        return frame(spark, [(k, rng.randrange(9)) for k in keys], "k int, v int")

    for _ in range(3):
        a, b = side(), side()
        once = upsert(a, b, ["k"])
        twice = upsert(once, b, ["k"])
        assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_keys_match_needs_keys():
    with pytest.raises(ValueError):
        keys_match([])


def test_overwrite_only_touched(spark, path):
    overwrite_parquet(frame(spark, FIRST + OTHER_DAY), path, PARTS)
    overwrite_parquet(frame(spark, SECOND), path, PARTS, only_touched=True)
    assert len(winds(read_parquet(spark, path))) == 3
    overwrite_parquet(frame(spark, SECOND), path, PARTS)
    assert len(winds(read_parquet(spark, path))) == 2
    with pytest.raises(ValueError):
        overwrite_parquet(frame(spark, SECOND), path, only_touched=True)


def test_table_merge(spark, db):
    table = f"{db}.facts"
    merge_table(frame(spark, FIRST + OTHER_DAY), table, KEYS, PARTS)
    merge_table(frame(spark, SECOND).withColumn("note", F.lit("n")), table, KEYS, PARTS)
    merge_table(frame(spark, SECOND).withColumn("note", F.lit("n")), table, KEYS, PARTS)
    rows = {(r.zone, r.mix_wind, r.note, r.month) for r in spark.table(table).collect()}
    assert rows == {("NL", 8.5, "n", "04"), ("BE", 3.5, "n", "04"), ("XX", 7.0, None, "04")}


def test_table_merge_with_absent_column(spark, db):
    table = f"{db}.facts"
    merge_table(frame(spark, FIRST + OTHER_DAY), table, KEYS)
    merge_table(frame(spark, SECOND).drop("mix_wind"), table, KEYS)
    assert winds(spark.table(table)) == {("NL", None), ("BE", None), ("XX", 7.0)}


def test_table_overwrite_mirror_and_ctas(spark, db, tmp_path):
    create_table(frame(spark, FIRST + OTHER_DAY), f"{db}.a", PARTS)
    create_table(frame(spark, SECOND).drop("day"), f"{db}.a", ["year"])
    assert winds(spark.table(f"{db}.a")) == {("NL", 8.5), ("BE", 3.5)}
    path = str(tmp_path / "mirror")
    mirror_table(spark, f"{db}.a", path, ["year", "month"])
    table_from_parquet(spark, f"{db}.b", path, ["year", "month"])
    assert dict(spark.table(f"{db}.b").dtypes)["month"] == "string"
    with pytest.raises(Exception, match="(?i)exists"):
        table_from_parquet(spark, f"{db}.b", path)
    table_from_parquet(spark, f"{db}.b", path, replace=True)
    assert winds(spark.table(f"{db}.b")) == {("NL", 8.5), ("BE", 3.5)}


def test_bronze_dispositions_and_comments(spark, db):
    def spec(disposition, **more):
        return PipelineSpec(
            "feed",
            BronzeSpec(
                "raw_" + disposition,
                schema=db,
                write_disposition=disposition,
                partition_by=("year",),
                table_comment="It's raw.",
                **more,
            ),
            columns=(
                ColumnSpec("payload", "text", False, "As received."),
                ColumnSpec("at", "timestamp"),
                ColumnSpec("year", "text", False),
            ),
        )

    rows = frame(spark, [("{}", datetime(2026, 1, 1), "2026")], "payload string, at timestamp, year string")
    for _ in range(3):
        write_bronze(rows, spec("append"))
        write_bronze(rows, spec("replace", cluster=("payload",)), buckets=2)
        write_bronze(rows, spec("merge"), keys=["payload"])
    counts = [spark.table(f"{db}.raw_{d}").count() for d in ("append", "replace", "merge")]
    assert counts == [3, 1, 1]
    described = {r[0]: r[2] for r in spark.sql(f"DESCRIBE {db}.raw_append").collect()}
    assert described["payload"] == "As received."
    extended = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {db}.raw_append").collect()}
    assert extended["Comment"] == "It's raw."
    with pytest.raises(ValueError, match="keys"):
        write_bronze(rows, spec("merge"))
    with pytest.raises(ValueError, match="declared columns"):
        write_bronze(rows.drop("at"), spec("append"))


def test_columns_unknown_to_the_schema_survive(spark, path):
    schema = frame(spark, []).schema
    stored = frame(spark, FIRST + OTHER_DAY).withColumn("extra", F.lit("kept"))
    overwrite_parquet(stored, path, PARTS)
    incoming = frame(spark, [("BE", "2026-04-16T11:00:00", 3.5, "2026", "04", "16")])
    upsert_parquet(incoming, path, KEYS, PARTS, schema=schema)
    rows = {r.zone: r.extra for r in read_parquet(spark, path).collect()}
    assert rows == {"NL": "kept", "XX": "kept", "BE": None}


def test_staged_copies_go_after_success(spark, path, tmp_path):
    from gridspark.session import scratch_root

    def copies():
        return [n for n in os.listdir(scratch_root(spark)) if "-incoming-" in n or "-merged-" in n]

    upsert_parquet(frame(spark, FIRST), path, ["zone"])
    before = copies()
    upsert_parquet(frame(spark, SECOND), path, ["zone"])
    assert copies() == before


def boom(spark, rows=SECOND):
    """Rows that fail while they are computed, after some of them are."""
    wind = F.when(F.col("zone") == "BE", F.raise_error(F.lit("boom"))).otherwise(1.0)
    return frame(spark, rows).withColumn("mix_wind", wind.cast("double"))


def test_failed_partition_write_leaves_every_row(spark, path, db):
    table = f"{db}.facts"
    upsert_parquet(frame(spark, FIRST + OTHER_DAY), path, KEYS, PARTS)
    merge_table(frame(spark, FIRST + OTHER_DAY), table, KEYS, PARTS)
    before = {("NL", 1.0), ("XX", 7.0)}
    for write in (
        lambda: overwrite_parquet(boom(spark), path, PARTS, only_touched=True),
        lambda: replace_partitions(boom(spark), table, PARTS),
        lambda: create_table(boom(spark), table, PARTS),
        lambda: overwrite_parquet(boom(spark), path),
    ):
        with pytest.raises(Exception, match="boom"):
            write()
        assert winds(read_parquet(spark, path)) == before
        assert winds(spark.table(table)) == before
    overwrite_parquet(frame(spark, FIRST), path, PARTS)
    assert winds(read_parquet(spark, path)) == set(map(lambda r: (r[0], r[2]), FIRST))
    assert not [n for n in os.listdir(path) if n.startswith(("_writing", "_ready", "_moving", "_replaced"))]


@pytest.mark.parametrize("depth", [0, 3])
@pytest.mark.parametrize("lost_at", [1, 2, 3, 4])
def test_driver_lost_between_renames(spark, path, monkeypatch, depth, lost_at):
    overwrite_parquet(frame(spark, FIRST + OTHER_DAY), path, PARTS)
    moves = []
    move = Files.move

    def counted(self, source, target):
        moves.append(source)
        if len(moves) == lost_at:
            raise KeyboardInterrupt
        move(self, source, target)

    monkeypatch.setattr(Files, "move", counted)
    with pytest.raises(KeyboardInterrupt):
        overwrite_parquet(frame(spark, SECOND), path, PARTS, only_touched=depth > 0)
    monkeypatch.undo()
    recover(spark, path)
    kept = {("XX", 7.0)} if depth else set()
    old, new = {("NL", 1.0), ("XX", 7.0)}, {("NL", 8.5), ("BE", 3.5)} | kept
    # Before the first rename nothing has happened; from then on the new rows are whole.
    assert winds(read_parquet(spark, path)) == (old if lost_at == 1 else new)
    assert [n for n in os.listdir(path) if n.startswith(("_ready", "_moving", "_replaced"))] == []


def test_table_lost_between_renames(spark, db, monkeypatch):
    create_table(frame(spark, FIRST + OTHER_DAY), f"{db}.t", PARTS)
    spark.sql(f"ALTER TABLE {db}.t RENAME TO {db}.t{tables.REPLACED}")
    merge_table(frame(spark, SECOND), f"{db}.t", KEYS, PARTS)
    assert winds(spark.table(f"{db}.t")) == {("NL", 8.5), ("BE", 3.5), ("XX", 7.0)}


def test_partitions_that_become_empty_go(spark, path, db):
    days = [("a", "2026-04-01"), ("b", "2026-04-02"), ("c", "2026-04-03")]
    rows = frame(spark, days, "v string, dt string")
    overwrite_parquet(rows, path, ["dt"])
    create_table(rows, f"{db}.p", ["dt"])
    new = frame(spark, [("d", "2026-04-02")], "v string, dt string")
    gone = lambda unit: unit >= "dt=2026-04-02"
    overwrite_parquet(new, path, ["dt"], only_touched=True, gone=gone)
    replace_partitions(new, f"{db}.p", ["dt"], gone=gone)
    overwrite_parquet(new.limit(0), path, ["dt"], only_touched=True, gone=lambda unit: unit == "dt=2026-04-09")
    for df in (read_parquet(spark, path), spark.table(f"{db}.p")):
        assert {r.v for r in df.collect()} == {"a", "d"}


def test_rows_can_replace_what_they_are_read_from(spark, path, db):
    overwrite_parquet(frame(spark, FIRST + OTHER_DAY), path, PARTS)
    overwrite_parquet(read_parquet(spark, path).where("zone = 'NL'"), path, PARTS)
    assert winds(read_parquet(spark, path)) == {("NL", 1.0)}
    create_table(frame(spark, FIRST + OTHER_DAY), f"{db}.own", PARTS)
    create_table(spark.table(f"{db}.own").where("zone = 'XX'"), f"{db}.own", PARTS)
    assert winds(spark.table(f"{db}.own")) == {("XX", 7.0)}


def test_column_that_some_partitions_have_survives(spark, path):
    schema = frame(spark, []).schema
    upsert_parquet(frame(spark, OTHER_DAY), path, KEYS, PARTS, schema=schema)
    upsert_parquet(frame(spark, FIRST).withColumn("note", F.lit("keep")), path, KEYS, PARTS, schema=schema)
    upsert_parquet(frame(spark, SECOND[1:]), path, KEYS, PARTS, schema=schema)
    stored = read_parquet(spark, path, schema)
    assert {r.zone: r.note for r in stored.collect()} == {"XX": None, "NL": "keep", "BE": None}


def test_touched_partitions_are_pruned_by_plain_comparisons(spark, path):
    upsert_parquet(frame(spark, FIRST + OTHER_DAY), path, KEYS, PARTS)
    rows = touched_rows(read_parquet(spark, path), frame(spark, SECOND), PARTS)
    assert winds(rows) == {("NL", 1.0)}
    filters = rows._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]
    assert "(year#" in filters and "to_json" not in filters and "concat" not in filters
    assert touched_rows(read_parquet(spark, path), frame(spark, []), PARTS).count() == 0


def test_merge_condition_has_the_tie_rule_of_upsert(spark):
    rng = random.Random(4)
    rows = [
        (k, rng.choice([None, 1, 2]), rng.choice([None, 1, 2]), rng.choice([None, "a", "b"]))
        for k in range(40) for _ in range(2)
    ]
    schema = "k int, version int, other int, v string"
    old, new = frame(spark, rows[::2], schema), frame(spark, rows[1::2], schema)
    wins = ranks_before(new, "s", "t", ["k"], ["version"])
    joined = old.alias("t").join(new.alias("s"), "k").select("k", wins.alias("wins"), "s.*", "t.*")
    merged = {r[0]: tuple(r[2:6]) if r[1] else tuple(r[6:10]) for r in joined.collect()}
    for order in ((old, new), (new, old)):
        assert {r.k: tuple(r) for r in upsert(*order, ["k"], ["version"]).collect()} == merged


def test_layers_append_or_say_no(spark, tmp_path, db):
    def spec(disposition):
        return LayerSpec.from_mapping(
            {"schema": db, "table": "log", "partition_by": ["year"], "write_disposition": disposition}
        )

    layer, root = spec("append"), str(tmp_path / "files")
    for tables in (True, False):
        for _ in range(2):
            write_output(frame(spark, FIRST), layer, layer.outputs()[0], root=root, write_tables=tables)
    assert spark.table(f"{db}.log").count() == 2
    assert read_parquet(spark, layer.location(layer.outputs()[0], root)).count() == 2
    with pytest.raises(ValueError, match="disposition"):
        spec("apend")


# ---- evolution, leases, single files ----


def test_replaced_days_keep_new_columns_and_fill_missing_ones(spark, db):
    table = f"{db}.gold"
    create_table(spark.sql("SELECT 1 AS a, 2.5D AS b, 'd1' AS dt UNION ALL SELECT 2, 3.5D, 'd2'"), table, ["dt"])
    replace_partitions(spark.sql("SELECT 7 AS a, 'new' AS note, 'd2' AS dt"), table, ["dt"])
    got = {tuple(r) for r in spark.table(table).select("a", "b", "note", "dt").collect()}
    assert got == {(1, 2.5, None, "d1"), (7, None, "new", "d2")}


def test_replaced_days_of_another_layout_are_refused(spark, db):
    table = f"{db}.gold"
    create_table(spark.sql("SELECT 1 AS a, 'z' AS zz, 'd1' AS dt"), table, ["zz"])
    with pytest.raises(ValueError, match="partitioned by"):
        replace_partitions(spark.sql("SELECT 2 AS a, 'z' AS zz, 'd1' AS dt"), table, ["dt"])
    create_table(spark.sql("SELECT 1 AS a"), f"{db}.flat")
    with pytest.raises(ValueError, match="no partitions"):
        replace_partitions(spark.sql("SELECT 2 AS a"), f"{db}.flat", [])
    assert [tuple(r) for r in spark.table(table).collect()] == [(1, "d1", "z")]


OLD = "SELECT id, CAST(id AS INT) AS n, CAST(id AS FLOAT) AS f, named_struct('x', CAST(id AS SMALLINT)) AS s, CAST(id % 3 AS STRING) AS p FROM range(30)"
WIDE = "SELECT id, id + 5000000000 AS n, id / 3 AS f, named_struct('x', id + 5000000000, 'y', 'new') AS s, CAST(id % 3 AS STRING) AS p FROM range(27, 33)"
TYPES = {"n": "bigint", "f": "double", "s": "struct<x:bigint,y:string>"}


def wide_rows(df):
    return {(r.id, r.n, r.f, r.s.x, r.s.y) for r in df.collect()}


WANT_WIDE = {(i, i, float(i), i, None) for i in range(27)} | {
    (i, i + 5 * 10**9, i / 3, i + 5 * 10**9, "new") for i in range(27, 33)
}


@pytest.mark.parametrize("parts", [["p"], []])
@pytest.mark.parametrize("by_file", [False, True])
def test_types_widen_in_directories(spark, path, parts, by_file):
    keys = ["id", "p"]
    write = upsert_files if by_file else upsert_parquet
    upsert_parquet(spark.sql(OLD), path, keys, parts)
    others = spark.sql(OLD.replace("range(30)", "range(60, 66)")).coalesce(1)
    others.write.mode("append").partitionBy(*parts).parquet(path)
    stored = set(read_parquet(spark, path).inputFiles())
    write(spark.sql(WIDE), path, keys, parts)
    after = read_parquet(spark, path)
    assert wide_rows(after) == WANT_WIDE | {(i, i, float(i), i, None) for i in range(60, 66)}
    assert {k: dict(after.dtypes)[k] for k in TYPES} == TYPES
    if by_file:
        assert stored & set(after.inputFiles())
    # Narrow rows again: types stay, and so do columns they lack.
    write(spark.sql(OLD).where("id = 3").drop("s"), path, keys, parts)
    write(spark.sql("SELECT 40L AS id, 4 AS n, '1' AS p, 'more' AS note"), path, keys, parts)
    now = read_parquet(spark, path)
    assert {k: dict(now.dtypes)[k] for k in TYPES} == TYPES and now.count() == 40
    assert now.where("id = 3 AND s IS NULL AND n = 3").count() == now.where("note = 'more' AND n = 4").count() == 1
    overwrite_parquet(spark.sql(OLD), path, parts)
    assert dict(read_parquet(spark, path).dtypes)["n"] == "int"


@pytest.mark.parametrize("by_file", [False, True])
def test_types_widen_in_tables(spark, db, by_file):
    merge_table(spark.sql(OLD), f"{db}.t", ["id", "p"], ["p"])
    merge_table(spark.sql(WIDE), f"{db}.t", ["id", "p"], by_file=by_file)
    assert wide_rows(spark.table(f"{db}.t")) == WANT_WIDE
    assert {k: dict(spark.table(f"{db}.t").dtypes)[k] for k in TYPES} == TYPES


def test_a_type_that_readers_do_not_widen_rewrites_the_store_once(spark, path):
    upsert_parquet(spark.sql("SELECT id, id AS n, CAST(id % 2 AS STRING) AS p FROM range(6)"), path, ["id", "p"], ["p"])
    upsert_parquet(spark.sql("SELECT 1L AS id, 0.5D AS n, '1' AS p"), path, ["id", "p"], ["p"])
    stored = read_parquet(spark, path)
    assert dict(stored.dtypes)["n"] == "double"
    assert {(r.id, r.n) for r in stored.collect()} == {(0, 0.0), (1, 0.5), (2, 2.0), (3, 3.0), (4, 4.0), (5, 5.0)}
    with pytest.raises(TypeError, match="column 'n'"):
        upsert_parquet(spark.sql("SELECT 1L AS id, 'text' AS n, '1' AS p"), path, ["id", "p"], ["p"])
    assert read_parquet(spark, path).count() == 6


def test_upsert_files_leaves_other_files(spark, path):
    rows = "SELECT id, id * 10 AS v, CAST(id DIV 500 AS STRING) AS p FROM range({}, {})"
    for low in range(0, 1000, 100):
        spark.sql(rows.format(low, low + 100)).coalesce(1).write.mode("append").partitionBy("p").parquet(path)

    def files():
        return {f: os.stat(f).st_mtime_ns for f in (x.removeprefix("file://") for x in read_parquet(spark, path).inputFiles())}

    before = files()
    new = spark.sql("SELECT id, -id AS v, CAST(id DIV 500 AS STRING) AS p FROM VALUES (5L), (450L), (2000L) AS t(id)")
    assert upsert_files(new, path, ["id", "p"], ["p"]) == 2
    after = files()
    assert len(before) == 10 and sum(after.get(f) == t for f, t in before.items()) == 8
    got = {r.id: r.v for r in read_parquet(spark, path).collect()}
    assert got == {**{i: i * 10 for i in range(1000)}, 5: -5, 450: -450, 2000: -2000}
    # Without partitions, null keys, guard; keys that nobody has leave all files.
    flat = path + "-flat"
    schema = "k int, v int, at int"
    upsert_files(frame(spark, [(None, 1, 5), (1, 1, 5), (2, 1, 5)], schema), flat, ["k"])
    upsert_files(frame(spark, [(None, 2, 4), (1, 2, 6), (3, 2, 1)], schema), flat, ["k"], guard=["at"])
    assert {(r.k, r.v) for r in read_parquet(spark, flat).collect()} == {(None, 1), (1, 2), (2, 1), (3, 2)}
    assert upsert_files(frame(spark, [(9, 9, 9)], schema), flat, ["k"]) == 0


def test_cut_short_replacement_of_files_is_finished(spark, path):
    overwrite_parquet(spark.range(5).coalesce(1), path)
    (old,) = Files(spark, path).walk()
    spark.range(10, 13).coalesce(1).write.parquet(f"{path}/_ready-files")
    Files(spark, path).write("_ready-files/_gone.json", f'["{old}"]')
    recover(spark, path)
    assert {r.id for r in read_parquet(spark, path).collect()} == {10, 11, 12}
    assert all(not n.startswith(("_ready", "_moving", "_replaced")) for n in Files(spark, path).names())


def test_second_writer_is_refused(spark, path, db):
    overwrite_parquet(spark.range(3), path)
    with replacing(spark, path) as folder:
        spark.range(7).write.parquet(folder)
        for write in (overwrite_parquet, lambda df, p: upsert_parquet(df, p, ["id"]), lambda df, p: upsert_files(df, p, ["id"])):
            with pytest.raises(Busy):
                write(spark.range(1), path)
    assert read_parquet(spark, path).count() == 7
    assert not [n for n in os.listdir(os.path.dirname(path)) if "lease" in n]
    with writing_table(spark, f"{db}.t"), pytest.raises(Busy):
        create_table(spark.range(2), f"{db}.t")
    create_table(spark.range(2), f"{db}.t")
    with writing_table(spark, f"{db}.t"), pytest.raises(Busy):
        merge_table(spark.range(2), f"{db}.t", ["id"])


def test_stale_lease_is_taken_over(spark, path, monkeypatch):
    overwrite_parquet(spark.range(3), path)
    parent, name = os.path.split(path)
    lease = f"{parent}/_lease-{name}"
    with open(lease, "w") as out:
        out.write("gone")
    with pytest.raises(Busy):
        overwrite_parquet(spark.range(4), path)
    os.utime(lease, (1, 1))
    os.makedirs(f"{path}/_writing-gone")
    overwrite_parquet(spark.range(4), path)
    assert read_parquet(spark, path).count() == 4 and not os.path.exists(f"{path}/_writing-gone")
    # A writer that lost its lease meanwhile puts nothing in place.
    with pytest.raises(Busy, match="lost"), replacing(spark, path) as folder:
        spark.range(9).write.parquet(folder)
        Files(spark, parent).write(f"_lease-{name}", "other")
    assert read_parquet(spark, path).count() == 4
    Files(spark, parent).delete(f"_lease-{name}")
    monkeypatch.setattr(lease_module, "SECONDS", 0.3)
    with leased(spark, path):
        time.sleep(1.0)
        with pytest.raises(Busy):
            with leased(spark, path):
                pass


# ---- contracts inside writes ----

CONTRACT = [ColumnSpec("a", "text", False, ""), ColumnSpec("b", "text", True, "")]
GOOD, BAD = "SELECT 'x' AS a, CAST(NULL AS STRING) AS b, 'p' AS p", "SELECT nullif(id % 2, 0) AS a, 'y' AS b, 'p' AS p FROM range(10)"


@pytest.mark.parametrize("parts", [["p"], []])
def test_broken_contract_fails_before_anything_is_in_place(spark, path, db, parts):
    bad = spark.sql(BAD).withColumn("a", F.col("a").cast("string"))
    overwrite_parquet(spark.sql(GOOD), path, parts, contract=CONTRACT)
    append_parquet(spark.sql(GOOD), path, parts, contract=CONTRACT)
    create_table(spark.sql(GOOD), f"{db}.t", parts, contract=CONTRACT)
    for write in (
        lambda: overwrite_parquet(bad, path, parts, contract=CONTRACT),
        lambda: append_parquet(bad, path, parts, contract=CONTRACT),
        lambda: create_table(bad, f"{db}.t", parts, contract=CONTRACT),
        lambda: create_table(bad, f"{db}.new", parts, contract=CONTRACT),
    ):
        with pytest.raises(ContractViolation) as failed:
            write()
        assert failed.value.counts == {"a": 5}
    assert read_parquet(spark, path).count() == 2 and spark.table(f"{db}.t").count() == 1
    assert not spark.catalog.tableExists(f"{db}.new")
    append_parquet(bad, path, parts)
    assert read_parquet(spark, path).count() == 12


def test_contract_needs_no_scan_of_its_own(spark, path):
    rows, counts = observed(spark.sql(GOOD), CONTRACT)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "CollectMetrics" in plan and plan.count("OneRowRelation") == 1
    rows.write.parquet(path)
    assert counts.get == {"a": 0}
    assert observed(spark.sql(GOOD), [CONTRACT[1]])[1] is None


def test_bronze_append_is_checked(spark, db):
    columns = (ColumnSpec("payload", "text", False, ""), ColumnSpec("day", "text", False, ""))
    spec = PipelineSpec("feed", BronzeSpec("raw", schema=db, write_disposition="append", partition_by=("day",)), columns=columns)
    write_bronze(spark.sql("SELECT 'x' AS payload, '01' AS day"), spec)
    write_bronze(spark.sql("SELECT 'y' AS payload, '02' AS day"), spec)
    with pytest.raises(ContractViolation):
        write_bronze(spark.sql("SELECT CAST(NULL AS STRING) AS payload, '02' AS day UNION ALL SELECT 'z', '03'"), spec)
    assert {tuple(r) for r in spark.table(f"{db}.raw").collect()} == {("x", "01"), ("y", "02")}
    write_bronze(spark.sql("SELECT CAST(NULL AS STRING) AS payload, '02' AS day"), spec, checked=False)
    assert spark.table(f"{db}.raw").count() == 3


def test_progress_of_a_feed(spark, tmp_path):
    log = ProgressLog(spark, str(tmp_path / "progress"))
    day, other = date(2026, 4, 16), date(2026, 4, 17)
    assert log.read("mix") == Progress()
    log.touched("mix", [day])
    log.taken("mix", datetime(2026, 4, 16, 12, 0, 0, 5, tzinfo=timezone.utc))
    log.touched("mix", [day, other])
    log.recomputed("mix", [day])
    log.taken("mix", None)
    now = log.read("mix")
    assert now.until == datetime(2026, 4, 16, 12, 0, 0, 5, tzinfo=timezone.utc) and now.pending == {other}
    assert log.read("flows") == Progress() and log.read("mi") == Progress()
    # A state that was cut short is passed over; one that another run has made meanwhile is not overwritten.
    Files(spark, str(tmp_path / "progress")).write(f"mix.{now.number + 1}.json", '{"until": ')
    assert log.read("mix") == now
    log.touched("mix", [day])
    assert log.read("mix").pending == {day, other} and log.read("mix").number == now.number + 2
    with pytest.raises(RuntimeError, match="another run"):
        log._write("mix", now, now)
