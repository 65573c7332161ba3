"""Payloads that no fact can come of, kept in a directory partitioned by the day of ingest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.operators.payload import rejected
from gridspark.session import session_conf, staged
from gridspark.sinks.layout import day_rounds, touched_rows
from gridspark.sinks.parquet import upsert_files
from gridspark.sources.silver import read_parquet

KEYS, PARTS = ["digest", "dt"], ["dt"]

# Text that is grouped, shuffled and laid out at once; and what a row has besides, about.
ROUND_BYTES, ROW_BYTES = 8 << 30, 256


def keep_dead_letters(judged: DataFrame, path: str) -> None:
    """The rejected rows of a copy of `judged_payloads`, each once however often it is read.

    Days are taken some at a time, so that the shuffled text of a round does not grow with the input
    (a single day is not cut). Letters that are stored as they are stay in their files.
    """
    size = F.coalesce(F.octet_length("payload"), F.lit(0)) + ROW_BYTES
    for days in day_rounds(judged.where("reason IS NOT NULL"), "extracted_at", size, ROUND_BYTES):
        with staged(rejected(judged.where(days)), "rejected") as letters:
            new = _not_stored(letters, path)
            if new is not None:
                with session_conf(judged.sparkSession, spark__sql__parquet__compression__codec="zstd"):
                    upsert_files(new, path, KEYS, PARTS, unique=True, ready=new is letters)


def _not_stored(letters: DataFrame, path: str) -> DataFrame | None:
    """Letters whose key has a row that is not stored yet, or not with this number of copies; None if
    there are none.

    The digest stands for the text, which is not read for this.
    """
    stored = read_parquet(letters.sparkSession, path)
    if stored is None or set(stored.columns) != set(letters.columns):
        return letters
    names = [name for name in letters.columns if name != "payload"]
    known = touched_rows(stored, letters, PARTS).withColumn("dt", F.col("dt").cast("date"))
    same = reduce(Column.__and__, [F.col(f"l.{name}").eqNullSafe(F.col(f"k.{name}")) for name in names])
    new = letters.alias("l").join(known.alias("k"), same, "left_anti").select(*KEYS)
    count = new.count()
    if count == 0:
        return None
    if count == letters.count():
        return letters
    match = reduce(Column.__and__, [F.col(f"l.{name}").eqNullSafe(F.col(f"n.{name}")) for name in KEYS])
    return letters.alias("l").join(new.alias("n"), match, "left_semi")
