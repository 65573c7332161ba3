"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def get_spark(app_name: str = "gridspark", **conf: str) -> SparkSession:
    """The active session, or a new one; master and sizes come from spark-submit.

    Either way the session zone becomes UTC, since every date column depends on it.
    """
    spark = SparkSession.getActiveSession()
    if spark is None:
        builder = SparkSession.builder.appName(app_name)
        for key, value in conf.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    return use_utc(spark)


def use_utc(spark: SparkSession) -> SparkSession:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def session_conf(spark: SparkSession, **pairs: str) -> Iterator[None]:
    """Set session options (`__` stands for a dot) for the statements inside the block only."""
    names = {key.replace("__", "."): value for key, value in pairs.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def even_tasks(spark: SparkSession) -> Iterator[None]:
    """For work that costs far more than its bytes tell, as JSON does: four tasks a core or more.

    Spark sizes scans and shuffles to about one task a core, so that one task too many doubles the time.
    Large inputs have more tasks anyway; a number that the session has set stays.
    """
    names = ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionNum")
    count = str(4 * spark.sparkContext.defaultParallelism)
    free = [name for name in names if spark.conf.get(name, None) is None]
    with session_conf(spark, **dict.fromkeys(free, count)):
        yield


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside the block go as each write ends.

    Spark keeps them until the driver happens to collect garbage, so that a job of several steps has those
    of all its steps on disk. Nothing here reads a shuffle twice: what is read again is a written copy.
    """
    with session_conf(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        yield


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors see: `spark.checkpoint.dir`.

    In local mode, where that may be unset, a folder of the application in the warehouse, which goes
    when the driver ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_scratch(spark.conf.get("spark.sql.warehouse.dir"), spark.conf.get("spark.app.id"))


@cache
def _local_scratch(warehouse: str, application: str) -> str:
    folder = f"{warehouse.removeprefix('file:').rstrip('/')}/_scratch-{application}"
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{scratch_root(spark)}/gridspark-{label}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """`df` written to the scratch folder and read back, for the statements inside the block.

    Cuts the lineage: work above it does not repeat what is below, also after an executor is lost,
    and the optimiser sees real sizes. The copy goes when the block ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    try:
        with even_tasks(spark), freed_shuffles(spark):
            df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
