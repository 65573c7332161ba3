"""Reading stored products back."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from gridspark.operators.dimensions import DIM_DATE, DIM_ZONE
from gridspark.schemas import (
    DIM_DATE as DIM_DATE_SCHEMA,
    DIM_ZONE as DIM_ZONE_SCHEMA,
    FLOW_FACT,
    FOCAL_EXPORTS,
    FOCAL_IMPORTS,
    MIX_DAILY,
    MIX_FACT,
)
from gridspark.session import use_utc
from gridspark.sinks.evolution import kept_schema, wider
from gridspark.sinks.files import Files
from gridspark.spec import PipelineSpec

STORED = {
    "fact_electricity_mix": MIX_FACT,
    "fact_electricity_flows": FLOW_FACT,
    DIM_ZONE: DIM_ZONE_SCHEMA,
    DIM_DATE: DIM_DATE_SCHEMA,
    "electricity_mix_daily_relative": MIX_DAILY,
    "electricity_flows_fr_imports_daily": FOCAL_IMPORTS,
    "electricity_flows_fr_exports_daily": FOCAL_EXPORTS,
}


def read_parquet(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame | None:
    """A Parquet directory, None if it does not exist; any other read error is raised.

    The columns are those of `schema`, then every other one that some file has, or that the directory
    keeps a list of. Partition values stay text unless `schema` gives them a type (`09` is not 9).
    """
    files = Files(spark, path)
    kept = kept_schema(files)
    try:
        stored = kept if kept is not None else spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    parts = set(files.partition_columns())
    noted = {} if kept is None else {f.name: f.dataType for f in kept if f.name not in parts}
    # A declared column that stored rows are wider than is read as wide as they are.
    declared = [] if schema is None else [
        StructField(f.name, wider(f.dataType, noted.get(f.name, f.dataType), f.name), f.nullable, f.metadata) for f in schema
    ]
    known = {field.name.lower() for field in declared}
    more = [
        StructField(f.name, StringType()) if f.name in parts else f
        for f in stored
        if f.name.lower() not in known
    ]
    return spark.read.schema(StructType([*declared, *more])).parquet(path)


def read_silver(
    spark: SparkSession,
    spec: PipelineSpec,
    *,
    root: str | None = None,
    include: Collection[str] | None = None,
) -> dict[str, DataFrame]:
    """Stored silver products by name; `include` picks by name or table.

    Below `root` products that were never written are left out; without a root they are tables.
    """
    use_utc(spark)
    layer = spec.layer("silver")
    products = {}
    for output in layer.outputs():
        if include and not {output.key, output.table} & set(include):
            continue
        if root is None:
            products[output.key] = spark.table(layer.qualified(output))
            continue
        frame = read_parquet(spark, layer.location(output, root), STORED.get(output.table))
        if frame is not None:
            products[output.key] = frame
    return products
