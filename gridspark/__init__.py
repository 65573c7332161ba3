"""Power-grid time series on Spark: raw snapshots to a star schema to daily products."""

from gridspark.plans.pipeline import (
    find_output,
    run_etl,
    run_gold,
    run_silver,
    run_table,
    transform_gold,
    transform_silver,
)
from gridspark.session import get_spark
from gridspark.sources.bronze import read_bronze
from gridspark.sources.silver import read_silver
from gridspark.spec import PipelineSpec, load_specs

__all__ = [
    "PipelineSpec",
    "find_output",
    "get_spark",
    "load_specs",
    "read_bronze",
    "read_silver",
    "run_etl",
    "run_gold",
    "run_silver",
    "run_table",
    "transform_gold",
    "transform_silver",
]
