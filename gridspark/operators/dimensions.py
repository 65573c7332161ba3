"""Zone and date dimensions, and the joins that widen a fact."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions import date_parts
from gridspark.schemas import ZONES

FACT = "fact"
DIM_ZONE = "dim_zone"
DIM_DATE = "dim_date"

ZONE_ATTRIBUTES = ("zone_name", "country", "region")
NEIGHBOR_ATTRIBUTES = ("neighbor_zone_name", "neighbor_country", "neighbor_region")


def dim_zone(spark: SparkSession) -> DataFrame:
    """The ten known zones as a literal relation.

    Its size is known to the optimiser, which therefore broadcasts it by itself; a larger zone table
    passed to the joins below is broadcast only while it is under the session's threshold.
    """
    rows = ", ".join(str(zone) for zone in ZONES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS z(zone, zone_name, country, region)")


def dim_date(*facts: DataFrame) -> DataFrame:
    """One row per date over all facts: union of `dt`, then one distinct."""
    if not facts:
        raise ValueError("dim_date needs at least one fact")
    dates = reduce(DataFrame.unionByName, [fact.select("dt") for fact in facts])
    parts = date_parts("dt")
    return (
        dates.where(F.col("dt").isNotNull())
        .distinct()
        .select("dt", *[parts[name].alias(name) for name in ("year", "month", "day")])
    )


def join_zone(fact: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Left join of the zone attributes; a fact that already has them passes through."""
    if "zone_name" in fact.columns:
        return fact
    zones = dim_zone(fact.sparkSession) if zones is None else zones
    return fact.join(zones, "zone", "left")


def join_neighbor(fact: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """The same dimension in the neighbour role, for facts with a `neighbor_zone`."""
    if "neighbor_zone" not in fact.columns or "neighbor_zone_name" in fact.columns:
        return fact
    zones = dim_zone(fact.sparkSession) if zones is None else zones
    renamed = zones.withColumnsRenamed(
        {
            "zone": "neighbor_zone",
            "zone_name": "neighbor_zone_name",
            "country": "neighbor_country",
            "region": "neighbor_region",
        }
    )
    return fact.join(renamed, "neighbor_zone", "left")


def split_silver(
    silver: DataFrame | Mapping[str, DataFrame],
) -> tuple[DataFrame, DataFrame | None]:
    """Fact and zone dimension of a silver product set, or of a bare fact."""
    if isinstance(silver, DataFrame):
        return silver, None
    if silver.get(FACT) is None:
        raise ValueError(f"silver products lack '{FACT}'")
    return silver[FACT], silver.get(DIM_ZONE)


def widen(silver: DataFrame | Mapping[str, DataFrame]) -> DataFrame:
    """Fact with zone and, where it has one, neighbour attributes."""
    fact, zones = split_silver(silver)
    return join_neighbor(join_zone(fact, zones), zones)
