"""Bronze payloads -> typed facts, one row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions import any_null, date_parts, instant
from gridspark.operators.latest import keep_latest
from gridspark.operators.payload import payload_items
from gridspark.schemas import (
    FLOWS_PAYLOAD,
    GENERATION_SOURCES,
    MIX_PAYLOAD,
    NESTED_MEASURES,
)

# Business keys of the two facts.
MIX_KEYS = ("zone", "datetime")
FLOW_KEYS = ("zone", "datetime", "neighbor_zone", "flow_direction")


def add_date_parts(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """`dt`, `year`, `month`, `day` of the data time."""
    return df.withColumns(date_parts(ts))


def mix_rows(bronze: DataFrame) -> DataFrame:
    """Every (zone, interval) ever received, typed and flat, repeats included."""
    paths = {name: (name,) for name in GENERATION_SOURCES}
    paths |= {name: (group, field) for group, field, name in NESTED_MEASURES}
    measures = [
        reduce(Column.getField, path, F.col("mix")).alias(f"mix_{name}") for name, path in paths.items()
    ]
    return (
        payload_items(bronze, MIX_PAYLOAD)
        .select(
            "zone",
            "temporal_granularity",
            "unit",
            instant("datetime").alias("datetime"),
            instant("updatedAt").alias("updated_at"),
            F.col("breakdownType").alias("breakdown_type"),
            F.col("isEstimated").alias("is_estimated"),
            F.col("estimationMethod").alias("estimation_method"),
            *measures,
            "extracted_at",
            "source_url",
        )
        .where(~any_null(["zone", "datetime"]))
    )


def flow_rows(bronze: DataFrame) -> DataFrame:
    """Every (zone, interval, neighbour, direction) ever received, repeats included.

    Both maps are unpivoted in one pass over the parsed payload: `unpivot` tags the direction,
    `explode` opens the map. A NULL or empty map gives no row, a NULL power stays.
    """
    ids = [
        "zone",
        "unit",
        "temporal_granularity",
        "datetime",
        "updated_at",
        "extracted_at",
        "source_url",
    ]
    return (
        payload_items(bronze, FLOWS_PAYLOAD)
        .withColumns(
            {
                "datetime": instant("datetime"),
                "updated_at": instant("updatedAt"),
            }
        )
        .where(~any_null(["zone", "datetime"]))
        .unpivot(ids, ["import", "export"], "flow_direction", "flows")
        .select(*ids, "flow_direction", F.explode("flows").alias("neighbor_zone", "power_mw"))
        .select(
            "zone",
            "neighbor_zone",
            "flow_direction",
            "power_mw",
            "unit",
            "temporal_granularity",
            "datetime",
            "updated_at",
            "extracted_at",
            "source_url",
        )
    )


def newest_facts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What is kept of received rows."""
    return add_date_parts(keep_latest(rows, keys))


def mix_fact(bronze: DataFrame, keys: Sequence[str] = MIX_KEYS) -> DataFrame:
    return newest_facts(mix_rows(bronze), keys)


def flow_fact(bronze: DataFrame, keys: Sequence[str] = FLOW_KEYS) -> DataFrame:
    return newest_facts(flow_rows(bronze), keys)
