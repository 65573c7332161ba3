"""Which table is built by which job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from gridspark.operators.daily import focal_exports, focal_imports, mix_daily, net_flow_daily
from gridspark.operators.facts import flow_fact, flow_rows, mix_fact, mix_rows
from gridspark.schemas import FLOWS_PAYLOAD, MIX_PAYLOAD


@dataclass(frozen=True)
class Product:
    """A gold table: `base` aggregates silver, `shape` picks rows and columns of the aggregate.

    Products with the same base share one aggregation.
    """

    base: Callable[..., DataFrame]
    shape: Callable[[DataFrame], DataFrame] | None = None

    def build(self, base: DataFrame) -> DataFrame:
        return self.shape(base) if self.shape else base


FACTS: dict[str, Callable[..., DataFrame]] = {
    "fact_electricity_mix": mix_fact,
    "fact_electricity_flows": flow_fact,
}

#: All rows received for a fact, of which `newest_facts` keeps the newest.
RECEIVED: dict[str, Callable[..., DataFrame]] = {
    "fact_electricity_mix": mix_rows,
    "fact_electricity_flows": flow_rows,
}

#: What a fact's payloads hold.
PAYLOADS: dict[str, StructType] = {
    "fact_electricity_mix": MIX_PAYLOAD,
    "fact_electricity_flows": FLOWS_PAYLOAD,
}

PRODUCTS: dict[str, Product] = {
    "electricity_mix_daily_relative": Product(mix_daily),
    "electricity_flows_fr_imports_daily": Product(net_flow_daily, focal_imports),
    "electricity_flows_fr_exports_daily": Product(net_flow_daily, focal_exports),
}
