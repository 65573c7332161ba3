"""Schemas and fixed tables of the data model."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, DOUBLE, BOOL = StringType(), DoubleType(), BooleanType()
DATE, TIMESTAMP = DateType(), TimestampType()

# Generation sources, interval lengths and zones of the data model.
GENERATION_SOURCES = (
    "nuclear",
    "geothermal",
    "biomass",
    "coal",
    "wind",
    "solar",
    "hydro",
    "gas",
    "oil",
    "unknown",
)

GRANULARITY_HOURS = {
    "hourly": 1.0,
    "5_minutes": 5.0 / 60.0,
    "15_minutes": 0.25,
    "daily": 24.0,
    "monthly": 720.0,
    "quarterly": 2184.0,
    "yearly": 8760.0,
}

ZONES = (
    ("AT", "Austria", "Austria", "Europe"),
    ("BE", "Belgium", "Belgium", "Europe"),
    ("DE", "Germany", "Germany", "Europe"),
    ("ES", "Spain", "Spain", "Europe"),
    ("FR", "France", "France", "Europe"),
    ("GB", "Great Britain", "United Kingdom", "Europe"),
    ("IT", "Italy", "Italy", "Europe"),
    ("NL", "Netherlands", "Netherlands", "Europe"),
    ("PL", "Poland", "Poland", "Europe"),
    ("SE", "Sweden", "Sweden", "Europe"),
)

FOCAL_ZONE = "FR"

# Fixed values: (field group, field, column) of the nested mix measures.
NESTED_MEASURES = (
    ("hydro storage", "charge", "hydro_storage_charge"),
    ("hydro storage", "discharge", "hydro_storage_discharge"),
    ("battery storage", "charge", "battery_storage_charge"),
    ("battery storage", "discharge", "battery_storage_discharge"),
    ("flows", "imports", "flows_imports"),
    ("flows", "exports", "flows_exports"),
)

MIX_MEASURES = tuple(f"mix_{name}" for name in GENERATION_SOURCES) + tuple(
    f"mix_{name}" for _, _, name in NESTED_MEASURES
)


def _struct(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields])


# Fields of bronze, of the two payloads and of the stored products, in order.
ENVELOPE = _struct(
    ("extracted_at", TEXT),
    ("source_url", TEXT),
    ("payload", TEXT),
)

BRONZE = _struct(
    ("extracted_at", TIMESTAMP),
    ("source_url", TEXT),
    ("payload", TEXT),
    ("year", TEXT),
    ("month", TEXT),
    ("day", TEXT),
)

_STORAGE = _struct(
    ("charge", DOUBLE),
    ("discharge", DOUBLE),
)

_EXCHANGE = _struct(
    ("imports", DOUBLE),
    ("exports", DOUBLE),
)

_MIX = _struct(
    ("nuclear", DOUBLE),
    ("geothermal", DOUBLE),
    ("biomass", DOUBLE),
    ("coal", DOUBLE),
    ("wind", DOUBLE),
    ("solar", DOUBLE),
    ("hydro", DOUBLE),
    ("gas", DOUBLE),
    ("oil", DOUBLE),
    ("unknown", DOUBLE),
    ("hydro storage", _STORAGE),
    ("battery storage", _STORAGE),
    ("flows", _EXCHANGE),
)

_MIX_ITEM = _struct(
    ("datetime", TEXT),
    ("updatedAt", TEXT),
    ("breakdownType", TEXT),
    ("isEstimated", BOOL),
    ("estimationMethod", TEXT),
    ("mix", _MIX),
)

_FLOWS_ITEM = _struct(
    ("datetime", TEXT),
    ("updatedAt", TEXT),
    ("import", MapType(TEXT, DOUBLE)),
    ("export", MapType(TEXT, DOUBLE)),
)

MIX_PAYLOAD = _struct(
    ("zone", TEXT),
    ("temporalGranularity", TEXT),
    ("unit", TEXT),
    ("data", ArrayType(_MIX_ITEM)),
)

FLOWS_PAYLOAD = _struct(
    ("zone", TEXT),
    ("temporalGranularity", TEXT),
    ("unit", TEXT),
    ("data", ArrayType(_FLOWS_ITEM)),
)

DIM_DATE = _struct(
    ("dt", DATE),
    ("year", TEXT),
    ("month", TEXT),
    ("day", TEXT),
)

DIM_ZONE = StructType(
    [
        StructField("zone", TEXT, nullable=False),
        StructField("zone_name", TEXT, nullable=False),
        StructField("country", TEXT, nullable=False),
        StructField("region", TEXT, nullable=False),
    ]
)

MIX_FACT = _struct(
    ("zone", TEXT),
    ("temporal_granularity", TEXT),
    ("unit", TEXT),
    ("datetime", TIMESTAMP),
    ("updated_at", TIMESTAMP),
    ("breakdown_type", TEXT),
    ("is_estimated", BOOL),
    ("estimation_method", TEXT),
    ("mix_nuclear", DOUBLE),
    ("mix_geothermal", DOUBLE),
    ("mix_biomass", DOUBLE),
    ("mix_coal", DOUBLE),
    ("mix_wind", DOUBLE),
    ("mix_solar", DOUBLE),
    ("mix_hydro", DOUBLE),
    ("mix_gas", DOUBLE),
    ("mix_oil", DOUBLE),
    ("mix_unknown", DOUBLE),
    ("mix_hydro_storage_charge", DOUBLE),
    ("mix_hydro_storage_discharge", DOUBLE),
    ("mix_battery_storage_charge", DOUBLE),
    ("mix_battery_storage_discharge", DOUBLE),
    ("mix_flows_imports", DOUBLE),
    ("mix_flows_exports", DOUBLE),
    ("extracted_at", TIMESTAMP),
    ("source_url", TEXT),
    ("dt", DATE),
    ("year", TEXT),
    ("month", TEXT),
    ("day", TEXT),
)

FLOW_FACT = _struct(
    ("zone", TEXT),
    ("neighbor_zone", TEXT),
    ("flow_direction", TEXT),
    ("power_mw", DOUBLE),
    ("unit", TEXT),
    ("temporal_granularity", TEXT),
    ("datetime", TIMESTAMP),
    ("updated_at", TIMESTAMP),
    ("extracted_at", TIMESTAMP),
    ("source_url", TEXT),
    ("dt", DATE),
    ("year", TEXT),
    ("month", TEXT),
    ("day", TEXT),
)

MIX_DAILY = _struct(
    ("dt", DATE),
    ("reference_date", DATE),
    ("zone", TEXT),
    ("zone_name", TEXT),
    ("country", TEXT),
    ("region", TEXT),
    ("grain", TEXT),
    ("unit_energy", TEXT),
    ("unit_share", TEXT),
    ("interval_start", TIMESTAMP),
    ("interval_end", TIMESTAMP),
    ("computed_at", TIMESTAMP),
    ("last_extracted_at", TIMESTAMP),
    ("generation_mwh", DOUBLE),
    ("nuclear_mwh", DOUBLE),
    ("geothermal_mwh", DOUBLE),
    ("biomass_mwh", DOUBLE),
    ("coal_mwh", DOUBLE),
    ("wind_mwh", DOUBLE),
    ("solar_mwh", DOUBLE),
    ("hydro_mwh", DOUBLE),
    ("gas_mwh", DOUBLE),
    ("oil_mwh", DOUBLE),
    ("unknown_mwh", DOUBLE),
    ("nuclear_pct", DOUBLE),
    ("geothermal_pct", DOUBLE),
    ("biomass_pct", DOUBLE),
    ("coal_pct", DOUBLE),
    ("wind_pct", DOUBLE),
    ("solar_pct", DOUBLE),
    ("hydro_pct", DOUBLE),
    ("gas_pct", DOUBLE),
    ("oil_pct", DOUBLE),
    ("unknown_pct", DOUBLE),
    ("hydro_storage_charge_mwh", DOUBLE),
    ("hydro_storage_discharge_mwh", DOUBLE),
    ("battery_storage_charge_mwh", DOUBLE),
    ("battery_storage_discharge_mwh", DOUBLE),
    ("imports_mwh", DOUBLE),
    ("exports_mwh", DOUBLE),
)

FOCAL_IMPORTS = _struct(
    ("dt", DATE),
    ("reference_date", DATE),
    ("dest_zone", TEXT),
    ("dest_zone_name", TEXT),
    ("dest_country", TEXT),
    ("dest_region", TEXT),
    ("source_zone", TEXT),
    ("source_zone_name", TEXT),
    ("source_country", TEXT),
    ("source_region", TEXT),
    ("import_mwh", DOUBLE),
    ("export_mwh", DOUBLE),
    ("net_import_mwh", DOUBLE),
    ("interval_start", TIMESTAMP),
    ("interval_end", TIMESTAMP),
    ("computed_at", TIMESTAMP),
    ("last_extracted_at", TIMESTAMP),
    ("grain", TEXT),
    ("unit_energy", TEXT),
)

FOCAL_EXPORTS = _struct(
    ("dt", DATE),
    ("reference_date", DATE),
    ("source_zone", TEXT),
    ("source_zone_name", TEXT),
    ("source_country", TEXT),
    ("source_region", TEXT),
    ("dest_zone", TEXT),
    ("dest_zone_name", TEXT),
    ("dest_country", TEXT),
    ("dest_region", TEXT),
    ("export_mwh", DOUBLE),
    ("import_mwh", DOUBLE),
    ("net_import_mwh", DOUBLE),
    ("interval_start", TIMESTAMP),
    ("interval_end", TIMESTAMP),
    ("computed_at", TIMESTAMP),
    ("last_extracted_at", TIMESTAMP),
    ("grain", TEXT),
    ("unit_energy", TEXT),
)
