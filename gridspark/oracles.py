"""The registered queries as DuckDB SQL over the given tables.

Written from the rules by which the snapshots are derived, not from the snapshots: of the three
deliveries of a version the late repeat is the newest, so the facts follow from the tables alone.
"""

from __future__ import annotations

# Fixed values, written out here so that a wrong one in the package shows.
GENERATION_SOURCES = (
    "nuclear", "geothermal", "biomass", "coal", "wind", "solar", "hydro", "gas", "oil", "unknown"
)
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
GRANULARITIES = (
    "hourly", "5_minutes", "15_minutes", "daily", "monthly", "quarterly", "yearly", "weekly", None
)
EVENT_SOURCES = {
    "click": "wind", "view": "solar", "purchase": "nuclear", "signup": "gas", "error": "coal"
}
BASE_URL = "https://grid.example.org/api/"
ITEMS_PER_SNAPSHOT = 256

ORACLES: dict[str, str] = {}


def _list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


_ZONE_LIST = _list(zone[0] for zone in ZONES)
_GRAN_LIST = _list(GRANULARITIES)
_DIM = "(VALUES " + ", ".join(str(z) for z in ZONES) + ") AS d(zone, zone_name, country, region)"
_HOURS = (
    "CASE temporal_granularity WHEN '5_minutes' THEN 5.0::DOUBLE / 60 WHEN '15_minutes' THEN 0.25 "
    "WHEN 'daily' THEN 24 WHEN 'monthly' THEN 720 WHEN 'quarterly' THEN 2184 "
    "WHEN 'yearly' THEN 8760 ELSE 1 END::DOUBLE"
)
_PARTS = "strftime({0}, '%Y') AS year, strftime({0}, '%m') AS month, strftime({0}, '%d') AS day"


def _parts(ts: str) -> str:
    return _PARTS.format(ts)


def _nation(column: str) -> str:
    return f"CASE WHEN {column} < 10 THEN ({_ZONE_LIST})[{column} + 1] ELSE 'N' || {column} END"


# ---- mix: snapshots, deliveries, facts ----

_POWER = {
    **{
        f"mix_{source}": f"CASE WHEN event_type = '{kind}' THEN floor(round(value * 100)) END"
        for kind, source in EVENT_SOURCES.items()
    },
    "mix_hydro": "CAST(event_id % 1000 AS DOUBLE)",
    "mix_unknown": "CAST(user_id % 7 AS DOUBLE)",
    "mix_hydro_storage_charge": "CAST(event_id % 11 AS DOUBLE)",
    "mix_battery_storage_discharge": "CAST(user_id % 5 AS DOUBLE)",
    "mix_flows_imports": "CAST(event_id % 13 AS DOUBLE)",
    "mix_flows_exports": "CAST(event_id % 17 AS DOUBLE)",
}
_MEASURES = [f"mix_{name}" for name in GENERATION_SOURCES] + [
    "mix_hydro_storage_charge",
    "mix_hydro_storage_discharge",
    "mix_battery_storage_charge",
    "mix_battery_storage_discharge",
    "mix_flows_imports",
    "mix_flows_exports",
]
_POWERS = ", ".join(f"{_POWER.get(name, 'CAST(NULL AS DOUBLE)')} AS {name}" for name in _MEASURES)

_EV = f"""
ev AS (
  SELECT *, CASE WHEN user_id % 25 < 10 THEN ({_ZONE_LIST})[user_id % 25 + 1]
                 ELSE 'U' || user_id END AS zone,
         CAST(ts AS DATE) AS date, event_id // {ITEMS_PER_SNAPSHOT} AS batch,
         date_trunc('hour', ts) AS datetime
  FROM events),
timed AS (
  SELECT *, CAST(date AS TIMESTAMP) + to_hours(CAST(batch % 20 + 24 AS INTEGER)) AS fetched,
         ({_GRAN_LIST})[batch % {len(GRANULARITIES)} + 1] AS granularity,
         '{BASE_URL}mix/latest?zone=' || zone AS url
  FROM ev),
snap AS (
  SELECT zone, date, batch, granularity, fetched, url, count(*) AS n,
         min(ts) AS first_ts FROM timed GROUP BY ALL),
delivery AS (
  SELECT zone, date, batch, granularity, url, n, d.kind AS kind,
         fetched + to_hours(d.late) AS extracted_at
  FROM snap, (VALUES ('older', -1), ('current', 0), ('current', 6), ('untimed', 7),
                     ('page', 8), ('blank', 9)) AS d(kind, late))"""

_MIX_SCHEMA = (
    "zone, temporal_granularity, unit, datetime, updated_at, breakdown_type, is_estimated, "
    "estimation_method, " + ", ".join(_MEASURES) + ", extracted_at, source_url"
)
_MIX_TIES = ", ".join(
    f"{name} ASC NULLS FIRST"
    for name in [
        "temporal_granularity",
        "unit",
        "breakdown_type",
        "is_estimated",
        "estimation_method",
        *_MEASURES,
        "source_url",
    ]
)


def _mix(source: str, extracted: str, first: str = "") -> str:
    """CTE `mix`: the newest of the rows in `source`; `first` ranks before the update time."""
    return f"""{_EV},
mix AS (
  SELECT * EXCLUDE (rank_first), CAST(datetime AS DATE) AS dt, {_parts('datetime')} FROM (
    SELECT zone, granularity AS temporal_granularity, 'MW' AS unit, datetime,
           date_trunc('second', ts) AS updated_at, event_type AS breakdown_type,
           user_id % 2 = 0 AS is_estimated,
           CASE WHEN event_id % 3 = 0 THEN 'MODEL' END AS estimation_method,
           {_POWERS}, {extracted} AS extracted_at, url AS source_url,
           {first or '0'} AS rank_first
    FROM {source})
  QUALIFY row_number() OVER (PARTITION BY zone, datetime ORDER BY rank_first DESC,
                             updated_at DESC NULLS LAST, extracted_at DESC NULLS LAST,
                             {_MIX_TIES}) = 1)"""


_MIX = _mix("timed", "fetched + to_hours(6)")

_KIND = "CASE kind WHEN 'page' THEN 'page' WHEN 'blank' THEN 'blank' ELSE 'json' END AS kind"

ORACLES["bronze_scan"] = f"""
WITH {_EV}
SELECT extracted_at, url AS source_url, {_parts('extracted_at')}, {_KIND} FROM delivery"""

ORACLES["bronze_since"] = ORACLES["bronze_scan"] + " WHERE extracted_at >= '2024-01-15'"

# An error page or an empty body names no zone.
ORACLES["bronze_from_landing"] = f"""
WITH {_EV}
SELECT TIMESTAMP '2026-09-16 12:00:00' AS extracted_at,
       CASE WHEN kind IN ('page', 'blank') THEN '{BASE_URL}mix/latest' ELSE url END AS source_url,
       '2026' AS year, '09' AS month, '16' AS day,
       CASE WHEN kind NOT IN ('page', 'blank') THEN zone END AS zone
FROM delivery"""

ORACLES["parsed_payloads"] = f"""
WITH {_EV}
SELECT extracted_at, url AS source_url,
       CASE WHEN kind <> 'page' THEN zone END AS zone,
       CASE WHEN kind <> 'page' THEN 'MW' END AS unit,
       CASE kind WHEN 'page' THEN NULL WHEN 'untimed' THEN 2 * n ELSE n END AS items
FROM delivery WHERE kind <> 'blank'"""

ORACLES["payload_rejected"] = f"""
WITH {_EV}
SELECT extracted_at, url AS source_url,
       CASE WHEN kind = 'blank' THEN 'blank' WHEN kind = 'page' THEN 'no object'
            ELSE CASE hour(extracted_at) % 5 WHEN 1 THEN 'malformed' WHEN 2 THEN 'no zone'
                      WHEN 3 THEN 'no data' ELSE 'accepted' END END AS reason,
       count(*) AS row_count
FROM delivery GROUP BY ALL"""

ORACLES["payload_items"] = f"""
WITH {_EV},
version AS (
  SELECT *, CASE kind WHEN 'older' THEN ts - to_hours(2) ELSE ts END AS updated,
         CASE kind WHEN 'current' THEN strftime(datetime, '%Y-%m-%dT%H:%M:%SZ')
                   WHEN 'older' THEN strftime(datetime, '%Y-%m-%dT%H:%M:%SZ')
                   WHEN 'soon' THEN 'soon' END AS datetime_text
  FROM timed, (VALUES ('older', -1), ('current', 0), ('current', 6), ('soon', 7),
                      ('missing', 7)) AS d(kind, late))
SELECT fetched + to_hours(late) AS extracted_at, zone, granularity AS temporal_granularity,
       datetime_text, strftime(date_trunc('millisecond', updated), '%Y-%m-%dT%H:%M:%S.%gZ')
         AS updated_text
FROM version"""

_RECEIVED = ", ".join(
    f"{_POWER.get(name, 'CAST(NULL AS DOUBLE)')} AS {name}".replace(
        "round(value * 100)", "round(value * 100) * CASE WHEN late < 0 THEN 0.5 ELSE 1 END"
    )
    for name in _MEASURES
)
ORACLES["mix_received"] = f"""
WITH {_EV}
SELECT zone, datetime,
       date_trunc('millisecond', CASE WHEN late < 0 THEN ts - to_hours(2) ELSE ts END)
         AS updated_at,
       fetched + to_hours(late) AS extracted_at, {_RECEIVED}
FROM timed, (VALUES (-1), (0), (6)) AS d(late)"""

ORACLES["mix_fact"] = f"WITH {_MIX} SELECT {_MIX_SCHEMA}, dt, year, month, day FROM mix"

# ---- flows ----

_LINES = f"""
line AS (
  SELECT l_orderkey, s_nationkey AS neighbor, l_linenumber % 2 = 1 AS odd,
         sum(l_quantity) AS power
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
placed AS (
  SELECT o_orderkey, o_orderdate AS date, c_nationkey AS nation, {_nation('c_nationkey')} AS zone,
         ({_GRAN_LIST})[o_orderkey % {len(GRANULARITIES)} + 1] AS granularity,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS datetime,
         o_orderdate + to_hours(24) + to_seconds(o_orderkey % 86400) AS updated,
         o_orderdate + to_hours(CAST(o_custkey % 24 + 48 AS INTEGER)) AS fetched
  FROM orders JOIN customer ON o_custkey = c_custkey),
flow AS (
  SELECT zone, {_nation('neighbor')} AS neighbor_zone,
         CASE WHEN odd THEN 'import' ELSE 'export' END AS flow_direction,
         CASE WHEN power % 13 <> 0 THEN power END AS power, granularity, datetime, updated, fetched
  FROM line JOIN placed ON l_orderkey = o_orderkey WHERE neighbor <> nation)"""


def _flows(source: str, extracted: str) -> str:
    """CTE `flows`: the newest of the rows in `source`."""
    return f"""{_LINES},
flows AS (
  SELECT *, CAST(datetime AS DATE) AS dt, {_parts('datetime')} FROM (
    SELECT zone, neighbor_zone, flow_direction, power AS power_mw, 'MW' AS unit,
           granularity AS temporal_granularity, datetime, updated AS updated_at,
           {extracted} AS extracted_at, '{BASE_URL}flows/latest?zone=' || zone AS source_url
    FROM {source})
  QUALIFY row_number() OVER (
    PARTITION BY zone, datetime, neighbor_zone, flow_direction
    ORDER BY updated_at DESC NULLS LAST, extracted_at DESC NULLS LAST,
             power_mw ASC NULLS FIRST, temporal_granularity ASC NULLS FIRST) = 1)"""


_FLOWS = _flows("flow", "fetched + to_hours(6)")

_FLOW_DELIVERY = """
delivery AS (
  SELECT *, fetched + to_hours(late) AS extracted_at
  FROM placed, (VALUES ('older', -1), ('current', 0), ('current', 6), ('untimed', 7),
                       ('page', 8), ('blank', 9)) AS d(kind, late))"""

ORACLES["bronze_parquet"] = f"""
WITH {_LINES}, {_FLOW_DELIVERY}
SELECT extracted_at, '{BASE_URL}flows/latest?zone=' || zone AS source_url,
       {_parts('extracted_at')}, {_KIND} FROM delivery"""

ORACLES["bronze_jsonl"] = f"""
WITH {_LINES}, {_FLOW_DELIVERY},
read AS (
  SELECT {_KIND}, zone, granularity, 1::BIGINT AS items,
         strftime(CASE delivery.kind WHEN 'older' THEN updated - to_hours(24) ELSE updated END,
                  '%Y-%m-%dT%H:%M:%S.%gZ') AS first_update
  FROM delivery)
SELECT kind, CASE kind WHEN 'json' THEN zone END AS zone,
       CASE kind WHEN 'json' THEN granularity END AS granularity,
       CASE kind WHEN 'json' THEN items END AS items,
       CASE kind WHEN 'json' THEN first_update END AS first_update
FROM read"""

ORACLES["bronze_rewrap"] = ORACLES["bronze_jsonl"] + " WHERE kind <> 'blank'"

ORACLES["bronze_mixed"] = f"""
WITH {_LINES}, {_FLOW_DELIVERY},
read AS (
  SELECT {_KIND}, zone, strftime(extracted_at, '%m') < '07' AS enveloped FROM delivery)
SELECT kind, CASE kind WHEN 'json' THEN zone END AS zone, enveloped
FROM read WHERE enveloped OR kind <> 'blank'"""

ORACLES["flow_received"] = f"""
WITH {_LINES}
SELECT zone, neighbor_zone, flow_direction, power * CASE WHEN late < 0 THEN 0.5 ELSE 1 END
         AS power_mw, datetime,
       CASE WHEN late < 0 THEN updated - to_hours(24) ELSE updated END AS updated_at,
       fetched + to_hours(late) AS extracted_at
FROM flow, (VALUES (-1), (0), (6)) AS d(late)"""

ORACLES["flow_fact"] = f"WITH {_FLOWS} SELECT * FROM flows"

# ---- keep latest, dates, URLs ----

ORACLES["source_url"] = f"""
SELECT o_orderkey, '{BASE_URL}flows/latest?priority='
       || replace(url_encode(o_orderpriority), '%20', '+') || '&status='
       || url_encode(o_orderstatus) || '&q=a%26b~c' AS url,
       'https://grid.example.org/api/flows' AS bare_url
FROM orders"""

ORACLES["keep_latest"] = """
SELECT * FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
           l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
           l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) = 1"""

ORACLES["latest_by_clock"] = """
SELECT event_type AS zone, user_id, date_trunc('second', ts) AS updated_at,
       CASE WHEN value > 10 THEN date_trunc('second', ts) END AS extracted_at, event_id, value
FROM events WHERE event_type <> 'error'
QUALIFY row_number() OVER (
  PARTITION BY zone, user_id ORDER BY updated_at DESC, extracted_at DESC NULLS LAST, event_id) = 1"""

ORACLES["latest_without_clock"] = """
SELECT l_suppkey, l_partkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_suppkey ORDER BY l_partkey NULLS FIRST, l_quantity NULLS FIRST) = 1"""

ORACLES["date_parts"] = f"""
SELECT o_orderkey, datetime, CAST(datetime AS DATE) AS dt, {_parts('datetime')}
FROM (SELECT o_orderkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS datetime
      FROM orders)"""

ORACLES["hours_by_granularity"] = f"""
WITH {_MIX}
SELECT temporal_granularity, count(*) AS intervals, round(sum({_HOURS}), 6) AS hours
FROM mix GROUP BY 1"""

# ---- dimensions ----

ORACLES["silver_products"] = f"""
WITH {_MIX}, {_FLOWS},
dates AS (SELECT dt, year, month, day FROM mix UNION SELECT dt, year, month, day FROM flows),
per_day AS (SELECT dt, count(*) AS facts FROM mix GROUP BY dt)
SELECT dates.*, facts, 'dim_date,fact' AS products FROM dates LEFT JOIN per_day USING (dt)"""

ORACLES["dim_zone"] = f"""
WITH {_FLOWS}
SELECT d.*, (SELECT nullif(count(*), 0) FROM flows WHERE flows.zone = d.zone) AS facts
FROM {_DIM}"""

ORACLES["dim_date"] = f"""
WITH {_MIX}, {_FLOWS}
SELECT dt, year, month, day FROM mix UNION SELECT dt, year, month, day FROM flows"""

ORACLES["zone_join"] = f"""
WITH {_MIX}
SELECT zone, datetime, mix_hydro, zone_name, country, region
FROM mix LEFT JOIN {_DIM} USING (zone)"""

_NEIGHBOR_DIM = _DIM.replace(
    "d(zone, zone_name, country, region)",
    "n(neighbor_zone, neighbor_zone_name, neighbor_country, neighbor_region)",
)

ORACLES["neighbor_join"] = f"""
WITH {_FLOWS}
SELECT zone, neighbor_zone, flow_direction, datetime, power_mw, neighbor_zone_name,
       neighbor_country, neighbor_region
FROM flows LEFT JOIN {_NEIGHBOR_DIM} USING (neighbor_zone)"""

ORACLES["wide_flows"] = f"""
WITH {_FLOWS}
SELECT * EXCLUDE (source_url, year, month, day)
FROM flows LEFT JOIN {_DIM} USING (zone) LEFT JOIN {_NEIGHBOR_DIM} USING (neighbor_zone)"""

# ---- daily products ----


def _energy(measure: str) -> str:
    return f"sum(coalesce({measure}, 0) * {_HOURS})"


def _share(part: str, whole: str) -> str:
    """Half-up on the decimal value, as Spark rounds; DuckDB rounds a DOUBLE on its binary value."""
    exact = f"CAST({part} / {whole} * 100 AS DECIMAL(38, 12))"
    return f"CASE WHEN {whole} > 0 THEN CAST(round({exact}, 6) AS DOUBLE) END"


_TOTAL = " + ".join(f"{name}_mwh" for name in GENERATION_SOURCES)
_NAMED = {
    "mix_hydro_storage_charge": "hydro_storage_charge_mwh",
    "mix_hydro_storage_discharge": "hydro_storage_discharge_mwh",
    "mix_battery_storage_charge": "battery_storage_charge_mwh",
    "mix_battery_storage_discharge": "battery_storage_discharge_mwh",
    "mix_flows_imports": "imports_mwh",
    "mix_flows_exports": "exports_mwh",
}
_MIX_DAILY = f"""{_MIX},
summed AS (
  SELECT dt, zone, min(datetime) AS interval_start, max(datetime) AS interval_end,
         max(extracted_at) AS last_extracted_at,
         {', '.join(f'{_energy("mix_" + name)} AS {name}_mwh' for name in GENERATION_SOURCES)},
         {', '.join(f'{_energy(measure)} AS {name}' for measure, name in _NAMED.items())}
  FROM mix GROUP BY dt, zone),
totals AS (SELECT *, {_TOTAL} AS total FROM summed),
daily AS (
  SELECT dt, dt AS reference_date, zone, zone_name, country, region, 'daily' AS grain,
         'MWh' AS unit_energy, 'percent' AS unit_share, interval_start, interval_end,
         last_extracted_at, round(total, 6) AS generation_mwh,
         {', '.join(f'round({name}_mwh, 6) AS {name}_mwh' for name in GENERATION_SOURCES)},
         {', '.join(f'{_share(name + "_mwh", "total")} AS {name}_pct' for name in GENERATION_SOURCES)},
         {', '.join(f'round({name}, 6) AS {name}' for name in _NAMED.values())}
  FROM totals LEFT JOIN {_DIM} USING (zone))"""

for _name in ("mix_daily", "mix_daily_from_wide", "mix_daily_from_bronze", "stream_daily"):
    ORACLES[_name] = f"WITH {_MIX_DAILY} SELECT * FROM daily"


def _net(focal: str) -> str:
    return f"""{_FLOWS},
energy AS (SELECT *, power_mw * {_HOURS} AS mwh FROM flows WHERE zone = '{focal}'),
net AS (
  SELECT dt, zone, neighbor_zone, min(datetime) AS interval_start,
         max(datetime) AS interval_end, max(extracted_at) AS last_extracted_at,
         round(sum(CASE WHEN flow_direction = 'import' THEN mwh ELSE 0 END), 6) AS import_mwh,
         round(sum(CASE WHEN flow_direction = 'export' THEN mwh ELSE 0 END), 6) AS export_mwh,
         round(sum(CASE WHEN flow_direction = 'import' THEN mwh ELSE 0 END)
             - sum(CASE WHEN flow_direction = 'export' THEN mwh ELSE 0 END), 6)
           AS net_import_mwh
  FROM energy GROUP BY dt, zone, neighbor_zone),
named AS (
  SELECT *, dt AS reference_date, 'daily' AS grain, 'MWh' AS unit_energy
  FROM net LEFT JOIN {_DIM} USING (zone) LEFT JOIN {_NEIGHBOR_DIM} USING (neighbor_zone))"""


ORACLES["net_flow_daily"] = f"WITH {_net('FR')} SELECT * FROM named"
ORACLES["net_flow_daily_from_wide"] = ORACLES["net_flow_daily"]
ORACLES["net_flow_daily_other_zone"] = f"WITH {_net('N17')} SELECT * FROM named"


def _focal(direction: str, own: str, other: str) -> str:
    return f"""
WITH {_net('FR')}
SELECT dt, reference_date, zone AS {own}_zone, zone_name AS {own}_zone_name,
       country AS {own}_country, region AS {own}_region, neighbor_zone AS {other}_zone,
       neighbor_zone_name AS {other}_zone_name, neighbor_country AS {other}_country,
       neighbor_region AS {other}_region, import_mwh, export_mwh, net_import_mwh,
       interval_start, interval_end, last_extracted_at, grain, unit_energy
FROM named WHERE {direction}_mwh > 0"""


ORACLES["focal_imports"] = _focal("import", "dest", "source")
ORACLES["focal_exports"] = _focal("export", "source", "dest")
ORACLES["gold_days_emptied"] = ORACLES["focal_imports"] + " AND dt < DATE '2000-01-01'"
ORACLES["gold_days_emptied_in_tables"] = ORACLES["gold_days_emptied"]

for _job in ("etl_tables", "etl_by_table", "etl_incremental"):
    ORACLES[_job] = ORACLES["mix_daily"]
    ORACLES[f"{_job}_mix_fact"] = ORACLES["mix_fact"]
    ORACLES[f"{_job}_flow_fact"] = ORACLES["flow_fact"]
    ORACLES[f"{_job}_dim_zone"] = f"SELECT * FROM {_DIM}"
    ORACLES[f"{_job}_dim_date"] = ORACLES["dim_date"]
    ORACLES[f"{_job}_imports"] = ORACLES["focal_imports"]
    ORACLES[f"{_job}_exports"] = ORACLES["focal_exports"]
for _end in ("", "_mix_fact", "_flow_fact", "_dim_date", "_imports", "_exports"):
    ORACLES[f"etl_resumed{_end}"] = ORACLES[f"etl_incremental{_end}"]

# ---- writes ----

_ORDERS = """
o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS datetime,
         strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month
  FROM orders),
old AS (SELECT * FROM o WHERE datetime < '1999-01-01'),
new AS (SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM o
        WHERE datetime >= '1998-07-01')"""
_KEPT = "WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)"

ORACLES["upserted"] = f"""
WITH {_ORDERS} SELECT * FROM old {_KEPT} UNION ALL SELECT * FROM new"""
for _name in ("upsert_parquet", "upsert_files", "merge_files", "merge_table_unpartitioned"):
    ORACLES[_name] = ORACLES["upserted"]

ORACLES["upsert_moved"] = f"""
WITH {_ORDERS}
SELECT * FROM old {_KEPT}
UNION ALL SELECT * REPLACE ('X' AS o_orderstatus) FROM new"""

ORACLES["upsert_null_keys"] = f"""
WITH {_ORDERS}
SELECT * REPLACE (nullif(o_custkey % 7, 0) AS o_custkey)
FROM (SELECT * FROM old {_KEPT} UNION ALL SELECT * FROM new)"""

ORACLES["upsert_evolve"] = f"""
WITH {_ORDERS}
SELECT * REPLACE (CAST(NULL AS BIGINT) AS o_custkey), CAST(NULL AS VARCHAR) AS note
FROM old {_KEPT}
UNION ALL SELECT *, 'new' FROM new"""

ORACLES["evolve_widened"] = f"""
WITH {_ORDERS}
SELECT o_orderkey, datetime, year, month, o_custkey AS number, floor(o_totalprice) AS price,
       o_custkey AS customer, CAST(NULL AS VARCHAR) AS note
FROM old {_KEPT}
UNION ALL
SELECT o_orderkey, datetime, year, month, o_custkey, o_totalprice, o_custkey + 5000000000, 'new' FROM new"""
ORACLES["evolve_rewritten"] = f"""
SELECT w.*, CAST(r.run AS INTEGER) AS run FROM ({ORACLES["evolve_widened"]}) w, range(2) AS r(run)"""

ORACLES["upsert_guarded"] = f"""
WITH {_ORDERS},
both_sides AS (
  SELECT *, o_orderkey % 3 AS version FROM old UNION ALL SELECT *, 1 FROM new)
SELECT * FROM both_sides
QUALIFY row_number() OVER (
  PARTITION BY o_orderkey ORDER BY version DESC, o_custkey, o_orderstatus, o_totalprice) = 1"""

ORACLES["upsert_guard_ties"] = f"""
WITH {_ORDERS},
both_sides AS (SELECT * FROM old UNION ALL SELECT * FROM new)
SELECT *, 1 AS version FROM both_sides, range(4) AS r(run)
QUALIFY row_number() OVER (
  PARTITION BY run, o_orderkey ORDER BY o_custkey, o_orderstatus, o_totalprice) = 1"""

# Of the day that got a note, rows that were sent again later have lost it.
ORACLES["upsert_evolve_partly"] = f"""
WITH {_MIX}
SELECT {_MIX_SCHEMA}, dt, year, month, day,
       CASE WHEN dt = DATE '2024-01-14' AND extracted_at < TIMESTAMP '2024-01-16'
            THEN 'kept' END AS note
FROM mix"""

ORACLES["gold_days_replaced"] = f"""
WITH {_MIX_DAILY}
SELECT * REPLACE (CASE WHEN dt >= DATE '2024-01-20' THEN 'again' ELSE 'daily' END AS grain)
FROM daily"""

ORACLES["gold_days_evolved"] = f"""
WITH {_MIX_DAILY}
SELECT * REPLACE (CASE WHEN dt < DATE '2024-01-20' THEN unit_share END AS unit_share),
       CASE WHEN dt >= DATE '2024-01-20' THEN 'again' END AS note
FROM daily"""

ORACLES["merge_table"] = f"""
WITH {_ORDERS}
SELECT * REPLACE (CAST(NULL AS BIGINT) AS o_custkey) FROM old {_KEPT}
UNION ALL SELECT * FROM new"""

ORACLES["table_ctas"] = f"WITH {_ORDERS} SELECT * FROM o"
ORACLES["table_mirrored"] = ORACLES["table_ctas"]
ORACLES["table_overwrite"] = f"WITH {_ORDERS} SELECT * FROM new"

ORACLES["bronze_append"] = f"""
WITH {_EV}
SELECT url AS source_url, {_parts('extracted_at')}, 3 * count(*) AS row_count
FROM delivery GROUP BY ALL"""

ORACLES["landing_expired"] = """
SELECT event_id, 'mix_' || strftime(ts, '%Y%m%dT%H%M%SZ') || CASE event_type
         WHEN 'click' THEN '.jsonl.gz' WHEN 'view' THEN '.JSONL' ELSE '.jsonl' END AS name
FROM events
WHERE event_type <> 'error' AND date_trunc('second', ts) < TIMESTAMP '2024-01-13 00:00:00'"""

ORACLES["landing_kept"] = f"""
WITH {_EV}
SELECT TIMESTAMP '2024-03-01 12:00:00' + to_days(CAST(hour(extracted_at) // 6 AS INTEGER)) AS stamp,
       count(*) AS row_count
FROM delivery GROUP BY 1 HAVING stamp >= TIMESTAMP '2024-03-02 18:00:00'"""

ORACLES["contract_violations"] = f"""
WITH {_EV},
counted AS (
  SELECT count(*) FILTER (WHERE kind = 'blank') AS payload,
         count(*) FILTER (WHERE kind IN ('page', 'blank')) AS source_url FROM delivery)
SELECT 'payload' AS column_name, payload AS violations FROM counted
UNION ALL SELECT 'source_url', source_url FROM counted
UNION ALL SELECT unnest(['extracted_at', 'year', 'month', 'day']), 0"""

# Two merges, the second of what was ingested from 16 January on: whatever that holds for a key
# replaces what is stored, newer or not. An older version has its update time two hours back.
_VERSIONS = f"""
(SELECT * REPLACE (CASE WHEN late < 0 THEN ts - to_hours(2) ELSE ts END AS ts,
                   CASE WHEN late < 0 THEN floor(round(value * 100) * 0.5) / 100
                        ELSE value END AS value)
 FROM timed, (VALUES (-1), (0), (6)) AS d(late))"""
ORACLES["contract_observed"] = f"""
WITH {_EV}
SELECT v.*, (SELECT count(*) FROM delivery) AS stored FROM ({ORACLES["contract_violations"]}) v"""

ORACLES["merge_replaces"] = f"""
WITH {_mix(_VERSIONS, 'fetched + to_hours(late)',
           "CAST(fetched + to_hours(late) >= TIMESTAMP '2024-01-16' AS INTEGER)")}
SELECT * FROM mix"""

# ---- streams ----

_STAMPED = """
stamped AS (
  SELECT *, TIMESTAMP '2024-03-01 12:00:00'
            + to_days(CAST(hour(extracted_at) // 6 AS INTEGER)) AS stamp
  FROM delivery WHERE kind <> 'blank')"""

ORACLES["stream_bronze"] = f"""
WITH {_EV}, {_STAMPED}
SELECT stamp AS extracted_at,
       CASE WHEN kind <> 'page' THEN url ELSE '{BASE_URL}mix/latest' END AS source_url,
       {_parts('stamp')}, count(*) AS row_count
FROM stamped GROUP BY ALL"""

# In the stream the ingest time is the stamp of the drop, which is not in order of delivery.
_DROP = (
    "TIMESTAMP '2024-03-01 12:00:00' "
    "+ to_days(CAST(hour(fetched + to_hours(late)) // 6 AS INTEGER))"
)
ORACLES["stream_silver"] = f"""
WITH {_mix('timed, (VALUES (0), (6)) AS d(late)', _DROP)}
SELECT * FROM mix"""
ORACLES["stream_tables"] = ORACLES["stream_silver"]

ORACLES["stream_flows"] = f"""
WITH {_flows('flow, (VALUES (0), (6)) AS d(late)', _DROP)}
SELECT * FROM flows"""

ORACLES["stream_daily_deduped"] = ORACLES["mix_daily"]
ORACLES["stream_gold"] = ORACLES["mix_daily"]
