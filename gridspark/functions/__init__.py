from gridspark.functions.columns import (
    any_null,
    date_parts,
    instant,
    interval_hours,
    keys_match,
    landing_stamp,
    past_retention,
    request_url,
    share_pct,
    total,
    url_param,
    utc,
)

__all__ = [
    "any_null",
    "date_parts",
    "instant",
    "interval_hours",
    "keys_match",
    "landing_stamp",
    "past_retention",
    "request_url",
    "share_pct",
    "total",
    "url_param",
    "utc",
]
