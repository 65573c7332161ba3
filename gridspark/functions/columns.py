"""Column expressions shared by all jobs. Built-in functions only."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridspark.schemas import GRANULARITY_HOURS

# Fixed value: file names in landing end with this stamp.
LANDING_STAMP = r"(?i)_(\d{8}T\d{6}Z)\.jsonl(?:\.gz)?$"


def column(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def instant(value: Column | str) -> Column:
    """ISO text (or a timestamp) as a timestamp; NULL, never an error, when it does not parse.

    The second pattern takes the form without seconds, which the first rejects. Text that lacks its
    signs is not given to it, since it throws an exception for each value that does not parse.
    """
    text = column(value)
    minutes = text.cast("string")
    return F.coalesce(
        F.try_to_timestamp(text),
        F.when(minutes.like("%-%-%T%:%"), F.try_to_timestamp(minutes, F.lit("yyyy-MM-dd'T'HH:mmX"))),
    )


def utc(value: datetime | Column) -> Column:
    """A moment as a literal; a naive one is taken as UTC."""
    if isinstance(value, Column):
        return value
    return F.lit(value if value.tzinfo else value.replace(tzinfo=timezone.utc))


def date_parts(ts: Column | str) -> dict[str, Column]:
    """`dt` and the zero-padded text parts of a timestamp, in the session zone (always UTC)."""
    ts = column(ts)
    return {
        "dt": F.to_date(ts),
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    }


def interval_hours(granularity: Column | str = "temporal_granularity") -> Column:
    """Length of one interval in hours; an unknown or missing granularity counts as one hour."""
    pairs = [F.lit(value) for item in GRANULARITY_HOURS.items() for value in item]
    return F.call_function("decode", column(granularity), *pairs, F.lit(1.0))


def share_pct(part: Column, whole: Column) -> Column:
    """`part` in percent of `whole`, six decimals, NULL unless `whole` is positive."""
    return F.round(F.try_divide(part, F.when(whole > 0, whole)) * 100.0, 6)


def total(columns: list[Column]) -> Column:
    return reduce(Column.__add__, columns)


def any_null(keys: list[str]) -> Column:
    """True if one of the keys is NULL.

    One predicate on purpose: split into `a IS NOT NULL AND b IS NOT NULL`, the half on a field of
    the parsed payload is pushed below the explode as a second `from_json` over every payload.
    """
    flags = [F.col(key).isNull() for key in keys]
    return F.greatest(*flags) if len(flags) > 1 else flags[0]


def keys_match(keys: list[str], left: str = "t", right: str = "s") -> Column:
    """Null-safe equality of all keys between the aliases `left` and `right`."""
    if not keys:
        raise ValueError("a keyed write needs at least one key")
    return reduce(
        Column.__and__,
        [F.col(f"{left}.`{key}`").eqNullSafe(F.col(f"{right}.`{key}`")) for key in keys],
    )


def url_param(value: Column | str) -> Column:
    """One query-string value: space as `+`, and `~` kept as is."""
    encoded = F.url_encode(column(value).cast("string"))
    return F.replace(
        F.replace(encoded, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A")
    )


def request_url(base_url: str, path: str, params: Mapping[str, Column | str]) -> Column:
    """Request URL of a snapshot: base, path and encoded parameters in the order given.

    A parameter is a Column, or text that is taken literally; a NULL one is left out.
    """
    head = base_url.rstrip("/") + "/" + path.lstrip("/")
    pairs = []
    for name, value in params.items():
        value = value if isinstance(value, Column) else F.lit(value)
        pairs.append(F.concat(F.lit(f"{name}="), url_param(value)))
    if not pairs:
        return F.lit(head)
    query = F.concat_ws("&", *pairs)
    return F.when(query == "", F.lit(head)).otherwise(F.concat(F.lit(head + "?"), query))


def landing_stamp(name: Column | str) -> Column:
    """Instant in a landing file name, NULL if the name carries none."""
    stamp = F.regexp_extract(column(name), LANDING_STAMP, 1)
    return F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyyMMdd'T'HHmmssX"))


def past_retention(name: Column | str, now: Column, days: int) -> Column:
    """True if the name is stamped more than `days` days before `now`; unstamped names stay."""
    if days < 1:
        raise ValueError("retention must be at least one day")
    limit = now - F.make_dt_interval(days=F.lit(days))
    return F.coalesce(landing_stamp(name) < limit, F.lit(False))
