"""One row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from gridspark.functions import any_null

RECENCY = ("updated_at", "extracted_at")
CLOCKS = ("datetime", *RECENCY)


def require_columns(df: DataFrame, names: Sequence[str], what: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what} not among the columns: {missing}")


def recency_order(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> list[Column]:
    """Newest first by `by`, then by the remaining columns, so that ties have one outcome.

    The remaining columns are compared only where everything before is equal.
    """
    order = [F.col(f"`{name}`").desc_nulls_last() for name in by]
    used = {*keys, *by}
    order += [
        F.col(f"`{field.name}`").asc_nulls_first()
        for field in df.schema
        if field.name not in used and not isinstance(field.dataType, (MapType, VariantType))
    ]
    return order or [F.lit(0).asc()]


def latest_by(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The first row per key in recency order.

    `row_number() = 1` becomes a WindowGroupLimit on both sides of the exchange: each map task sends
    at most one row per key, so a key that holds a third of all rows is cut down before the shuffle.
    Keys that are not text come first: a sort tells most rows apart by the first eight bytes, which
    zone codes share.
    """
    kinds = dict(df.dtypes)
    ranked = sorted(keys, key=lambda k: kinds.get(k) == "string")
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in ranked]).orderBy(
        *recency_order(df, keys, by)
    )
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def keep_latest(
    df: DataFrame, keys: Sequence[str], by: Sequence[str] | None = None
) -> DataFrame:
    """Newest row per key: `updated_at`, then `extracted_at`, both to the second.

    Rows with a NULL key go. The clock columns are cut to the second before ranking, so that
    `...00.000Z` and `...00Z` are the same key. `by` names other columns to rank by.
    """
    keys = list(keys)
    require_columns(df, keys, "keys")
    if by is None:
        by = [name for name in RECENCY if name in df.columns]
    require_columns(df, by, "ranking columns")
    clocks = {
        name: F.date_trunc("second", F.col(name))
        for name in CLOCKS
        if name in df.columns and dict(df.dtypes)[name].startswith("timestamp")
    }
    rows = df.where(~any_null(keys))
    if clocks:
        rows = rows.withColumns(clocks)
    return latest_by(rows, keys, list(by))


def ranks_before(
    df: DataFrame, left: str, right: str, keys: Sequence[str], by: Sequence[str]
) -> Column:
    """Whether the row of alias `left` comes before that of `right` in `recency_order`.

    Both have the columns of `df`. Structs compare field by field with NULL as the least value, which
    is where the order puts it on either side.
    """

    def part(side: str, names: Sequence[str]) -> Column:
        return F.struct(*[F.col(f"{side}.`{name}`") for name in names])

    used = {*keys, *by}
    rest = [
        f.name for f in df.schema
        if f.name not in used and not isinstance(f.dataType, (MapType, VariantType))
    ]
    newer, as_new = part(left, by) > part(right, by), part(left, by) == part(right, by)
    return newer | (as_new & (part(left, rest) < part(right, rest))) if rest else newer
