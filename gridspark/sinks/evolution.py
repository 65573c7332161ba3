"""What becomes of a store's columns when rows with other columns or types are written to it.

One rule for directories and tables: columns stay, new ones are added, and a type gives way to the
narrowest that holds both (`int` to `bigint`, numbers to `double`, fields of structs one by one).
Rows take the store's columns before they are written; what they lack is NULL.

Files are not touched for a type that Spark's Parquet reader widens by itself. A directory notes its
columns in a file of its own (`SCHEMA_FILE`): files that disagree cannot be read without, and readers
need not look into every file. Files that others put there are read with these columns.
Only where the reader cannot (`bigint` to `double`, say) the store is rewritten, once.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Readers pass over names that begin with `_`.
SCHEMA_FILE = "_schema.json"

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 19), strict=True))


def wider(stored: T.DataType, incoming: T.DataType, name: str = "") -> T.DataType:
    """The narrowest type that holds both; TypeError if there is none."""
    a, b = type(stored), type(incoming)
    if stored == incoming or b is T.NullType:
        return stored
    if a is T.NullType:
        return incoming
    if a in _WHOLE and b in _WHOLE:
        return stored if _WHOLE.index(a) >= _WHOLE.index(b) else incoming
    numbers = (*_WHOLE, T.FloatType, T.DoubleType)
    if a in numbers and b in numbers:
        short = (T.ByteType, T.ShortType, T.FloatType)
        return T.FloatType() if a in short and b in short else T.DoubleType()
    if {a, b} <= {T.DecimalType, *_WHOLE}:
        sides = [x if isinstance(x, T.DecimalType) else T.DecimalType(_DIGITS[type(x)], 0) for x in (stored, incoming)]
        scale = max(x.scale for x in sides)
        precision = max(x.precision - x.scale for x in sides) + scale
        if precision <= 38:
            return T.DecimalType(precision, scale)
    if a is b is T.StructType:
        return evolved(stored, incoming, f"{name}.")
    if a is b is T.ArrayType:
        return T.ArrayType(wider(stored.elementType, incoming.elementType, f"{name}[]"))
    if a is b is T.MapType:
        return T.MapType(wider(stored.keyType, incoming.keyType, f"{name} key"), wider(stored.valueType, incoming.valueType, f"{name} value"))
    raise TypeError(f"column {name!r} is {stored.simpleString()} where rows have {incoming.simpleString()}")


def evolved(stored: T.StructType, incoming: T.StructType, prefix: str = "") -> T.StructType:
    """The fields of `stored` in their order, as wide as needed, then the new ones of `incoming`."""
    come = {field.name.lower(): field for field in incoming}
    fields = []
    for field in stored:
        other = come.pop(field.name.lower(), None)
        kind = field.dataType if other is None else wider(field.dataType, other.dataType, prefix + field.name)
        fields.append(T.StructField(field.name, kind, metadata=field.metadata))
    return T.StructType([*fields, *[T.StructField(f.name, f.dataType, metadata=f.metadata) for f in come.values()]])


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with everything inside nullable, as stored files have it."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    return kind


def plain(schema: T.StructType) -> T.StructType:
    """A schema to compare and to evolve: everything in it nullable, comments kept."""
    return T.StructType([T.StructField(f.name, _nullable(f.dataType), metadata=f.metadata) for f in schema])


def _as(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if _nullable(have) == _nullable(want):
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name.lower(): f for f in have}
        fields = [
            (_as(value.getField(own[f.name.lower()].name), own[f.name.lower()].dataType, f.dataType)
             if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: _as(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        if _nullable(have.keyType) != _nullable(want.keyType):
            value = F.transform_keys(value, lambda k, v: _as(k, have.keyType, want.keyType))
        return F.transform_values(value, lambda k, v: _as(v, have.valueType, want.valueType))
    return value.cast(want)


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of `df` with the columns of `schema`, in its order; what they lack is NULL."""
    own = {field.name.lower(): field for field in df.schema}
    columns = []
    for field in schema:
        have = own.get(field.name.lower())
        value = F.lit(None).cast(field.dataType) if have is None else _as(F.col(f"`{have.name}`"), have.dataType, field.dataType)
        columns.append(value.alias(field.name, metadata=field.metadata))
    return df.select(*columns)


def read_as(stored: T.DataType, now: T.DataType) -> bool:
    """Whether Spark reads a Parquet column of the type `stored` as `now`."""
    if _nullable(stored) == _nullable(now):
        return True
    if isinstance(stored, T.StructType) and isinstance(now, T.StructType):
        kinds = {f.name: f.dataType for f in now}
        return all(read_as(f.dataType, kinds[f.name]) for f in stored)
    if isinstance(stored, T.ArrayType) and isinstance(now, T.ArrayType):
        return read_as(stored.elementType, now.elementType)
    if isinstance(stored, T.MapType) and isinstance(now, T.MapType):
        return read_as(stored.keyType, now.keyType) and read_as(stored.valueType, now.valueType)
    small = _WHOLE[:3]
    if type(stored) in small:
        return type(now) in (*_WHOLE, T.DoubleType)
    if isinstance(stored, T.FloatType):
        return isinstance(now, T.DoubleType)
    if isinstance(stored, T.DecimalType) and isinstance(now, T.DecimalType):
        return now.scale >= stored.scale and now.precision - now.scale >= stored.precision - stored.scale
    return False


def kept_schema(files) -> T.StructType | None:
    """The columns that a directory keeps a file of (`files` is a `swap.Files`)."""
    text = files.read(SCHEMA_FILE)
    return None if text is None else T.StructType.fromJson(json.loads(text))


def keep_schema(files, schema: T.StructType) -> None:
    files.write(SCHEMA_FILE, schema.json())


def widened(stored: T.StructType, now: T.StructType) -> list[str]:
    """Columns whose type is another one now."""
    kinds = {f.name: f.dataType for f in now}
    return [f.name for f in stored if _nullable(f.dataType) != _nullable(kinds[f.name])]


def add_table_columns(spark: SparkSession, table: str, fields: list[T.StructField]) -> None:
    names = ".".join(f"`{part}`" for part in table.split("."))
    added = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)
    if added:
        spark.sql(f"ALTER TABLE {names} ADD COLUMNS ({added})")
