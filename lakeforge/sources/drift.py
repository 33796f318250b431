"""Reading folders whose schemas differ: missing columns and types that changed.

Folders whose shared columns agree in type are read together.  Each such
group is read with its own types, then every column is brought to the common
type of all groups, and the groups are united by name.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}  # and their digits
_TIMES = ("date", "timestamp_ntz", "timestamp")


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both.

    Integers widen; an integer beside a decimal is a wider decimal; any number
    beside a float or double is a double; a date beside a timestamp is a
    timestamp; whatever else differs is text, which every value can be written as.
    """
    if a == b:
        return a
    x, y = a.simpleString(), b.simpleString()
    if "void" in (x, y):
        return b if x == "void" else a
    if x in _INTEGERS and y in _INTEGERS:
        return a if _INTEGERS[x] > _INTEGERS[y] else b
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if {x, y} & {"float", "double"}:
            return T.DoubleType()
        (whole, part), (other, fraction) = _digits(a), _digits(b)
        scale = max(part, fraction)
        digits = max(whole, other) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    if x in _TIMES and y in _TIMES:
        return a if _TIMES.index(x) > _TIMES.index(y) else b
    return T.StringType()


def _digits(kind: T.DataType) -> tuple[int, int]:
    """Digits before and behind the point."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return _INTEGERS[kind.simpleString()], 0


def merged(schemas: Sequence[T.StructType]) -> T.StructType:
    """Columns of all schemas in order of appearance, by name without case, with their common types."""
    fields: dict[str, tuple[str, T.DataType]] = {}
    for schema in schemas:
        for f in schema.fields:
            name, kind = fields.get(f.name.lower(), (f.name, f.dataType))
            fields[f.name.lower()] = (name, common_type(kind, f.dataType))
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.values()])


def agree(a: T.StructType, b: T.StructType) -> bool:
    kinds = {f.name.lower(): f.dataType for f in a.fields}
    return all(kinds.get(f.name.lower(), f.dataType) == f.dataType for f in b.fields)


def as_type(name: str, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return F.col(f"`{name}`")
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(f"`{name}`").alias(name)
    return F.col(f"`{name}`").try_cast(want).alias(name)


def union(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows, by column name and common type; a column that a frame lacks is NULL there."""
    target = merged([df.schema for df in frames])
    return reduce(DataFrame.unionByName, [_aligned(df, df.schema, target) for df in frames])


def _aligned(df: DataFrame, schema: T.StructType, target: T.StructType, *extra: str) -> DataFrame:
    have = {f.name.lower(): f for f in schema.fields}
    cols = [
        as_type(have[f.name.lower()].name, have[f.name.lower()].dataType, f.dataType).alias(f.name) if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in target.fields
    ]
    return df.select(*cols, *extra)


def read(
    reader: DataFrameReader, folders: Sequence[tuple[str, T.StructType]], partitions: str, whole: Sequence[str] | None = None
) -> DataFrame:
    """All files of the folders, by the schemas given with them.

    ``partitions``: the partition columns' types; ``whole``: paths that hold
    just these folders, read in their place when all schemas agree.
    """
    parts = T.StructType.fromDDL(partitions)
    names = set(parts.fieldNames())
    groups: list[tuple[T.StructType, list[str]]] = []
    distinct: dict[str, int] = {}  # schema text -> its group
    for path, schema in folders:
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields if f.name not in names])
        key = schema.json()
        if key not in distinct:
            at = next((i for i, (s, _) in enumerate(groups) if agree(s, schema)), len(groups))
            if at == len(groups):
                groups.append((schema, []))
            groups[at] = (merged([groups[at][0], schema]), groups[at][1])
            distinct[key] = at
        groups[distinct[key]][1].append(path)
    # columns in order of appearance over all folders, not over groups
    target = merged([T.StructType.fromJson(json.loads(k)) for k in distinct])
    frames = []
    for schema, paths in groups:
        df = reader.schema(T.StructType([*schema.fields, *parts.fields])).parquet(*(whole if whole and len(groups) == 1 else paths))
        frames.append(_aligned(df, schema, target, *parts.fieldNames()))
    return reduce(DataFrame.unionByName, frames)
