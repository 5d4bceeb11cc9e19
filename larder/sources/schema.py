"""Declared schemas for raw tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# DDL names accepted for plain column types.
_NAMED_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "long": T.LongType(),
    "smallint": T.ShortType(),
    "tinyint": T.ByteType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "binary": T.BinaryType(),
}


def to_type(dtype: T.DataType | str) -> T.DataType:
    if isinstance(dtype, T.DataType):
        return dtype
    try:
        return _NAMED_TYPES[dtype.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown type name {dtype!r}; pass a DataType") from None


def make_schema(columns: Iterable[tuple[str, T.DataType | str]], nullable: bool = True) -> T.StructType:
    """Build a ``StructType`` from ``(name, type)`` pairs.

    A type may be a ``DataType`` or a plain type name such as ``"string"``.
    """
    return T.StructType([T.StructField(name, to_type(dtype), nullable) for name, dtype in columns])
