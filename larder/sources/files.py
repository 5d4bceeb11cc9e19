"""Typed file reads and whole-table writes.

CSV is read by Spark's own reader with a declared schema, so parsing is split
across executors by file block and no value passes through the driver.  A
blank field becomes NULL (never the text ``'nan'``), and ids declared as
strings are read as the text in the file.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
                   mode: str = "FAILFAST") -> DataFrame:
    """Read CSV with a declared schema; malformed rows fail the job by default."""
    return (spark.read.schema(schema)
            .option("header", header)
            .option("mode", mode)
            .option("enforceSchema", False)
            .csv(path))


def read_tables(spark: SparkSession, paths: Mapping[str, str],
                schemas: Mapping[str, T.StructType]) -> dict[str, DataFrame]:
    """Read several typed CSV sources; ``paths`` and ``schemas`` share their keys."""
    missing = set(paths) ^ set(schemas)
    if missing:
        raise ValueError(f"paths and schemas differ in keys: {sorted(missing)}")
    return {name: read_csv_typed(spark, path, schemas[name]) for name, path in paths.items()}


def cast_columns(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """Cast the named columns in place (e.g. integer ids to string keys); order is kept."""
    unknown = set(types) - set(df.columns)
    if unknown:
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    return df.select([F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def write_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
                path: str | None = None) -> None:
    """Write a whole table to the catalog (replaces it in ``overwrite`` mode)."""
    writer = df.write.mode(mode).format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def create_source_tables(spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, T.StructType],
                         table_names: Mapping[str, str], fmt: str = "parquet") -> dict[str, str]:
    """Read each typed CSV source and write it as a catalog table, replacing any earlier one.

    ``paths``, ``schemas`` and ``table_names`` share their keys (e.g. ``ticket``,
    ``demographic``, ``labels``).  Each source is read and written by one
    distributed job.  Returns the table name per key.
    """
    if set(table_names) != set(paths):
        raise ValueError("paths and table_names differ in keys")
    frames = read_tables(spark, paths, schemas)
    for key, df in frames.items():
        write_table(df, table_names[key], fmt=fmt)
    return dict(table_names)
