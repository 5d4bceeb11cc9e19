"""Schemas, typed reads, table sinks and the JDBC publish path."""

from larder.sources.files import cast_columns, create_source_tables, read_csv_typed, read_tables, write_table
from larder.sources.schema import make_schema

__all__ = ["cast_columns", "create_source_tables", "make_schema", "read_csv_typed", "read_tables", "write_table"]
