"""Access to the driver's Parquet tables and to a per-run scratch database."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from larder.session import shared_dir
from larder.sources.storage import create_database

# The table names of the driver data set.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_database(spark: SparkSession, purpose: str) -> str:
    """A new database whose folder lies in the shared folder; returns its name."""
    tag = uuid.uuid4().hex[:10]
    name = f"larder_{purpose}_{tag}"
    create_database(spark, name, f"{shared_dir(spark)}/larder/db/{name}")
    return name
