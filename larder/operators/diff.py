"""What changed between two states of a keyed table: inserts, updates and removals.

The states are joined once by their key. Snapshots of one feature table are bucketed alike, so
nothing is shuffled (as long as the table was not re-bucketed between them); the old row is
compared in the task that holds the new one, and only changed rows come out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.feature_table import get_feature_table, leases, primary_key_tuple, read_snapshot

# The kinds of change.
INSERT, UPDATE, REMOVE = "insert", "update", "remove"
CHANGE = "change"


def row_changes(old: DataFrame, new: DataFrame, primary_keys: str | Sequence[str]) -> DataFrame:
    """``change``, the key and the other columns of every row that differs between ``old`` and ``new``.

    Both have the same columns and unique non-NULL keys. NULL equals NULL and NaN equals NaN. An
    update has the new values, a removal NULL in all columns but the key. Maps are compared by their entries.
    """
    keys = list(primary_key_tuple(primary_keys))
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError(f"the states have different columns: {old.columns} and {new.columns}")
    if CHANGE in new.columns:
        raise ValueError(f"{CHANGE} is the name of the added column")
    values = [c for c in new.columns if c not in keys]

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(f"`{k}`") for k in keys], F.struct(F.lit(True).alias("there"), *[F.col(f"`{c}`") for c in values]).alias(name))

    def comparable(name: str):
        parts = []
        for c in values:
            field = F.col(f"{name}.`{c}`")
            kind = new.schema[c].dataType.simpleString()
            parts.append(F.array_sort(F.map_entries(field)) if kind.startswith("map<") else field)
        return F.struct(F.col(f"{name}.there"), *parts)

    both = packed(old, "__old").join(packed(new, "__new"), keys, "full")
    change = (F.when(F.col("__old").isNull(), INSERT).when(F.col("__new").isNull(), REMOVE)
              .when(~comparable("__old").eqNullSafe(comparable("__new")), UPDATE))
    return (both.withColumn(CHANGE, change).where(F.col(CHANGE).isNotNull())
            .select(CHANGE, *[F.col(f"`{c}`") if c in keys else F.col(f"__new.`{c}`").alias(c) for c in new.columns]))


def snapshot_diff(spark: SparkSession, name: str, holder: str) -> DataFrame:
    """Changes of a feature table since the snapshot that ``holder`` has leased."""
    if holder not in leases(spark, name):
        raise ValueError(f"{holder!r} holds no snapshot of {name}")
    return row_changes(read_snapshot(spark, name, holder), spark.table(name), get_feature_table(spark, name).primary_keys)


def apply_changes(df: DataFrame, changes: DataFrame, primary_keys: str | Sequence[str]) -> DataFrame:
    """``df`` with the changes applied: the state that ``changes`` leads to."""
    keys = list(primary_key_tuple(primary_keys))
    kept = df.join(changes.select(*keys), keys, "left_anti")
    return kept.select(*df.columns).unionByName(changes.where(F.col(CHANGE) != REMOVE).select(*df.columns))
