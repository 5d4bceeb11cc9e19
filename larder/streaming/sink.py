"""Micro-batch upsert: ``stream.writeStream.foreachBatch(upsert_batch_writer(name))``.

Each micro-batch is merged into the feature table with the batch upsert
(``write_feature_table``).  A re-run of a failed batch merges the same rows
again, which leaves the same table, so the effect is exactly once.  A stream
may carry a key several times within one batch; ``latest_by`` keeps one row
per key (the one with the greatest ordering value) before the merge, and the merge
replaces a row of the table only by one that is not older, so late data changes
nothing and batches may arrive in any order. Partitioned tables follow their own
``order_by``.

On a snapshot table each micro-batch writes a complete new snapshot (see
``feature_table``; a partitioned table only rewrites the buckets it touches), so the trigger interval should be long enough to amortise
one table rewrite (e.g. ``trigger(processingTime="1 hour")`` or
``availableNow`` runs), not seconds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.feature_table import get_feature_table, row_rank, write_feature_table
from larder.operators.partitioned_table import get_partitioned_table, is_partitioned, write_partitioned


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` (partial aggregation, skew-safe).

    A NULL ``order_by`` is older than any value. Ties go to the greatest row by its other
    columns in order, so a re-run chooses the same row.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), row_rank(df, keys, order_by)).alias("__row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__row.`{c}`").alias(c) for c in others])


def upsert_batch_writer(table_name: str, latest_by: str | None = None) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        if is_partitioned(spark, table_name):
            table = get_partitioned_table(spark, table_name)
            if latest_by and table.order_by != latest_by:
                raise ValueError(f"{table_name} is ordered by {table.order_by!r}, not by {latest_by!r}")
            rows = latest_per_key(batch, table.primary_keys, table.order_by) if table.order_by else batch
            write_partitioned(spark, table_name, rows)
            return
        rows = batch
        if latest_by:
            rows = latest_per_key(batch, get_feature_table(spark, table_name).primary_keys, latest_by)
        write_feature_table(spark, table_name, rows, mode="merge", newer_by=latest_by)
    return write
