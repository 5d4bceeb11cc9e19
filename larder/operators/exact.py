"""Exact shares and modes of very large tables, without a global sort or a shuffle of all values."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Imputer, ImputerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from larder.operators.prepare import SPLIT_SEED, TEST_SHARE
from larder.session import scratch_path

_BINS = 16              # digest bits that one histogram resolves
_PREFIX = 60            # digest bits that are compared as a number
_FEW = 10_000           # digests of one bin that the driver orders


# --- split with an exact size

def split_digest(key: str, seed: int = SPLIT_SEED) -> Column:
    """md5 of ``seed:key`` as text; a NULL key has the digest of ``seed`` alone."""
    return F.md5(F.coalesce(F.concat(F.lit(f"{seed}:"), F.col(f"`{key}`").cast("string")), F.lit(f"{seed}")))


def smallest_digests(digests: DataFrame, k: int) -> tuple[str, int] | None:
    """The ``k``-th smallest value of the column ``d`` (hex digests), and how many rows with it belong to the ``k`` smallest.

    Each round counts the digests by their next 16 bits (65,536 numbers reach the driver) and goes on
    in the bin that holds the ``k``-th; n rows need about log(n) / 11 rounds. ``None`` for k = 0.
    """
    if k <= 0:
        return None
    prefix = F.conv(F.substring("d", 1, _PREFIX // 4), 16, 10).cast("bigint")
    rows, left = digests.select("d", prefix.alias("h")), k
    for shift in range(_PREFIX - _BINS, -_BINS, -_BINS):
        shift = max(shift, 0)
        counted = rows.groupBy(F.shiftright("h", shift).alias("b")).count().collect()
        before = 0
        for b, n in sorted((r["b"], r["count"]) for r in counted):
            if before + n >= left:
                break
            before += n
        left -= before
        rows = rows.where(F.shiftright("h", shift) == b)
        if n <= _FEW or not shift:
            break
    # digests that share 60 bits are equal in practice, so this is one row per repeated key at most
    ends = rows.groupBy("d").count().orderBy("d").limit(_FEW).collect()
    for r in ends:
        if r["count"] >= left:
            return r["d"], left
        left -= r["count"]
    raise RuntimeError("more than 10,000 digests agree on 60 bits")


def split_exact(df: DataFrame, key: str, seed: int = SPLIT_SEED, test_share: float = TEST_SHARE) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly ``ceil(test_share * rows)`` test rows: those with the smallest digests of the key.

    Reads the key column two or three times and shuffles only counts; the parts themselves are
    filters. Where a repeated (or NULL) key lies on the border, its rows are written once and numbered, and
    the first ones are test rows.
    """
    if not 0.0 <= test_share <= 1.0:
        raise ValueError(f"test_share must lie between 0 and 1, got {test_share}")
    digest = split_digest(key, seed)
    digests = df.select(digest.alias("d"))
    total = digests.count()
    k = math.ceil(round(test_share * total, 9))
    found = smallest_digests(digests, k)
    if found is None:
        return df, df.where(F.lit(False))
    border, n = found
    tied = df.where(digest == border)
    if tied.count() == n:
        return df.where(digest > border), df.where(digest <= border)
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "split-border")
    tied.withColumn("__larder_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    part = F.shiftright("__larder_at", 33)
    counts = placed.groupBy(part.alias("p")).count().orderBy("p").collect()       # one row per partition
    limit = F.lit(False)
    for r in counts:
        take = min(n, r["count"])
        if take:
            limit = limit | ((part == r["p"]) & (F.col("__larder_at").bitwiseAND((1 << 33) - 1) < take))
        n -= take
    chosen = placed.where(limit).drop("__larder_at").select(*df.columns)
    rest = placed.where(~limit).drop("__larder_at").select(*df.columns)
    return df.where(digest > border).unionByName(rest), df.where(digest < border).unionByName(chosen)


# --- most frequent value

def _summaries(values: DataFrame, column: str, counters: int) -> DataFrame:
    """(value, n, missed) per task: a Misra-Gries summary of at most ``counters`` values.

    A value's true count in the task's rows lies between ``n`` and ``n + missed`` (``n`` is 0 for a value not listed).
    """
    kind = values.schema[column].dataType.simpleString()
    schema = pa.schema([("value", to_arrow_type(values.schema[column].dataType)), ("n", pa.int64()), ("missed", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pd.Series = pd.Series(dtype="int64")
        missed = 0
        for batch in batches:
            counts = batch.column(0).value_counts()
            found = pd.Series(counts.field("counts").to_numpy(), index=counts.field("values").to_pylist(), dtype="int64")
            held = held.add(found, fill_value=0).astype("int64") if len(held) else found
            if len(held) > counters:
                cut = int(np.partition(held.to_numpy(), -counters - 1)[-counters - 1])     # the greatest that can't stay
                held = held[held > cut] - cut
                missed += cut
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held.index) + [None], schema.field("value").type), pa.array([*held.tolist(), 0], pa.int64()),
             pa.array([0] * len(held) + [missed], pa.int64())], schema=schema)

    return values.select(column).mapInArrow(run, f"value {kind}, n bigint, missed bigint")


def most_frequent(df: DataFrame, column: str, counters: int = 2048) -> tuple[object, str]:
    """The most frequent value of a column (ties: the smallest; NULL and NaN don't count), and how it was found.

    1. Each task keeps a summary of at most ``counters`` values, so what is shuffled does not
       grow with the number of distinct values.
    2. The ``counters`` best values are counted exactly (a semi join with a bounded broadcast).
    3. A value outside of them occurs at most as often as the best of the others' lower bounds plus all
       that the summaries missed. If the winner occurs more often, it is proven (``"summary"``);
       else all values are counted (``"full"``). Without any value the result is ``(None, "empty")``.
    """
    values = df.select(F.col(f"`{column}`").alias("value")).where(F.col("value").isNotNull())
    if values.schema["value"].dataType.simpleString() in ("double", "float"):
        values = values.where(~F.isnan("value")).select((F.col("value") + F.lit(0).cast(values.schema["value"].dataType)).alias("value"))
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "mode-summary")
    _summaries(values, "value", counters).write.parquet(path)
    parts = spark.read.parquet(path)
    missed = int(parts.agg(F.sum("missed").alias("m")).first()["m"] or 0)
    ranked = (parts.where(F.col("value").isNotNull()).groupBy("value").agg(F.sum("n").alias("n"))
              .orderBy(F.desc("n"), "value").limit(counters + 1).collect())
    if not ranked and not missed:
        return None, "empty"
    if ranked:
        chosen = spark.createDataFrame([(r["value"],) for r in ranked[:counters]], values.schema)
        best = (values.join(F.broadcast(chosen), "value", "left_semi").groupBy("value").count()
                .orderBy(F.desc("count"), "value").first())
        others = ranked[counters]["n"] if len(ranked) > counters else 0
        if not missed and len(ranked) <= counters or best["count"] > others + missed:
            return best["value"], "summary"
    full = values.groupBy("value").count().orderBy(F.desc("count"), "value").first()
    return full["value"], "full"


def exact_mode_imputer(df: DataFrame, columns: list[str], suffix: str = "__imputed", counters: int = 2048) -> ImputerModel:
    """An ``ImputerModel`` equal to ``mode_imputer(columns).fit(df)``, with the modes found by ``most_frequent``.

    Raises for a column without any value, as the estimator does.
    """
    modes = [most_frequent(df, c, counters)[0] for c in columns]
    empty = [c for c, m in zip(columns, modes, strict=True) if m is None]
    if empty:
        raise ValueError(f"columns {empty} have no value to fill with")
    one = df.sparkSession.createDataFrame([tuple(modes)], df.select(*columns).schema)
    return Imputer(strategy="mode", inputCols=columns, outputCols=[f"{c}{suffix}" for c in columns]).fit(one)
