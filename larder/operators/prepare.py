"""Model preparation on DataFrames: id limit, hash split, imputers, vocabularies, one-hot.

All fitted state (fill values, vocabularies) is computed by distributed
aggregates. What MLlib estimators fit (one value per column, or per category)
reaches the driver; ``vocabulary`` gives the categories as a table instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.columns import MISSING
from larder.session import scratch_path

# The split rule.  A row is in the test part when the first eight
# hex digits of md5("<seed>:<key>") are below 0x40000000, i.e. 25 % of rows.
SPLIT_SEED = 123
TEST_SHARE = 0.25


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def take_ids(df: DataFrame, key: str | Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by key (a repeatable ``limit``); runs as a top-k, not a sort."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.select(*keys).orderBy(*keys).limit(n)


def split_is_test(key: str | Column, seed: int = SPLIT_SEED, test_share: float = TEST_SHARE) -> Column:
    """True for rows in the test part.

    The rule reads only the row's key, so it gives the same parts however the
    data is partitioned, re-read or retried, unlike ``randomSplit``.
    """
    if not 0.0 <= test_share <= 1.0:
        raise ValueError(f"test_share must lie between 0 and 1, got {test_share}")
    k = F.col(key) if isinstance(key, str) else key
    bound = int(test_share * 0x100000000)
    digest = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string"))), 1, 8), 16, 10).cast("bigint")
    # a NULL key has no digest; such rows go to the training part, so the two
    # parts always cover every row
    return F.coalesce(digest < F.lit(bound), F.lit(False))


def split_train_test(df: DataFrame, key: str, seed: int = SPLIT_SEED,
                     test_share: float = TEST_SHARE) -> tuple[DataFrame, DataFrame]:
    cond = split_is_test(key, seed, test_share)
    return df.where(~cond), df.where(cond)


def check_cardinality(df: DataFrame, columns: Sequence[str], max_categories: int | None) -> None:
    """Raise ``ValueError`` if a column has more distinct values than ``max_categories`` (exact count).

    MLlib keeps a fitted vocabulary on the driver and ships it inside the model. Whoever
    fits decides how much of that is wanted: ``None`` sets no limit. One aggregate.
    """
    if not columns or max_categories is None:
        return
    row = df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in columns]).first()
    wide = {c: row[c] for c in columns if row[c] > max_categories}
    if wide:
        raise ValueError(f"too many categories to encode (limit {max_categories}): {wide}")


def fill_missing_sql(categorical: Sequence[str], binary: Sequence[str]) -> SQLTransformer:
    """A pipeline stage: NULL categories become ``'missing'``; absent flags become 0.0.

    The stage is a SQL projection, so it runs in the JVM and is saved with the model.
    """
    q = lambda name: "`" + name.replace("`", "``") + "`"
    cols = ["*"]
    cols += [f"coalesce({q(c)}, '{MISSING}') AS {q(c + '__filled')}" for c in categorical]
    cols += [f"CAST(coalesce({q(c)}, '0') AS DOUBLE) AS {q(c + '__num')}" for c in binary]
    return SQLTransformer(statement=f"SELECT {', '.join(cols)} FROM __THIS__")


def mode_imputer(columns: Sequence[str], suffix: str = "__imputed") -> Imputer:
    """Most frequent value per column, ties to the smallest; NULL and NaN are filled, not counted."""
    return Imputer(strategy="mode", inputCols=list(columns), outputCols=[f"{c}{suffix}" for c in columns])


def category_indexer(columns: Sequence[str], suffix: str = "__idx") -> StringIndexer:
    """Alphabetical vocabulary per column; unseen values get the extra last index."""
    return StringIndexer(inputCols=list(columns), outputCols=[f"{c}{suffix}" for c in columns],
                         handleInvalid="keep", stringOrderType="alphabetAsc")


def one_hot(columns: Sequence[str], suffix: str = "__vec") -> OneHotEncoder:
    """One slot per known category; the dropped last slot is the unseen one, so
    an unseen value encodes as all zeros."""
    return OneHotEncoder(inputCols=list(columns), outputCols=[f"{c}{suffix}" for c in columns],
                         dropLast=True, handleInvalid="keep")


def fit_one_hot(df: DataFrame, columns: Sequence[str], max_categories: int | None = None) -> PipelineModel:
    """Fill, index and encode ``columns``; fitted on ``df``. See ``check_cardinality`` for the optional limit."""
    check_cardinality(df, columns, max_categories)
    filled = [f"{c}__filled" for c in columns]
    idx = [f"{c}__idx" for c in filled]
    stages = [fill_missing_sql(columns, []), category_indexer(filled), one_hot(idx)]
    return Pipeline(stages=stages).fit(df)


def one_hot_columns(model: PipelineModel, df: DataFrame, columns: Sequence[str], keep: Sequence[str],
                    sep: str = "_") -> DataFrame:
    """Apply a ``fit_one_hot`` model and spread each vector into one double column per category."""
    indexer = next(s for s in model.stages if isinstance(s, StringIndexerModel))
    out = model.transform(df)
    cols = [F.col(k) for k in keep]
    for c, labels in zip(columns, indexer.labelsArray):
        arr = vector_to_array(F.col(f"{c}__filled__idx__vec"))
        cols += [arr[i].alias(f"{c}{sep}{label}") for i, label in enumerate(labels)]
    return out.select(*cols)


def vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, category, category_index)``: the distinct values of each column, numbered in order.

    One pass over ``df`` for all columns and no value on the driver, so there is no limit on
    their number: values are sorted by range, and a value's number is its place in its range
    plus the sizes of the ranges before (one row per range).
    """
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("slot"), F.lit(c).alias("column_name"),
                                                   F.col(c).cast("string").alias("category"))
                                          for n, c in enumerate(columns)])).alias("p")).select("p.*")
    distinct = pairs.where(F.col("category").isNotNull()).distinct()
    ranged = distinct.repartitionByRange("slot", "category").sortWithinPartitions("slot", "category")
    placed = written(ranged.select("*", F.monotonically_increasing_id().alias("place")), "vocabulary")
    part = F.shiftright("place", 33)
    before = Window.partitionBy("slot").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("slot", part.alias("part")).agg(F.min("place").alias("low"), F.count(F.lit(1)).alias("n"))
              .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))))
    return (placed.withColumn("part", part).join(starts, ["slot", "part"])
            .select("column_name", "category", (F.col("offset") + F.col("place") - F.col("low")).cast("double")
                    .alias("category_index")))
