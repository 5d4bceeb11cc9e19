"""One-hot encoding with the vocabulary in tables: no list of categories on the driver.

``fit_encoder`` writes one feature table per column, keyed by category, with the category's number
in order (``prepare.vocabulary``). ``encode`` looks the numbers up like any feature, so hot
categories are joined apart and few categories are broadcast, and MLlib's encoder turns them
into sparse vectors; its model holds the size of each vocabulary and nothing else. NULL counts as
the category ``missing``; a category that the fit did not see encodes as all zeros.

The encoder is described by a dictionary (tables and sizes), which a model bundle can carry.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.feature_table import get_feature_table, save_features
from larder.operators.lookup import FeatureLookup, attach_features
from larder.operators.prepare import MISSING, vocabulary
from larder.operators.skew import SkewPolicy


@dataclass(frozen=True)
class TableEncoder:
    columns: tuple[str, ...]
    tables: tuple[str, ...]             # one vocabulary table per column
    sizes: tuple[int, ...]

    def to_dict(self) -> dict:
        return {"columns": list(self.columns), "tables": list(self.tables), "sizes": list(self.sizes)}

    @staticmethod
    def from_dict(d: dict) -> TableEncoder:
        return TableEncoder(tuple(d["columns"]), tuple(d["tables"]), tuple(d["sizes"]))


def _filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}__filled": F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING)) for c in columns})


def fit_encoder(spark: SparkSession, df: DataFrame, columns: Sequence[str], prefix: str) -> TableEncoder:
    """Write the vocabularies of ``columns`` as feature tables ``<prefix>_<column>``; only their sizes reach the driver."""
    columns = list(columns)
    filled = _filled(df.select(*columns), columns).select(*[F.col(f"{c}__filled").alias(c) for c in columns])
    numbered = vocabulary(filled, columns)
    tables, sizes = [], []
    for c in columns:
        name = f"{prefix}_{c}"
        rows = numbered.where(F.col("column_name") == c).select(
            F.col("category").alias(f"{c}__filled"), F.col("category_index").alias(f"{c}__filled__idx"))
        save_features(spark, name, rows, f"{c}__filled", f"Vocabulary of {c}", mode="overwrite")
        tables.append(name)
        sizes.append(int(get_feature_table(spark, name).rows or 0))
    return TableEncoder(tuple(columns), tuple(tables), tuple(sizes))


def with_indices(spark: SparkSession, df: DataFrame, encoder: TableEncoder, skew: SkewPolicy | None = None) -> DataFrame:
    """``df`` with ``<column>__filled`` and ``<column>__filled__idx``; an unseen category has the vocabulary's size as its index."""
    lookups = [FeatureLookup(t, [f"{c}__filled__idx"], f"{c}__filled") for c, t in zip(encoder.columns, encoder.tables, strict=True)]
    found = attach_features(spark, _filled(df, encoder.columns), lookups, skew)
    return found.withColumns({f"{c}__filled__idx": F.coalesce(f"{c}__filled__idx", F.lit(float(n)))
                              for c, n in zip(encoder.columns, encoder.sizes, strict=True)})


def encode(spark: SparkSession, df: DataFrame, encoder: TableEncoder, skew: SkewPolicy | None = None) -> DataFrame:
    """``df`` with a sparse vector ``<column>__filled__idx__vec`` per column (as ``prepare.fit_one_hot`` makes them)."""
    indexed = with_indices(spark, df, encoder, skew)
    idx = [f"{c}__filled__idx" for c in encoder.columns]
    # fitted on the largest index of each column: one row, the sizes
    largest = spark.createDataFrame([tuple(float(n) for n in encoder.sizes)], ", ".join(f"`{i}` double" for i in idx))
    model = OneHotEncoder(inputCols=idx, outputCols=[f"{i}__vec" for i in idx], dropLast=True, handleInvalid="error").fit(largest)
    return model.transform(indexed)
