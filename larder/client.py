"""One object with the feature-table workflow verbs, for callers who prefer a client.

Each method is a direct call of the library function of the same purpose;
nothing is cached in the client except the session.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from larder.operators.feature_table import (
    FeatureTable,
    create_feature_table,
    drop_feature_table,
    feature_table_exists,
    get_feature_table,
    write_feature_table,
)
from larder.operators.lookup import FeatureLookup, SkewPolicy, TrainingSet, create_training_set
from larder.operators.model import ModelBundle, load_bundle, save_bundle, score_batch
from larder.sources.jdbc import JdbcTarget, publish_table, read_published


class FeatureClient:
    def __init__(self, spark: SparkSession, skew: SkewPolicy | None = None):
        self.spark = spark
        self.skew = skew or SkewPolicy()

    # tables
    def table_exists(self, name: str) -> bool:
        return feature_table_exists(self.spark, name)

    def create_table(self, name: str, primary_keys: str | Sequence[str], schema: T.StructType,
                     description: str | None = None, buckets: int | None | str = "auto") -> bool:
        """Create unless present; returns whether it was created."""
        return create_feature_table(self.spark, name, primary_keys, schema, description, buckets)

    def get_table(self, name: str) -> FeatureTable:
        return get_feature_table(self.spark, name)

    def read_table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def write_table(self, name: str, df: DataFrame, mode: str = "merge") -> FeatureTable:
        return write_feature_table(self.spark, name, df, mode)

    def drop_table(self, name: str, purge: bool = True) -> bool:
        return drop_feature_table(self.spark, name, purge)

    # training and scoring
    def create_training_set(self, df: DataFrame, feature_lookups: Sequence[FeatureLookup], label: str | None,
                            exclude_columns: str | Iterable[str] = ()) -> TrainingSet:
        return create_training_set(self.spark, df, feature_lookups, label, exclude_columns, self.skew)

    def log_model(self, model: PipelineModel, path: str, training_set: TrainingSet) -> str:
        """Save the model with the lookups of its training set (a bundle)."""
        return save_bundle(self.spark, model, path, training_set)

    def load_model(self, path: str) -> ModelBundle:
        return load_bundle(self.spark, path)

    def score_batch(self, model: str | ModelBundle, df: DataFrame) -> DataFrame:
        return score_batch(self.spark, model, df, self.skew)

    # online copy
    def publish_table(self, name: str, target: JdbcTarget, mode: str = "merge",
                      num_partitions: int | None = None) -> None:
        ft = get_feature_table(self.spark, name)
        publish_table(self.spark, self.spark.table(name), target, ft.primary_keys, mode, num_partitions)

    def read_published(self, target: JdbcTarget, **partitioning) -> DataFrame:
        return read_published(self.spark, target, **partitioning)
