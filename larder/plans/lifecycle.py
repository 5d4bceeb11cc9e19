"""Registered queries over the life of tables and models: partitioned and ordered upserts, changes between
snapshots, exact split and mode, encoding by tables, pinned bundles, the registry."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.diff import snapshot_diff
from larder.operators.encoding import encode, fit_encoder
from larder.operators.exact import exact_mode_imputer, split_exact
from larder.operators.feature_table import get_feature_table, lease_snapshot, save_features, write_feature_table
from larder.operators.lookup import FeatureLookup, create_training_set
from larder.operators.model import load_bundle, save_bundle, score_batch
from larder.operators.partitioned_table import create_partitioned_table, read_partitioned, write_partitioned
from larder.operators.prepare import split_train_test
from larder.operators.registry import ModelRegistry
from larder.plans import queries as base
from larder.plans.derive import doc_text_features
from larder.plans.tables import scratch_database, table
from larder.session import scratch_path
from larder.streaming import latest_per_key


def q_merge_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    name = f"{scratch_database(spark, 'partitioned')}.customer_features"
    target, source = base._segment_versions(spark, sf)
    create_partitioned_table(spark, name, "PassengerId", target.schema, 16, "Customer name features")
    write_partitioned(spark, name, target)
    write_partitioned(spark, name, source)
    return read_partitioned(spark, name)


def q_merge_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """The newest order of each customer, from deltas that arrive newest first and twice."""
    name = f"{scratch_database(spark, 'ordered')}.newest_order"
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    create_partitioned_table(spark, name, "o_custkey", orders.schema, 8, order_by="o_orderdate")
    deltas = [orders.where(F.col("o_orderkey") % 2 == k) for k in (0, 1)]        # all rows, in two deltas
    for delta in (*deltas, deltas[0]):
        write_partitioned(spark, name, latest_per_key(delta, ["o_custkey"], "o_orderdate"))
    return read_partitioned(spark, name)


def q_snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    """What a publish would send after the table was overwritten."""
    name = f"{scratch_database(spark, 'diff')}.customer_features"
    target, source = base._segment_versions(spark, sf)
    save_features(spark, name, target, "PassengerId")
    lease_snapshot(spark, name, "published")
    write_feature_table(spark, name, source, mode="overwrite")
    return snapshot_diff(spark, name, "published")


def q_split_exact(spark: SparkSession, sf: str) -> DataFrame:
    train, test = split_exact(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def q_impute_mode_exact(spark: SparkSession, sf: str) -> DataFrame:
    rows = base._balance_with_gaps(spark, sf)
    train, _ = split_train_test(rows, "c_custkey")
    return exact_mode_imputer(train, ["bal"]).transform(rows).select("c_custkey", F.col("bal__imputed").alias("bal_filled"))


def q_encode_by_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = base._segments(spark, sf)
    fit_part = rows.where((F.col("segment") != base.UNSEEN_SEGMENT) | F.col("segment").isNull())
    encoder = fit_encoder(spark, fit_part, ["segment"], f"{scratch_database(spark, 'vocab')}.vocabulary")
    slots = vector_to_array("segment__filled__idx__vec")
    return encode(spark, rows, encoder).select("c_custkey", F.concat_ws(",", F.transform(slots, lambda x: x.cast("int").cast("string")))
                                               .alias("encoded"))


def _rule_model(prediction: str) -> PipelineModel:
    """A model that is one SQL rule, so its right predictions are known."""
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {prediction} AS prediction FROM __THIS__")])


def _text_table(spark: SparkSession, sf: str, purpose: str) -> tuple[str, DataFrame]:
    name = f"{scratch_database(spark, purpose)}.doc_text_features"
    features = doc_text_features(table(spark, sf, "documents"))
    save_features(spark, name, features, "doc_id", "Text features of documents")
    return name, features


def q_pinned_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of a pinned bundle after the features it reads were changed twice."""
    name, features = _text_table(spark, sf, "pinned")
    ids = table(spark, sf, "documents").select("doc_id")
    ts = create_training_set(spark, ids, [FeatureLookup(name, base.TEXT_FEATURES, "doc_id")], label=None)
    path = save_bundle(spark, _rule_model("CAST(has_digits AS DOUBLE) + n_lines"), scratch_path(spark, "pinned-bundle"), ts, pin=True)
    for more in (100, 200):
        write_feature_table(spark, name, features.withColumn("n_lines", F.col("n_lines") + more), retain=0)
    bundle = load_bundle(spark, path)
    return score_batch(spark, bundle, ids).select("*", F.lit(bundle.snapshots[name]).alias("version"),
                                                  F.lit(get_feature_table(spark, name).version).alias("table_version"))


def q_registry_production(spark: SparkSession, sf: str) -> DataFrame:
    """Register three versions, promote two after another, score with what is in production."""
    name, _ = _text_table(spark, sf, "registry")
    ids = table(spark, sf, "documents").select("doc_id")
    ts = create_training_set(spark, ids, [FeatureLookup(name, ["n_lines"], "doc_id")], label=None)
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    for rule in ("0.0D", "CAST(n_lines AS DOUBLE)", "1.0D"):
        registry.register("lines", save_bundle(spark, _rule_model(rule), scratch_path(spark, "registered"), ts), rule)
    for version, stage in ((1, "production"), (2, "staging"), (2, "production"), (3, "staging")):
        registry.set_stage("lines", version, stage)
    found = registry.find("lines", "production")
    now = registry.versions().where((F.col("name") == "lines") & (F.col("version") == found.version)).select("version", "stage").first()
    return score_batch(spark, load_bundle(spark, found.bundle), ids).select(
        "*", F.lit(now["version"]).alias("version"), F.lit(now["stage"]).alias("stage"))


LIFECYCLE = {
    "merge_partitioned": q_merge_partitioned,
    "merge_ordered": q_merge_ordered,
    "snapshot_diff": q_snapshot_diff,
    "split_exact": q_split_exact,
    "impute_mode_exact": q_impute_mode_exact,
    "encode_by_table": q_encode_by_table,
    "pinned_scores": q_pinned_scores,
    "registry_production": q_registry_production,
}
