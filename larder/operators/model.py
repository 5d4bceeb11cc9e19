"""Gradient-boosted binary classifier with its preparation, as one MLlib pipeline,
plus model bundles that carry their feature lookups so scoring takes ids only.

Pipeline stages (all JVM-side and saved with the model):

1. SQL projection: NULL categories -> ``'missing'``, flags -> 0.0/1.0;
2. alphabetical string indexer per categorical column (unseen -> extra index);
3. one-hot encoder dropping that extra slot (unseen -> all zeros);
4. mode imputer for numeric columns (NULL and NaN filled);
5. vector assembler;
6. ``GBTClassifier`` (50 rounds by default).

Fill values and vocabularies are fitted on the frame given to ``fit``: the
training part for evaluation, all rows for the final model.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.encoding import TableEncoder, encode
from larder.operators.evaluate import weighted_prf
from larder.operators.feature_table import lease_snapshot, release_snapshot
from larder.operators.lookup import FeatureLookup, SkewPolicy, TrainingSet, attach_features
from larder.operators.prepare import (
    category_indexer,
    check_cardinality,
    fill_missing_sql,
    mode_imputer,
    one_hot,
    split_train_test,
)

# Classifier settings.  50 rounds as in the reference; depth and
# step size are this library's choice.
GBT_ROUNDS = 50
GBT_DEPTH = 6
GBT_STEP = 0.3
GBT_SEED = 123


def build_pipeline(categorical: Sequence[str], numeric: Sequence[str], binary: Sequence[str], label: str,
                   max_iter: int = GBT_ROUNDS, max_depth: int = GBT_DEPTH, step_size: float = GBT_STEP,
                   seed: int = GBT_SEED, encoded: bool = False) -> Pipeline:
    """``encoded``: the input has the categorical vectors already (``encoding.encode``), so no vocabulary is fitted."""
    categorical, numeric, binary = list(categorical), list(numeric), list(binary)
    stages = [fill_missing_sql([] if encoded else categorical, binary)]
    vectors: list[str] = []
    if encoded:
        vectors += [f"{c}__filled__idx__vec" for c in categorical]
    elif categorical:
        filled = [f"{c}__filled" for c in categorical]
        idx = [f"{c}__idx" for c in filled]
        stages += [category_indexer(filled), one_hot(idx)]
        vectors += [f"{c}__vec" for c in idx]
    if numeric:
        stages.append(mode_imputer(numeric))
        vectors += [f"{c}__imputed" for c in numeric]
    vectors += [f"{c}__num" for c in binary]
    stages.append(VectorAssembler(inputCols=vectors, outputCol="features"))
    stages.append(GBTClassifier(labelCol=label, featuresCol="features", predictionCol="prediction",
                                maxIter=max_iter, maxDepth=max_depth, stepSize=step_size, seed=seed))
    return Pipeline(stages=stages)


def fit_pipeline(pipeline: Pipeline, df: DataFrame, categorical: Sequence[str] = (),
                 max_categories: int | None = None) -> PipelineModel:
    """Fit with the input persisted (memory, spilling to disk) for the duration of the fit.

    Every stage reads its input once (indexer, imputer, the assembler's size
    probe, split finding, boosting), so without this the joins that built the
    training frame would run once per stage. An input that its owner has persisted
    already is used as it is. ``max_categories`` limits the vocabularies of the
    ``categorical`` columns, which MLlib keeps in the model (``None``: no limit).
    """
    held = df.storageLevel.useMemory or df.storageLevel.useDisk
    cached = df if held else df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        check_cardinality(cached, categorical, max_categories)
        return pipeline.fit(cached)
    finally:
        if not held:
            cached.unpersist()


def fit_and_evaluate(pipeline: Pipeline, train: DataFrame, test: DataFrame, label: str,
                     decimals: int = 2, categorical: Sequence[str] = (),
                     max_categories: int | None = None) -> tuple[PipelineModel, DataFrame]:
    """Fit on ``train``; return the model and ``(part, metric, value, value_rounded)`` for both parts.

    Both parts are persisted over fit and evaluation, and the six metric rows are
    computed before they are released.
    """
    spark, parts = train.sparkSession, {"training": train, "testing": test}
    parts = {n: df.persist(StorageLevel.MEMORY_AND_DISK) for n, df in parts.items()}
    try:
        model = fit_pipeline(pipeline, parts["training"], categorical, max_categories)
        measured = [weighted_prf(model.transform(df), label=label, decimals=decimals).select(F.lit(n).alias("part"), "*")
                    for n, df in parts.items()]
        both = measured[0].unionByName(measured[1])
        return model, spark.createDataFrame(both.collect(), both.schema)     # six rows
    finally:
        for df in parts.values():
            df.unpersist()


@dataclass(frozen=True)
class ModelBundle:
    model: PipelineModel
    spec: dict

    @property
    def lookups(self) -> list[FeatureLookup]:
        """The lookups to score with: on the pinned snapshots, if the bundle has pinned them."""
        pinned = self.spec.get("pinned", {})
        found = [FeatureLookup.from_dict(d) for d in self.spec["feature_lookups"]]
        return [lk.on_table(pinned[lk.table_name]["entry"]) if lk.table_name in pinned else lk for lk in found]

    @property
    def encoder(self) -> TableEncoder | None:
        """The vocabulary tables that the model's input is encoded with, if any."""
        return TableEncoder.from_dict(self.spec["encoder"]) if self.spec.get("encoder") else None

    @property
    def snapshots(self) -> dict[str, int]:
        """Pinned tables and the versions the bundle reads."""
        return {t: x["version"] for t, x in self.spec.get("pinned", {}).items()}


def bundle_holder(path: str) -> str:
    """The name under which a bundle leases snapshots."""
    return f"bundle:{path.rstrip('/')}"


def save_bundle(spark: SparkSession, model: PipelineModel, path: str, training_set: TrainingSet, pin: bool = False,
                encoder: TableEncoder | None = None) -> str:
    """Save the fitted pipeline and the lookups that built its training set.

    With ``pin`` the bundle leases the present snapshot of every feature table it looks up (and
    of the encoder's vocabularies) and scores with these, whatever is written to the tables
    later; ``release_bundle`` ends the leases. ``encoder``: vocabulary tables to encode with before the
    model is applied.
    """
    path = path.rstrip("/")
    spec = training_set.spec()
    if encoder is not None:
        spec["encoder"] = encoder.to_dict()
    if pin:
        tables = [lk.table_name for lk in training_set.feature_lookups] + list(encoder.tables if encoder else ())
        held = {t: lease_snapshot(spark, t, bundle_holder(path)) for t in dict.fromkeys(tables)}
        spec["pinned"] = {t: {"entry": x.entry, "version": x.version} for t, x in held.items()}
        if encoder is not None:
            spec["encoder"]["tables"] = [held[t].entry for t in encoder.tables]
    model.write().overwrite().save(f"{path}/model")
    (spark.createDataFrame([(json.dumps(spec, sort_keys=True),)], "spec string")
     .coalesce(1).write.mode("overwrite").text(f"{path}/spec"))
    return path


def release_bundle(spark: SparkSession, path: str) -> list[str]:
    """End the leases of a pinned bundle that is no longer used; returns the tables."""
    spec = json.loads(spark.read.text(f"{path.rstrip('/')}/spec").first()[0])
    return [t for t in spec.get("pinned", {}) if release_snapshot(spark, t, bundle_holder(path))]


def load_bundle(spark: SparkSession, path: str) -> ModelBundle:
    path = path.rstrip("/")
    spec = json.loads(spark.read.text(f"{path}/spec").first()[0])
    return ModelBundle(PipelineModel.load(f"{path}/model"), spec)


def score_batch(spark: SparkSession, bundle: ModelBundle | str, df: DataFrame,
                skew: SkewPolicy | None = None) -> DataFrame:
    """Attach the bundle's features to ``df`` (ids only are needed) and predict.

    One output row per input row: the input columns, the looked-up features
    and ``prediction``.  Unknown ids get NULL features, which the pipeline
    fills as it did in training.
    """
    if isinstance(bundle, str):
        bundle = load_bundle(spark, bundle)
    joined = attach_features(spark, df, bundle.lookups, skew)
    if bundle.encoder is not None:
        return bundle.model.transform(encode(spark, joined, bundle.encoder, skew)).select(*joined.columns, "prediction")
    return bundle.model.transform(joined).select(*joined.columns, "prediction")


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """All columns of ``df`` except the excluded ones (label, keys), in order."""
    return [c for c in df.columns if c not in set(exclude)]


def train_and_save(spark: SparkSession, training_set: TrainingSet, path: str, split_key: str,
                   categorical: Sequence[str], numeric: Sequence[str], binary: Sequence[str],
                   max_categories: int | None = None, **gbt_params) -> tuple[str, DataFrame]:
    """The whole training workflow on the cluster.

    Split the training set by ``split_key`` (25 % test), fit on the training
    part, compute weighted precision/recall/F1 for both parts, refit on all
    rows, and save the final model with the training set's lookups.  Returns
    the bundle path and the metrics (``part, metric, value, value_rounded``),
    already computed.  Columns not listed in any of the three kinds are not
    used by the model.
    """
    label = training_set.label
    data = training_set.load_df()
    listed = list(categorical) + list(numeric) + list(binary)
    unknown = [c for c in listed + [split_key] if c not in data.columns]
    if unknown:
        raise ValueError(f"columns {unknown} are not in the training set")
    pipeline = build_pipeline(categorical, numeric, binary, label, **gbt_params)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)       # the joins run once for all three fits and evaluations
    try:
        train, test = split_train_test(data, split_key)
        _, metrics = fit_and_evaluate(pipeline, train, test, label, categorical=categorical,
                                      max_categories=max_categories)
        final = fit_pipeline(pipeline, data, categorical, max_categories)
    finally:
        data.unpersist()
    return save_bundle(spark, final, path, training_set), metrics
