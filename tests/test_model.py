"""Pipeline fit, evaluation, bundles and batch scoring (few rounds to stay quick)."""

from pyspark.sql import functions as F

from larder.operators import FeatureLookup, create_training_set, save_features
from larder.operators.model import (
    build_pipeline,
    feature_columns,
    fit_and_evaluate,
    load_bundle,
    save_bundle,
    score_batch,
    train_and_save,
)
from larder.operators.prepare import split_train_test
from larder.plans.derive import doc_meta_features, doc_text_features
from larder.plans.tables import table
from larder.session import scratch_path
from tests.conftest import SF_SMALL


def _training(spark, db):
    docs = table(spark, SF_SMALL, "documents")
    save_features(spark, f"{db}.text", doc_text_features(docs), "doc_id")
    save_features(spark, f"{db}.meta", doc_meta_features(docs), "doc_id")
    labels = table(spark, SF_SMALL, "labels").select("doc_id", "quality")
    lookups = [FeatureLookup(f"{db}.text", ["first_word", "n_lines", "size_rounded"], "doc_id"),
               FeatureLookup(f"{db}.meta", ["lang"], "doc_id")]
    return create_training_set(spark, labels, lookups, label="quality")


def _pipeline():
    return build_pipeline(["first_word", "lang"], ["n_lines", "size_rounded"], [], "quality", max_iter=3, max_depth=3)


def test_fit_evaluate_six_metrics(spark, db):
    ts = _training(spark, db)
    train, test = split_train_test(ts.load_df(), "doc_id")
    _, metrics = fit_and_evaluate(_pipeline(), train, test, "quality")
    rows = metrics.collect()
    assert len(rows) == 6 and {r["part"] for r in rows} == {"training", "testing"}
    assert all(0.0 <= r["value"] <= 1.0 for r in rows)


def test_bundle_round_trip_and_scoring(spark, db):
    ts = _training(spark, db)
    model = _pipeline().fit(ts.load_df())
    path = save_bundle(spark, model, scratch_path(spark, "bundle-test"), ts)
    bundle = load_bundle(spark, path)
    assert bundle.spec == ts.spec()
    ids = table(spark, SF_SMALL, "documents").select("doc_id")
    ids = ids.unionByName(spark.range(1).select(F.lit(-5).cast("bigint").alias("doc_id")))
    scored = score_batch(spark, path, ids)
    assert scored.columns[:1] == ["doc_id"] and "prediction" in scored.columns
    assert scored.count() == ids.count()
    unknown = scored.where(F.col("doc_id") == -5).first()
    assert unknown["first_word"] is None and unknown["prediction"] in (0.0, 1.0)
    # scoring through the loaded bundle equals the in-memory model on the same rows
    direct = model.transform(ts.load_df()).select("prediction").collect()
    replay = score_batch(spark, bundle, table(spark, SF_SMALL, "labels").select("doc_id", "quality"))
    assert sorted(r[0] for r in direct) == sorted(r[0] for r in replay.select("prediction").collect())


def test_train_and_save_workflow(spark, db):
    ts = _training(spark, db)
    path, metrics = train_and_save(spark, ts, scratch_path(spark, "bundle-wf"), "doc_id",
                                   ["first_word", "lang"], ["n_lines", "size_rounded"], [],
                                   max_iter=2, max_depth=2)
    assert metrics.count() == 6
    scored = score_batch(spark, path, table(spark, SF_SMALL, "labels").select("doc_id"))
    assert scored.count() == table(spark, SF_SMALL, "labels").count()
    assert feature_columns(ts.load_df(), ["quality", "doc_id"]) == ["first_word", "n_lines", "size_rounded", "lang"]
