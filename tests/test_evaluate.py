"""Weighted metrics against MLlib's evaluator."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from larder.operators.evaluate import weighted_prf


@pytest.mark.parametrize("pairs", [
    [(1, 1), (1, 0), (0, 0), (0, 0), (1, 1), (0, 1), (1, 1)],
    [(0, 0), (0, 0), (1, 0)],                       # class 1 never predicted
    [(0, 0), (1, 1), (2, 1), (2, 2), (2, 2)],       # three classes
])
def test_matches_mllib(spark, pairs):
    df = spark.createDataFrame([(float(y), float(p)) for y, p in pairs], "label double, prediction double")
    got = {r["metric"]: r["value"] for r in weighted_prf(df).collect()}
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert got["precision"] == pytest.approx(ev.setMetricName("weightedPrecision").evaluate(df))
    assert got["recall"] == pytest.approx(ev.setMetricName("weightedRecall").evaluate(df))
    assert got["f1"] == pytest.approx(ev.setMetricName("weightedFMeasure").evaluate(df))


def test_rounded_column(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0)], "label int, prediction int")
    rows = {r["metric"]: (r["value"], r["value_rounded"]) for r in weighted_prf(df).collect()}
    for v, r in rows.values():
        assert r == round(v, 2)


def test_metrics_read_their_input_once(spark):
    from larder.operators.evaluate import weighted_prf
    df = spark.range(100).selectExpr("id % 3 AS label", "id % 2 AS prediction")
    plan = weighted_prf(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Range (") == 1
