"""Classification metrics as DataFrames.

Weighted precision, recall and F1 follow the usual definitions: per class c,
precision = tp / predicted_c, recall = tp / support_c, F1 = 2pr / (p + r)
(0 where undefined), then a support-weighted mean.  The only aggregate is a
count per (label, prediction) pair, so the data is never collected; the
result has one row per metric.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("precision", "recall", "f1")


def weighted_prf(predictions: DataFrame, label: str = "label", prediction: str = "prediction",
                 decimals: int = 2) -> DataFrame:
    """``(metric, value, value_rounded)`` rows for weighted precision, recall and F1."""
    pairs = predictions.select(F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p"))
    counts = pairs.groupBy("y", "p").agg(F.count(F.lit(1)).cast("double").alias("n"))
    # each (label, prediction) count adds to the label's support and to the predicted class; one pass over the input
    none = F.lit(0.0)
    sides = counts.select(F.explode(F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("support"), none.alias("predicted"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(none).alias("tp")),
        F.struct(F.col("p").alias("c"), none.alias("support"), F.col("n").alias("predicted"), none.alias("tp")))).alias("s"))
    per_class = (sides.select("s.*").groupBy("c")
                 .agg(*[F.sum(x).alias(x) for x in ("support", "predicted", "tp")]).where("support > 0"))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.col("tp") / F.col("support")
    per_class = per_class.select("c", "support", prec.alias("precision"), rec.alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    per_class = per_class.select("c", "support", "precision", "recall", f1.alias("f1"))
    total = F.sum("support")
    wide = per_class.agg(*[(F.sum(F.col("support") * F.col(m)) / total).alias(m) for m in METRICS])
    stacked = wide.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS])).alias("m"))
    return stacked.select("m.metric", "m.value", F.round("m.value", decimals).alias("value_rounded"))
