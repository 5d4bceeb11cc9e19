"""Micro-batch upsert from a file stream into a feature table."""

from pyspark.sql import functions as F

from larder.operators import save_features
from larder.session import scratch_path
from larder.streaming import latest_per_key, upsert_batch_writer


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 3, 3.0), ("b", 2, 2.0), ("a", 2, 2.5)], "k string, ts int, v double")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], "ts").collect())
    assert got == [("a", 3, 3.0), ("b", 2, 2.0)]


def test_stream_upsert(spark, db):
    name = f"{db}.ft"
    save_features(spark, name, spark.createDataFrame([("a", 0, 0.0), ("z", 0, 9.0)], "k string, ts int, v double"), "k")
    src = scratch_path(spark, "stream-src")
    spark.createDataFrame([("a", 1, 1.0), ("b", 1, 1.0), ("a", 2, 2.0)], "k string, ts int, v double") \
        .write.parquet(f"{src}/batch1")
    stream = spark.readStream.schema("k string, ts int, v double").parquet(f"{src}/batch1")
    q = (stream.writeStream.foreachBatch(upsert_batch_writer(name, latest_by="ts"))
         .option("checkpointLocation", scratch_path(spark, "stream-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {r["k"]: r["v"] for r in spark.table(name).collect()}
    assert got == {"a": 2.0, "b": 1.0, "z": 9.0}
    assert spark.table(name).where(F.col("k") == "a").count() == 1


def test_latest_per_key_null_order_and_ties(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", None), (2, "c", 5), (3, "x", 7), (3, "y", 7)], "k int, v string, ts int")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], "ts").collect())
    assert got == [(1, "a", None), (2, "c", 5), (3, "y", 7)]
    again = sorted(tuple(r) for r in latest_per_key(df.orderBy(F.desc("v")).repartition(3), ["k"], "ts").collect())
    assert again == got
