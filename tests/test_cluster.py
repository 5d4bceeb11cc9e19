"""Opt-in: the lookup paths across two executor processes (``local-cluster``).

    LARDER_LOCAL_CLUSTER=1 python -m pytest tests/test_cluster.py -q

Runs in a child process with its own session, since the suite's session is
in-process local mode.
"""

import os
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = textwrap.dedent("""
    import sys
    sys.path.insert(0, %r)
    from pyspark.sql import SparkSession, functions as F
    spark = (SparkSession.builder.master("local-cluster[2,1,2048]")
             .config("spark.checkpoint.dir", "file:" + __import__("tempfile").mkdtemp()).config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.executorEnv.PYTHONPATH", %r).getOrCreate())
    from larder.plans.tables import table, scratch_database
    from larder.plans.derive import customer_demographic_features
    from larder.operators import save_features, FeatureLookup, SkewPolicy, attach_features, write_feature_table
    sf = "/root/testdata/sf0.001"
    db = scratch_database(spark, "cluster")
    name = db + ".cust"
    feats = customer_demographic_features(table(spark, sf, "customer"))
    save_features(spark, name, feats, "PassengerId")
    write_feature_table(spark, name, feats.withColumn("Age", F.col("Age") + 1))
    orders = table(spark, sf, "orders")
    cust = (F.when(F.col("o_orderkey") %% 3 == 0, F.lit(7)).when(F.col("o_orderkey") %% 10 == 1, F.lit(None))
            .otherwise(F.col("o_custkey")))
    df = orders.select("o_orderkey", cust.cast("string").alias("cust_id"))
    lk = [FeatureLookup(name, ["NamePrefix", "Age"], "cust_id")]
    norm = lambda d: sorted((tuple(r) for r in d.collect()), key=repr)
    hot = SkewPolicy(hot_key_rows=100, point_lookup_keys=0)
    for frame, pol in [(df, hot), (df.select("cust_id"), hot), (df, SkewPolicy(literal_keys=0)), (df, SkewPolicy())]:
        assert norm(attach_features(spark, frame, lk, pol)) == norm(attach_features(spark, frame, lk, SkewPolicy(enabled=False)))
    assert len(spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos()) >= 3
    print("CLUSTER-OK")
""") % (str(ROOT), str(ROOT))


@pytest.mark.skipif(os.environ.get("LARDER_LOCAL_CLUSTER") != "1", reason="set LARDER_LOCAL_CLUSTER=1")
def test_lookup_paths_on_two_executors():
    out = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, timeout=900)
    assert "CLUSTER-OK" in out.stdout, out.stderr[-3000:]
