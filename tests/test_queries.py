"""Registered queries against their SQL oracles, and plan properties."""

import pytest

from tools.check import compare, duck
from larder.plans.oracles import ORACLES
from larder.plans.queries import QUERIES
from tests.conftest import SF_SMALL

import __spark_entry__ as entry_module

MODEL_QUERIES = {"gbt_fit_score", "model_bundle", "score_batch"}       # MLlib transforms: their plans hold no Python either, but fits are slow


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_registry_consistent():
    q, o = entry_module.queries(), entry_module.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(q)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, SF_SMALL, name)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODEL_QUERIES))
def test_no_python_in_plan(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.columns[0] == "quality" and df.count() > 0


def test_bucketed_lookup_shuffles_input_only(spark, db):
    """With broadcast off (as for a large table), the bucketed feature table is not shuffled."""
    from larder.operators import FeatureLookup, SkewPolicy, attach_features, save_features
    from larder.plans.derive import doc_text_features
    from larder.plans.tables import table
    name = f"{db}.text"
    save_features(spark, name, doc_text_features(table(spark, SF_SMALL, "documents")), "doc_id", buckets=8)
    labels = table(spark, SF_SMALL, "labels").select("doc_id", "quality")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = attach_features(spark, labels, [FeatureLookup(name, ["first_word", "n_lines"])], SkewPolicy(enabled=False))
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 1      # the labels side only
    assert "Bucketed: true" in plan


def test_upsert_does_not_shuffle_the_table(spark, db):
    """The bucketed target is read in place; only the source is shuffled (keys for the anti join, rows for the write)."""
    from larder.operators import save_features
    from larder.operators.feature_table import align_to, upsert_plan
    from larder.plans.queries import _segment_versions
    target, source = _segment_versions(spark, SF_SMALL)
    name = f"{db}.cust"
    save_features(spark, name, target, "PassengerId", buckets=8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        t = spark.table(name)
        merged = upsert_plan(t, align_to(source, t.schema).repartition(8, "PassengerId"), ["PassengerId"])
        merged.collect()
        plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "LeftAnti" in plan and "Bucketed: true" in plan
    exchanges = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
    assert len(exchanges) == 2
