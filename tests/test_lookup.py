"""Lookups and training sets: LEFT semantics, pruning, hot-key splitting."""

import pytest
from pyspark.sql import functions as F

from larder.operators import (
    FeatureLookup,
    SkewPolicy,
    attach_features,
    create_training_set,
    save_features,
)
from larder.operators.skew import HOT, profile_keys


@pytest.fixture
def tables(spark, db):
    ticket = spark.createDataFrame([("1", "C", 7.0), ("2", None, 71.0), ("3", "B", 8.0)],
                                   "PassengerId string, CabinChar string, FareRounded double")
    demo = spark.createDataFrame([("1", "Mr", 22.0), ("2", "Mrs", None), ("4", "Miss", 4.0)],
                                 "PassengerId string, NamePrefix string, Age double")
    save_features(spark, f"{db}.ticket", ticket, "PassengerId")
    save_features(spark, f"{db}.demo", demo, "PassengerId")
    return f"{db}.ticket", f"{db}.demo"


def _lookups(t, d):
    return [FeatureLookup(t, ["CabinChar", "FareRounded"], "PassengerId"),
            FeatureLookup(d, ["NamePrefix", "Age"], "PassengerId")]


def test_training_set_left_semantics(spark, tables):
    labels = spark.createDataFrame([("1", 1), ("3", 0), ("4", 1), ("9", 0)], "PassengerId string, Survived int")
    ts = create_training_set(spark, labels, _lookups(*tables), label="Survived", exclude_columns=["PassengerId"])
    out = ts.load_df()
    assert out.columns == ["Survived", "CabinChar", "FareRounded", "NamePrefix", "Age"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    # id 3 has ticket features only, id 4 demographic only, id 9 none: all rows kept
    assert got == sorted([(1, "C", 7.0, "Mr", 22.0), (0, "B", 8.0, None, None),
                          (1, None, None, "Miss", 4.0), (0, None, None, None, None)], key=repr)


def test_repeated_input_keys_keep_row_count(spark, tables):
    ids = spark.createDataFrame([("1",)] * 5 + [("2",), (None,)], "PassengerId string")
    out = attach_features(spark, ids, _lookups(*tables))
    assert out.count() == 7
    assert out.where(F.col("PassengerId") == "1").select("NamePrefix").distinct().collect()[0][0] == "Mr"


def test_label_and_exclusion_checks(spark, tables):
    labels = spark.createDataFrame([("1", 1)], "PassengerId string, Survived int")
    with pytest.raises(ValueError):
        create_training_set(spark, labels, _lookups(*tables), label="nope")
    with pytest.raises(ValueError):
        create_training_set(spark, labels, _lookups(*tables), label="Survived", exclude_columns=["Survived"])


def test_feature_name_clash(spark, tables):
    t, _ = tables
    df = spark.createDataFrame([("1", "x")], "PassengerId string, CabinChar string")
    with pytest.raises(ValueError):
        attach_features(spark, df, [FeatureLookup(t, ["CabinChar"], "PassengerId")])


def test_lookup_key_with_other_name(spark, tables):
    t, _ = tables
    df = spark.createDataFrame([(1, "1"), (2, "3")], "n int, pid string")
    out = attach_features(spark, df, [FeatureLookup(t, ["FareRounded"], "pid")])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "1", 7.0), (2, "3", 8.0)]


def test_same_table_lookups_merge_and_empty_lookup_skipped(spark, tables):
    t, d = tables
    ids = spark.createDataFrame([("1",)], "PassengerId string")
    lookups = [FeatureLookup(t, ["CabinChar"]), FeatureLookup(t, ["FareRounded"]), FeatureLookup(d, [])]
    out = attach_features(spark, ids, lookups, SkewPolicy(enabled=False))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1
    assert out.columns == ["PassengerId", "CabinChar", "FareRounded"]


def test_only_requested_columns_are_read(spark, tables):
    t, _ = tables
    ids = spark.createDataFrame([("1",)], "PassengerId string")
    out = attach_features(spark, ids, [FeatureLookup(t, ["FareRounded"])], SkewPolicy(enabled=False))
    scans = [ln for ln in out._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in ln]
    assert scans and all("CabinChar" not in ln for ln in scans)


def _skewed_orders(spark, sf):
    from larder.plans.tables import table
    # a third of all orders carry one customer id, and a tenth carry no id at all
    orders = table(spark, sf, "orders")
    cust = (F.when(F.col("o_orderkey") % 3 == 0, F.lit(7))
            .when(F.col("o_orderkey") % 10 == 1, F.lit(None))
            .otherwise(F.col("o_custkey")))
    return orders.select("o_orderkey", cust.cast("string").alias("cust_id"))


def _customer_table(spark, db):
    from tests.conftest import SF_SMALL
    from larder.plans.derive import customer_demographic_features
    from larder.plans.tables import table
    name = f"{db}.cust"
    save_features(spark, name, customer_demographic_features(table(spark, SF_SMALL, "customer")), "PassengerId")
    return name, _skewed_orders(spark, SF_SMALL)


def _norm(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def no_auto_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = spark.conf.get(names[0])
    for n in names:
        spark.conf.set(n, "-1")
    yield
    spark.conf.set(names[0], before)
    spark.conf.unset(names[1])


@pytest.mark.parametrize("policy", [
    SkewPolicy(hot_key_rows=100, point_lookup_keys=0),                              # many keys
    SkewPolicy(hot_key_rows=100, max_broadcast_bytes=0),                            # few keys, nothing proven small
    SkewPolicy(hot_key_rows=100, max_broadcast_bytes=2000),                         # hot keys in several blocks
    SkewPolicy(hot_key_rows=100, literal_keys=0, max_broadcast_bytes=0),
    SkewPolicy(hot_key_rows=1, max_hot_keys=3, point_lookup_keys=0),                # the threshold rises
    SkewPolicy(hot_key_rows=5, point_lookup_keys=0),                                # many hot keys
], ids=["many", "few-unproven", "blocks", "few-semi", "raised", "many-hot"])
@pytest.mark.parametrize("ids_only", [False, True], ids=["rows", "ids"])
def test_hot_keys_are_joined_apart_on_every_path(spark, db, no_auto_broadcast, policy, ids_only):
    name, df = _customer_table(spark, db)
    df = df.select("cust_id") if ids_only else df
    lookups = [FeatureLookup(name, ["NamePrefix", "Age"], "cust_id")]
    split = attach_features(spark, df, lookups, policy)
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert HOT in plan and HOT not in split.columns
    assert split.columns == [*df.columns, "NamePrefix", "Age"]
    assert _norm(split) == _norm(attach_features(spark, df, lookups, SkewPolicy(enabled=False)))


def test_hot_rows_and_the_bucketed_table_are_not_shuffled(spark, db, no_auto_broadcast):
    """Only the rest rows are shuffled; hot rows of a (key, 0/1 label) frame stay spread as they were read."""
    name, df = _customer_table(spark, db)
    labelled = df.withColumn("label", F.col("o_orderkey") % 2).drop("o_orderkey").repartition(8)
    out = attach_features(spark, labelled, [FeatureLookup(name, ["Age"], "cust_id")],
                          SkewPolicy(hot_key_rows=100, point_lookup_keys=0))
    lines = out._jdf.queryExecution().executedPlan().toString().split("Final Plan")[-1].splitlines()
    exchanges = [n for n, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    for n in exchanges:         # below an exchange by key stands the orders scan, never the feature table
        below = next(ln for ln in lines[n:] if "FileScan" in ln)
        assert "PassengerId" not in below
    sizes = out.where("cust_id = '7'").rdd.glom().map(len).collect()
    assert max(sizes) <= sum(sizes) / 4


def test_no_cap_on_hot_keys(spark):
    df = spark.createDataFrame([(str(i % 5),) for i in range(100)] + [(None,)] * 30, "k string")
    p = profile_keys(df, ["k"], SkewPolicy(hot_key_rows=10))
    assert p.n_hot == 5 and p.null_rows == 30 and p.rows == 130 and p.distinct == 6
    raised = profile_keys(df, ["k"], SkewPolicy(hot_key_rows=10, max_hot_keys=4))
    assert raised.hot.count() <= 4
    assert profile_keys(df, ["k"], SkewPolicy(enabled=False)) is None


def test_two_lookup_keys_are_profiled_on_the_input(spark, tables):
    """The second profile counts the input's own keys: no join runs while the frame is built."""
    t, d = tables
    df = spark.createDataFrame([("1", "2"), ("3", "1")], "a string, b string")
    out = attach_features(spark, df, [FeatureLookup(t, ["CabinChar"], "a"), FeatureLookup(d, ["Age"], "b")])
    assert _norm(out) == [("1", "2", "C", None), ("3", "1", "B", 22.0)]


def test_key_type_mismatch_raises(spark, tables):
    t, _ = tables
    df = spark.createDataFrame([(1,)], "PassengerId int")
    with pytest.raises(ValueError, match="types differ"):
        attach_features(spark, df, [FeatureLookup(t, ["FareRounded"])])


def test_point_lookup_prunes_buckets(spark, db):
    """A few ids read only their buckets: files of other buckets may even be gone."""
    import glob
    import os
    from tests.conftest import SF_SMALL
    from larder.plans.derive import doc_text_features
    from larder.plans.tables import table
    name = f"{db}.text"
    ft = save_features(spark, name, doc_text_features(table(spark, SF_SMALL, "documents")), "doc_id", buckets=8)
    ids = spark.createDataFrame([(1,), (5,), (7,), (1,)], "doc_id bigint")
    lookups = [FeatureLookup(name, ["first_word", "n_lines"])]
    expected = sorted((tuple(r) for r in attach_features(spark, ids, lookups, SkewPolicy(point_lookup_keys=0)).collect()), key=repr)
    point = attach_features(spark, ids, lookups)
    plan = point._jdf.queryExecution().executedPlan().toString()
    assert "In(doc_id, [1,5,7])" in plan                                   # pushed into the Parquet scan
    wanted = {r[0] for r in ids.select(F.expr("pmod(hash(doc_id), 8)")).collect()}
    for f in glob.glob(ft.location.replace("file:", "") + "/*.parquet"):
        if int(f.rsplit("_", 1)[-1].split(".")[0]) not in wanted:
            os.remove(f)
    spark.catalog.refreshTable(name)
    again = attach_features(spark, ids, lookups)
    assert sorted((tuple(r) for r in again.collect()), key=repr) == expected


def test_profile_counts_distinct_keys(spark):
    df = spark.createDataFrame([(str(i % 4),) for i in range(40)] + [(None,)], "k string")
    p = profile_keys(df, ["k"], SkewPolicy(hot_key_rows=1000, literal_keys=10))
    assert p.distinct == 5 and sorted(p.literals) == [("0",), ("1",), ("2",), ("3",)] and p.hot is None
    assert profile_keys(df, ["k"], SkewPolicy(literal_keys=3)).literals is None
    p2 = profile_keys(df, ["k"], SkewPolicy(hot_key_rows=5, literal_keys=10))
    assert sorted(p2.literals) == [("0",), ("1",), ("2",), ("3",)] and p2.hot.count() == 4


def test_semi_join_regime_same_rows(spark, tables):
    t, d = tables
    ids = spark.createDataFrame([("1",), ("3",), ("9",), (None,), ("1",)], "PassengerId string")
    semi = attach_features(spark, ids, _lookups(t, d), SkewPolicy(literal_keys=0))
    plan = semi._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "SortMergeJoin" not in plan
    plain = attach_features(spark, ids, _lookups(t, d), SkewPolicy(enabled=False))
    norm = lambda d_: sorted((tuple(r) for r in d_.collect()), key=repr)
    assert norm(semi) == norm(plain)


def test_literal_filter_quotes(spark):
    from larder.operators.skew import literal_filter
    df = spark.createDataFrame([("a'b",), ("c\\d",), ("e",)], "k string")
    got = sorted(r[0] for r in df.where(literal_filter("k", [("a'b",), ("c\\d",)])).collect())
    assert got == ["a'b", "c\\d"]


def test_point_path_broadcasts_even_with_hot_keys(spark, db):
    name, df = _customer_table(spark, db)
    lookups = [FeatureLookup(name, ["NamePrefix", "Age"], "cust_id")]
    point = attach_features(spark, df, lookups, SkewPolicy(hot_key_rows=100))
    plan = point._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and HOT not in plan
    assert _norm(point) == _norm(attach_features(spark, df, lookups, SkewPolicy(enabled=False)))


def test_point_broadcast_needs_a_byte_bound(spark, tables):
    """A filtered table is broadcast only when rows x stored row size stays under the bound."""
    from larder.operators import get_feature_table
    t, d = tables
    assert get_feature_table(spark, t).rows == 3
    ids = spark.createDataFrame([("1",), ("3",)], "PassengerId string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = attach_features(spark, ids, _lookups(t, d), SkewPolicy(max_broadcast_bytes=1))
        small = attach_features(spark, ids, _lookups(t, d))
        big_plan = big._jdf.queryExecution().executedPlan().toString()
        small_plan = small._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(repr, big.collect())) == sorted(map(repr, small.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in big_plan
    assert "BroadcastHashJoin" in small_plan
