"""Split, id limit, imputers, vocabularies and one-hot encoding."""

import math

import pytest
from pyspark.sql import functions as F

from larder.operators.prepare import (
    check_cardinality,
    fit_one_hot,
    mode_imputer,
    one_hot_columns,
    split_is_test,
    split_train_test,
    take_ids,
    vocabulary,
)
from tests.conftest import SF_SMALL


def _orders(spark):
    from larder.plans.tables import table
    return table(spark, SF_SMALL, "orders")


def test_split_disjoint_complete_and_about_a_quarter(spark):
    orders = _orders(spark)
    train, test = split_train_test(orders, "o_orderkey")
    n, a, b = orders.count(), train.count(), test.count()
    assert a + b == n
    assert train.join(test, "o_orderkey").count() == 0
    assert 0.18 < b / n < 0.32


def test_split_does_not_depend_on_partitioning(spark):
    orders = _orders(spark)
    a = {r[0] for r in orders.where(split_is_test("o_orderkey")).select("o_orderkey").collect()}
    b = {r[0] for r in orders.repartition(7, "o_custkey").where(split_is_test("o_orderkey"))
         .select("o_orderkey").collect()}
    assert a == b


def test_take_ids_is_ordered(spark):
    ids = [r[0] for r in take_ids(_orders(spark), "o_orderkey", 20).collect()]
    assert ids == sorted(ids) and len(ids) == 20
    assert ids[0] == _orders(spark).agg(F.min("o_orderkey")).first()[0]


def test_mode_ties_smallest_and_gaps_filled(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 3.0), (3, 1.0), (4, 1.0), (5, None), (6, float("nan")), (7, 9.0)],
                               "k int, v double")
    out = mode_imputer(["v"]).fit(df).transform(df)
    got = {r["k"]: r["v__imputed"] for r in out.collect()}
    assert got[5] == 1.0 and got[6] == 1.0 and got[7] == 9.0


def test_mode_ignores_null_and_nan_in_counts(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, None), (4, float("nan")), (5, float("nan"))],
                               "k int, v double")
    out = mode_imputer(["v"]).fit(df).transform(df)
    assert {r["v__imputed"] for r in out.collect()} == {2.0}


def test_one_hot_unseen_zero_and_null_missing(spark):
    fit_rows = spark.createDataFrame([("S",), ("C",), (None,)], "e string")
    model = fit_one_hot(fit_rows, ["e"])
    rows = spark.createDataFrame([(1, "S"), (2, "Q"), (3, None), (4, "C")], "k int, e string")
    out = one_hot_columns(model, rows, ["e"], keep=["k"])
    assert out.columns == ["k", "e_C", "e_S", "e_missing"]
    got = {r["k"]: tuple(r)[1:] for r in out.collect()}
    assert got == {1: (0.0, 1.0, 0.0), 2: (0.0, 0.0, 0.0), 3: (0.0, 0.0, 1.0), 4: (1.0, 0.0, 0.0)}


def test_vocabulary_alphabetical(spark):
    df = spark.createDataFrame([("b", "y"), ("a", "x"), ("c", None), ("a", "x")], "p string, q string")
    got = sorted(tuple(r) for r in vocabulary(df, ["p", "q"]).collect())
    assert got == [("p", "a", 0.0), ("p", "b", 1.0), ("p", "c", 2.0), ("q", "x", 0.0), ("q", "y", 1.0)]
    assert not any(math.isnan(v[2]) for v in got)


def test_cardinality_guard(spark):
    import pytest
    df = spark.range(500).select(F.col("id").cast("string").alias("c"), F.lit("x").alias("d"))
    check_cardinality(df, ["d"], max_categories=10)
    with pytest.raises(ValueError, match="too many categories"):
        check_cardinality(df, ["c", "d"], max_categories=10)
    with pytest.raises(ValueError):
        check_cardinality(df, ["c"], 100)


def test_split_null_key_goes_to_training(spark):
    df = spark.createDataFrame([(None,), ("1",), ("2",)], "k string")
    train, test = split_train_test(df, "k")
    assert train.count() + test.count() == 3
    assert train.where(F.col("k").isNull()).count() == 1


def test_split_shares_at_the_ends(spark):
    df = spark.range(10_000).withColumnRenamed("id", "k")
    for share, rows in ((0.0, 0), (1.0, 10_000)):
        train, test = split_train_test(df, "k", test_share=share)
        assert test.count() == rows and train.count() == 10_000 - rows
    with pytest.raises(ValueError, match="test_share"):
        split_train_test(df, "k", test_share=1.5)


def test_vocabulary_reads_its_input_once_and_collects_nothing(spark):
    from larder.operators.prepare import vocabulary
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.createDataFrame([(f"a{i % 700:04d}", str(i % 3), None) for i in range(3000)], "x string, y string, z string")
    out = vocabulary(df.mapInArrow(count, df.schema), ["x", "y", "z"]).collect()
    assert seen.value in (3000, 6000)            # once, and once more for the sample of the range sort
    by_col = {}
    for r in out:
        by_col.setdefault(r["column_name"], []).append((r["category_index"], r["category"]))
    assert sorted(by_col["x"]) == [(float(i), f"a{i:04d}") for i in range(700)]
    assert sorted(by_col["y"]) == [(0.0, "0"), (1.0, "1"), (2.0, "2")] and "z" not in by_col
