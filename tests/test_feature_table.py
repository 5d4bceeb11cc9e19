"""Feature tables: create if absent, key checks, upsert, overwrite, drop."""

import pytest

from larder.operators import (
    create_feature_table,
    drop_feature_table,
    feature_table_exists,
    get_feature_table,
    save_features,
    write_feature_table,
)
from larder.sources.storage import path_exists

SCHEMA = "k string, a double, b string"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(spark, name):
    return {r["k"]: (r["a"], r["b"]) for r in spark.table(name).collect()}


def test_create_if_absent(spark, db):
    name = f"{db}.ft"
    df = _df(spark, [("1", 1.0, "x")])
    assert create_feature_table(spark, name, "k", df.schema, "first") is True
    assert create_feature_table(spark, name, "k", df.schema, "second") is False
    ft = get_feature_table(spark, name)
    assert ft.primary_keys == ("k",) and ft.description == "first" and ft.version == 0
    assert spark.table(name).count() == 0


def test_unknown_key_column(spark, db):
    with pytest.raises(ValueError):
        create_feature_table(spark, f"{db}.bad", "nope", _df(spark, []).schema)


def test_upsert_semantics(spark, db):
    name = f"{db}.ft"
    save_features(spark, name, _df(spark, [("1", 1.0, "x"), ("2", 2.0, "y")]), "k")
    write_feature_table(spark, name, _df(spark, [("2", None, "z"), ("3", 3.0, None)]))
    # key in both -> source row (its NULLs too); only target -> kept; only source -> added
    assert _rows(spark, name) == {"1": (1.0, "x"), "2": (None, "z"), "3": (3.0, None)}
    assert get_feature_table(spark, name).rows == 3      # counted while writing


def test_upsert_twice_equals_once(spark, db):
    src = _df(spark, [("2", 5.0, "q"), ("9", 9.0, "n")])
    a, b = f"{db}.once", f"{db}.twice"
    for name, times in ((a, 1), (b, 2)):
        save_features(spark, name, _df(spark, [("1", 1.0, "x"), ("2", 2.0, "y")]), "k")
        for _ in range(times):
            write_feature_table(spark, name, src)
    assert _rows(spark, a) == _rows(spark, b)


def test_upsert_into_empty_is_source(spark, db):
    src = _df(spark, [("1", 1.0, "x"), ("2", None, None)])
    name = f"{db}.empty"
    save_features(spark, name, src, "k")
    assert _rows(spark, name) == {"1": (1.0, "x"), "2": (None, None)}


@pytest.mark.parametrize("rows,kind", [([("1", 1.0, "x"), ("1", 2.0, "y")], "duplicate"),
                                       ([(None, 1.0, "x")], "NULL")])
def test_bad_source_keys_raise(spark, db, rows, kind):
    name = f"{db}.ft"
    save_features(spark, name, _df(spark, [("1", 1.0, "x")]), "k")
    with pytest.raises(ValueError, match=kind):
        write_feature_table(spark, name, _df(spark, rows))
    assert _rows(spark, name) == {"1": (1.0, "x")}    # table unchanged


def test_columns_must_match(spark, db):
    name = f"{db}.ft"
    save_features(spark, name, _df(spark, [("1", 1.0, "x")]), "k")
    with pytest.raises(ValueError):
        write_feature_table(spark, name, spark.createDataFrame([("1", 1.0)], "k string, a double"))
    with pytest.raises(ValueError):
        write_feature_table(spark, name, spark.createDataFrame([("1", 1.0, "x", 1)], SCHEMA + ", extra int"))


def test_source_columns_reordered_and_cast(spark, db):
    name = f"{db}.ft"
    save_features(spark, name, _df(spark, [("1", 1.0, "x")]), "k")
    src = spark.createDataFrame([("y", 2, "1")], "b string, a int, k string")
    write_feature_table(spark, name, src)
    assert _rows(spark, name) == {"1": (2.0, "y")}


def test_overwrite_mode(spark, db):
    name = f"{db}.ft"
    save_features(spark, name, _df(spark, [("1", 1.0, "x"), ("2", 2.0, "y")]), "k")
    write_feature_table(spark, name, _df(spark, [("3", 3.0, "z")]), mode="overwrite")
    assert _rows(spark, name) == {"3": (3.0, "z")}
    with pytest.raises(ValueError):
        write_feature_table(spark, name, _df(spark, []), mode="append")


def test_snapshots_and_retention(spark, db):
    from larder.operators.feature_table import snapshot_version
    from larder.sources.storage import list_children
    name = f"{db}.ft"
    save_features(spark, name, _df(spark, [("1", 1.0, "x")]), "k")
    for i in range(3):
        write_feature_table(spark, name, _df(spark, [(str(i), float(i), "v")]))
    ft = get_feature_table(spark, name)
    assert ft.version == 4 and path_exists(spark, ft.location)
    kept = sorted(snapshot_version(p) for p in list_children(spark, ft.base))
    assert kept == [3, 4]                 # current one plus one older snapshot


def test_stale_version_property_cannot_clobber_current(spark, db):
    """A writer that died after moving the location but before the version property."""
    from larder.operators.feature_table import PROP_VERSION
    name = f"{db}.ft"
    save_features(spark, name, _df(spark, [("1", 1.0, "x")]), "k")
    write_feature_table(spark, name, _df(spark, [("2", 2.0, "y")]))
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PROP_VERSION}' = '0')")
    write_feature_table(spark, name, _df(spark, [("3", 3.0, "z")]))
    assert _rows(spark, name) == {"1": (1.0, "x"), "2": (2.0, "y"), "3": (3.0, "z")}


def test_bucketed_snapshot_one_file_per_bucket_per_part(spark, db):
    name = f"{db}.ft"
    rows = [(str(i), float(i), "v") for i in range(200)]
    save_features(spark, name, _df(spark, rows), "k", buckets=4)
    write_feature_table(spark, name, _df(spark, rows[:50]))
    files = [f for f in spark.table(name).inputFiles()]
    assert len(files) <= 8
    desc = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert desc.get("Num Buckets") == "4"
    assert spark.table(name).count() == 200


def test_drop(spark, db):
    name = f"{db}.ft"
    ft = save_features(spark, name, _df(spark, [("1", 1.0, "x")]), "k")
    assert drop_feature_table(spark, name) is True
    assert not feature_table_exists(spark, name) and not path_exists(spark, ft.base)
    assert drop_feature_table(spark, name) is False


def test_write_back_a_frame_read_from_the_table(spark, db):
    """Recompute a column from the table itself; a plain overwrite of a table read in the same plan is refused."""
    from pyspark.sql import functions as F
    name = f"{db}.ft"
    save_features(spark, name, _df(spark, [("1", 1.0, "x"), ("2", 2.0, "y")]), "k")
    write_feature_table(spark, name, spark.table(name).withColumn("a", F.col("a") * 10))
    assert _rows(spark, name) == {"1": (10.0, "x"), "2": (20.0, "y")}
    write_feature_table(spark, name, spark.table(name).where("k = '1'"), mode="overwrite")
    assert _rows(spark, name) == {"1": (10.0, "x")}


def test_drop_refuses_a_plain_table(spark, db):
    spark.createDataFrame([(1,)], "a int").write.saveAsTable(f"{db}.plain")
    with pytest.raises(ValueError, match="not a feature table"):
        drop_feature_table(spark, f"{db}.plain")
    assert spark.table(f"{db}.plain").count() == 1


def test_pruning_keeps_the_snapshot_of_readers(spark, db):
    """A dead writer's folder has the newest number; the snapshot the table pointed to before must stay all the same."""
    from larder.sources.storage import list_children
    name = f"{db}.ft"
    save_features(spark, name, _df(spark, [("1", 1.0, "x")]), "k")
    write_feature_table(spark, name, _df(spark, [("2", 2.0, "y")]))
    before = get_feature_table(spark, name)
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{before.base}/v000003-deadbeef")
    reader = spark.read.parquet(before.location)
    write_feature_table(spark, name, _df(spark, [("3", 3.0, "z")]))
    folders = {p.rstrip("/").rsplit("/", 1)[-1] for p in list_children(spark, before.base)}
    assert "v000003-deadbeef" not in folders
    assert before.location.rsplit("/", 1)[-1] in folders and reader.count() == 2


@pytest.mark.parametrize("schema,value", [("k string, a string, b string", ("1", "1.5", "x")),
                                          ("k string, a decimal(30,10), b string", None), ("k int, a double, b string", (1, 1.0, "x"))])
def test_lossy_source_types_raise(spark, db, schema, value):
    name = f"{db}.ft"
    save_features(spark, name, _df(spark, [("1", 1.0, "x")]), "k")
    with pytest.raises(ValueError, match="without loss"):
        write_feature_table(spark, name, spark.createDataFrame([value] if value else [], schema))
    assert _rows(spark, name) == {"1": (1.0, "x")}


def test_double_into_int_raises(spark, db):
    name = f"{db}.ints"
    save_features(spark, name, spark.createDataFrame([("1", 1)], "k string, a int"), "k")
    with pytest.raises(ValueError, match="without loss"):
        write_feature_table(spark, name, spark.createDataFrame([("1", 1.9)], "k string, a double"))


def test_widening():
    from pyspark.sql import types as T
    from larder.operators.feature_table import widens
    good = [(T.IntegerType(), T.LongType()), (T.IntegerType(), T.DoubleType()), (T.FloatType(), T.DoubleType()),
            (T.IntegerType(), T.DecimalType(12, 2)), (T.DecimalType(5, 2), T.DecimalType(7, 3)), (T.NullType(), T.StringType())]
    bad = [(T.LongType(), T.IntegerType()), (T.LongType(), T.DoubleType()), (T.DoubleType(), T.FloatType()),
           (T.StringType(), T.IntegerType()), (T.IntegerType(), T.StringType()), (T.DecimalType(7, 3), T.DecimalType(5, 2))]
    assert all(widens(a, b) for a, b in good) and not any(widens(a, b) for a, b in bad)


def test_source_is_evaluated_once(spark, db):
    name = f"{db}.ft"
    save_features(spark, name, _df(spark, [("1", 1.0, "x")]), "k")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    source = _df(spark, [(str(i), 1.0, "y") for i in range(20)]).mapInArrow(count, SCHEMA)
    write_feature_table(spark, name, source)
    assert seen.value == 20 and spark.table(name).count() == 20


def test_staged_merge_shuffles_neither_side(spark, db):
    """Table and staged source are bucketed alike: the anti join reads both in place."""
    from larder.operators.feature_table import _drop_entry, _open_snapshot, upsert_plan
    name = f"{db}.ft"
    ft = save_features(spark, name, _df(spark, [(str(i), 1.0, "x") for i in range(50)]), "k", buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    staged, entry = _open_snapshot(spark, db, spark.table(name).schema, ft, ft.location)
    try:
        plan = upsert_plan(spark.table(name), staged, ["k"])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "LeftAnti" in plan
    finally:
        _drop_entry(spark, entry)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_automatic_buckets_follow_the_bytes(spark, db, monkeypatch):
    from larder.operators import feature_table as ft_module
    monkeypatch.setattr(ft_module, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(ft_module, "MIN_BUCKETS", 2)
    name = f"{db}.ft"
    rows = [(str(i), float(i), f"value {i * 7919}") for i in range(4000)]
    small = save_features(spark, name, _df(spark, rows[:5]), "k", "some text")
    assert small.buckets == 2
    grown = write_feature_table(spark, name, _df(spark, rows))
    assert grown.buckets >= 8 and grown.auto_buckets and grown.description == "some text" and grown.rows == 4000
    desc = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert desc.get("Num Buckets") == str(grown.buckets)
    assert _rows(spark, name) == {k: (a, b) for k, a, b in rows}
    again = write_feature_table(spark, name, _df(spark, [("new", 1.0, "n")]))
    assert again.buckets >= grown.buckets and spark.table(name).count() == 4001
    less = write_feature_table(spark, name, _df(spark, rows[:5]), mode="overwrite")
    assert less.buckets < grown.buckets and spark.table(name).count() == 5
    fixed = save_features(spark, f"{db}.fixed", _df(spark, rows), "k", buckets=3)
    assert fixed.buckets == 3


def test_failed_write_leaves_nothing_behind(spark, db):
    from larder.sources.storage import list_children
    name = f"{db}.ft"
    ft = save_features(spark, name, _df(spark, [("1", 1.0, "x")]), "k")
    before = sorted(list_children(spark, ft.base))
    with pytest.raises(ValueError):
        write_feature_table(spark, name, _df(spark, [("2", 1.0, "x"), ("2", 1.0, "x")]))
    assert sorted(list_children(spark, ft.base)) == before
    assert not [t.name for t in spark.catalog.listTables(db) if "stage" in t.name]


def test_row_count_of_another_snapshot_is_not_used(spark, db):
    name = f"{db}.ft"
    first = save_features(spark, name, _df(spark, [("1", 1.0, "x")]), "k")
    write_feature_table(spark, name, _df(spark, [("2", 2.0, "y")]))
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{first.location}'")
    assert get_feature_table(spark, name).rows is None


def test_key_names_may_hold_commas(spark, db):
    df = spark.createDataFrame([("1", "2", 3.0)], "`a,b` string, c string, v double")
    ft = save_features(spark, f"{db}.odd", df, ["a,b", "c"], buckets=None)
    assert ft.primary_keys == ("a,b", "c") and spark.table(f"{db}.odd").count() == 1


def test_database_keeps_its_catalog(spark):
    from larder.sources.storage import split_name
    assert split_name(spark, "cat.db.t") == ("cat.db", "t") and split_name(spark, "db.t") == ("db", "t")
