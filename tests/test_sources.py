"""Typed CSV reads, schemas, casts and whole-table writes."""

import pytest

from larder.session import scratch_path
from larder.sources import cast_columns, create_source_tables, make_schema, read_csv_typed, read_tables, write_table

SCHEMA = make_schema([("PassengerId", "string"), ("Ticket", "string"), ("Fare", "double"),
                      ("Cabin", "string"), ("Embarked", "string")])


def _csv(spark, text):
    path = scratch_path(spark, "csvtest")
    spark.sparkContext.parallelize([text], 1).saveAsTextFile(path)
    return path


def test_blank_is_null_and_ids_are_text(spark):
    path = _csv(spark, "PassengerId,Ticket,Fare,Cabin,Embarked\n001,A/5 21171,7.25,,S\n2,PC 17599,71.2833,C85,\n")
    rows = read_csv_typed(spark, path, SCHEMA).orderBy("PassengerId").collect()
    assert rows[0]["PassengerId"] == "001" and rows[0]["Cabin"] is None
    assert rows[1]["Embarked"] is None and rows[1]["Fare"] == 71.2833


def test_header_mismatch_fails(spark):
    path = _csv(spark, "Id,Ticket,Fare,Cabin,Embarked\n1,x,1.0,,S\n")
    with pytest.raises(Exception):
        read_csv_typed(spark, path, SCHEMA).collect()


def test_read_tables_keys_must_agree(spark):
    with pytest.raises(ValueError):
        read_tables(spark, {"a": "/x"}, {"b": SCHEMA})


def test_make_schema_types():
    s = make_schema([("a", "string"), ("b", "double"), ("c", "int")])
    assert [f.dataType.simpleString() for f in s.fields] == ["string", "double", "int"]
    with pytest.raises(ValueError):
        make_schema([("a", "no_such_type")])


def test_cast_columns_keeps_order(spark):
    df = spark.createDataFrame([(1, 2.0)], "id bigint, v double")
    out = cast_columns(df, {"id": "string"})
    assert out.dtypes == [("id", "string"), ("v", "double")]
    with pytest.raises(ValueError):
        cast_columns(df, {"nope": "string"})


def test_write_table_overwrite(spark, db):
    df = spark.range(5).toDF("k")
    write_table(df, f"{db}.t")
    write_table(spark.range(3).toDF("k"), f"{db}.t")
    assert spark.table(f"{db}.t").count() == 3


def test_create_source_tables(spark, db):
    t = _csv(spark, "PassengerId,Ticket,Fare,Cabin,Embarked\n1,A/5 21171,7.25,,S\n")
    lab = _csv(spark, "PassengerId,Survived\n1,0\n")
    names = create_source_tables(
        spark, {"ticket": t, "labels": lab},
        {"ticket": SCHEMA, "labels": make_schema([("PassengerId", "string"), ("Survived", "int")])},
        {"ticket": f"{db}.passenger_ticket", "labels": f"{db}.passenger_labels"})
    assert spark.table(names["ticket"]).first()["Cabin"] is None
    assert spark.table(names["labels"]).dtypes == [("PassengerId", "string"), ("Survived", "int")]
    create_source_tables(spark, {"labels": lab}, {"labels": make_schema([("PassengerId", "string"), ("Survived", "int")])},
                         {"labels": f"{db}.passenger_labels"})          # replaces, does not append
    assert spark.table(f"{db}.passenger_labels").count() == 1
