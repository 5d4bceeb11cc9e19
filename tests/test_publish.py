"""Publish statement text per database (no database is started in tests)."""

import pytest

from larder.sources.jdbc import JdbcTarget, merge_statement


def test_mysql_upsert():
    s = merge_statement("mysql", "online", "stage", ["id", "a", "b"], ["id"])
    assert s == ("INSERT INTO `online` (`id`, `a`, `b`) SELECT * FROM (SELECT `id`, `a`, `b` FROM `stage`) AS s "
                 "ON DUPLICATE KEY UPDATE `a` = s.`a`, `b` = s.`b`")


def test_postgres_upsert():
    s = merge_statement("postgresql", "online", "stage", ["id", "a"], ["id"])
    assert s == ('INSERT INTO "online" ("id", "a") SELECT "id", "a" FROM "stage" '
                 'ON CONFLICT ("id") DO UPDATE SET "a" = EXCLUDED."a"')


def test_ansi_merge_with_key_cast():
    s = merge_statement("ansi", "online", "stage", ["id", "a"], ["id"], key_expr="CAST({} AS VARCHAR(128))")
    assert s.startswith('MERGE INTO "online" t USING "stage" s ON CAST(t."id" AS VARCHAR(128)) = CAST(s."id" AS VARCHAR(128))')
    assert 'WHEN MATCHED THEN UPDATE SET "a" = s."a"' in s
    assert s.endswith('WHEN NOT MATCHED THEN INSERT ("id", "a") VALUES (s."id", s."a")')


def test_keys_only_table():
    assert "WHEN MATCHED" not in merge_statement("ansi", "t", "s", ["id"], ["id"])
    assert "DO NOTHING" in merge_statement("postgresql", "t", "s", ["id"], ["id"])


def test_unknown_dialect():
    with pytest.raises(ValueError):
        JdbcTarget("jdbc:x://h", "t", {}, dialect="oracle9")


def test_publish_mode_is_checked_before_any_connection(spark):
    from larder.sources.jdbc import publish_table
    df = spark.createDataFrame([("1", 1.0)], "k string, a double")
    target = JdbcTarget("jdbc:none://nowhere", "t", {})
    with pytest.raises(ValueError, match="mode"):
        publish_table(spark, df, target, ["k"], mode="append")


def test_qualified_names_are_quoted_part_by_part():
    from larder.sources.jdbc import quote_table, staging_name
    assert quote_table("mysql", "feature_store.online") == "`feature_store`.`online`"
    assert quote_table("postgresql", 'a.b"c') == '"a"."b""c"'
    name = staging_name("feature_store.online")
    assert name.startswith("feature_store.online_stage_") and name != staging_name("feature_store.online")
    assert "INSERT INTO `fs`.`online`" in merge_statement("mysql", "fs.online", "fs.stage", ["id", "a"], ["id"])


def test_create_declares_a_bounded_key():
    from pyspark.sql import types as T
    from larder.sources.jdbc import create_statement
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()),
                           T.StructField("note", T.StringType()), T.StructField("x", T.DoubleType()),
                           T.StructField("d", T.DecimalType(8, 2))])
    assert create_statement("mysql", "fs.online", schema, ["id"]) == (
        "CREATE TABLE `fs`.`online` (`id` VARCHAR(255) NOT NULL, `n` INTEGER, `note` LONGTEXT, `x` DOUBLE, "
        "`d` DECIMAL(8, 2), PRIMARY KEY (`id`))")
    assert '"note" TEXT' in create_statement("postgresql", "t", schema, ["id", "n"])
    with pytest.raises(ValueError, match="no column type"):
        create_statement("ansi", "t", T.StructType([T.StructField("m", T.MapType(T.StringType(), T.LongType()))]), [])


def test_steps_create_check_and_refill():
    from pyspark.sql import types as T
    from larder.sources.jdbc import publish_steps
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("a", T.DoubleType())])
    before, after = publish_steps("mysql", "t", "s", schema, ["id"], "merge", None)
    assert before[0].startswith("CREATE TABLE `t`") and "ON DUPLICATE KEY UPDATE" in after[0]
    before, after = publish_steps("postgresql", "t", "s", schema, ["id"], "overwrite", ["id"])
    assert before == [] and after == ['DELETE FROM "t"', 'INSERT INTO "t" ("id", "a") SELECT "id", "a" FROM "s"']
    assert publish_steps("mysql", "t", "s", schema, ["id"], "merge", ["ID"])[0] == []
    for declared in ([], ["other"], ["id", "a"]):
        with pytest.raises(ValueError, match="primary key"):
            publish_steps("mysql", "t", "s", schema, ["id"], "merge", declared)


class _Db:
    """Stands in for a connection: remembers statements, fails where told."""

    log, tables = [], {"t": ["id"]}

    def __init__(self, *_):
        pass

    def __enter__(self):
        return self

    def __exit__(self, *_):
        pass

    def run(self, statements):
        self.log.extend(statements)

    def declared_key(self, table):
        return self.tables.get(table, ["id"] if "_stage_" in table else None)


def test_staging_is_dropped_when_the_staging_write_fails(spark, monkeypatch):
    from larder.sources import jdbc
    monkeypatch.setattr(jdbc, "_Connection", _Db)
    _Db.log = []
    df = spark.createDataFrame([("1", 1.0)], "id string, a double")
    with pytest.raises(Exception):                      # no such driver: the write fails
        jdbc.publish_table(spark, df, JdbcTarget("jdbc:none://nowhere", "t", {}), ["id"])
    assert len(_Db.log) == 1 and _Db.log[0].startswith('DROP TABLE "t_stage_')
