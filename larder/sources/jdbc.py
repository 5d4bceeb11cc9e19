"""Publishing a feature table to a relational database over JDBC.

Executors write the rows in parallel; the driver sends statement text only.

* A target that does not exist is created first, with the primary key declared (text
  key columns get a bounded length, since databases do not index unbounded text).
* ``merge``: rows go to a staging table, then one set-based statement inserts new keys
  and updates known ones. Before that the target's declared key is read through JDBC
  metadata: without one, an upsert statement would insert every row again or fail.
* ``overwrite``: rows go to a staging table as well, and one transaction empties the
  target and refills it, so its key stays declared and readers never see it half full.
* ``publish_changes``: only what changed since the snapshot that was published last is sent,
  removals too, and applied in one transaction.

The staging table is dropped whatever happens. Table names may be qualified
(``schema.table``). Credentials are supplied by the caller in ``JdbcTarget.properties``.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.diff import CHANGE, REMOVE, row_changes
from larder.operators.feature_table import (
    get_feature_table,
    lease_snapshot,
    leases,
    move_lease,
    read_snapshot,
    release_snapshot,
)

DIALECTS = ("mysql", "postgresql", "ansi")
MODES = ("merge", "overwrite")
KEY_LENGTH = 255        # characters of a text key column in a table made here


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    table: str
    properties: Mapping[str, str] = field(default_factory=dict)   # user, password, driver, ...
    dialect: str = "ansi"

    def __post_init__(self):
        if self.dialect not in DIALECTS:
            raise ValueError(f"dialect must be one of {DIALECTS}")


def quote(dialect: str, ident: str) -> str:
    """Quote one identifier."""
    if dialect == "mysql":
        return "`" + ident.replace("`", "``") + "`"
    return '"' + ident.replace('"', '""') + '"'


def quote_table(dialect: str, name: str) -> str:
    """Quote a possibly qualified table name, part by part."""
    return ".".join(quote(dialect, part) for part in name.split("."))


def staging_name(table: str) -> str:
    """A new table name beside ``table``, in the same schema."""
    schema, dot, last = table.rpartition(".")
    return f"{schema}{dot}{last[:40]}_stage_{uuid.uuid4().hex[:10]}"


def column_type(dialect: str, kind: T.DataType, is_key: bool) -> str:
    """SQL type of a column in a table made here."""
    text = f"VARCHAR({KEY_LENGTH})" if is_key else {"mysql": "LONGTEXT", "postgresql": "TEXT"}.get(dialect, "CLOB")
    simple = {T.ByteType: "SMALLINT", T.ShortType: "SMALLINT", T.IntegerType: "INTEGER", T.LongType: "BIGINT",
              T.FloatType: {"mysql": "FLOAT"}.get(dialect, "REAL"), T.BooleanType: "BOOLEAN", T.DateType: "DATE",
              T.DoubleType: {"mysql": "DOUBLE"}.get(dialect, "DOUBLE PRECISION"), T.TimestampType: "TIMESTAMP",
              T.TimestampNTZType: "TIMESTAMP", T.StringType: text}
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision}, {kind.scale})"
    if type(kind) not in simple:
        raise ValueError(f"no column type for {kind.simpleString()}")
    return simple[type(kind)]


def create_statement(dialect: str, table: str, schema: T.StructType, keys: Sequence[str]) -> str:
    """``CREATE TABLE`` with the primary key declared."""
    q = lambda c: quote(dialect, c)
    columns = [f"{q(f.name)} {column_type(dialect, f.dataType, f.name in keys)}" + (" NOT NULL" if f.name in keys else "")
               for f in schema.fields]
    key = f"PRIMARY KEY ({', '.join(q(k) for k in keys)})"
    return f"CREATE TABLE {quote_table(dialect, table)} ({', '.join([*columns, key])})"


def merge_statement(dialect: str, table: str, staging: str, columns: Sequence[str], keys: Sequence[str],
                    key_expr: str = "{}") -> str:
    """One statement that inserts new keys and updates known keys of ``table`` from ``staging``.

    ``key_expr`` wraps each key reference in the ANSI form, e.g.
    ``"CAST({} AS VARCHAR(128))"`` for databases that cannot compare long text types.
    """
    q = lambda c: quote(dialect, c)
    into, source = quote_table(dialect, table), quote_table(dialect, staging)
    cols = ", ".join(q(c) for c in columns)
    values = [c for c in columns if c not in keys]
    if dialect == "mysql":
        updates = ", ".join(f"{q(c)} = s.{q(c)}" for c in values) or f"{q(keys[0])} = s.{q(keys[0])}"
        return (f"INSERT INTO {into} ({cols}) SELECT * FROM (SELECT {cols} FROM {source}) AS s "
                f"ON DUPLICATE KEY UPDATE {updates}")
    if dialect == "postgresql":
        conflict = ", ".join(q(k) for k in keys)
        action = ("DO UPDATE SET " + ", ".join(f"{q(c)} = EXCLUDED.{q(c)}" for c in values)) if values else "DO NOTHING"
        return f"INSERT INTO {into} ({cols}) SELECT {cols} FROM {source} ON CONFLICT ({conflict}) {action}"
    on = " AND ".join(f"{key_expr.format('t.' + q(k))} = {key_expr.format('s.' + q(k))}" for k in keys)
    matched = (" WHEN MATCHED THEN UPDATE SET " + ", ".join(f"{q(c)} = s.{q(c)}" for c in values)) if values else ""
    inserted = ", ".join(f"s.{q(c)}" for c in columns)
    return (f"MERGE INTO {into} t USING {source} s ON {on}{matched} "
            f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({inserted})")


def refill_statements(dialect: str, table: str, staging: str, columns: Sequence[str]) -> list[str]:
    """Empty ``table`` and fill it from ``staging``: statements of one transaction."""
    cols = ", ".join(quote(dialect, c) for c in columns)
    return [f"DELETE FROM {quote_table(dialect, table)}",
            f"INSERT INTO {quote_table(dialect, table)} ({cols}) SELECT {cols} FROM {quote_table(dialect, staging)}"]


def delete_statement(dialect: str, table: str, staging: str, keys: Sequence[str]) -> str:
    """One statement that removes from ``table`` the keys that stand in ``staging``."""
    q = lambda c: quote(dialect, c)
    target, source = quote_table(dialect, table), quote_table(dialect, staging)
    same = " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in keys)
    if dialect == "mysql":
        return f"DELETE t FROM {target} t JOIN {source} s ON {same}"
    if dialect == "postgresql":
        return f"DELETE FROM {target} t USING {source} s WHERE {same}"
    same = " AND ".join(f"s.{q(k)} = {target}.{q(k)}" for k in keys)
    return f"DELETE FROM {target} WHERE EXISTS (SELECT 1 FROM {source} s WHERE {same})"


def change_statements(dialect: str, table: str, staging: str, removals: str, columns: Sequence[str], keys: Sequence[str],
                      key_expr: str = "{}") -> list[str]:
    """Removals, then inserts and updates: statements of one transaction. Run twice they leave the same table."""
    return [delete_statement(dialect, table, removals, keys), merge_statement(dialect, table, staging, columns, list(keys), key_expr)]


def changes_to_publish(spark: SparkSession, name: str, holder: str, upto: str) -> tuple[DataFrame, DataFrame] | None:
    """(rows to merge, keys to remove) from the snapshot leased by ``holder`` to that leased by ``upto``; ``None`` without the first."""
    if holder not in leases(spark, name):
        return None
    keys = get_feature_table(spark, name).primary_keys
    changes = row_changes(read_snapshot(spark, name, holder), read_snapshot(spark, name, upto), keys)
    return (changes.where(F.col(CHANGE) != REMOVE).drop(CHANGE), changes.where(F.col(CHANGE) == REMOVE).select(*keys))


def key_batches(keys: DataFrame, key: str, per_statement: int = 1000) -> DataFrame:
    """``predicate`` per batch of keys: ``key IN (...)`` lists of at most ``per_statement`` values, made in the tasks.

    Strings are quoted; NULL keys can't match and are left out, repeated ones stand once.
    """
    kind = keys.schema[key].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint", "string"):
        raise ValueError(f"keys of type {kind} have no plain literal form")
    value = F.col(f"`{key}`").cast("string")
    literal = F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'")) if kind == "string" else value
    distinct = keys.select(F.col(f"`{key}`")).where(F.col(f"`{key}`").isNotNull()).distinct()
    numbered = distinct.select(literal.alias("l"), F.monotonically_increasing_id().alias("i"))
    return (numbered.groupBy(F.expr(f"i div {int(per_statement)}").alias("batch"))
            .agg(F.concat_ws(", ", F.sort_array(F.collect_list("l"))).alias("list"))
            .select(F.concat(F.lit(f"{key} IN ("), F.col("list"), F.lit(")")).alias("predicate")))


def check_target_key(declared: Sequence[str], keys: Sequence[str], table: str) -> None:
    """Raise unless the target's declared primary key is the feature table's."""
    if {k.lower() for k in declared} != {k.lower() for k in keys}:
        raise ValueError(f"table {table} has primary key {sorted(declared) or 'none'}, the feature table has {sorted(keys)}: "
                         "a merge needs the same key declared")


def publish_steps(dialect: str, table: str, staging: str, schema: T.StructType, keys: Sequence[str], mode: str,
                  declared: Sequence[str] | None, key_expr: str = "{}") -> tuple[list[str], list[str]]:
    """Statements before and after the rows are staged; ``declared``: the target's key, ``None`` if there is no such table."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    before = [create_statement(dialect, table, schema, keys)] if declared is None else []
    if declared is not None and mode == "merge":
        check_target_key(declared, keys, table)
    columns = schema.fieldNames()
    if mode == "merge":
        return before, [merge_statement(dialect, table, staging, columns, list(keys), key_expr)]
    return before, refill_statements(dialect, table, staging, columns)


class _Connection:
    """A driver-side JDBC connection (statement text and metadata only, no rows)."""

    def __init__(self, spark: SparkSession, target: JdbcTarget):
        jvm = spark.sparkContext._jvm
        props = jvm.java.util.Properties()
        for k, v in target.properties.items():
            props.setProperty(k, v)
        self.jdbc = jvm.java.sql.DriverManager.getConnection(target.url, props)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.jdbc.close()

    def run(self, statements: Sequence[str]) -> None:
        """One transaction (databases that commit definitions at once do so)."""
        self.jdbc.setAutoCommit(False)
        try:
            stmt = self.jdbc.createStatement()
            for s in statements:
                stmt.execute(s)
            stmt.close()
            self.jdbc.commit()
        except BaseException:
            self.jdbc.rollback()
            raise

    def declared_key(self, table: str) -> list[str] | None:
        """Primary key columns of a table, or ``None`` if it does not exist. Names are tried as given and in either case."""
        meta = self.jdbc.getMetaData()
        schema, _, last = table.rpartition(".")
        for spell in (str, str.lower, str.upper):
            # databases without schemas take the qualifier as the catalog
            for place in ((None, spell(schema) or None), (spell(schema) or None, None)):
                found = meta.getTables(*place, spell(last), None)
                if found.next():
                    keys, out = meta.getPrimaryKeys(*place, spell(last)), []
                    while keys.next():
                        out.append(keys.getString("COLUMN_NAME"))
                    return out
        return None


def publish_table(spark: SparkSession, df: DataFrame, target: JdbcTarget, primary_keys: Sequence[str],
                  mode: str = "merge", num_partitions: int | None = None, batch_size: int = 10000,
                  key_expr: str = "{}") -> None:
    """Copy ``df`` (a feature table) to ``target``; ``merge`` keeps other database rows.

    ``num_partitions`` bounds the connections: the rows are dealt anew to so many
    tasks, so the stages before keep their own number.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    staging, d = staging_name(target.table), target.dialect
    with _Connection(spark, target) as db:
        before, after = publish_steps(d, target.table, staging, df.schema, primary_keys, mode,
                                      db.declared_key(target.table), key_expr)
        db.run(before)
    rows = df.repartition(num_partitions) if num_partitions else df
    try:
        rows.write.option("batchsize", batch_size).mode("overwrite").jdbc(
            target.url, quote_table(d, staging), properties=dict(target.properties))
        with _Connection(spark, target) as db:
            db.run(after)
    finally:
        with _Connection(spark, target) as db:
            if db.declared_key(staging) is not None:
                db.run([f"DROP TABLE {quote_table(d, staging)}"])


def publish_changes(spark: SparkSession, name: str, target: JdbcTarget, num_partitions: int | None = None,
                    batch_size: int = 10000, key_expr: str = "{}") -> str:
    """Bring the published copy of a feature table up to date; returns ``"whole"`` or ``"changes"``.

    The first time the whole table is published (``overwrite``). The snapshot that was published is
    leased, so the next time only what changed since is sent: rows to insert or update, and keys to
    remove, each to a staging table, applied in one transaction. The lease moves on only after
    that; a publish that died is repeated with the same or more changes, which is harmless.
    """
    holder = f"published:{target.url}|{target.table}"
    sent = f"{holder}|sending"
    lease_snapshot(spark, name, sent)               # what this publish sends, also if the table is written meanwhile
    keys = get_feature_table(spark, name).primary_keys
    try:
        found = changes_to_publish(spark, name, holder, sent)
        if found is None:
            publish_table(spark, read_snapshot(spark, name, sent), target, keys, "overwrite", num_partitions, batch_size, key_expr)
        else:
            _send_changes(spark, *found, target, keys, num_partitions, batch_size, key_expr)
        move_lease(spark, name, sent, holder)
    finally:
        release_snapshot(spark, name, sent)
    return "whole" if found is None else "changes"


def _send_changes(spark: SparkSession, rows: DataFrame, removed: DataFrame, target: JdbcTarget, keys: Sequence[str],
                  num_partitions: int | None, batch_size: int, key_expr: str) -> None:
    d = target.dialect
    with _Connection(spark, target) as db:
        check_target_key(db.declared_key(target.table) or [], keys, target.table)
    staged = {staging_name(target.table): rows, staging_name(target.table): removed}
    into, gone = staged
    try:
        for name, part in staged.items():
            dealt = part.repartition(num_partitions) if num_partitions else part
            dealt.write.option("batchsize", batch_size).mode("overwrite").jdbc(
                target.url, quote_table(d, name), properties=dict(target.properties))
        with _Connection(spark, target) as db:
            db.run(change_statements(d, target.table, into, gone, rows.columns, keys, key_expr))
    finally:
        with _Connection(spark, target) as db:
            for name in staged:
                if db.declared_key(name) is not None:
                    db.run([f"DROP TABLE {quote_table(d, name)}"])


def read_published(spark: SparkSession, target: JdbcTarget, partition_column: str | None = None,
                   lower: int | None = None, upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Read the published table back; with a numeric partition column the read is split across tasks."""
    props, name = dict(target.properties), quote_table(target.dialect, target.table)
    if partition_column:
        return spark.read.jdbc(target.url, name, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(target.url, name, properties=props)


def read_published_keys(spark: SparkSession, target: JdbcTarget, keys: DataFrame, key: str, per_statement: int = 1000,
                        max_statements: int = 10_000) -> DataFrame:
    """The published rows of some keys: one bounded ``IN`` list per task, so the database reads by its primary key.

    Meant for batches of ids; more than ``per_statement * max_statements`` keys raise (read the whole table then).
    """
    found = key_batches(keys, key, per_statement).limit(max_statements + 1).collect()
    if len(found) > max_statements:
        raise ValueError(f"more than {max_statements} statements of {per_statement} keys; read the whole table instead")
    predicates = [r["predicate"] for r in found] or ["1 = 0"]
    return spark.read.jdbc(target.url, quote_table(target.dialect, target.table), predicates=predicates, properties=dict(target.properties))
