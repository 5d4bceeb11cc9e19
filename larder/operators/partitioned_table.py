"""Feature tables cut into key buckets that an upsert replaces one by one.

Where ``feature_table`` writes a complete snapshot, a partitioned table rewrites only the
buckets that a delta touches, so the work follows the delta and not the table.

Storage model
-------------
The table is an external Parquet table in the catalog, partitioned by ``BUCKET``, a hash of
the primary key modulo a fixed count. Each bucket lies in a folder of its own, which can
belong to any earlier write::

    <base>/w000003-<token>/larder_bucket=17/part-...

A *commit record* (one Parquet row per bucket: folder, rows, bytes) lists the folders that
make up a version. The table's property ``larder.commit`` names the record in force, and one
``ALTER TABLE ... SET TBLPROPERTIES`` puts a new one in force. A write

1. stages the source, dealt by bucket, checks its keys, and sees which buckets it has;
2. joins these buckets with the staged rows, bucket by bucket, and writes their new folders;
3. writes the new record, marks the table as being switched, and points the touched partitions
   of the catalog to their new folders, one by one;
4. puts the record in force, takes the mark away (one statement) and deletes folders that no kept record lists.

``read_partitioned`` reads by the record, so a writer that dies anywhere before step 4, also
between two switches of step 3, leaves the old table; the next write (or ``repair_partitions``)
points the partitions back first. Plain readers of the catalog table see single buckets
early only while a write is at step 3. One writer per table is assumed, as for snapshots.

With ``order_by`` the table keeps the newer row of a key: a source row replaces a table row
only if its ``order_by`` value is not smaller (equal values: the greater row by its other
columns in order; NULL is older than any value). The table is then the same in whatever order
deltas arrive, also if some arrive twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.feature_table import (
    PROP_BASE,
    PROP_KEYS,
    align_to,
    buckets_for,
    check_keys,
    feature_table_exists,
    primary_key_tuple,
    table_properties,
    upsert_plan,
)
from larder.sources.storage import (
    database_location,
    delete_path,
    list_children,
    path_bytes,
    quote_ident,
    split_name,
    sql_string,
)

# The partition column and the table property names.
BUCKET = "larder_bucket"
PROP_COMMIT = "larder.commit"
PROP_COUNT = "larder.partition_buckets"
PROP_ORDER = "larder.order_by"
PROP_KEPT = "larder.kept_commits"
PROP_SWITCHING = "larder.switching"

RECORD = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("folder", T.StringType()),
                       T.StructField("rows", T.LongType()), T.StructField("bytes", T.LongType())])


@dataclass(frozen=True)
class PartitionedTable:
    name: str
    primary_keys: tuple[str, ...]
    base: str
    buckets: int
    order_by: str | None
    schema: T.StructType            # without the bucket column
    commit: str | None              # folder of the record in force; None for an empty table
    kept: tuple[str, ...] = ()      # earlier records whose folders stay for readers, newest first

    @property
    def version(self) -> int:
        return int(self.commit.rsplit("/c", 1)[1][:6]) if self.commit else 0


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def create_partitioned_table(spark: SparkSession, name: str, primary_keys: str | Sequence[str], schema: T.StructType,
                             buckets: int, description: str | None = None, order_by: str | None = None) -> bool:
    """Create an empty partitioned table unless one of that name exists; tells whether it did.

    About 256 MB a bucket is a good size (``feature_table.buckets_for``); ``rebucket`` changes the count.
    """
    if feature_table_exists(spark, name):
        return False
    keys = primary_key_tuple(primary_keys)
    missing = [c for c in [*keys, *([order_by] if order_by else [])] if c not in schema.fieldNames()]
    if missing:
        raise ValueError(f"columns {missing} are not in the schema")
    if BUCKET in schema.fieldNames():
        raise ValueError(f"{BUCKET} is the name of the partition column")
    if order_by in keys:
        raise ValueError("the order column can't be part of the key")
    if buckets < 1:
        raise ValueError("a table has at least one bucket")
    db, table = split_name(spark, name)
    base = f"{database_location(spark, db)}/{table}"
    props = {PROP_KEYS: json.dumps(list(keys)), PROP_BASE: base, PROP_COUNT: str(int(buckets)), PROP_COMMIT: "", PROP_KEPT: "[]",
             PROP_ORDER: order_by or "", PROP_SWITCHING: ""}
    _create(spark, name, schema, f"{base}/none", description, props)
    return True


def _create(spark: SparkSession, name: str, schema: T.StructType, location: str, comment: str | None, props: dict[str, str]) -> None:
    text = f" COMMENT {sql_string(comment)}" if comment else ""
    listed = ", ".join(f"{sql_string(k)} = {sql_string(v)}" for k, v in props.items())
    columns = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    spark.sql(f"CREATE TABLE {quote_ident(name)} ({columns.toDDL()}) USING parquet "
              f"PARTITIONED BY ({BUCKET}) LOCATION {sql_string(location)}{text} TBLPROPERTIES ({listed})")


def is_partitioned(spark: SparkSession, name: str) -> bool:
    return feature_table_exists(spark, name) and PROP_COUNT in table_properties(spark, name)


def get_partitioned_table(spark: SparkSession, name: str) -> PartitionedTable:
    if not feature_table_exists(spark, name):
        raise ValueError(f"table {name} does not exist")
    props = table_properties(spark, name)
    if PROP_COUNT not in props:
        raise ValueError(f"{name} is not a partitioned feature table")
    schema = T.StructType([f for f in spark.table(name).schema.fields if f.name != BUCKET])
    return PartitionedTable(name, tuple(json.loads(props[PROP_KEYS])), props[PROP_BASE], int(props[PROP_COUNT]),
                            props[PROP_ORDER] or None, schema, props[PROP_COMMIT] or None, tuple(json.loads(props[PROP_KEPT])))


def commit_record(spark: SparkSession, table: PartitionedTable) -> dict[int, T.Row]:
    """The record in force by bucket (at most one row per bucket of the table)."""
    if table.commit is None:
        return {}
    return {r["bucket"]: r for r in spark.read.schema(RECORD).parquet(table.commit).collect()}


def _read(spark: SparkSession, table: PartitionedTable, folders: Sequence[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], table.schema)
    return spark.read.schema(table.schema).parquet(*folders)


def read_partitioned(spark: SparkSession, name: str) -> DataFrame:
    """The table as the record in force has it."""
    table = get_partitioned_table(spark, name)
    return _read(spark, table, [r["folder"] for r in commit_record(spark, table).values()])


def write_partitioned(spark: SparkSession, name: str, df: DataFrame, mode: str = "merge", retain: int = 1) -> PartitionedTable:
    """Merge ``df`` into the table (or ``overwrite`` it); only the buckets that ``df`` has are read and written.

    The source must have the table's columns and unique non-NULL keys; it is evaluated once.
    The folders of the ``retain`` records before the new one stay for readers.
    """
    if mode not in ("merge", "overwrite"):
        raise ValueError(f"mode must be merge or overwrite, got {mode!r}")
    table = get_partitioned_table(spark, name)
    source = align_to(df, table.schema)
    repair_partitions(spark, name)
    tag = f"{table.version + 1:06d}-{uuid.uuid4().hex[:8]}"
    staged_path, written_path = f"{table.base}/s{tag}", f"{table.base}/w{tag}"
    keys = list(table.primary_keys)
    before = commit_record(spark, table)
    try:
        _write_buckets(source, table, staged_path)
        staged_schema = T.StructType([*table.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        staged = spark.read.schema(staged_schema).parquet(staged_path)
        check_keys(staged, keys)
        touched = sorted(_bucket_folders(spark, staged_path))
        if mode == "overwrite":
            base_folder, kept = staged_path, {}
        else:
            kept = {b: r for b, r in before.items() if b not in set(touched)}
            old = [before[b]["folder"] for b in touched if b in before]
            if old:
                # both sides carry the bucket, so the join deals whole buckets and no other row of the table
                rows = _read(spark, table, old).withColumn(BUCKET, bucket_of(keys, table.buckets))
                merged = upsert_plan(rows, staged, [BUCKET, *keys], table.order_by)
                _write_buckets(merged.drop(BUCKET), table, written_path)
                base_folder = written_path
            else:
                base_folder = staged_path
        record = {**{b: tuple(r) for b, r in kept.items()}, **_folder_rows(spark, table, base_folder)}
        after = _commit(spark, table, record, {b: r["folder"] for b, r in before.items()}, tag, retain)
    except BaseException:
        for path in (staged_path, written_path):
            delete_path(spark, path)
        raise
    return after


def _write_buckets(df: DataFrame, table: PartitionedTable, path: str) -> None:
    keys = list(table.primary_keys)
    (df.withColumn(BUCKET, bucket_of(keys, table.buckets)).repartition(table.buckets, BUCKET)
     .sortWithinPartitions(BUCKET, *keys).write.partitionBy(BUCKET).parquet(path))


def _bucket_folders(spark: SparkSession, path: str) -> dict[int, str]:
    mark = f"/{BUCKET}="
    return {int(p.rsplit(mark, 1)[1]): p for p in list_children(spark, path) if mark in p}


def _folder_rows(spark: SparkSession, table: PartitionedTable, path: str) -> dict[int, tuple]:
    """(bucket, folder, rows, bytes) by bucket of one write; a count of a partition column reads the files' footers only."""
    folders = _bucket_folders(spark, path)
    if not folders:
        return {}
    schema = T.StructType([T.StructField(BUCKET, T.IntegerType())])
    counts = {r[BUCKET]: r["count"] for r in spark.read.schema(schema).parquet(path).groupBy(BUCKET).count().collect()}
    return {b: (b, f, counts.get(b, 0), path_bytes(spark, f)) for b, f in folders.items()}


def _commit(spark: SparkSession, table: PartitionedTable, record: dict[int, tuple], now: dict[int, str], tag: str,
            retain: int) -> PartitionedTable:
    commit = f"{table.base}/c{tag}"
    spark.createDataFrame([record[b] for b in sorted(record)], RECORD).coalesce(1).write.parquet(commit)
    _set_properties(spark, table.name, {PROP_SWITCHING: commit})
    _point_partitions(spark, table.name, {b: r[1] for b, r in record.items()}, now)
    kept = [c for c in (table.commit, *table.kept) if c][:max(0, retain)]
    _set_properties(spark, table.name, {PROP_COMMIT: commit, PROP_KEPT: json.dumps(kept), PROP_SWITCHING: ""})
    spark.catalog.refreshTable(table.name)
    _prune(spark, table, [commit, *kept])
    return get_partitioned_table(spark, table.name)


def _set_properties(spark: SparkSession, name: str, props: dict[str, str]) -> None:
    listed = ", ".join(f"{sql_string(k)} = {sql_string(v)}" for k, v in props.items())
    spark.sql(f"ALTER TABLE {quote_ident(name)} SET TBLPROPERTIES ({listed})")


def catalog_partitions(spark: SparkSession, name: str) -> dict[int, str]:
    """Bucket -> folder as the catalog has them."""
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {quote_ident(name)}").collect():
        bucket = int(row[0].rsplit("=", 1)[1])
        lines = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_ident(name)} PARTITION ({BUCKET} = {bucket})").collect()
        found[bucket] = next(r[1].rstrip("/") for r in lines if r[0] == "Location")
    return found


def switch_partition(spark: SparkSession, name: str, bucket: int, folder: str | None, known: bool) -> None:
    """Point one bucket of the catalog table to a folder (``None``: drop it)."""
    spec = f"PARTITION ({BUCKET} = {int(bucket)})"
    if folder is None:
        spark.sql(f"ALTER TABLE {quote_ident(name)} DROP IF EXISTS {spec}")
    elif known:
        spark.sql(f"ALTER TABLE {quote_ident(name)} {spec} SET LOCATION {sql_string(folder)}")
    else:
        spark.sql(f"ALTER TABLE {quote_ident(name)} ADD IF NOT EXISTS {spec} LOCATION {sql_string(folder)}")


def _plain(path: str) -> str:
    """A path without its scheme, to compare paths that the catalog and the file system spell differently."""
    return "/" + path.split(":", 1)[-1].strip("/")


def _point_partitions(spark: SparkSession, name: str, wanted: dict[int, str], now: dict[int, str]) -> int:
    """Switch the partitions whose folders ``now`` differ from ``wanted``; returns how many."""
    changed = 0
    for bucket in sorted(set(now) | set(wanted)):
        folder = wanted.get(bucket)
        if folder is None or bucket not in now or _plain(now[bucket]) != _plain(folder):
            switch_partition(spark, name, bucket, folder, bucket in now)
            changed += 1
    return changed


def repair_partitions(spark: SparkSession, name: str) -> int:
    """Point the catalog's partitions to the record in force, if a writer died between two switches; returns how many it moved."""
    table = get_partitioned_table(spark, name)
    if not table_properties(spark, name).get(PROP_SWITCHING):
        return 0
    changed = _point_partitions(spark, name, {b: r["folder"] for b, r in commit_record(spark, table).items()},
                                catalog_partitions(spark, name))
    _set_properties(spark, name, {PROP_SWITCHING: ""})
    spark.catalog.refreshTable(name)
    return changed


def _prune(spark: SparkSession, table: PartitionedTable, commits: Sequence[str]) -> None:
    """Delete the folders of a table that none of the records lists, and all other records."""
    listed = {_plain(r["folder"]) for c in commits for r in spark.read.schema(RECORD).parquet(c).collect()}
    records = {_plain(c) for c in commits}
    for path in list_children(spark, table.base):
        kind = path.rstrip("/").rsplit("/", 1)[-1][:1]
        if kind == "c" and _plain(path) not in records:
            delete_path(spark, path)
        elif kind in "sw":
            folders = _bucket_folders(spark, path)
            dead = [f for f in folders.values() if _plain(f) not in listed]
            if len(dead) == len(folders):
                delete_path(spark, path)
            else:
                for f in dead:
                    delete_path(spark, f)


def rebucket(spark: SparkSession, name: str, buckets: int | None = None) -> PartitionedTable:
    """Rewrite the table with another number of buckets (``None``: by its bytes), as one commit.

    The bucket count is put in force together with the record: the property statement is one.
    """
    table = get_partitioned_table(spark, name)
    before = commit_record(spark, table)
    wanted = buckets or buckets_for(sum(r["bytes"] for r in before.values()))
    if wanted == table.buckets:
        return table
    repair_partitions(spark, name)
    anew = PartitionedTable(table.name, table.primary_keys, table.base, wanted, table.order_by, table.schema, table.commit, table.kept)
    tag = f"{table.version + 1:06d}-{uuid.uuid4().hex[:8]}"
    path = f"{table.base}/w{tag}"
    _write_buckets(_read(spark, table, [r["folder"] for r in before.values()]), anew, path)
    record = _folder_rows(spark, anew, path)
    commit = f"{table.base}/c{tag}"
    spark.createDataFrame([record[b] for b in sorted(record)], RECORD).coalesce(1).write.parquet(commit)
    _set_properties(spark, name, {PROP_COUNT: str(wanted), PROP_COMMIT: commit, PROP_KEPT: "[]", PROP_SWITCHING: commit})
    repair_partitions(spark, name)
    _prune(spark, anew, [commit])
    return get_partitioned_table(spark, name)


def drop_partitioned_table(spark: SparkSession, name: str) -> bool:
    """Drop the table and all its folders; ``False`` if there is no such table."""
    if not feature_table_exists(spark, name):
        return False
    base = get_partitioned_table(spark, name).base
    spark.sql(f"DROP TABLE IF EXISTS {quote_ident(name)}")
    delete_path(spark, base)
    return True
