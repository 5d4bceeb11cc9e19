"""Keyed feature tables: create if absent, upsert by primary key, overwrite, drop.

Storage model
-------------
A feature table is an external Parquet table in the catalog whose files live in
versioned snapshot folders ``<base>/v000000-<token>, v000001-<token>, ...``.
Every write produces a complete new snapshot in a folder of its own; the table
is then pointed at it with ``ALTER TABLE ... SET LOCATION``.  A failed write
never leaves a half-written table behind, a table can be read while the next
snapshot is written, and since the current snapshot is taken from the table's
recorded location (not from a counter), a writer that died half-way can
never make the next one overwrite the folder the table reads (Parquet tables
in the session catalog have no row-level MERGE).

By default the table is bucketed (and sorted) by its primary key.  The anti
join of an upsert and every lookup join against the table then find the table
already hash-partitioned by key, so only the (usually far smaller) other side
is shuffled.

The primary key, the base folder and the current version are kept as table
properties, the description as the table comment.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources.storage import (
    database_location,
    delete_path,
    list_children,
    path_bytes,
    quote_ident,
    split_name,
    sql_string,
    table_location,
)

# Table property names used by this library.
PROP_KEYS = "larder.primary_keys"
PROP_BASE = "larder.base"
PROP_VERSION = "larder.version"
PROP_BUCKETS = "larder.buckets"
PROP_ROWS = "larder.rows"
PROP_AUTO = "larder.auto_buckets"
PROP_HISTORY = "larder.history"
PROP_LEASES = "larder.leases"
PROP_PINNED = "larder.pinned"

BUCKET_BYTES = 256 << 20    # wanted size of a bucket of a table with automatic buckets
MIN_BUCKETS = 8             # an automatic count is never below

MODES = ("merge", "overwrite")


@dataclass(frozen=True)
class FeatureTable:
    name: str
    primary_keys: tuple[str, ...]
    base: str
    location: str          # current snapshot folder
    version: int
    buckets: int | None
    description: str | None
    rows: int | None = None  # rows of the current snapshot, counted while it was written
    auto_buckets: bool = False
    history: tuple[str, ...] = ()   # earlier snapshots kept for readers, newest first


_SNAPSHOT = re.compile(r"/v(\d{6})-[0-9a-f]+$")


def snapshot_path(base: str, version: int) -> str:
    """A new, unique folder for snapshot ``version``."""
    return f"{base}/v{version:06d}-{uuid.uuid4().hex[:8]}"


def snapshot_version(path: str) -> int:
    m = _SNAPSHOT.search(path.rstrip("/"))
    if not m:
        raise ValueError(f"{path} is not a snapshot folder")
    return int(m.group(1))


def primary_key_tuple(primary_keys: str | Sequence[str]) -> tuple[str, ...]:
    keys = (primary_keys,) if isinstance(primary_keys, str) else tuple(primary_keys)
    if not keys:
        raise ValueError("a feature table needs at least one primary-key column")
    return keys


def feature_table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_feature_table(spark: SparkSession, name: str, primary_keys: str | Sequence[str],
                         schema: T.StructType, description: str | None = None,
                         buckets: int | None | str = "auto", base: str | None = None) -> bool:
    """Create an empty feature table unless one of that name exists.

    Returns ``True`` when the table was created and ``False`` when it already
    existed (it is then left untouched).  ``buckets="auto"`` starts small and lets
    each write choose the count from the table's bytes (about ``BUCKET_BYTES`` a
    bucket), independent of the cluster that happens to run; a number fixes the
    count, ``None`` turns bucketing off.
    """
    if feature_table_exists(spark, name):
        return False
    keys = primary_key_tuple(primary_keys)
    missing = [k for k in keys if k not in schema.fieldNames()]
    if missing:
        raise ValueError(f"primary keys {missing} are not columns of the schema")
    auto = buckets == "auto"
    if auto:
        buckets = MIN_BUCKETS       # an empty table; writes re-bucket it by its bytes
    db, table = split_name(spark, name)
    base = (base or f"{database_location(spark, db)}/{table}").rstrip("/")
    props = {PROP_KEYS: json.dumps(list(keys)), PROP_BASE: base, PROP_VERSION: "0", PROP_BUCKETS: str(buckets or 0),
             PROP_AUTO: str(auto).lower()}
    # Plain DDL: no job runs, the empty snapshot folder is simply absent.
    _create_entry(spark, name, schema, keys, buckets, snapshot_path(base, 0), description, props)
    return True


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quote_ident(name)}").collect()}


def get_feature_table(spark: SparkSession, name: str) -> FeatureTable:
    """Metadata of a feature table (raises ``ValueError`` if the table is not one)."""
    if not feature_table_exists(spark, name):
        raise ValueError(f"feature table {name} does not exist")
    props = table_properties(spark, name)
    if PROP_KEYS not in props or PROP_VERSION not in props:
        raise ValueError(f"table {name} is not a feature table (no primary key recorded)")
    buckets = int(props.get(PROP_BUCKETS, "0")) or None
    location = table_location(spark, name)
    # A row count belongs to one snapshot: one recorded for another location is not used.
    counted = json.loads(props.get(PROP_ROWS, "{}"))
    rows = counted["rows"] if counted and _folder(counted["location"]) == _folder(location) else None
    return FeatureTable(name=name, primary_keys=tuple(json.loads(props[PROP_KEYS])), base=props[PROP_BASE],
                        location=location, version=snapshot_version(location), buckets=buckets,
                        description=spark.catalog.getTable(name).description, rows=rows,
                        auto_buckets=props.get(PROP_AUTO) == "true" and buckets is not None,
                        history=tuple(json.loads(props.get(PROP_HISTORY, "[]"))))


def read_feature_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def check_keys(df: DataFrame, primary_keys: str | Sequence[str]) -> None:
    """Raise ``ValueError`` if a key is NULL or repeats in ``df``.

    One aggregate over the key columns only (partial aggregation before the
    shuffle, so a heavily repeated key costs one row per map task); at most one
    offending key reaches the driver.
    """
    keys = primary_key_tuple(primary_keys)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    bad = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
           .where((F.col("__n") > 1) | any_null)
           .limit(1).collect())
    if bad:
        row = bad[0].asDict()
        kind = "NULL" if any(row[k] is None for k in keys) else "duplicate"
        raise ValueError(f"{kind} primary key in source: {row}")


_WHOLE = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_EXACT_BITS = {T.FloatType: 24, T.DoubleType: 53}


def widens(source: T.DataType, target: T.DataType) -> bool:
    """Whether every value of ``source`` has one equal value of ``target`` (so a cast loses nothing)."""
    a, b = type(source), type(target)
    if source.simpleString() == target.simpleString() or a is T.NullType:
        return True
    if a in _WHOLE and b in _WHOLE:
        return _WHOLE[a] <= _WHOLE[b]
    if a in _WHOLE and b in _EXACT_BITS:
        return _WHOLE[a] <= _EXACT_BITS[b]
    if a is T.FloatType and b is T.DoubleType:
        return True
    if b is T.DecimalType:
        if a in _DIGITS:
            return target.precision - target.scale >= _DIGITS[a]
        if a is T.DecimalType:
            return target.scale >= source.scale and target.precision - target.scale >= source.precision - source.scale
    return (a, b) in {(T.VarcharType, T.StringType), (T.CharType, T.StringType), (T.DateType, T.TimestampNTZType)}


def align_to(df: DataFrame, target_schema: T.StructType) -> DataFrame:
    """Reorder ``df`` to the target's columns, widening types where nothing is lost.

    Extra or missing columns raise, and so does a type whose cast could change a value
    (a changed key could meet another one).
    """
    want = target_schema.fieldNames()
    extra = [c for c in df.columns if c not in want]
    missing = [c for c in want if c not in df.columns]
    if extra or missing:
        raise ValueError(f"source columns differ from table: extra={extra} missing={missing}")
    current = {f.name: f.dataType for f in df.schema.fields}
    lossy = {f.name: f"{current[f.name].simpleString()} -> {f.dataType.simpleString()}" for f in target_schema.fields
             if not widens(current[f.name], f.dataType)}
    if lossy:
        raise ValueError(f"source types do not fit the table without loss: {lossy}; cast the columns")
    return df.select([F.col(f.name) if current[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
                      for f in target_schema.fields])


def row_rank(df: DataFrame, keys: Sequence[str], order_by: str) -> Column:
    """How new a row is: its ``order_by`` (NULL is older than any value), then its other columns in order."""
    others = [c for c in df.columns if c not in keys and c != order_by and "map<" not in df.schema[c].dataType.simpleString()]
    return F.struct(F.col(f"`{order_by}`").isNotNull(), F.col(f"`{order_by}`"), *[F.col(f"`{c}`") for c in others])


def upsert_plan(target: DataFrame, source: DataFrame, primary_keys: Sequence[str], newer_by: str | None = None) -> DataFrame:
    """Rows of ``target`` whose key is not in ``source``, plus all of ``source``.

    A source row replaces the whole target row, NULL values included.  The anti join
    reads only the key columns of ``source``; if both sides are bucketed alike by
    the key, nothing is shuffled.

    With ``newer_by`` the newer row of a key stays (``row_rank``): two anti joins with a
    condition, each leaving out the rows that the other side has a newer one of. Keys are
    unique on both sides. Merging is then commutative and idempotent.
    """
    keys = list(primary_keys)
    if newer_by is None:
        kept = target.join(source.select(*keys), keys, "left_anti")
        return kept.unionByName(source)
    rank = "__larder_rank"
    old = target.withColumn(rank, row_rank(target, keys, newer_by))
    new = source.select(*target.columns).withColumn(rank, row_rank(source.select(*target.columns), keys, newer_by))

    def without(rows: DataFrame, other: DataFrame, beaten) -> DataFrame:
        a, b = rows.alias("a"), other.select(*keys, rank).alias("b")
        same = [F.col(f"a.`{k}`") == F.col(f"b.`{k}`") for k in keys]
        cond = same[0]
        for c in same[1:]:
            cond = cond & c
        return a.join(b, cond & beaten(F.col(f"a.{rank}"), F.col(f"b.{rank}")), "left_anti").drop(rank)
    # of equal ranks the source's row stays, so every key keeps exactly one row
    return without(old, new, lambda a, b: b >= a).unionByName(without(new, old, lambda a, b: b > a))


def buckets_for(n_bytes: int) -> int:
    """Bucket count that gives buckets of about ``BUCKET_BYTES`` (a power of two, so tables of one size agree)."""
    return 1 << max(0, math.ceil(math.log2(max(1, n_bytes) / BUCKET_BYTES)))


def write_feature_table(spark: SparkSession, name: str, df: DataFrame, mode: str = "merge",
                        retain: int = 1, newer_by: str | None = None) -> FeatureTable:
    """Write ``df`` into the feature table ``name``.

    ``merge``: keys new to the table are inserted, known keys are replaced, other
    table rows are kept.  ``overwrite``: ``df`` becomes the whole table.  The
    source must have exactly the table's columns and unique non-NULL keys.
    The snapshot that the table pointed to before is kept for readers still on it,
    and ``retain - 1`` recorded ones before it; all other snapshot folders go.

    With ``newer_by`` (a column of the table) a merge never replaces a newer row by an
    older one; see ``upsert_plan``.

    ``df`` is evaluated once: it is first written, bucketed by key, into a staged
    folder, and key check, anti join and union all read that.  The staged folder
    is the new snapshot itself for an overwrite or a first load.

    A table with automatic buckets is re-bucketed by this rewrite when its bytes ask
    for at least twice or at most a quarter of its present count.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    ft = get_feature_table(spark, name)
    if PROP_PINNED in table_properties(spark, name):
        raise ValueError(f"{name} is a leased snapshot and can't be written")
    target = spark.table(name)
    if newer_by is not None and (newer_by not in target.columns or newer_by in ft.primary_keys):
        raise ValueError(f"{newer_by!r} must be a column of {name} outside of its key")
    source = align_to(df, target.schema)
    db, _ = split_name(spark, name)
    new_version = ft.version + 1
    # Version 0 is the empty table made by ``create_feature_table``: a first load needs no anti join.
    whole = mode == "overwrite" or ft.version == 0
    staged_path = snapshot_path(ft.base, new_version)
    made = [staged_path]
    stage = None
    try:
        staged_rows = _write_snapshot(spark, source, ft, staged_path, ft.buckets, deal=True)
        staged, stage = _open_snapshot(spark, db, target.schema, ft, staged_path)
        check_keys(staged, ft.primary_keys)
        n_bytes = path_bytes(spark, staged_path) + (0 if whole else path_bytes(spark, ft.location))
        buckets = ft.buckets
        if ft.auto_buckets:
            wanted = max(buckets_for(n_bytes), MIN_BUCKETS)
            if wanted >= 2 * buckets or 4 * wanted <= buckets:
                buckets = wanted
        if whole and buckets == ft.buckets:
            new_path, rows = staged_path, staged_rows
        else:
            new_path = snapshot_path(ft.base, new_version)
            made.append(new_path)
            merged = staged if whole else upsert_plan(target, staged, ft.primary_keys, newer_by)
            # unchanged buckets: table and staged rows are already one bucket per task, nothing is shuffled
            rows = _write_snapshot(spark, merged, ft, new_path, buckets, deal=buckets != ft.buckets)
    except BaseException:
        _drop_entry(spark, stage)
        for path in made:
            delete_path(spark, path)
        raise
    _drop_entry(spark, stage)
    if new_path != staged_path:
        delete_path(spark, staged_path)
    history = [ft.location, *ft.history][:max(0, retain)]
    props = {PROP_VERSION: str(new_version), PROP_ROWS: json.dumps({"location": new_path, "rows": rows}),
             PROP_HISTORY: json.dumps(history)}
    if buckets != ft.buckets:
        # The catalog can't change a bucket count: the (external) entry is made anew over the same folders.
        # A stop between the two statements leaves all snapshots; create_feature_table finds none of its name then.
        held = _leases_json(leases(spark, name))
        spark.sql(f"DROP TABLE {quote_ident(name)}")
        _create_entry(spark, name, target.schema, ft.primary_keys, buckets, new_path, ft.description,
                      {PROP_KEYS: json.dumps(list(ft.primary_keys)), PROP_BASE: ft.base, PROP_BUCKETS: str(buckets),
                       PROP_AUTO: "true", PROP_LEASES: held, **props})
    else:
        spark.sql(f"ALTER TABLE {quote_ident(name)} SET LOCATION {sql_string(new_path)}")
        spark.sql(f"ALTER TABLE {quote_ident(name)} SET TBLPROPERTIES ("
                  + ", ".join(f"{sql_string(k)} = {sql_string(v)}" for k, v in props.items()) + ")")
    spark.catalog.refreshTable(name)
    # leases are read now: one may have been taken while this write ran
    _prune_snapshots(spark, ft.base, [new_path, *history, *(x.folder for x in leases(spark, name).values())])
    return get_feature_table(spark, name)


def _folder(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _prune_snapshots(spark: SparkSession, base: str, keep: Sequence[str]) -> None:
    """Delete the snapshot folders of a table that are not in ``keep`` (whatever a dead writer left behind as well)."""
    names = {_folder(p) for p in keep}
    for path in list_children(spark, base):
        if _SNAPSHOT.search(path.rstrip("/")) and _folder(path) not in names:
            delete_path(spark, path)


# --- leases: snapshots that stay readable

@dataclass(frozen=True)
class Lease:
    """A snapshot that a holder keeps; ``entry`` is the catalog entry that reads it, bucketed as it was written."""
    holder: str
    folder: str
    buckets: int | None
    rows: int | None
    entry: str

    @property
    def version(self) -> int:
        return snapshot_version(self.folder)


def leases(spark: SparkSession, name: str) -> dict[str, Lease]:
    """The leases of a feature table by holder."""
    held = json.loads(table_properties(spark, name).get(PROP_LEASES, "{}"))
    return {h: Lease(h, x["folder"], x["buckets"], x["rows"], x["entry"]) for h, x in held.items()}


def _leases_json(held: dict[str, Lease]) -> str:
    return json.dumps({h: {"folder": x.folder, "buckets": x.buckets, "rows": x.rows, "entry": x.entry} for h, x in held.items()})


def _set_leases(spark: SparkSession, name: str, held: dict[str, Lease]) -> None:
    spark.sql(f"ALTER TABLE {quote_ident(name)} SET TBLPROPERTIES ({sql_string(PROP_LEASES)} = {sql_string(_leases_json(held))})")


def lease_snapshot(spark: SparkSession, name: str, holder: str) -> Lease:
    """Keep the table's present snapshot for ``holder`` (whose earlier lease on the table ends).

    Later writes don't delete a leased snapshot. The lease is recorded before the holder relies on
    it; a single writer per table is assumed.
    """
    ft = get_feature_table(spark, name)
    held = leases(spark, name)
    db, _ = split_name(spark, name)
    entry = f"{db}.__larder_pin_{hashlib.md5(_folder(ft.location).encode()).hexdigest()[:12]}"
    lease = Lease(holder, ft.location, ft.buckets, ft.rows, entry)
    _set_leases(spark, name, {**held, holder: lease})
    if not spark.catalog.tableExists(entry):
        # a feature table of its own, so lookups can name it; it is never written
        _create_entry(spark, entry, spark.table(name).schema, ft.primary_keys, ft.buckets, ft.location, ft.description,
                      {PROP_KEYS: json.dumps(list(ft.primary_keys)), PROP_BASE: ft.base, PROP_VERSION: str(ft.version),
                       PROP_BUCKETS: str(ft.buckets or 0), PROP_PINNED: name,
                       **({PROP_ROWS: json.dumps({"location": ft.location, "rows": ft.rows})} if ft.rows is not None else {})})
    old = held.get(holder)
    if old is not None and old.entry != entry:
        _forget_entry(spark, old.entry, {**held, holder: lease})
    return lease


def move_lease(spark: SparkSession, name: str, holder: str, to: str) -> None:
    """Give the snapshot that ``holder`` has leased to the holder ``to`` as well (whose earlier lease ends)."""
    held = leases(spark, name)
    lease, old = held[holder], held.get(to)
    after = {**held, to: Lease(to, lease.folder, lease.buckets, lease.rows, lease.entry)}
    _set_leases(spark, name, after)
    if old is not None:
        _forget_entry(spark, old.entry, after)


def release_snapshot(spark: SparkSession, name: str, holder: str) -> bool:
    """End a lease; the folder goes with the next write that no longer needs it. ``False`` if there is no such lease."""
    held = leases(spark, name)
    lease = held.pop(holder, None)
    if lease is None:
        return False
    _set_leases(spark, name, held)
    _forget_entry(spark, lease.entry, held)
    return True


def _forget_entry(spark: SparkSession, entry: str, held: dict[str, Lease]) -> None:
    if all(x.entry != entry for x in held.values()):
        _drop_entry(spark, entry)


def read_snapshot(spark: SparkSession, name: str, holder: str) -> DataFrame:
    """The snapshot that ``holder`` has leased."""
    held = leases(spark, name)
    if holder not in held:
        raise ValueError(f"{holder!r} holds no snapshot of {name}")
    return spark.table(held[holder].entry)


def drop_feature_table(spark: SparkSession, name: str, purge: bool = True, force: bool = False) -> bool:
    """Drop the table; with ``purge`` its snapshot folders are deleted as well.

    Returns ``False`` if there is no such table; raises ``ValueError`` for a table
    that is not a feature table, or whose snapshots are leased (unless ``force``),
    and leaves it alone.
    """
    if not feature_table_exists(spark, name):
        return False
    base = get_feature_table(spark, name).base
    held = leases(spark, name)
    if held and not force:
        raise ValueError(f"snapshots of {name} are leased by {sorted(held)}")
    for lease in held.values():
        _drop_entry(spark, lease.entry)
    spark.sql(f"DROP TABLE IF EXISTS {quote_ident(name)}")
    if purge:
        delete_path(spark, base)
    return True


def _create_entry(spark: SparkSession, name: str, schema: T.StructType, keys: Sequence[str], buckets: int | None,
                  location: str, comment: str | None, props: dict[str, str]) -> None:
    """Make the catalog entry of an external Parquet table by plain DDL (no job runs)."""
    cols = ", ".join(_ident(k) for k in keys)
    clustered = f" CLUSTERED BY ({cols}) SORTED BY ({cols}) INTO {int(buckets)} BUCKETS" if buckets else ""
    text = f" COMMENT {sql_string(comment)}" if comment else ""
    listed = (" TBLPROPERTIES (" + ", ".join(f"{sql_string(k)} = {sql_string(v)}" for k, v in props.items()) + ")") if props else ""
    spark.sql(f"CREATE TABLE {quote_ident(name)} ({schema.toDDL()}) USING parquet{clustered}"
              f" LOCATION {sql_string(location)}{text}{listed}")


def _ident(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _drop_entry(spark: SparkSession, entry: str | None) -> None:
    if entry:
        spark.sql(f"DROP TABLE IF EXISTS {quote_ident(entry)}")


def _open_snapshot(spark: SparkSession, db: str, schema: T.StructType, ft: FeatureTable,
                   path: str) -> tuple[DataFrame, str | None]:
    """Read a snapshot folder; bucketed ones through a temporary catalog entry, so Spark knows the buckets."""
    if not ft.buckets:
        return spark.read.schema(schema).parquet(path), None
    entry = f"{db}.__larder_stage_{uuid.uuid4().hex[:12]}"
    _create_entry(spark, entry, schema, ft.primary_keys, ft.buckets, path, None, {})
    return spark.table(entry), entry


def _write_snapshot(spark: SparkSession, df: DataFrame, ft: FeatureTable, path: str, buckets: int | None,
                    deal: bool) -> int:
    """Write one complete snapshot to ``path``; returns its number of rows, counted while it is written.

    Bucketed snapshots are written through a temporary catalog entry (Spark
    writes bucket files only via ``saveAsTable``); dropping that external
    entry afterwards leaves the files in place. With ``deal`` the rows are first
    shuffled to one task per bucket.
    """
    counted = Observation()
    db, _ = split_name(spark, ft.name)
    if not buckets:
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        return int(counted.get["rows"])
    cols = list(ft.primary_keys)
    dealt = (df.repartition(buckets, *cols) if deal else df).observe(counted, F.count(F.lit(1)).alias("rows"))
    stage = f"{db}.__larder_stage_{uuid.uuid4().hex[:12]}"
    try:
        (dealt.write.format("parquet").mode("overwrite").option("path", path)
         .bucketBy(buckets, *cols).sortBy(*cols).saveAsTable(stage))
    finally:
        _drop_entry(spark, stage)
    return int(counted.get["rows"])


def save_features(spark: SparkSession, name: str, df: DataFrame, primary_keys: str | Sequence[str],
                  description: str | None = None, mode: str = "merge",
                  buckets: int | None | str = "auto") -> FeatureTable:
    """Create the feature table from ``df``'s schema if it is absent, then write ``df`` into it."""
    create_feature_table(spark, name, primary_keys, df.schema, description, buckets=buckets)
    return write_feature_table(spark, name, df, mode=mode)
