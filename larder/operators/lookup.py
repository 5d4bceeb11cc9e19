"""Feature lookups: attach columns of keyed feature tables to an id or label frame.

``create_training_set`` joins every lookup to the input frame with a LEFT join
(one output row per input row; ids unknown to a table get NULL features) and
drops the excluded columns.  The plan stays lazy except for one count of the
input's keys per lookup key (see ``skew``), all of them on the input itself.

Plan shape, per lookup key:

* lookups on the same table and key are merged, lookups without columns are
  skipped (Catalyst cannot drop an unused left join, since it does not know
  the table's key is unique);
* each feature table is read with only its key and the requested columns;
* when the input holds at most ``point_lookup_keys`` distinct keys, each
  feature table is first cut down to those keys (a literal IN list pushed into
  the scan for very few keys, with bucket pruning and row-group skipping; a
  semi join otherwise) and broadcast if the remaining bytes are proven small;
* otherwise, whatever the number of keys, the input is taken in parts, if it has hot keys.
  It is evaluated once: one pass marks each row's part and writes the rows part by part, and
  every part is read back by itself. Rows with a hot key are joined with the feature rows of the hot keys, which
  are few and broadcast (in bounded blocks), so these rows are never shuffled;
  rows with a hot NULL key get NULL features without any join; the rest share
  one partitioning per key, so they are shuffled once and a bucketed feature
  table not at all. Without hot keys the rest is everything.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.feature_table import FeatureTable, get_feature_table
from larder.session import scratch_path
from larder.sources.storage import path_bytes
from larder.operators.skew import (
    HOT,
    KeyProfile,
    SkewPolicy,
    any_null,
    block_of,
    blocks_for,
    literal_filter,
    mark_hot,
    profile_keys,
)


def _tuple(v: str | Iterable[str] | None) -> tuple[str, ...] | None:
    if v is None:
        return None
    return (v,) if isinstance(v, str) else tuple(v)


@dataclass(frozen=True)
class FeatureLookup:
    """Columns ``feature_names`` of table ``table_name``, matched on ``lookup_key``.

    ``lookup_key`` names columns of the input frame, matched in order to the
    table's primary key (default: columns named like the primary key).
    ``feature_names=None`` takes every non-key column.
    """

    table_name: str
    feature_names: tuple[str, ...] | None = None
    lookup_key: tuple[str, ...] | None = None

    def __init__(self, table_name: str, feature_names: str | Iterable[str] | None = None,
                 lookup_key: str | Iterable[str] | None = None):
        object.__setattr__(self, "table_name", table_name)
        object.__setattr__(self, "feature_names", _tuple(feature_names))
        object.__setattr__(self, "lookup_key", _tuple(lookup_key))

    def on_table(self, table_name: str) -> FeatureLookup:
        """The same lookup on another table (for example a leased snapshot of it)."""
        return FeatureLookup(table_name, self.feature_names, self.lookup_key)

    def to_dict(self) -> dict:
        return {"table_name": self.table_name,
                "feature_names": list(self.feature_names) if self.feature_names is not None else None,
                "lookup_key": list(self.lookup_key) if self.lookup_key is not None else None}

    @staticmethod
    def from_dict(d: dict) -> FeatureLookup:
        return FeatureLookup(d["table_name"], d.get("feature_names"), d.get("lookup_key"))


@dataclass(frozen=True)
class _Resolved:
    frame: DataFrame            # key columns renamed to the lookup key, then features
    lookup_key: tuple[str, ...]
    features: tuple[str, ...]
    row_bytes: float | None = None   # stored bytes per row of the table's current snapshot


# Parquet stores rows compressed; a broadcast holds them decoded.  Estimates of
# broadcast sizes multiply stored bytes by this margin.
_DECODED_MARGIN = 5.0
_UNKNOWN_ROW_BYTES = 10_000.0       # assumed for a table whose size was not recorded


def _resolve(spark: SparkSession, df: DataFrame, lookups: Sequence[FeatureLookup]) -> list[_Resolved]:
    """Merge lookups per (table, key), drop empty ones, read only the needed columns."""
    merged: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    order: list[tuple[str, tuple[str, ...]]] = []
    metas: dict[str, FeatureTable] = {}
    for lk in lookups:
        if lk.table_name not in metas:
            metas[lk.table_name] = get_feature_table(spark, lk.table_name)
        pk = metas[lk.table_name].primary_keys
        key = lk.lookup_key or pk
        if len(key) != len(pk):
            raise ValueError(f"lookup key {key} does not match primary key {pk} of {lk.table_name}")
        missing = [k for k in key if k not in df.columns]
        if missing:
            raise ValueError(f"lookup key columns {missing} are not in the input frame")
        if lk.feature_names is None:
            names = [c for c in spark.table(lk.table_name).columns if c not in pk]
        else:
            names = list(lk.feature_names)
        slot = (lk.table_name, tuple(key))
        if slot not in merged:
            merged[slot] = []
            order.append(slot)
        merged[slot].extend(n for n in names if n not in merged[slot])

    resolved, seen = [], set(df.columns)
    for table, key in order:
        names = merged[(table, key)]
        if not names:
            continue
        clash = seen & set(names)
        if clash:
            raise ValueError(f"feature columns {sorted(clash)} of {table} already exist in the frame")
        seen |= set(names)
        meta = metas[table]
        pk = meta.primary_keys
        ft = spark.table(table)
        unknown = [n for n in names if n not in ft.columns]
        if unknown:
            raise ValueError(f"table {table} has no columns {unknown}")
        dtypes = dict(df.dtypes)
        ft_types = dict(ft.dtypes)
        # Keys must agree in type: a cast could map two distinct keys to one
        # (e.g. '0123' and '123' as numbers) and multiply input rows.
        wrong = [(k, dtypes[k], p, ft_types[p]) for p, k in zip(pk, key) if ft_types[p] != dtypes[k]]
        if wrong:
            raise ValueError(f"lookup key types differ from {table}'s primary key: {wrong}; cast the input column")
        key_cols = [F.col(p).alias(k) for p, k in zip(pk, key)]
        row_bytes = path_bytes(spark, meta.location) / meta.rows if meta.rows else None
        resolved.append(_Resolved(ft.select(*key_cols, *names), key, tuple(names), row_bytes))
    return resolved


def attach_features(spark: SparkSession, df: DataFrame, lookups: Sequence[FeatureLookup],
                    skew: SkewPolicy | None = None) -> DataFrame:
    """``df`` with the lookups' feature columns appended (LEFT joins, row count kept)."""
    skew = skew or SkewPolicy()
    resolved = _resolve(spark, df, lookups)
    by_key: dict[tuple[str, ...], list[_Resolved]] = {}
    for r in resolved:
        by_key.setdefault(r.lookup_key, []).append(r)
    # all profiles before the first join: none of them runs a join
    profiles = {key: profile_keys(df, key, skew) for key in by_key}
    out = df
    for key, group in by_key.items():
        out = _join_group(out, list(key), group, profiles[key], skew)
    # input columns in their own order, then the features in lookup order
    return out.select(*df.columns, *[n for r in resolved for n in r.features])


def _join_all(df: DataFrame, key: list[str], frames: list[DataFrame]) -> DataFrame:
    for frame in frames:
        df = df.join(frame, key, "left")
    return df


def _join_group(df: DataFrame, key: list[str], group: list[_Resolved], profile: KeyProfile | None,
                skew: SkewPolicy) -> DataFrame:
    frames = [r.frame for r in group]
    if profile is None:
        return _join_all(df, key, frames)
    if profile.distinct <= skew.point_lookup_keys:
        frames = _cut_down(df, key, frames, profile, skew)
        # At most ``distinct`` rows survive (the table key is unique); they are
        # broadcast only when their bytes are proven small.
        bytes_ = [profile.distinct * r.row_bytes * _DECODED_MARGIN if r.row_bytes is not None else None for r in group]
        if all(b is not None and b <= skew.max_broadcast_bytes for b in bytes_):
            return _join_all(df, key, [F.broadcast(f) for f in frames])
    null_apart = profile.null_rows >= skew.hot_key_rows
    if profile.hot is None and not null_apart:
        return _join_all(df, key, frames)
    n_blocks = _hot_blocks(group, profile, skew) if profile.hot is not None else 0
    rows = _in_parts(df, key, profile, n_blocks, null_apart, skew)
    features = [f.schema[n] for f, r in zip(frames, group, strict=True) for n in r.features]
    out = _join_all(rows(COLD), key, frames)
    if null_apart:
        out = out.unionByName(rows(NULL_KEY).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in features]))
    for b in range(n_blocks):
        keys = profile.hot if n_blocks == 1 else profile.hot.where(block_of(key, n_blocks) == b)
        few = [f.join(F.broadcast(keys), key, "left_semi") for f in frames]
        out = out.unionByName(_join_all(rows(b), key, [F.broadcast(f) for f in few]))
    return out


COLD, NULL_KEY = -1, -2         # parts of an input; hot keys have the number of their block
_PART = f"{HOT}_part"


def _in_parts(df: DataFrame, key: list[str], profile: KeyProfile, n_blocks: int, null_apart: bool,
              skew: SkewPolicy) -> Callable[[int], DataFrame]:
    """Evaluate ``df`` once, writing its rows part by part; the function returned reads one part back.

    Marking broadcasts the hot keys in bounded blocks and shuffles nothing.
    """
    spark = df.sparkSession
    part = F.lit(COLD)
    rows = df
    if n_blocks:
        rows = mark_hot(df, profile, skew)
        block = F.lit(0) if n_blocks == 1 else block_of(key, n_blocks).cast("int")
        part = F.when(F.col(HOT), block).otherwise(part)
    if null_apart:
        part = F.when(any_null(key), NULL_KEY).otherwise(part)
    path = scratch_path(spark, "lookup-parts")
    rows.withColumn(_PART, part.cast("int")).select(*df.columns, _PART).write.partitionBy(_PART).parquet(path)
    written = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(_PART, T.IntegerType())])).parquet(path)
    return lambda number: written.where(F.col(_PART) == number).select(*df.columns)        # one folder each


def _hot_blocks(group: list[_Resolved], profile: KeyProfile, skew: SkewPolicy) -> int:
    """Blocks of hot keys, so that the broadcast of each block's keys and feature rows (one per key at most) is bounded."""
    widest = max((r.row_bytes if r.row_bytes is not None else _UNKNOWN_ROW_BYTES) for r in group)
    n = blocks_for(profile.n_hot * widest * _DECODED_MARGIN, skew)
    return min(max(n, blocks_for(2 * profile.hot_bytes + 64 * profile.n_hot, skew)), profile.n_hot)


def _cut_down(df: DataFrame, key: list[str], frames: list[DataFrame], profile: KeyProfile,
              skew: SkewPolicy) -> list[DataFrame]:
    """The feature rows that few distinct keys can match.

    Very few keys go into the scan as a literal IN list (bucket pruning, row-group
    skipping on the key-sorted bucket files); otherwise the distinct input keys, whose
    bytes were observed, are broadcast into a semi join (or shuffled, if too wide).
    """
    cond = literal_filter(key[0], profile.literals) if profile.literals is not None and len(key) == 1 else None
    if cond is not None:
        return [f.where(cond) for f in frames]
    wanted = df.select(*key).distinct()
    if 2 * profile.key_bytes + 64 * profile.distinct <= skew.max_broadcast_bytes:
        wanted = F.broadcast(wanted)
    return [f.join(wanted, key, "left_semi") for f in frames]


@dataclass
class TrainingSet:
    """Input frame + lookups + label; ``load_df()`` builds the joined frame."""

    spark: SparkSession
    df: DataFrame
    feature_lookups: list[FeatureLookup]
    label: str | None
    exclude_columns: list[str] = field(default_factory=list)
    skew: SkewPolicy = field(default_factory=SkewPolicy)

    def load_df(self) -> DataFrame:
        joined = attach_features(self.spark, self.df, self.feature_lookups, self.skew)
        return joined.drop(*self.exclude_columns) if self.exclude_columns else joined

    def spec(self) -> dict:
        return {"feature_lookups": [lk.to_dict() for lk in self.feature_lookups],
                "label": self.label, "exclude_columns": list(self.exclude_columns)}

    def spec_json(self) -> str:
        return json.dumps(self.spec(), sort_keys=True)


def create_training_set(spark: SparkSession, df: DataFrame, feature_lookups: Sequence[FeatureLookup],
                        label: str | None, exclude_columns: str | Iterable[str] = (),
                        skew: SkewPolicy | None = None) -> TrainingSet:
    """Declare a training set; columns are checked now, rows are joined on ``load_df()``."""
    if label is not None and label not in df.columns:
        raise ValueError(f"label {label!r} is not a column of the input frame")
    excl = list(_tuple(exclude_columns) or ())
    if label in excl:
        raise ValueError("the label cannot be excluded")
    _resolve(spark, df, feature_lookups)
    return TrainingSet(spark, df, list(feature_lookups), label, excl, skew or SkewPolicy())
