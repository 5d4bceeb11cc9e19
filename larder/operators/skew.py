"""Finding heavily repeated lookup keys, so that joins can treat them apart.

A many-to-one lookup join shuffles the input by its lookup key. When one key (or
the NULL key) holds a large share of the input rows, the task that owns it does
most of the work. ``profile_keys`` counts the keys once (partial aggregation
first, so the count itself is not skewed) and writes the hot ones as a table: no
list of keys reaches the driver. ``lookup`` then joins hot rows with the few
feature rows of the hot keys, without a shuffle, and all other rows as usual.

A key is hot from ``hot_key_rows`` rows on, or from ``rows / max_hot_keys`` if that
is more: by counting there can be at most ``max_hot_keys`` such keys, and every key
with a larger share is among them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from larder.session import scratch_path

HOT = "__larder_hot"
COUNT = "__larder_n"


@dataclass(frozen=True)
class SkewPolicy:
    """How lookup keys are profiled before joining.

    When the input has at most ``point_lookup_keys`` distinct keys, they are also
    pushed into the feature-table scan, so a small batch of ids reads only the
    buckets (and Parquet row groups) that can hold them. ``max_broadcast_bytes``
    bounds every broadcast; what exceeds it is joined in several bounded blocks
    (hot keys) or by a shuffle (all others).
    """

    enabled: bool = True
    hot_key_rows: int = 1_000_000    # a key with at least this many input rows is joined apart
    max_hot_keys: int = 1_000_000    # the threshold rises until at most so many keys can be hot
    point_lookup_keys: int = 10_000  # at most this many distinct keys: cut the tables down to them
    literal_keys: int = 256          # at most this many: the filter is a literal IN list
    max_broadcast_bytes: int = 256 << 20


@dataclass(frozen=True)
class KeyProfile:
    """What one count of the keys of a frame shows."""

    keys: tuple[str, ...]
    rows: int
    distinct: int                        # distinct keys (NULL counts as one)
    key_bytes: int                       # bytes of all distinct keys as text
    null_rows: int                       # rows whose key has a NULL
    hot: DataFrame | None                # the hot keys without NULL, or None
    n_hot: int
    hot_bytes: int                       # bytes of the hot keys as text
    literals: tuple[tuple, ...] | None   # every non-NULL key, when there are at most ``literal_keys``


def any_null(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def profile_keys(df: DataFrame, keys: Sequence[str], policy: SkewPolicy) -> KeyProfile | None:
    """Profile the lookup keys of ``df`` by one aggregate; ``None`` when the policy is off.

    The numbers are observed while the hot keys are written, so they cost no extra
    pass; the keys themselves are collected (a second, keys-only pass) only when
    there are at most ``literal_keys`` of them.
    """
    keys = tuple(keys)
    if not policy.enabled:
        return None
    spark = df.sparkSession
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COUNT))
    size = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(0)).cast("bigint")
    is_null = any_null(keys)
    is_hot = (F.col(COUNT) >= policy.hot_key_rows) & ~is_null
    seen, path = Observation(), scratch_path(spark, "hot-keys")

    def total(value: Column, when: Column | None = None) -> Column:
        return F.coalesce(F.sum(value if when is None else F.when(when, value)), F.lit(0).cast("bigint"))
    (counts.observe(seen, F.count(F.lit(1)).alias("distinct"), total(F.col(COUNT)).alias("rows"),
                    total(size).alias("key_bytes"), total(F.col(COUNT), is_null).alias("null_rows"),
                    total(F.lit(1).cast("bigint"), is_hot).alias("n_hot"), total(size, is_hot).alias("hot_bytes"))
     .where(is_hot).write.parquet(path))
    found = seen.get
    hot = None
    if found["n_hot"]:
        hot = spark.read.schema(counts.schema).parquet(path)
        if found["n_hot"] > policy.max_hot_keys:
            hot = hot.where(F.col(COUNT) > found["rows"] // policy.max_hot_keys)
        hot = hot.select(*keys)
    literals = None
    if found["distinct"] <= policy.literal_keys:
        values = [tuple(r[k] for k in keys) for r in counts.select(*keys).collect()]   # at most literal_keys rows
        literals = tuple(v for v in values if all(x is not None for x in v))
    return KeyProfile(keys, found["rows"], found["distinct"], found["key_bytes"], found["null_rows"], hot,
                      min(found["n_hot"], policy.max_hot_keys), found["hot_bytes"], literals)


def blocks_for(n_bytes: float, policy: SkewPolicy) -> int:
    """Number of blocks so that each stays under the broadcast bound."""
    return max(1, int(-(-n_bytes // max(1, policy.max_broadcast_bytes))))


def block_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n))


def mark_hot(df: DataFrame, profile: KeyProfile, policy: SkewPolicy) -> DataFrame:
    """Adds ``HOT``: whether the row's key is hot. Broadcasts the hot keys, in bounded blocks; no shuffle."""
    keys, n = list(profile.keys), blocks_for(2 * profile.hot_bytes + 64 * profile.n_hot, policy)
    out, flags = df, []
    for b in range(n):
        part = profile.hot if n == 1 else profile.hot.where(block_of(keys, n) == b)
        out = out.join(F.broadcast(part.withColumn(f"{HOT}{b}", F.lit(True))), keys, "left")
        flags.append(F.col(f"{HOT}{b}"))
    return out.select(*df.columns, F.coalesce(*flags, F.lit(False)).alias(HOT))


def _sql_literal(v) -> str | None:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return None


def literal_filter(key: str, values: Sequence[tuple]) -> Column | None:
    """``key IN (v1, v2, ...)`` as one SQL expression (parsed once on the JVM), or
    ``None`` when a value has no plain literal form."""
    if not values:
        return F.lit(False)
    lits = [_sql_literal(v[0]) for v in values]
    if any(x is None for x in lits):
        return None
    return F.expr(f"`{key.replace('`', '``')}` IN ({', '.join(lits)})")
