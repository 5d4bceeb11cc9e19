"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the smallest hash among its inner
s-mers lies at its first or last place. That depends on the k-mer alone, not on
its neighbours, so an unchanged passage keeps its anchors wherever it stands.

The fingerprint keeps the ``size`` anchors of smallest hash, in text order, each
as ``hash:position`` in hex. The likeness of two fingerprints is a bottom-k
resemblance that counts only anchors matching in position order (the longest
chain of common anchors that rises in both texts).

``compare_with_next`` fingerprints every document, its edited text and the next
document. Documents are dealt by ranges of (id, text hash), so each task holds
consecutive documents in order and streams over them with two documents in memory;
the one row missing at the end of a range (the first of the next range) is added to
it beforehand. Texts are shuffled once. Many rows under one id (NULL included) are
several ranges; repeats of one text follow each other and are compared once.

Nulls, edges: a NULL text is empty; an empty text has the empty fingerprint, equal
only to itself (likeness 1; 0 to any other). A text without any syncmer (shorter
than k, or just none) has one anchor: the hash of the whole text. Rows with equal
ids follow each other by the hash of the text, then by text; NULL ids come last. A
single row is its own next.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import bounded_batches, input_bytes, mix64, partitions_for, sliding_min

_SLICE = 1 << 20        # code points hashed at a time
_LAST = (1 << 63) - 1   # order of NULL ids


@dataclass(frozen=True)
class SyncmerParams:
    """``max_ranges`` bounds the list of range starts; more text makes longer ranges, read row by row."""
    k: int = 12
    s: int = 5
    size: int = 48
    max_ranges: int = 1 << 20


def syncmer_hashes(codes: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 32-bit hashes of the closed syncmers of a code point array."""
    n = len(codes)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inner = np.zeros(n - s + 1, np.uint64)
    for j in range(s):
        inner *= np.uint64(0x100000001B3)
        inner += codes[j:n - s + 1 + j]
    inner = mix64(inner)
    w = k - s + 1
    low = sliding_min(inner, w)
    at = np.flatnonzero((inner[:len(low)] == low) | (inner[w - 1:] == low))
    whole = np.zeros(len(at), np.uint64)
    for j in sorted({*range(0, k - s + 1, s), k - s}):
        whole = mix64(whole ^ inner[at + j])
    return at, whole >> np.uint64(32)


def anchors(text: str, p: SyncmerParams) -> list[tuple[int, int]]:
    """The fingerprint as (hash, position) pairs in text order."""
    if not text:
        return []
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    best_hash, best_at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for start in range(0, len(codes), _SLICE):
        at, h = syncmer_hashes(codes[start:start + _SLICE + p.k - 1].astype(np.uint64), p.k, p.s)
        best_hash, best_at = np.concatenate([best_hash, h]), np.concatenate([best_at, at + start])
        # a hash may stand at many places: only its first counts, and only distinct hashes fill the fingerprint
        best_hash, first = np.unique(best_hash, return_index=True)
        best_hash, best_at = best_hash[:p.size], best_at[first[:p.size]]
    if not len(best_hash):
        whole = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=4).digest()
        return [(int.from_bytes(whole, "big"), 0)]
    order = np.argsort(best_at, kind="stable")
    return list(zip(best_hash[order].tolist(), best_at[order].tolist(), strict=True))


def as_text(fingerprint: list[tuple[int, int]]) -> str:
    return " ".join(f"{h:08x}:{at:x}" for h, at in fingerprint)


def likeness(a: list[tuple[int, int]], b: list[tuple[int, int]], size: int) -> float:
    """Share of the ``size`` smallest hashes of both that match in position order."""
    if not a or not b:
        return float(not a and not b)
    in_a, in_b = dict(a), dict(b)
    union = sorted(in_a.keys() | in_b.keys())[:size]
    common = sorted((in_a[h], in_b[h]) for h in union if h in in_a and h in in_b)
    chain: list[int] = []
    for _, at in common:
        i = bisect_left(chain, at)
        chain[i:i + 1] = [at]
    return len(chain) / len(union)


def _range_starts(keys: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First key (order, hash) of each of at most ``n`` ranges of about equal numbers of rows, ascending.

    Only the keys are shuffled (by range); 16 bytes a range reach the driver.
    """
    found = (keys.repartitionByRange(n, "__order", "__fp").withColumn("__part", F.spark_partition_id())
             .groupBy("__part").agg(F.min(F.struct("__order", "__fp")).alias("k")).select("k.*").toArrow())
    order, fp = (found.column(c).to_numpy() for c in ("__order", "__fp"))
    sort = np.lexsort((fp, order))
    return order[sort], fp[sort]


def range_of(order: np.ndarray, fp: np.ndarray, starts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the range that holds each key, and whether the key is the range's first."""
    low, high = (np.searchsorted(starts[0], order, side=side) for side in ("left", "right"))
    upto = low.copy()                               # starts at or before the key
    several = np.flatnonzero(high > low)            # ranges that start within the rows of this id
    for value in np.unique(order[several]):
        rows = several[order[several] == value]
        lo, hi = low[rows[0]], high[rows[0]]
        upto[rows] = lo + np.searchsorted(starts[1][lo:hi], fp[rows], side="right")
    at = upto - 1
    return at, (starts[0][at] == order) & (starts[1][at] == fp)


def compare_with_next(docs: DataFrame, params: SyncmerParams = SyncmerParams()) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Next is the next smaller id (after the smallest: the largest). Edited: the last half
    of the code points is replaced by the first as many of the next document.
    """
    spark = docs.sparkSession
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("__order", F.coalesce(F.bitwise_not("doc_id"), F.lit(_LAST).cast("bigint")))
            .withColumn("__fp", F.xxhash64("text")))
    bounded_batches(spark)
    n_parts = partitions_for(spark, input_bytes(docs, "text"))
    starts = _range_starts(rows.select("__order", "__fp"), min(4 * n_parts, params.max_ranges))
    n_ranges = len(starts[0])
    shared = spark.sparkContext.broadcast(starts)           # at most max_ranges x 16 bytes

    @F.pandas_udf("range int, first boolean")
    def place(order: pd.Series, fp: pd.Series) -> pd.DataFrame:
        at, first = range_of(order.to_numpy(np.int64), fp.to_numpy(np.int64), shared.value)
        return pd.DataFrame({"range": at.astype(np.int32), "first": first})

    dealt = rows.withColumn("__place", place("__order", "__fp"))
    edges = (dealt.where("__place.first").groupBy("__place.range").agg(F.min("text").alias("text"))
             .select(F.pmod(F.col("range") - 1, F.lit(max(n_ranges, 1))).alias("__range"), F.lit(1).alias("__edge"),
                     F.lit(None).cast("bigint").alias("__order"), F.lit(None).cast("bigint").alias("__fp"),
                     F.lit(None).cast("bigint").alias("doc_id"), "text"))
    everything = dealt.select(F.col("__place.range").alias("__range"), F.lit(0).alias("__edge"), "__order", "__fp", "doc_id",
                              "text").unionByName(edges)
    ordered = (everything.repartition(n_parts, "__range").sortWithinPartitions("__range", "__edge", "__order", "__fp", "text")
               .select("__range", "__edge", "doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, last = None, (None, None, ())
        for batch in batches:
            out = []
            for part, edge, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                follows = pending is not None and pending[0] == part
                print_ = pending[3] if follows and pending[2] == text else anchors(text, params)
                if follows:
                    _, own_id, own, own_print = pending
                    if last[0] != own or last[1] != text:       # else: a run of copies, compared once
                        half = len(own) // 2
                        edited = own[:len(own) - half] + text[:half]
                        edited_print = anchors(edited, params)
                        last = own, text, (len(own), hashlib.sha256(edited.encode()).hexdigest(), as_text(own_print),
                                           as_text(edited_print), likeness(own_print, edited_print, params.size),
                                           likeness(own_print, print_, params.size))
                    out.append((own_id, *last[2]))
                pending = None if edge else (part, doc_id, text, print_)
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=NAMES)

    return ordered.mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double")


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
