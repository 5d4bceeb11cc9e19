"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import scratch_path


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage with files every executor can reach, so a lost executor
    costs the tasks it held and no earlier step.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def input_bytes(docs: DataFrame, column: str) -> int:
    """Total UTF-8 bytes of a text column (one aggregate; 0 for an empty table)."""
    return int(docs.agg(F.sum(F.octet_length(column)).alias("b")).first()["b"] or 0)


def partitions_for(spark: SparkSession, n_bytes: int, per_task: int = 32 << 20) -> int:
    """Number of shuffle partitions so that each holds about ``per_task`` bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // per_task))


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns and all columns as one struct ``__all``, so no added name can clash with the table's."""
    return docs.select(*columns, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__all"))


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``BATCH_BYTES``, so Python workers hold little text at a time."""
    now = spark.conf.get(BATCH)
    if not now.rstrip("b").isdigit() or int(now.rstrip("b")) > BATCH_BYTES:
        spark.conf.set(BATCH, f"{BATCH_BYTES}b")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (NULL for a NULL id)."""
    return F.crc32(doc_id.cast("string")) % modulus


def utf8_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """A text column of a batch as one byte buffer and row offsets, without copying per row.

    NULL rows are empty. Returns ``(buffer uint8, offsets int64 of len rows + 1)``.
    """
    col = batch.column(batch.schema.get_field_index(name))
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_binary())
    data = col.buffers()
    offsets = np.frombuffer(data[1], np.int64)[col.offset:col.offset + len(col) + 1]
    whole = np.frombuffer(data[2], np.uint8) if data[2] is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def keyed_tables(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """One table per key (the first ``n_keys`` columns, integers) from rows sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in range(n_keys)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if held and last != keys[lo].tolist():
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = keys[lo].tolist()
    if held:
        yield pa.Table.from_batches(held)


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (uint64, wrapping)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (length ``n - width + 1``)."""
    if len(values) < width:
        return values[:0]
    done, out = 1, values
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    if done < width:
        rest = width - done
        out = np.minimum(out[:-rest], out[rest:])
    return out
