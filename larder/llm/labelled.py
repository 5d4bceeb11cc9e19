"""Bounded training samples and application of a fitted text scorer.

Shared by the two classifiers. Labels come from rows outside the held-out fold
only; the sample is the only bounded part (``max_docs``), scoring covers every
document.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import bounded_batches

TRAIN_SCHEMA = "label int, ids binary, weights binary, extra binary"


def training_rows(docs: DataFrame, labels: DataFrame, target: str, trainable: Column, max_docs: int,
                  describe: Callable[[str], tuple[bytes, bytes, bytes]]) -> list[dict]:
    """Features of at most ``max_docs`` labelled documents, as rows on the driver.

    The sample is the ``max_docs`` labelled ids with the smallest hash: the same
    rows whatever the partitioning. Conflicting labels of one id count as 1.
    NULL ids and NULL labels are left out. Texts stay on the executors; only
    hashed features travel.
    """
    bounded_batches(docs.sparkSession)
    chosen = (labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & trainable)
              .groupBy("doc_id").agg(F.max(F.col(target).cast("int")).alias("__label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))
    pairs = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("__text"))
             .join(F.broadcast(chosen), "doc_id")          # at most max_docs ids: a proven bound
             .select("doc_id", "__text", "__label"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            out = [[squeeze.compress(x) for x in describe(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2).cast(pa.int32()),
                 *(pa.array([o[i] for o in out], pa.binary()) for i in range(3))],
                names=["doc_id", "label", "ids", "weights", "extra"])

    found = pairs.mapInArrow(features, "doc_id bigint, " + TRAIN_SCHEMA).toArrow()      # max_docs rows
    ids, label = (found.column(c).to_numpy() for c in ("doc_id", "label"))
    parts = {c: unpacked(found.column(c)) for c in ("ids", "weights", "extra")}
    order = sorted(range(len(ids)), key=lambda k: (ids[k], zlib.crc32(parts["ids"][k])))
    return [{"doc_id": int(ids[k]), "label": int(label[k]), **{c: v[k] for c, v in parts.items()}} for k in order]


def unpacked(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The decompressed values of a binary column, as views of one buffer (which goes at once with the last of them)."""
    open_ = zstandard.ZstdDecompressor()
    frames = [x.as_buffer() for chunk in column.chunks for x in chunk]
    ends = np.cumsum([0, *(zstandard.frame_content_size(f) for f in frames)])
    whole = np.empty(int(ends[-1]), np.uint8)
    for f, lo, hi in zip(frames, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        whole[lo:hi] = np.frombuffer(open_.decompress(f), np.uint8)
    return [whole[lo:hi] for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def scored(docs: DataFrame, held_out: Column, make_scorer: Callable[[], Callable[[str], float]],
           threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted for every document (NULL text scores as empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make_scorer()
        for batch in batches:
            values = [score(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values, pa.float64()),
                 pa.array([int(v >= threshold) for v in values], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    return (docs.select(F.col("doc_id").cast("bigint"), held_out.alias("held_out"), "text")
            .mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int"))
