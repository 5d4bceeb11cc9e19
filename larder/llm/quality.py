"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors: one per word, per adjacent word
pair and per character n-gram (3 and 4 characters of ``<word>``), all hashed
into one table. A softmax layer on the average gives the label. Vectors and
layer are trained together by numpy stochastic gradient descent.

A pair of equal words hashes to one shared bucket, so runs of a repeated word
are one feature whatever the word.

Since the output is linear in the average, the fitted model reduces to one
number per bucket (its part of the label-1 margin); scoring adds these up.

Nulls, edges: NULL and empty texts have no n-gram and score by the bias alone.
A NULL ``doc_id`` counts as held out. Without any usable label every document
scores 0.5.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.labelled import scored, training_rows
from larder.llm.word_table import RecentValues, WordTable


@dataclass(frozen=True)
class QualityParams:
    """``max_docs`` bounds the labelled sample for the fit; scoring has no bound."""
    buckets: int = 1 << 18
    dim: int = 10
    epochs: int = 6
    rate: float = 0.2
    max_docs: int = 5_000
    threshold: float = 0.3
    seed: int = 7


def subwords(word: str, buckets: int) -> list[int]:
    """Buckets of a word: the word itself, then its character 3- and 4-grams."""
    padded = f"<{word}>"
    if padded.isascii():
        padded = padded.encode()
        grams = [padded[i:i + n] for n in (3, 4) for i in range(len(padded) - n + 1)]
    else:
        grams = [padded[i:i + n].encode() for n in (3, 4) for i in range(len(padded) - n + 1)]
        padded = padded.encode()
    return [crc32(g) % buckets for g in (padded, *grams)]


def word_pairs(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each adjacent word pair; equal words share bucket 0."""
    a, b = hashes[:-1], hashes[1:]
    mixed = (a * np.uint64(0x9E3779B1) + b * np.uint64(0x85EBCA77)) >> np.uint64(7)
    return np.where(a == b, 0, mixed % np.uint64(buckets)).astype(np.int64)


def describe_for(params: QualityParams):
    """Bag of buckets of a text: sorted bucket ids and their shares."""
    known = RecentValues(lambda w: np.array([crc32(w.encode()), *subwords(w, params.buckets)], np.uint32), 150_000)

    def describe(text: str) -> tuple[bytes, bytes, bytes]:
        words = text.split()
        if not words:
            return b"", b"", b""
        known.trim()
        rows = [known[w] for w in words]
        hashes = np.array([r[0] for r in rows], np.uint64)
        flat = np.concatenate([*(r[1:] for r in rows), word_pairs(hashes, params.buckets)])
        ids, counts = np.unique(flat.astype(np.int32), return_counts=True)
        return ids.tobytes(), (counts / counts.sum()).astype(np.float32).tobytes(), b""
    return describe


def train(rows: list, params: QualityParams) -> tuple[np.ndarray, float]:
    """Fit by SGD; returns the label-1 margin of each bucket and the bias margin.

    Each step is scaled by the squared norm of the bag, so the averaged vector
    moves by ``rate`` times its gradient however long the text.
    """
    rng = np.random.default_rng(params.seed)
    table = rng.uniform(-0.1, 0.1, (params.buckets, params.dim)).astype(np.float32)
    layer = rng.normal(0, 0.5, (params.dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    bags = [(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["weights"], np.float32), r["label"])
            for r in rows]
    if not bags:
        return np.zeros(params.buckets, np.float32), 0.0
    steps, total = 0, params.epochs * len(bags)
    for _ in range(params.epochs):
        for k in rng.permutation(len(bags)):
            ids, share, label = bags[k]
            rate = params.rate * (1 - steps / total)
            steps += 1
            hidden = share @ table[ids] if len(ids) else np.zeros(params.dim, np.float32)
            z = hidden @ layer + bias
            error = np.exp(z - z.max())
            error /= error.sum()
            error[label] -= 1
            back = layer @ error
            layer -= rate * np.outer(hidden, error)
            bias -= 0.1 * rate * error
            if len(ids):
                table[ids] -= np.outer(share * (rate / float(share @ share)), back)
    margin = layer[:, 1] - layer[:, 0]
    return table @ margin, float(bias[1] - bias[0])


def scorer(margins: np.ndarray, bias: float, buckets: int):
    """Function text -> probability of label 1, with its own bounded word table."""
    def columns(word: str) -> tuple[float, float, float]:
        ids = subwords(word, buckets)
        return float(margins[ids].sum()), len(ids), crc32(word.encode())

    words = WordTable(columns, 3)

    def score(text: str) -> float:
        tokens = text.split()
        total, n = 0.0, 0
        if tokens:
            words.trim()
            rows = words.rows(tokens)
            total, n = float(words.values[rows, 0].sum()), int(words.values[rows, 1].sum())
            hashes = words.values[rows, 2].astype(np.uint64)
            total += float(margins[word_pairs(hashes, buckets)].sum())
            n += len(tokens) - 1
        z = total / n + bias if n else bias
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
    return score


def classify_quality(docs: DataFrame, labels: DataFrame, held_out: Column, trainable: Column,
                     params: QualityParams = QualityParams(), target: str = "quality") -> DataFrame:
    """Fit on the ``trainable`` labelled rows and score every document.

    Returns doc_id, held_out, score (probability of label 1), predicted.
    """
    rows = training_rows(docs, labels, target, trainable, params.max_docs, describe_for(params))
    margins, bias = train(rows, params)
    shared = docs.sparkSession.sparkContext.broadcast(margins)      # buckets x 4 bytes: fixed size
    return scored(docs, held_out, lambda: scorer(shared.value, bias, params.buckets), params.threshold)


def reject_low_quality(docs: DataFrame, labels: DataFrame, held_out: Column, trainable: Column,
                       params: QualityParams = QualityParams()) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns.

    Works row by row on the text itself (no join back), so repeated and NULL ids keep their rows.
    """
    from larder.llm.text_filter import keep_where
    rows = training_rows(docs, labels, "quality", trainable, params.max_docs, describe_for(params))
    margins, bias = train(rows, params)
    shared = docs.sparkSession.sparkContext.broadcast(margins)

    def make():
        score = scorer(shared.value, bias, params.buckets)
        return lambda text: score(text) >= params.threshold
    return keep_where(docs, make)
