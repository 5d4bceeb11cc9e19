"""Toxicity: counterfactual-regularised classifier.

Logistic regression over the distinct tokens of a text: one weight per hashed
word and per hashed character 4-gram of the word. In every labelled sentence
that names a group, each identity term is swapped for the next of its category;
the fit penalises the squared change of the sentence's score (the log-odds, whose
change doesn't fade where a long text's probability is near 0 or 1), so which group
is named moves the score little and neutral mentions are not flagged.

Nulls, edges: NULL and empty texts score by the bias alone. A NULL ``doc_id``
counts as held out. Without labels all weights are 0 (score 0.5).
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.labelled import scored, training_rows
from larder.llm.word_table import RecentValues, WordTable

# Identity terms by category; a term is swapped for the next of its category.
IDENTITY_TERMS = {
    "gender": ["woman", "man", "girl", "boy", "transgender", "nonbinary"],
    "genders": ["women", "men", "girls", "boys"],
    "religion": ["muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"],
    "religions": ["muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"],
    "origin": ["black", "white", "asian", "african", "european", "arab", "latino", "mexican", "chinese", "indian"],
    "orientation": ["gay", "straight", "lesbian", "bisexual", "queer", "heterosexual", "homosexual"],
    "status": ["immigrant", "refugee", "foreigner", "citizen"],
    "statuses": ["immigrants", "refugees", "foreigners", "citizens"],
    "ability": ["disabled", "blind", "deaf", "autistic"],
    "age": ["old", "young", "elderly", "teenage"],
    "frau": ["frau", "mann"], "frauen": ["frauen", "männer"],
    "glaube": ["muslime", "christen", "juden", "hindus"],
    "femme": ["femme", "homme"], "femmes": ["femmes", "hommes"],
    "religions_fr": ["musulmans", "chrétiens", "juifs", "bouddhistes"],
    "mujer": ["mujer", "hombre"], "mujeres": ["mujeres", "hombres"],
    "religiones": ["musulmanes", "cristianos", "judíos", "budistas"],
}
TERMS = sorted(t for terms in IDENTITY_TERMS.values() for t in terms)
SWAP = {t: terms[(i + 1) % len(terms)] for terms in IDENTITY_TERMS.values() for i, t in enumerate(terms)}

_NUMBER = {t: n for n, t in enumerate(TERMS)}
_SENTENCE = re.compile(r"[^.!?\n]+")
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


@dataclass(frozen=True)
class ToxicityParams:
    """``max_docs`` bounds the labelled sample for the fit; scoring has no bound."""
    buckets: int = 1 << 20
    min_df: int = 3
    epochs: int = 12
    batch: int = 256
    rate: float = 0.1
    l1: float = 5e-4
    fairness: float = 2.0
    max_docs: int = 8_000
    threshold: float = 0.3
    seed: int = 11


def plain(token: str) -> str:
    return token.lower().strip(_EDGE)


def word_buckets(token: str, buckets: int) -> list[int]:
    """Buckets of a token: the plain word and its distinct character 4-grams; none for bare punctuation."""
    word = plain(token)
    if not word:
        return []
    padded = f"<{word}>"
    if padded.isascii():
        padded = padded.encode()
        grams = {padded[i:i + 4] for i in range(len(padded) - 3)}
    else:
        grams = {padded[i:i + 4].encode() for i in range(len(padded) - 3)}
        padded = padded.encode()
    return sorted({crc32(g) % buckets for g in (padded, *grams)})


def swap_counts(text: str) -> dict[int, int]:
    """Number of the text's sentences that name each identity term, by the term's place in ``TERMS``."""
    counts: dict[int, int] = {}
    for sentence in _SENTENCE.findall(text):
        for term in {w for w in map(plain, sentence.split()) if w in SWAP}:
            counts[_NUMBER[term]] = counts.get(_NUMBER[term], 0) + 1
    return counts


def swap_change(term: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and signed feature changes of a sentence in which the term is swapped."""
    change: dict[int, int] = {}
    for word, sign in ((term, -1), (SWAP[term], 1)):
        for b in word_buckets(word, buckets):
            change[b] = change.get(b, 0) + sign
    kept = sorted((b, v) for b, v in change.items() if v)
    return np.array([b for b, _ in kept], np.int64), np.array([v for _, v in kept], np.float64)


def describe_for(params: ToxicityParams):
    """Feature counts over distinct tokens; extra: pairs of identity term and number of sentences that name it."""
    known = RecentValues(lambda t: np.array(word_buckets(t, params.buckets), np.int32), 150_000)

    def describe(text: str) -> tuple[bytes, bytes, bytes]:
        known.trim()
        tokens = set(text.split())
        flat = np.concatenate([known[t] for t in tokens]) if tokens else np.zeros(0, np.int32)
        ids, counts = np.unique(flat, return_counts=True)
        swaps = swap_counts(text) if any(plain(t) in SWAP for t in tokens) else {}
        extra = np.array([v for kv in sorted(swaps.items()) for v in kv], np.int32)
        return ids.tobytes(), counts.astype(np.float32).tobytes(), extra.tobytes()
    return describe


def train(rows: list, params: ToxicityParams) -> tuple[np.ndarray, float]:
    """AdaGrad mini-batches over numpy arrays; returns bucket weights and bias.

    Loss: cross-entropy + fairness * (log-odds(swapped) - log-odds(original))^2 for every term of every
    labelled sentence + L1 (proximal steps).
    Buckets in fewer than ``min_df`` sampled documents keep weight 0.
    """
    weights = np.zeros(params.buckets, np.float64)
    if not rows:
        return weights.astype(np.float32), 0.0
    ids = [np.frombuffer(r["ids"], np.int32) for r in rows]
    values = [np.frombuffer(r["weights"], np.float32) for r in rows]
    named = [np.frombuffer(r["extra"], np.int32).reshape(-1, 2) for r in rows]
    changes = {int(t): swap_change(TERMS[t], params.buckets) for t in np.unique(np.concatenate(named)[:, 0])}
    labels = np.array([r["label"] for r in rows], np.float64)
    df = np.bincount(np.concatenate(ids), minlength=params.buckets)
    usable = df >= min(params.min_df, max(1, len(rows) // 50))
    for k, i in enumerate(ids):
        keep = usable[i]
        ids[k], values[k] = i[keep], values[k][keep]
    bias, seen = float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))), np.full(params.buckets, 1e-6)
    rng = np.random.default_rng(params.seed)
    for epoch in range(params.epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), params.batch):
            part = order[at:at + params.batch]
            sizes = np.array([len(ids[k]) for k in part])
            doc = np.repeat(np.arange(len(part)), sizes)
            flat, val = np.concatenate([ids[k] for k in part]), np.concatenate([values[k] for k in part])
            z = bias + np.bincount(doc, weights[flat] * val, minlength=len(part))
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            slope = p - labels[part]
            extra_ids, extra_grad = [], []
            terms, where = np.unique(np.concatenate([named[k][:, 0] for k in part]), return_inverse=True)
            sentences = np.bincount(where, np.concatenate([named[k][:, 1] for k in part]), minlength=len(terms))
            for term, n in zip(terms.tolist(), sentences, strict=True):
                at_, change = changes[term]
                extra_ids.append(at_)
                extra_grad.append(2 * params.fairness * n * (weights[at_] @ change) * change)
            touched = np.concatenate([flat, *extra_ids])
            pushes = np.concatenate([slope[doc] * val, *extra_grad]) / len(part)
            rows_, where = np.unique(touched, return_inverse=True)
            grad = np.bincount(where, pushes, minlength=len(rows_))
            seen[rows_] += grad * grad
            step = params.rate / np.sqrt(seen[rows_])
            moved = weights[rows_] - step * grad
            weights[rows_] = np.sign(moved) * np.maximum(np.abs(moved) - step * params.l1, 0)
            bias -= 0.05 * float(slope.mean())
    return weights.astype(np.float32), bias


def scorer(weights: np.ndarray, bias: float, buckets: int):
    """Function text -> probability of label 1, with its own bounded word table."""
    words = WordTable(lambda t: (float(weights[word_buckets(t, buckets)].sum()),), 1)

    def score(text: str) -> float:
        words.trim()
        rows = words.rows(set(text.split()))
        z = bias + float(words.values[rows, 0].sum())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
    return score


def classify_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, trainable: Column,
                      params: ToxicityParams = ToxicityParams(), target: str = "toxic") -> DataFrame:
    """Fit on the ``trainable`` labelled rows and score every document.

    Returns doc_id, held_out, score (probability of label 1), predicted.
    """
    rows = training_rows(docs, labels, target, trainable, params.max_docs, describe_for(params))
    weights, bias = train(rows, params)
    shared = docs.sparkSession.sparkContext.broadcast(weights)      # buckets x 4 bytes: fixed size
    return scored(docs, held_out, lambda: scorer(shared.value, bias, params.buckets), params.threshold)
