"""HyperMinHash sketches of shingle sets.

The shingle hashes of a document fall into ``registers`` buckets; each keeps its
smallest hash in compressed form: the number of leading zeros (6 bits) and the
``mantissa`` bits after the first one. Two documents agree in a register with
about the probability of their Jaccard similarity, plus a small chance that two
different minima compress alike, which ``similarity`` takes off.
"""

from __future__ import annotations

import hashlib

import numpy as np

from larder.llm.common import mix64

REGISTERS, MANTISSA, EMPTY = 128, 10, np.uint16(0)
ROWS = 4                                # registers in a band
BANDS = REGISTERS // ROWS
_LEVELS = 53                            # leading zeros told apart (of 57 bits)


def word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``size`` words (all words as one, if fewer)."""
    if not len(words):
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - size + 1)
    out = np.full(n, min(size, len(words)), np.uint64)
    for j in range(min(size, len(words))):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n])
    return np.unique(out)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch: 16-bit registers, 0 where no shingle falls (a filled one is never 0)."""
    out = np.zeros(REGISTERS, np.uint16)
    if not len(hashes):
        return out
    bucket = (hashes >> np.uint64(57)).astype(np.int64)                 # 7 bits: 128 registers
    rest = (hashes & np.uint64((1 << 57) - 1)) | np.uint64(1)
    lowest = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))   # hashes are sorted
    lowest[bucket[first]] = rest[first]
    filled = bucket[first]
    value = lowest[filled]
    bits = np.frexp(value.astype(np.float64))[1].astype(np.int64)       # position of the leading one, plus one
    too_high = (np.uint64(1) << (bits - 1).astype(np.uint64)) > value   # rounding up at a power of two
    bits = bits - too_high
    zeros = 57 - bits
    shift = np.maximum(bits - 1 - MANTISSA, 0).astype(np.uint64)
    mantissa = (value >> shift) & np.uint64((1 << MANTISSA) - 1)
    level = np.minimum(zeros, _LEVELS).astype(np.uint64)
    out[filled] = ((level + np.uint64(1)) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band that is not empty: its number and its registers."""
    bands = sketch.reshape(BANDS, ROWS)
    used = np.flatnonzero(bands.any(axis=1))
    packed = np.ascontiguousarray(bands[used]).view(np.uint64).ravel()
    return mix64(mix64(packed) + used.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def level_shares(n: np.ndarray) -> np.ndarray:
    """For sets of n shingles: the chance that a register's minimum has each number of leading zeros."""
    load = n[:, None] / REGISTERS
    edge = 2.0 ** -np.arange(_LEVELS + 1)
    below = -np.expm1(-load * edge)                  # chance of a hash below each edge (Poisson)
    return below[:, :-1] - below[:, 1:]


def similarity(equal: np.ndarray, either: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates from the numbers of equal and of filled registers."""
    chance = REGISTERS * (level_shares(n_a) * level_shares(n_b)).sum(axis=1) / (1 << MANTISSA)
    return np.clip((equal - chance) / np.maximum(either - chance, 1e-9), 0, 1)


def may_reach(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float,
              sigmas: float = 6.0) -> np.ndarray:
    """Which sketch pairs (rows of ``a`` and ``b``) can belong to sets at ``threshold`` or above.

    Certain: the sizes must allow it, and each shingle that only one set has spoils at most
    one register. Then the corrected estimate must not lie more than ``sigmas`` standard
    errors below the threshold.
    """
    n_a, n_b = n_a.astype(np.float64), n_b.astype(np.float64)
    unequal = (a != b).sum(axis=1)
    ok = (np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b) - 1e-9) \
        & (unequal <= (n_a + n_b) * (1 - threshold) / (1 + threshold) + 1e-9)
    left = np.flatnonzero(ok)
    if len(left):
        either = ((a[left] > 0) | (b[left] > 0)).sum(axis=1)
        equal = either - unequal[left]
        error = np.sqrt(threshold * (1 - threshold) / np.maximum(either, 1))
        close = equal / np.maximum(either, 1) >= threshold - sigmas * error     # the uncorrected one is never lower
        left, either, equal, error = left[close], either[close], equal[close], error[close]
        good = similarity(equal, either, n_a[left], n_b[left]) >= threshold - sigmas * error
        ok[:] = False
        ok[left[good]] = True
    return ok
