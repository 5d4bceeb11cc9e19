"""Blockwise suffix sorting with a difference cover, in numpy.

The suffixes of a block are told apart on their first ``length`` bytes:

* cover samples are the positions whose number modulo ``PERIOD`` lies in
  ``COVER``; they are ranked first, by their first
  ``length - PERIOD + 1`` bytes;
* all suffixes are sorted by their head (first ``PERIOD`` bytes) and tail (last
  bytes); most are alone then;
* a tie of suffixes i and j is resolved by one comparison of cover ranks: for any
  i, j there is a shift k < PERIOD for which i + k and j + k are both cover
  samples, and head, tail and those ranks together span all ``length`` bytes.

So no comparison reads further than the head, however long a repeat is, and the
memory is a fixed multiple of the block.
"""

from __future__ import annotations

import numpy as np

# A perfect difference set (each difference modulo 13 occurs).
PERIOD, COVER = 13, (0, 1, 3, 9)


def loads(buffer: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes at each position as big-endian numbers (order of bytes = order of numbers)."""
    view = np.ndarray((len(buffer) - 7,), ">u8", buffer, 0, (1,))
    return view[at].astype(np.uint64)


def refined(rank: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Dense ranks by (rank, word)."""
    order = np.lexsort((words, rank))
    r, w = rank[order], words[order]
    step = np.zeros(len(order), np.int64)
    step[1:] = (r[1:] != r[:-1]) | (w[1:] != w[:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(step)
    return out


def dense(words: np.ndarray) -> np.ndarray:
    order = np.argsort(words)
    w = words[order]
    step = np.zeros(len(order), np.int64)
    step[1:] = w[1:] != w[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(step)
    return out


def tied(rank: np.ndarray) -> np.ndarray:
    """Which dense ranks occur more than once."""
    return np.bincount(rank)[rank] > 1 if len(rank) else np.zeros(0, bool)


def prefix_ranks(buffer: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Dense ranks of the positions by their first ``depth`` bytes (depth >= 8); only ties are read on."""
    rank = dense(loads(buffer, at))
    for j in sorted({*range(8, depth - 7, 8), depth - 8} - {0}):
        open_ = np.flatnonzero(tied(rank))
        if not len(open_):
            break
        sub = refined(rank[open_], loads(buffer, at[open_] + j))
        # spread the finer ranks within their old rank: new rank = order of (old, fine)
        fine = np.zeros(len(rank), np.uint64)
        fine[open_] = sub.astype(np.uint64)
        rank = refined(rank, fine)
    return rank


def lowest_owner(buffer: np.ndarray, windows: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """For each window (a suffix start) the smallest owner among all windows with equal first ``length`` bytes.

    ``buffer`` must have 8 spare bytes at its end; ``length`` is at least 29.
    """
    best = owner.copy()
    if len(windows) < 2:
        return best
    depth = length - PERIOD + 1
    head = prefix_ranks(buffer, windows, PERIOD)
    live = np.flatnonzero(tied(head))
    if not len(live):
        return best
    tail = prefix_ranks(buffer, windows[live] + depth, length - depth)
    pair = refined(head[live], tail.astype(np.uint64))
    still = tied(pair)
    live, pair = live[still], pair[still]
    if not len(live):
        return best
    # cover samples that any live window can refer to
    residue = windows[live] % PERIOD
    wanted = [live_at for k in range(PERIOD)
              for live_at in [windows[live][np.isin((residue + k) % PERIOD, COVER)] + k]]
    samples = np.unique(np.concatenate(wanted))
    rank = prefix_ranks(buffer, samples, depth)
    for k in range(PERIOD):
        use = np.flatnonzero(np.isin((residue + k) % PERIOD, COVER))
        if not len(use):
            continue
        sample = rank[np.searchsorted(samples, windows[live[use]] + k)]
        key = pair[use] * np.int64(len(samples) + 1) + sample
        order = np.argsort(key)
        sorted_key, who = key[order], owner[live[use]][order]
        first = np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]))
        low = np.repeat(np.minimum.reduceat(who, first), np.diff(np.append(first, len(order))))
        target = live[use][order]
        best[target] = np.minimum(best[target], low)
    return best
