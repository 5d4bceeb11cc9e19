"""Periodic runs of the words of a text, by Lyndon roots from Baier's grouping.

A run is a stretch of words with smallest period q, at least ``max(shortest, repeats * q)``
words long, that can't be extended by a word with the same period.

1. ``stretches`` cuts a text down to pieces outside of which no run can lie: at scale B
   (1, 2, 4, ...) a run with period B <= q < 2B makes the B words at more than 2B
   consecutive places return within 2B words. Nothing else is decided there.
2. ``lyndon_lengths`` is the first phase of Baier's suffix sorter: groups of suffixes with a
   common prefix are taken from the greatest to the smallest, and the suffixes just before
   a group move to a new group whose prefix is their old one followed by the group's. When
   a group's turn has come, its prefix is the longest Lyndon word at its places. Under the
   order of the words and its inverse this gives both Lyndon arrays, with no suffix array.
3. Every run has, under one of the orders, Lyndon roots as longest Lyndon words at its first
   places, one after the other. ``runs_of`` takes places with ``repeats - 1`` equal lengths in
   a row and extends them by the longest common extensions to the right and to the left.

A document stays in one task; nothing is shuffled. Time is linear in the words of a piece,
plus the lengths of its runs (n log n in all for runs of three repeats and more).

Nulls, edges: NULL and empty texts, and texts of white space, have no words and no runs. Ties
for the strongest run go to the smallest start, then the smallest period. Each row is treated
by itself, so repeated rows give equal rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from larder.llm.common import bounded_batches, utf8_column


@dataclass(frozen=True)
class RunParams:
    """A run has at least ``repeats`` (3 or more) periods and ``shortest`` words."""
    repeats: int = 4
    shortest: int = 6

    def __post_init__(self):
        if self.repeats < 3:
            raise ValueError("runs of fewer than three periods are not supported")


# --- pieces that can hold a run

def _names(keys: np.ndarray, alive: np.ndarray, least: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For places ``alive`` (ascending) with these keys: the places whose key occurs ``least`` times, its name, the way to the next."""
    order = np.argsort(keys, kind="stable")
    sorted_keys, places = keys[order], alive[order]
    new = np.append(True, sorted_keys[1:] != sorted_keys[:-1])
    group = np.cumsum(new) - 1
    sizes = np.bincount(group)
    ahead = np.full(len(places), n, np.int64)
    same = ~new[1:]
    ahead[:-1][same] = places[1:][same] - places[:-1][same]
    often = sizes[group] >= least
    back = np.argsort(places[often])
    return places[often][back], group[often][back], ahead[often][back]


def stretches(ids: np.ndarray, params: RunParams = RunParams()) -> list[tuple[int, int]]:
    """Disjoint pieces ``(start, end)`` of a sequence of word numbers that hold all its runs.

    Several texts may follow one another if no number occurs in two of them.
    """
    n, pieces, size = len(ids), [], 1
    alive, names = np.arange(n), np.asarray(ids, np.int64)
    # a word group of a run occurs at least repeats - 1 times, at every scale up to the period
    while len(alive) > (params.repeats - 2) * size:
        alive, names, ahead = _names(names, alive, params.repeats - 1, n)
        near = alive[ahead < 2 * size]
        if len(near):
            cuts = np.flatnonzero(np.diff(near) != 1) + 1
            first, last = near[np.append(0, cuts)], near[np.append(cuts, len(near)) - 1]
            # a run with period q has (repeats - 1) * q - B + 1 such places in a row
            long = last - first + 1 >= (params.repeats - 2) * size + 1
            pieces += zip(first[long].tolist(), np.minimum(last[long] + 3 * size, n).tolist(), strict=True)
        follower = np.full(n, -1, np.int64)
        follower[alive] = names
        after = follower[np.minimum(alive + size, n - 1)]
        ok = (after >= 0) & (alive + size < n)
        alive, names = alive[ok], names[ok] * np.int64(n) + after[ok]
        size *= 2
    merged: list[tuple[int, int]] = []
    for lo, hi in sorted(pieces):
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return [(lo, hi) for lo, hi in merged if hi - lo >= params.shortest]


# --- Lyndon arrays

def lyndon_lengths(ranks: list[int], n_ranks: int) -> list[int]:
    """Length of the longest Lyndon word at every place of a sequence of ranks 0 .. n_ranks - 1 (Baier, phase one).

    Groups are linked in order. ``left`` and ``right`` link the places whose group is still to
    come, so that a place's left neighbour, when its group's turn comes, is the nearest
    place before it with a smaller suffix group.
    """
    n = len(ranks)
    members: list[list[int]] = [[] for _ in range(n_ranks)]
    for place, r in enumerate(ranks):
        members[r].append(place)
    group = list(ranks)
    length = [1] * n_ranks                          # of the prefix that a group's suffixes share
    above, below = list(range(1, n_ranks + 1)), list(range(-1, n_ranks - 1))
    left, right = list(range(-1, n)), list(range(1, n + 2))     # one place more: the end
    found = [0] * n
    g = n_ranks - 1
    while g >= 0:
        prefix, times = length[g], {}
        for place in members[g]:                    # ascending
            if group[place] != g:
                continue                            # moved on since
            found[place] = prefix
            before, after = left[place], right[place]
            left[after] = before
            if before >= 0:
                right[before] = after
                times[before] = times.get(before, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for place, k in times.items():
            moves.setdefault((k, group[place]), []).append(place)
        # more repeats of the prefix stand higher: they are put in first, the others below them
        for k, old in sorted(moves, reverse=True) if len(moves) > 1 else moves:
            new = len(length)
            length.append(length[old] + k * prefix)
            members.append(moves[k, old])
            for place in moves[k, old]:
                group[place] = new
            up = above[old]
            above.append(up)
            below.append(old)
            above[old] = below[up] = new            # up exists: the old group lies below g
        g = below[g]
    return found


# --- runs

def _common(x: np.ndarray, a: int, b: int) -> int:
    """Longest common extension to the right of the places a < b."""
    done, step = 0, 16
    while b + done < len(x):
        part = min(step, len(x) - b - done)
        differ = x[a + done:a + done + part] != x[b + done:b + done + part]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + part, step * 2
    return done


def runs_of(ids: np.ndarray, params: RunParams = RunParams()) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of word numbers, by start, then period."""
    x = np.unique(np.asarray(ids, np.int64), return_inverse=True)[1].astype(np.int64)
    n, n_ranks = len(x), int(x.max()) + 1 if len(x) else 0
    back = x[::-1]
    out: set[tuple[int, int, int]] = set()
    for ranks in (x, n_ranks - 1 - x):
        words = np.array(lyndon_lengths(ranks.tolist(), n_ranks), np.int64)
        places = np.arange(n)
        for k in range(1, params.repeats - 1):      # repeats - 1 words of one length in a row
            at = places + k * words[places]
            ok = at < n
            ok[ok] = words[at[ok]] == words[places[ok]]
            places = places[ok]
        reach: dict[int, int] = {}                  # per period: up to here the last stretch was extended
        for i, q in zip(places.tolist(), words[places].tolist(), strict=True):
            if i < reach.get(q, 0):
                continue
            right = _common(x, i, i + q)
            left = _common(back, n - i - q, n - i)  # the places before i + q and before i, backwards
            reach[q] = i + right + 1
            size = left + right + q
            if size >= max(params.shortest, params.repeats * q):
                out.add((i - left, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared exactly; the first of equal ones."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that some run repeats (all but its first period)."""
    if not runs:
        return words
    drop = np.zeros(len(words), bool)
    for start, size, period in runs:
        drop[start + period:start + size] = True
    return [words[i] for i in np.flatnonzero(~drop).tolist()]


def batch_runs(texts: list[list[bytes]], params: RunParams = RunParams()) -> list[list[tuple[int, int, int]]]:
    """The runs of each of several word lists."""
    starts = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    ids, fresh = np.empty(int(starts[-1]), np.int64), count()
    for t, lo, hi in zip(texts, starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        numbers = defaultdict(fresh.__next__)       # a word has another number in each text
        ids[lo:hi] = np.fromiter(map(numbers.__getitem__, t), np.int64, len(t))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for lo, hi in stretches(ids, params):
        first = int(np.searchsorted(starts, lo, side="right")) - 1
        for start, size, period in runs_of(ids[lo:hi], params):
            # a piece can reach over the end of a text, a run can't
            text = int(np.searchsorted(starts, lo + start, side="right")) - 1 if hi > starts[first + 1] else first
            out[text].append((lo + start - int(starts[text]), size, period))
    return out


def periodic_runs(docs: DataFrame, params: RunParams = RunParams(),
                  rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, n_words, n_dropped per row.

    ``rewrite`` may replace the words of a document, given its id (None for a NULL id).
    """
    bounded_batches(docs.sparkSession)
    source = docs.select("doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buffer, offsets = utf8_column(batch, "text")
            ids = batch.column(0).to_pylist()
            texts = [buffer[lo:hi].tobytes().split()        # bytes: ASCII white space only
                     for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            if rewrite is not None:
                texts = [rewrite(i, t) for i, t in zip(ids, texts, strict=True)]
            rows = []
            for words, runs in zip(texts, batch_runs(texts, params), strict=True):
                best = strongest(runs)
                start, size, period = best or (None, None, None)
                kept = collapsed(words, runs)
                rows.append((len(runs), start, size, period, 1000 * size // period if best else None,
                             hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
                             hashlib.sha256(b" ".join(kept)).hexdigest(), len(words), len(words) - len(kept)))
            columns = list(zip(*rows, strict=True)) or [()] * 9
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                       "collapsed_sha256", "n_words", "n_dropped"])

    return source.mapInArrow(run, f"doc_id {kind}, n_runs bigint, start bigint, length bigint, period bigint, "
                             "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string, n_words bigint, n_dropped bigint")
