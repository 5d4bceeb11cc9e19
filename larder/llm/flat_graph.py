"""A flat neighbour graph over unit vectors in numpy: robust-pruned edges, greedy beam search, range expansion.

Everything works on many queries at once; a graph is held by one task and has a bounded
number of vectors. Edges are an array (vectors, degree) of row numbers, -1 where there is none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class GraphParams:
    """``degree``: edges per vector; ``width``: beam; ``alpha``: how much longer a detour may be than an edge it replaces."""
    degree: int = 24
    width: int = 32
    alpha: float = 1.2
    batch: int = 256
    at_once: int = 4            # beam entries expanded in one step


def medoids(vectors: np.ndarray, n: int) -> np.ndarray:
    """Rows nearest to the centre of all and to the centres of up to ``n - 1`` rough clusters."""
    centres = [vectors.mean(axis=0)]
    if len(vectors) > n > 1:
        seeds = vectors[np.linspace(0, len(vectors) - 1, n - 1).astype(int)]
        home = (vectors @ seeds.T).argmax(axis=1)
        centres += [vectors[home == c].mean(axis=0) for c in range(n - 1) if (home == c).any()]
    return np.unique((vectors @ np.stack(centres).T).argmax(axis=0))


def _pairs(keys: np.ndarray, n: int, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct unseen (query, row) pairs among ``query * n + row`` keys; marks them as seen."""
    keys = np.unique(keys)
    flat = seen.reshape(-1)
    keys = keys[~flat[keys]]
    flat[keys] = True
    return keys // n, keys % n


def _cosines(vectors: np.ndarray, queries: np.ndarray, q: np.ndarray, row: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", queries[q], vectors[row]) if len(q) else np.zeros(0, vectors.dtype)


def search(vectors: np.ndarray, edges: np.ndarray, starts: np.ndarray, queries: np.ndarray, params: GraphParams,
           own: np.ndarray | None = None, radius: np.ndarray | None = None):
    """Beam search for each query from ``starts`` (and from its ``own`` row, -1: none).

    Returns the beams ``(rows, cosines)``, best first, -1 where empty. With ``radius`` (a cosine per
    query) also all pairs found at or above it: after the greedy phase every row in range is
    expanded, and the rows in range that this finds, until none is left.
    """
    n, n_q, width = len(vectors), len(queries), params.width
    seen = np.zeros((n_q, n), bool)
    done = np.zeros((n_q, n), bool)
    beam = np.full((n_q, width), -1, np.int64)
    score = np.full((n_q, width), -np.inf, vectors.dtype)
    hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def take(keys: np.ndarray) -> None:
        q, row = _pairs(keys, n, seen)
        if not len(q):
            return
        cosine = _cosines(vectors, queries, q, row)
        if radius is not None:
            near = cosine >= radius[q]
            hits.append((q[near], row[near], cosine[near]))
        who, first, many = np.unique(q, return_index=True, return_counts=True)
        place = np.arange(len(q)) - np.repeat(first, many)
        rows = np.full((len(who), int(many.max())), -1, np.int64)
        values = np.full(rows.shape, -np.inf, vectors.dtype)
        line = np.repeat(np.arange(len(who)), many)
        rows[line, place], values[line, place] = row, cosine
        rows, values = np.hstack([beam[who], rows]), np.hstack([score[who], values])
        best = np.argsort(-values, axis=1, kind="stable")[:, :width]
        beam[who], score[who] = np.take_along_axis(rows, best, 1), np.take_along_axis(values, best, 1)

    first = (np.arange(n_q)[:, None] * n + starts[None, :]).reshape(-1)
    if own is not None:
        first = np.append(first, (np.arange(n_q) * n + own)[own >= 0])
    take(first)
    lines = np.arange(n_q)
    while len(lines):
        open_ = (beam[lines] >= 0) & ~done[lines[:, None], np.maximum(beam[lines], 0)]
        rank = np.cumsum(open_, axis=1)
        chosen = open_ & (rank <= params.at_once)
        line, column = np.nonzero(chosen)
        if not len(line):
            break
        q, row = lines[line], beam[lines[line], column]
        done[q, row] = True
        next_ = edges[row]
        ok = next_ >= 0
        take((q[:, None] * n + next_)[ok])
        lines = lines[open_.any(axis=1)]
    if radius is None:
        return beam, score
    at = 0
    while at < len(hits):
        q, row = (np.concatenate(x) for x in zip(*[(h[0], h[1]) for h in hits[at:]], strict=True))
        at = len(hits)
        fresh = ~done[q, row]
        q, row = q[fresh], row[fresh]
        done[q, row] = True
        for lo in range(0, len(q), 65_536):
            next_ = edges[row[lo:lo + 65_536]]
            keys = (q[lo:lo + 65_536, None] * n + next_)[next_ >= 0]
            a, b = _pairs(keys, n, seen)
            cosine = _cosines(vectors, queries, a, b)
            near = cosine >= radius[a]
            if near.any():
                hits.append((a[near], b[near], cosine[near]))
    if not hits:
        return beam, score, (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return beam, score, tuple(np.concatenate(x) for x in zip(*hits, strict=True))


def robust_prune(vectors: np.ndarray, points: np.ndarray, candidates: np.ndarray, params: GraphParams) -> np.ndarray:
    """Up to ``degree`` of the candidates (points, -1 for none) of each point.

    The nearest candidate stays and removes those that it is ``alpha`` times nearer to than the point is; and so on.
    """
    out = np.full((len(points), params.degree), -1, np.int64)
    for lo in range(0, len(points), 512):
        p, c = points[lo:lo + 512], candidates[lo:lo + 512]
        c = np.sort(np.where(c == p[:, None], -1, c), axis=1)
        c[:, 1:][c[:, 1:] == c[:, :-1]] = -1                        # a candidate listed twice
        x = vectors[np.maximum(c, 0)]
        far = np.where(c >= 0, 2 - 2 * np.matmul(x, vectors[p][:, :, None])[:, :, 0], np.inf)
        order = np.argsort(far, axis=1, kind="stable")
        c, far = np.take_along_axis(c, order, 1), np.take_along_axis(far, order, 1)
        x = np.take_along_axis(x, order[:, :, None], 1)
        between = (2 - 2 * np.matmul(x, x.transpose(0, 2, 1))) * params.alpha ** 2
        alive = np.isfinite(far)
        lines = np.arange(len(p))
        for k in range(params.degree):
            left = alive.any(axis=1)
            if not left.any():
                break
            pick = alive.argmax(axis=1)
            out[lo:lo + 512][left, k] = c[lines, pick][left]
            alive &= ~(left[:, None] & (between[lines, pick] <= far))
            alive[lines, pick] = False
    return out


def _add_back_edges(vectors: np.ndarray, edges: np.ndarray, points: np.ndarray, params: GraphParams) -> None:
    """For every edge point -> row of new points the edge back; full lists are pruned again."""
    rows = edges[points]
    line, column = np.nonzero(rows >= 0)
    target, source = rows[line, column], points[line]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    who, first, many = np.unique(target, return_index=True, return_counts=True)
    # hubs take their new edges in turns, so that a list to prune stays short
    for turn in range(0, int(many.max(initial=0)), params.degree):
        some = many > turn
        w, count = who[some], np.minimum(many[some] - turn, params.degree)
        extra = np.full((len(w), int(count.max())), -1, np.int64)
        place = np.arange(extra.shape[1])[None, :] < count[:, None]
        extra[place] = source[(first[some][:, None] + turn + np.arange(extra.shape[1])[None, :])[place]]
        used = (edges[w] >= 0).sum(axis=1)
        fits = used + count <= params.degree
        for t, e, u, k in zip(w[fits].tolist(), extra[fits], used[fits].tolist(), count[fits].tolist(), strict=True):
            edges[t, u:u + k] = e[:k]
        full = ~fits
        if full.any():
            edges[w[full]] = robust_prune(vectors, w[full], np.hstack([edges[w[full]], extra[full]]), params)


def build(vectors: np.ndarray, params: GraphParams, near: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the graph over the vectors, and the owner of each.

    Vectors are inserted in batches: each is searched in the graph so far, its beam and its batch's
    nearest are pruned to its edges. With ``near`` a vector that finds another one at that cosine or
    above is not inserted; that other one owns it (else a vector owns itself).
    """
    n = len(vectors)
    edges = np.full((n, params.degree), -1, np.int64)
    owner = np.arange(n)
    if n < 2:
        return edges, owner
    start = medoids(vectors, 1)
    rest = np.random.default_rng(n).permutation(n)
    rest = rest[rest != start[0]]
    at, inserted = 0, 1
    while at < len(rest):
        points = rest[at:at + min(params.batch, max(8, inserted))]
        at += len(points)
        beam, score = search(vectors, edges, start, vectors[points], params)
        mutual = vectors[points] @ vectors[points].T
        np.fill_diagonal(mutual, -np.inf)
        if near is not None:
            held = score[:, 0] >= near
            owner[points[held]] = beam[held, 0]
            free = ~held
            for i in np.flatnonzero((mutual >= near).any(axis=1)).tolist():
                if free[i]:
                    close = free & (mutual[i] >= near)
                    close[:i] = False
                    owner[points[close]] = points[i]
                    free &= ~close
            points, beam, mutual = points[free], beam[free], mutual[np.ix_(free, free)]
            if not len(points):
                continue
        peers = min(8, len(points) - 1)
        if peers:
            ids = points[np.argpartition(-mutual, peers - 1, axis=1)[:, :peers]]
            beam = np.hstack([beam, ids])
        edges[points] = robust_prune(vectors, points, beam, params)
        _add_back_edges(vectors, edges, points, params)
        inserted += len(points)
    return edges, owner
