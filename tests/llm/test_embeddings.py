"""Near-duplicate vectors against all pairs, the flat graph against plain search."""

import numpy as np
import pytest

from larder.llm import embedding_dedup as ed
from larder.llm import flat_graph
from larder.llm.queries import op12_embedding_dedup
from tests.conftest import SF_ORACLE
from tests.llm import edge

SCHEMA = "vec_id bigint, embedding array<float>, label int, node bigint, cls bigint, shard bigint, digest string, __at int"


def plain(rows, cosine=0.95):
    """(id, links, component) per row (id, components), by all pairs in double precision."""
    good, units = [], []
    for k, (_, v) in enumerate(rows):
        x = np.array([np.nan if c is None else c for c in v or []], np.float32).astype(float)
        if len(x) and np.isfinite(x).all() and np.abs(x).max() > 0:
            x /= np.abs(x).max()
            good.append(k)
            units.append(x / np.linalg.norm(x))
    links = {k: [] for k in range(len(rows))}
    for a, x in zip(good, units, strict=True):
        for b, y in zip(good, units, strict=True):
            if a != b and len(x) == len(y) and x @ y >= cosine:
                links[a].append(b)
    out = []
    for k, (i, _) in enumerate(rows):
        todo, seen = [k], {k}
        while todo:
            for b in links[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        low = min(edge.order_of(rows[b][0]) for b in seen)
        out.append((i, len(links[k]), None if low == (1 << 63) - 1 else low, edge.order_of(i) == low))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, "d", 5) for i, v in rows], SCHEMA)


def found(spark, rows, **params):
    return sorted((tuple(r) for r in ed.linked_vectors(frame(spark, rows), ed.EmbeddingParams(**params)).collect()), key=str)


def some_vectors(seed, spread, n=700, dim=24):
    """Random directions; groups around some of them, of 2 to 200 vectors; exact and scaled copies."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    parts = [x]
    for k, size in enumerate((2, 3, 10, 40, 200)):
        parts.append(x[k] + rng.normal(size=(size, dim)) * spread * np.linalg.norm(x[k]) / np.sqrt(dim))
    parts += [x[:20], 3 * x[:20], np.repeat(x[30:31], 50, axis=0)]
    every = np.vstack(parts).astype(np.float32)
    return [(int(i), every[k].tolist()) for k, i in enumerate(rng.permutation(len(every)) - 5)]


@pytest.mark.parametrize("spread", [0.05, 0.15, 0.22])
def test_equals_all_pairs(spark, spread):
    rows = some_vectors(1, spread)
    assert found(spark, rows) == plain(rows)                    # one shard
    want, got = plain(rows), found(spark, rows, shard_rows=150)       # several shards
    links = sum(r[1] for r in want)
    assert sum(min(a[1], b[1]) for a, b in zip(got, want, strict=True)) >= 0.97 * links
    assert all(a[1] <= b[1] for a, b in zip(got, want, strict=True))        # none below the threshold


def test_blocks_of_a_hot_shard_lose_nothing(spark):
    rows = some_vectors(2, 0.08, n=100)
    assert found(spark, rows, shard_rows=20, max_shards=1) == plain(rows)
    assert found(spark, rows, shard_rows=20, max_shards=1, member_block=7) == plain(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (2, [1.0, 0.1]), (None, [1.0, 0.0]), (None, None), (3, None), (4, []), (5, [0.0, 0.0]),
            (6, [None, 1.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [-0.0, 1.0]), (10, [0.0, 1.0]), (11, [1.0]), (12, [5.0]),
            (13, [1.0, 0.0, 0.0]), (14, [3e38, 0.0]), (15, [1e-38, 0.0]), (16, [0.0, -1.0]), (-3, [0.95, 0.3123])]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []
    assert found(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_recall_is_audited(spark):
    rows = some_vectors(3, 0.05)
    nodes = ed.node_table(ed.unit_rows(frame(spark, rows)))
    params = ed.EmbeddingParams()
    right, there = ed.audited_recall(nodes, ed.node_links(nodes, params), params)
    assert right == there > 0
    blind = nodes.selectExpr("node", "0L AS n_links", "low AS component")
    assert ed.audited_recall(nodes, blind, params)[0] == 0


def test_whole_table_equals_all_pairs(spark):
    rows = [tuple(r)[:2] for r in spark.read.parquet(SF_ORACLE + "/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in op12_embedding_dedup(spark, SF_ORACLE).collect()), key=str)
    assert got == plain(rows)


def test_graph_finds_all_in_range():
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(600, 16)), rng.normal(size=16) + 0.05 * rng.normal(size=(90, 16))])
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    params = flat_graph.GraphParams(degree=12, width=24)
    edges, owner = flat_graph.build(x, params)
    assert (owner == np.arange(len(x))).all() and ((edges >= 0).sum(axis=1) > 0).all()
    assert all(i not in row for i, row in enumerate(edges.tolist()))
    _, _, (q, row, cosine) = flat_graph.search(x, edges, flat_graph.medoids(x, 4), x, params, np.arange(len(x)),
                                               np.full(len(x), 0.9, np.float32))
    assert len(set(zip(q.tolist(), row.tolist(), strict=True))) == len(q) and (cosine >= 0.9 - 1e-6).all()
    assert len(q) >= 0.98 * (x @ x.T >= 0.9).sum()
