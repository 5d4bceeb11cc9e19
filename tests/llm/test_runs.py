"""Lyndon arrays and periodic runs against definitions written out, the query against them on a whole table."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import periodic
from larder.llm.queries import op11_periodic_runs
from tests.conftest import SF_SMALL
from tests.llm import edge


def plain_lyndon(x):
    """The longest Lyndon word at each place: up to the next smaller suffix."""
    return [next((j for j in range(i + 1, len(x)) if x[j:] < x[i:]), len(x)) - i for i in range(len(x))]


def plain_runs(x, repeats=4, shortest=6):
    found, seen = [], set()
    for q in range(1, len(x) // repeats + 1):
        i = 0
        while i + q < len(x):
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            size = j - i + q
            if size >= max(shortest, repeats * q) and (i, size) not in seen:    # a smaller period came first
                seen.add((i, size))
                found.append((i, size, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


periodic_words = st.builds(
    lambda head, root, n, tail: head + (root * n)[:n * 2] + tail,
    st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(0, 30),
    st.lists(st.integers(0, 3), max_size=30))


@settings(max_examples=300, deadline=None)
@given(periodic_words)
def test_lyndon_arrays_under_both_orders(x):
    assert periodic.lyndon_lengths(x, 4) == plain_lyndon(x)
    back = [3 - v for v in x]
    assert periodic.lyndon_lengths(back, 4) == plain_lyndon(back)


@settings(max_examples=300, deadline=None)
@given(periodic_words, st.sampled_from([3, 4, 5]))
def test_runs_of_one_and_several_texts(x, repeats):
    params = periodic.RunParams(repeats=repeats)
    want = plain_runs(x, repeats)
    if x:
        assert periodic.runs_of(np.array(x), params) == want
    words = [b"%d" % v for v in x]
    assert periodic.batch_runs([words, [], [b"0"] * 5, words, words[:1]], params) == [want, [], [], want, []]


def test_long_texts_take_linear_time():
    ids = np.append(np.arange(20_000, 70_000), np.tile(np.arange(10_000), 12))
    assert periodic.runs_of(ids) == [(50_000, 120_000, 10_000)]
    assert periodic.runs_of(np.zeros(200_000, int)) == [(0, 200_000, 1)]
    with pytest.raises(ValueError):
        periodic.RunParams(repeats=2)


def digest(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def plain_row(doc_id, text, tail):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if tail and doc_id is not None and words and h % 10 == 0:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            digest(b" ".join(w for i, w in enumerate(words) if i not in drop)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_whole_table_equals_the_definition(spark):
    docs = spark.read.parquet(SF_SMALL + "/documents.parquet").collect()
    got = op11_periodic_runs(spark, SF_SMALL).select(COLUMNS).collect()
    want = [plain_row(r["doc_id"], r["text"], True) for r in docs]
    assert sorted(map(tuple, got)) == sorted(want) and any(r[1] for r in want)


def test_edge_rows(spark):
    rows = [(i, t, s) for i, t, s in edge.texts() if len(t or "") < 50_000]
    rows += [(30, "a b " * 40 + "c " + "d\n" * 6, "x"), (31, "x y " * 9, "x"), (None, "z " * 7, None)]
    got = periodic.periodic_runs(edge.documents(spark, rows)).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == sorted((plain_row(i, t, False) for i, t, _ in rows), key=str)
    assert periodic.periodic_runs(edge.documents(spark, [])).count() == 0
