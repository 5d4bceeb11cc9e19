"""Exact passage removal and near-duplicates against plain-Python versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import hyperminhash as hmh
from larder.llm import near_dedup, suffix_dedup
from larder.llm.near_dedup import NearParams, keep_one_of_each, near_duplicates
from larder.llm.queries import op2_suffix_dedup, op4_near_dedup
from larder.llm.suffix_dedup import DedupParams, cut_runs, dedup_report, from_planes, merged, planes, remove_repeats
from larder.llm.suffix_sort import lowest_owner
from tests.conftest import SF_SMALL
from tests.llm import edge

LAST = (1 << 63) - 1


def short_rows():
    """The edge rows without the very long ones (the plain-Python version is slow on those)."""
    return [(i, t, s) for i, t, s in edge.texts() if len(t or "") < 20_000]


def test_suffix_sort_equals_dictionary():
    rng = np.random.default_rng(1)
    for trial in range(20):
        base = bytes(rng.integers(97, 100, 300).astype(np.uint8))
        text, windows, owners = b"", [], []
        for i in range(20):
            at = int(rng.integers(0, 200))
            part = bytearray(base[at:at + int(rng.integers(50, 100))]) if trial % 4 else bytearray(b"a" * 90)
            part[int(rng.integers(0, len(part)))] = 120
            for j in range(len(part) - 49):
                windows.append(len(text) + j)
                owners.append(i * 7 % 20)
            text += bytes(part)
        lowest = {}
        for w, o in zip(windows, owners, strict=True):
            lowest[text[w:w + 50]] = min(lowest.get(text[w:w + 50], 99), o)
        got = lowest_owner(np.frombuffer(text + b"\0" * 16, np.uint8), np.array(windows), np.array(owners), 50)
        assert got.tolist() == [lowest[text[w:w + 50]] for w in windows]


def test_runs_cover_every_suffix_once():
    rng = np.random.default_rng(2)
    text = rng.integers(97, 101, 3000).astype(np.uint8)
    offsets = np.array([0, 10, 60, 109, 159, 159, 3000])
    runs = cut_runs(text, offsets, 50)
    covered = np.concatenate([np.arange(s, s + c) for s, c in zip(runs.start, runs.count, strict=True)])
    expected = np.concatenate([np.arange(a, b - 49) for a, b in zip(offsets[:-1], offsets[1:], strict=True) if b - a >= 50])
    assert covered.tolist() == expected.tolist()


def test_planes_round_trip():
    values = np.sort(np.random.default_rng(3).integers(0, 1 << 62, 1000).astype(np.uint64))
    assert (from_planes(planes(values)) == values).all()
    assert len(from_planes(planes(values[:0]))) == 0


def test_merged_ranges():
    assert merged(np.array([5, 0, 8, 20]), np.array([8, 3, 9, 21])).tolist() == [[0, 3], [5, 9], [20, 21]]


def test_dedup_edge_rows(spark):
    rows = [(i, (t or "").encode()) for i, t, _ in short_rows()]
    got = [tuple(r) for r in dedup_report(edge.documents(spark, short_rows())).collect()]
    assert sorted(got, key=str) == sorted(edge.dedup_rows(rows), key=str)


def test_dedup_long_texts_and_tiny_filter(spark):
    long_ = " ".join(f"word{i}" for i in range(60_000))
    rows = [(1, long_, "a"), (2, "start " + long_, "a"), (3, "y" * 9000, "a"), (4, "y" * 60, "a")]
    got = {r["doc_id"]: r for r in dedup_report(edge.documents(spark, rows), DedupParams(filter_bytes=64)).collect()}
    assert got[1]["n_removed"] == 0 and got[3]["n_removed"] == 0
    assert got[2]["n_removed"] == len(long_) and got[2]["n_spans"] == 1
    assert got[4]["n_removed"] == 60


def test_dedup_whole_table(spark):
    docs = spark.read.parquet(SF_SMALL + "/documents.parquet").select("doc_id", "text").collect()
    exp = edge.dedup_rows([(r[0], (r[1] or "").encode()) for r in docs])
    got = [tuple(r) for r in op2_suffix_dedup(spark, SF_SMALL).collect()]
    assert sorted(got) == sorted(exp)


def shared_passage(n):
    """One passage in ``n`` documents, each with its own words around it."""
    rng = np.random.default_rng(9)

    def own():
        return bytes(rng.integers(97, 123, 80).astype(np.uint8)).decode()
    return [(i, own() + edge.PASSAGE + own(), "a") for i in range(n)]


def test_edges_of_a_common_passage_spread_over_buckets(spark):
    rows = shared_passage(400)
    docs = edge.documents(spark, rows).select(
        F.col("doc_id").alias("__at"), F.xxhash64("text").alias("__fp"), F.lit(0).alias("__blk"), "text")
    sizes = []
    real = type(docs).repartition

    def seen(self, n, *cols):
        if cols == ("bucket",):
            packed = self.collect()
            for b in {r["bucket"] for r in packed if r["bucket"] >= 0}:
                opened = [suffix_dedup.unpack(r["__payload"], suffix_dedup.zstandard.ZstdDecompressor()) for r in packed if r["bucket"] == b]
                sizes.append(sum(len(x[1]) for x in opened))
        return real(self, n, *cols)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(docs), "repartition", seen)
        suffix_dedup.repeated_ranges(docs, DedupParams(hot_runs=50), 16, 100)
    assert max(sizes) < 0.1 * sum(sizes)


def test_dedup_hot_hashes(spark):
    rows = shared_passage(60) + [(i + 100, t, s) for i, t, s in short_rows() if i is not None]
    want = edge.dedup_rows([(i, (t or "").encode()) for i, t, _ in rows])
    for hot in (0, 20):
        got = [tuple(r) for r in dedup_report(edge.documents(spark, rows), DedupParams(hot_runs=hot)).collect()]
        assert sorted(got) == sorted(want)


def test_dedup_empty_table(spark):
    empty = edge.documents(spark, [])
    assert dedup_report(empty).count() == 0 and remove_repeats(empty).count() == 0


def test_remove_repeats_keeps_columns_and_cuts_text(spark):
    docs = edge.documents(spark, short_rows())
    rows = [(i, (t or "").encode()) for i, t, _ in short_rows()]
    out = remove_repeats(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    exp = []
    for (i, t, s), m in zip(short_rows(), edge.repeated_bytes(rows), strict=True):
        kept = bytes(b for b, x in zip((t or "").encode(), m, strict=True) if not x).decode("utf-8", "ignore")
        if not any(m):
            exp.append((i, t, s))
        elif kept:
            exp.append((i, kept, s))
    got = [(r["doc_id"], r["text"], r["source"]) for r in out.collect()]
    assert sorted(got, key=str) == sorted(exp, key=str)
    assert {r["__parts"] for r in out.collect()} == {"pp"}
    assert all(r["n_chars"] == len(r["text"]) for r in out.where("text IS NOT NULL").collect())


@pytest.mark.parametrize("words", [4, 5])
def test_near_edge_rows(spark, words):
    rows = [(i, t) for i, t, _ in edge.texts()]
    got = [(r[0], r[1], LAST if r[2] is None else r[2], r[3]) for r in
           near_duplicates(edge.documents(spark), NearParams(words=words)).collect()]
    exp = [(i, n, c, edge.order_of(i) == c) for i, n, c in edge.near_rows(rows, words)]
    assert sorted(got, key=str) == sorted(exp, key=str)


def variants(n):
    """Near copies in chains (each a little further from the first), one common line, unrelated texts."""
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 10_000, 120)]
    rows, current = [], list(base)
    for i in range(n):
        if i % 3 == 0:
            current = list(current)
            current[int(rng.integers(0, 120))] = f"new{i}"
        rows.append((i, " ".join(current)))
    line = "this very common line stands in many of the small documents here"
    for i in range(n, 3 * n):
        own = " ".join(f"q{x}" for x in rng.integers(0, 10_000, int(rng.integers(3, 30))))
        rows.append((i, line + " " + own))
    return rows


def test_near_chains_and_blocks(spark):
    rows = variants(60)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    exp = sorted((i, n, c) for i, n, c in edge.near_rows(rows, 4))
    for block in (1000, 7):                 # small blocks: large groups are dealt by block pairs
        got = near_duplicates(docs, NearParams(words=4, block=block)).collect()
        assert sorted(tuple(r)[:3] for r in got) == exp


def test_one_large_cluster_ships_its_sets_a_few_times(spark, monkeypatch):
    """5,000 copies like one original (0.85) but not like each other (0.72), and a few texts that only look near."""
    rng = np.random.default_rng(8)
    base = [f"w{x}" for x in range(100)]

    def changed(i, places):
        words = list(base)
        for k in places:
            words[k] = f"new{i}x{k}"
        return " ".join(words)
    rows = [(0, " ".join(base))] + [(i, changed(i, sorted({int(rng.integers(5, 45)), int(rng.integers(50, 95))})))
                                    for i in range(1, 5000)]
    rows += [(i, changed(i, [10, 50, 90])) for i in range(5000, 5005)]
    shipped = []
    confirm = near_dedup.confirmed_forest

    def counting(members, percent, parts):
        shipped.append(members.count())
        return confirm(members, percent, parts)
    monkeypatch.setattr(near_dedup, "confirmed_forest", counting)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, NearParams(words=4, block=250)).collect()}
    assert {i for i in range(5000) if got[i] != 0} == set()
    assert all(got[i] == i for i in range(5000, 5005))
    assert sum(shipped) <= 4 * len(rows)                # block pairs of all nodes would ship 20 * len(rows)


def test_near_whole_table(spark):
    docs = spark.read.parquet(SF_SMALL + "/documents.parquet").select("doc_id", "text").collect()
    exp = [(i, n, c, i == c) for i, n, c in edge.near_rows([tuple(r) for r in docs], 4)]
    assert sorted(tuple(r) for r in op4_near_dedup(spark, SF_SMALL).collect()) == sorted(exp)


def test_near_empty_table(spark):
    empty = edge.documents(spark, [])
    assert near_duplicates(empty).count() == 0 and keep_one_of_each(empty).count() == 0


def test_keep_one_of_each(spark):
    docs = edge.documents(spark)
    out = keep_one_of_each(docs)
    assert out.columns == docs.columns
    rows = [(i, t) for i, t, _ in edge.texts()]
    comps = edge.near_rows(rows, 5)
    with_words = {c: None for _, n, c in comps if n}
    groups = {}
    for (i, t), (_, n, c) in zip(rows, comps, strict=True):
        if n and edge.order_of(i) == c:
            groups.setdefault((c, frozenset(edge.shingle_set(t, 5))), []).append(t)
    kept = out.collect()
    assert sum(1 for r in kept if not (r["text"] or "").split()) == sum(1 for _, n, _ in comps if not n)
    # one row of every group of linked documents; edge ids 7 and NULL hold several groups
    full = [(r["doc_id"], r["text"]) for r in kept if (r["text"] or "").split()]
    assert len(full) == len(set(full))
    assert {edge.order_of(i) for i, _ in full} == set(with_words)


def test_keep_one_of_each_keeps_every_group(spark):
    near = " ".join(f"v{i}" for i in range(60))
    rows = [(None, "the first text without an id stands alone", "a"), (None, "another one that has no id and no likeness", "a"),
            (None, near + " x", "a"), (None, near + " y", "a"),             # linked with each other, not with the two above
            (5, "one text under a number that is used again", "a"), (5, "quite different words below the same number here", "a"),
            (5, "one text under a number that is used again", "a"), (6, near.upper() + " z", "a"), (None, "  ", "a"), (5, None, "a")]
    kept = [(r["doc_id"], r["text"]) for r in keep_one_of_each(edge.documents(spark, rows)).collect()]
    alone = [(i, t) for i, t, _ in (rows[0], rows[1], rows[4], rows[5], rows[7], rows[8], rows[9])]
    assert sorted(kept, key=str) == sorted(alone, key=str)
    twins = edge.documents(spark, rows[:4])     # without the row with an id, one of the two linked NULL ids stays
    texts = {r["text"] for r in keep_one_of_each(twins).collect()}
    assert texts in ({rows[0][1], rows[1][1], rows[2][1]}, {rows[0][1], rows[1][1], rows[3][1]})


def test_register_estimate_is_close():
    rng = np.random.default_rng(7)
    pool = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    for overlap in (0.3, 0.8, 0.95):
        n = 3000
        shared = int(2 * n * overlap / (1 + overlap))
        a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:shared], rng.integers(0, 1 << 63, n - shared).astype(np.uint64)]))
        ra, rb = hmh.registers(a)[None], hmh.registers(b)[None]
        either, equal = ((ra > 0) | (rb > 0)).sum(1), ((ra == rb) & (ra > 0)).sum(1)
        got = hmh.similarity(equal, either, np.array([n]), np.array([n]))[0]
        assert abs(got - overlap) < 0.2


def test_sketch_filter_never_drops_a_link():
    rng = np.random.default_rng(8)
    for n in (4, 5, 9, 20, 60, 200, 1000):
        for _ in range(60):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            own = int(len(a) * 0.1)
            b = np.unique(np.concatenate([a[own:], rng.integers(0, 1 << 63, own).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert hmh.may_reach(hmh.registers(a)[None], hmh.registers(b)[None], np.array([len(a)]), np.array([len(b)]), 0.8)[0]
                keys = set(hmh.band_keys(hmh.registers(a)).tolist()) & set(hmh.band_keys(hmh.registers(b)).tolist())
                assert keys


def test_native_kept_flag(spark):
    got = near_duplicates(edge.documents(spark)).where(F.col("n_shingles") == 0)
    assert got.where(~F.col("kept")).count() == 0
