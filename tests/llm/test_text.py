"""Token counts, fingerprints, classifiers and the url filter."""

import hashlib
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from larder.llm import quality, syncmers, token_counts, toxicity
from larder.llm.bloom import filter_words, key_hashes, probe, split_by_keys
from larder.llm.queries import (
    fold, op1_toxicity, op6_fingerprints, op8_quality, op9_token_counts, op10_url_filter, vocabulary_path)
from larder.llm.url_filter import filter_urls
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm import edge

ROWS = [(i, t, s) for i, t, s in edge.texts()]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


# --- token counts

def reference_counts(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary_path())
    return [len(e.ids) for e in t.encode_batch(list(texts), add_special_tokens=False)]


def test_token_counts_equal_the_library_on_edges():
    texts = [t or "" for _, t, _ in ROWS] + [
        " a", "a ", "a  b", "a\tb", "a \n b", "  ", " \n", "\n a", "don't we'll I'd", "x" * 3000, "é " * 50, "1 22 333 4444",
        "a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> ", "<|endoftext|><|endoftext|>", "<|endoftext|", "a\u00a0b \u2003 c",
        "\u200bzero width", "emoji 👩‍👩‍👧 done", "trailing nbsp\u00a0 next", "\x00 \x01", "a \u00a0b"]
    count = token_counts.counter(token_counts.load_merges(vocabulary_path()), "edges")
    assert [count(t) for t in texts] == reference_counts(texts)


def test_token_counts_whole_table(spark):
    rows = op9_token_counts(spark, SF_SMALL).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(SF_SMALL + "/documents.parquet").collect()}
    want = dict(zip(texts, reference_counts(texts.values()), strict=True))
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want
    assert all(r["n_bytes"] == len(texts[r["doc_id"]].encode()) and r["over_limit"] == (r["n_tokens"] > 512) for r in rows)


def test_token_counts_edge_rows(spark):
    got = token_counts.count_tokens(edge.documents(spark), vocabulary_path()).collect()
    want = [(i, len((t or "").encode()), n) for (i, t, _), n in zip(ROWS, reference_counts([t or "" for _, t, _ in ROWS]), strict=True)]
    assert sorted((tuple(r)[:3] for r in got), key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(edge.documents(spark, []), vocabulary_path()).count() == 0


def test_one_pair_of_word_tables_per_process():
    table = token_counts.load_merges(vocabulary_path())
    for name in ("one", "two", table.digest):
        token_counts.counter(table, name)("some words")
    assert list(token_counts._counters) == [table.digest] and len(table.digest) == 64


# --- fingerprints

def signed_hash(text):
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >= 1 << 63 else value


def expected_pairs(rows):
    """(id, text, next text) in descending order of id, NULL ids last, equal ids by the hash of their text."""
    order = sorted(((i, t or "") for i, t in rows),
                   key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), signed_hash(r[1]), r[1].encode()))
    return [(i, t, order[(n + 1) % len(order)][1]) for n, (i, t) in enumerate(order)]


@pytest.mark.parametrize("table", ["edge", "whole"])
def test_fingerprints(spark, table):
    if table == "edge":
        rows, got = [(i, t) for i, t, _ in ROWS], syncmers.compare_with_next(edge.documents(spark)).collect()
    else:
        rows = [tuple(r) for r in spark.read.parquet(SF_SMALL + "/documents.parquet").select("doc_id", "text").collect()]
        got = op6_fingerprints(spark, SF_SMALL).collect()
    p, want = syncmers.SyncmerParams(), []
    for i, own, after in expected_pairs(rows):
        half = len(own) // 2
        edited = own[:len(own) - half] + after[:half]
        a, b, c = (syncmers.anchors(x, p) for x in (own, edited, after))
        want.append((i, len(own), hashlib.sha256(edited.encode()).hexdigest(), syncmers.as_text(a), syncmers.as_text(b),
                     syncmers.likeness(a, b, p.size), syncmers.likeness(a, c, p.size)))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def plain_likeness(a, b, size):
    """By definition: of the ``size`` smallest hashes of both, the longest row of common ones that rises in both texts."""
    if not a or not b:
        return float(a == b)
    smallest = sorted({h for h, _ in a + b})[:size]
    both = sorted((dict(a)[h], dict(b)[h]) for h in smallest if h in dict(a) and h in dict(b))
    longest = []
    for n, (_, at) in enumerate(both):
        longest.append(1 + max((longest[m] for m in range(n) if both[m][1] < at), default=0))
    return max(longest, default=0) / len(smallest)


def test_likeness_by_definition():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = ([(int(h), int(at)) for h, at in zip(rng.permutation(40)[:n], np.sort(rng.permutation(90)[:n]), strict=True)]
                for n in rng.integers(0, 25, 2))
        assert syncmers.likeness(a, b, 12) == plain_likeness(a, b, 12)


def test_many_rows_without_an_id_are_many_ranges(spark):
    """A third of the rows has no id, another third is one text under one id."""
    rows = [(i, f"text number {i} of those that have an id of their own") for i in range(200)] \
        + [(None, f"a text that has no id, in version {i * i}") for i in range(200)] + [(77, "the same text again and again")] * 200
    docs = edge.documents(spark, [(i, t, "a") for i, t in rows])
    p = syncmers.SyncmerParams(max_ranges=40)
    keys = docs.select(F.coalesce(F.bitwise_not("doc_id"), F.lit(syncmers._LAST)).alias("__order"),
                       F.xxhash64("text").alias("__fp"))
    starts = syncmers._range_starts(keys, 40)
    assert (starts[0] == syncmers._LAST).sum() > 5 and len(starts[0]) <= 40
    order, fp = (np.array(c, np.int64) for c in zip(*[tuple(r) for r in keys.collect()], strict=True))
    firsts = list(zip(*(c.tolist() for c in starts), strict=True))
    for o, f, at, first in zip(order.tolist(), fp.tolist(), *(c.tolist() for c in syncmers.range_of(order, fp, starts)), strict=True):
        assert at == sum(s <= (o, f) for s in firsts) - 1 and first == ((o, f) in firsts)
    want = []
    for i, own, after in expected_pairs(rows):
        edited = own[:len(own) - len(own) // 2] + after[:len(own) // 2]
        a, b, c = (syncmers.anchors(x, p) for x in (own, edited, after))
        want.append((i, len(own), hashlib.sha256(edited.encode()).hexdigest(), syncmers.as_text(a), syncmers.as_text(b),
                     plain_likeness(a, b, p.size), plain_likeness(a, c, p.size)))
    got = syncmers.compare_with_next(docs, p).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_fingerprints_single_row_and_empty_table(spark):
    one = syncmers.compare_with_next(edge.documents(spark, [(1, "just one text here", "a")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert syncmers.compare_with_next(edge.documents(spark, [])).count() == 0


def test_closed_syncmers_by_definition():
    rng = np.random.default_rng(1)
    codes = rng.integers(97, 123, 400).astype(np.uint64)
    at, _ = syncmers.syncmer_hashes(codes, 12, 5)
    inner = {}
    for i in range(len(codes) - 4):         # hash of every inner string, from the function's own definition on that string alone
        h = np.zeros(1, np.uint64)
        for j in range(5):
            h = h * np.uint64(0x100000001B3) + codes[i + j]
        inner[i] = int(syncmers.mix64(h)[0])
    want = [i for i in range(len(codes) - 11)
            if min(inner[i + j] for j in range(8)) in (inner[i], inner[i + 7])]
    assert at.tolist() == want


def test_syncmers_do_not_depend_on_their_place_or_on_slices(monkeypatch):
    p, text = syncmers.SyncmerParams(size=10**6), "Some words " + " ".join(f"w{i * i % 1009}" for i in range(900))
    whole = {h for h, _ in syncmers.anchors(text, p)}
    shifted = {h for h, _ in syncmers.anchors("12345 before it " + text, p)}
    assert whole <= shifted
    monkeypatch.setattr(syncmers, "_SLICE", 100)
    assert {h for h, _ in syncmers.anchors(text, p)} == whole


@pytest.mark.parametrize("slice_", [syncmers._SLICE, 700])
@pytest.mark.parametrize("times", [1, 2, 3, 48])
def test_anchors_are_the_smallest_distinct_hashes(monkeypatch, times, slice_):
    monkeypatch.setattr(syncmers, "_SLICE", slice_)
    p, text = syncmers.SyncmerParams(), " ".join(f"w{i * i % 1009}" for i in range(120)) * times
    places = {}
    codes = np.array([ord(c) for c in text], np.uint64)
    for at in range(len(codes) - p.k + 1):          # every k-mer on its own
        for h in syncmers.syncmer_hashes(codes[at:at + p.k], p.k, p.s)[1].tolist():
            places.setdefault(h, at)
    want = sorted((places[h], h) for h in sorted(places)[:p.size])
    assert len(want) == p.size and syncmers.anchors(text, p) == [(h, at) for at, h in want]


def test_likeness_orders_edits():
    p, words = syncmers.SyncmerParams(), [f"word{i * 37 % 1013}" for i in range(400)]
    text = " ".join(words)
    small, large = " ".join(words[:380] + ["other"] * 20), " ".join(words[:150] + [f"z{i}" for i in range(250)])
    a, b, c, d = (syncmers.anchors(t, p) for t in (text, small, large, "nothing in common at all, really nothing"))
    values = [syncmers.likeness(a, x, p.size) for x in (a, b, c, d)]
    assert values[0] == 1.0 and values == sorted(values, reverse=True) and values[3] == 0.0


# --- classifiers

def accuracy(spark, df, target, modulus, held):
    lab = spark.read.parquet(SF_ORACLE + "/labels.parquet")
    rows = df.join(lab, "doc_id").select("doc_id", "held_out", "predicted", target).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == held) for r in rows)
    test = [r for r in rows if r["held_out"]]
    return sum(r["predicted"] == r[target] for r in test) / len(test)


def test_quality_on_held_out_rows(spark):
    df = op8_quality(spark, SF_ORACLE)
    assert accuracy(spark, df, "quality", 5, 0) > 0.95
    assert df.count() == 1000 and df.where("score < 0 OR score > 1 OR predicted != int(score >= 0.3)").count() == 0


def test_toxicity_on_held_out_rows(spark):
    df = op1_toxicity(spark, SF_ORACLE)
    assert accuracy(spark, df, "toxic", 4, 2) > 0.8
    assert df.count() == 1000 and df.where("score < 0 OR score > 1 OR predicted != int(score >= 0.3)").count() == 0


@pytest.mark.parametrize("classify", [quality.classify_quality, toxicity.classify_toxicity])
def test_classifiers_edge_rows(spark, classify):
    docs, target = edge.documents(spark), "quality" if classify is quality.classify_quality else "toxic"
    lab = labels(spark, [(7, 1, 0), (3, 1, 0), (7, 1, None), (2, None, 1), (None, 1, 1), (20, 0, 1), (11, 0, 1), (999, 1, 0)])
    got = classify(docs, lab, *fold(4, 2), target=target).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _, _ in ROWS)
    assert all(r["held_out"] for r in got if r["doc_id"] is None)
    empty = {r["score"] for r in got if r["doc_id"] in (2, 4)}
    assert len(empty) == 1
    same = [r["score"] for r in got if r["doc_id"] in (6, 8)]
    assert same[0] == same[1]
    none = classify(docs, labels(spark, []), *fold(4, 2), target=target)
    assert {r["score"] for r in none.collect()} == {0.5}
    assert classify(edge.documents(spark, []), lab, *fold(4, 2), target=target).count() == 0


def test_labels_of_the_held_out_fold_are_not_used(spark):
    docs = spark.read.parquet(SF_SMALL + "/documents.parquet")
    lab = spark.read.parquet(SF_SMALL + "/labels.parquet")
    held, trainable = fold(5, 0)
    turned = lab.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.classify_quality(docs, x, held, trainable).collect() for x in (lab, turned))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_counterfactual_penalty_evens_out_groups():
    """Group terms that go with the label in the data move the score less with the penalty."""
    rng = np.random.default_rng(3)
    filler = [f"word{i}" for i in range(60)]
    texts = []
    for i in range(600):
        toxic = i % 3 == 0
        group = "muslim" if (rng.random() < 0.85) == toxic else "christian"
        words = list(rng.choice(filler, 12)) + ([["idiot", "scum"][i % 2]] if toxic and rng.random() < 0.8 else [])
        rng.shuffle(words)
        texts.append((f"That {group} person said {' '.join(words)}.", int(toxic)))
    neutral = [f"My {g} neighbour likes {filler[k]} and {filler[k + 1]}." for g in ("muslim", "christian") for k in range(20)]
    gaps, flagged = [], []
    for strength in (0.0, toxicity.ToxicityParams().fairness):
        p = toxicity.ToxicityParams(fairness=strength, buckets=1 << 16, min_df=1)
        describe = toxicity.describe_for(p)
        rows = [dict(zip(("ids", "weights", "extra"), describe(t), strict=True)) | {"label": y} for t, y in texts]
        weights, bias = toxicity.train(rows, p)
        score = toxicity.scorer(weights, bias, p.buckets)
        s = [score(t) for t in neutral]
        gaps.append(abs(np.mean(s[:20]) - np.mean(s[20:])))
        flagged.append(sum(x >= p.threshold for x in s))
        assert score("You idiot scum.") > score("You word1 word2.")
    # what is left is the noise of the filler words (a third of the texts is toxic), alike for both groups
    assert gaps[0] > 0.3 and gaps[1] < 0.02 and flagged[0] == 20 and flagged[1] < 10


def test_swaps_are_counted_by_sentence():
    text = "The Muslim and the christian. A muslim, again! Men and women; muslim\nmen"
    got = {toxicity.TERMS[k]: n for k, n in toxicity.swap_counts(text).items()}
    assert got == {"muslim": 3, "christian": 1, "men": 2, "women": 1}
    assert toxicity.swap_counts("nobody here. or there") == {} == toxicity.swap_counts("")
    at, change = toxicity.swap_change("men", 1 << 20)
    lost, new = toxicity.word_buckets("men", 1 << 20), toxicity.word_buckets(toxicity.SWAP["men"], 1 << 20)
    want = {b: new.count(b) - lost.count(b) for b in lost + new}
    assert dict(zip(at.tolist(), change.tolist(), strict=True)) == {b: v for b, v in want.items() if v}


# --- url filter and its Bloom filter

URLS = [(1, "http://Example.COM/en/x?y=1"), (2, "https://www.example.com/en/"), (3, "http://a.b.net/es/q"), (4, "http://net/es/"),
        (5, "http://example.com"), (6, None), (7, "no scheme"), (8, ""), (9, "http://notexample.com/en/"), (1, "http://Example.COM/en/x?y=1"),
        (None, "x://y.net/fr/"), (10, "http://net.evil.org/es/"), (11, "a://b://c.com/z"), (12, "http://com?x=/en/"), (13, "http://.com/"),
        (14, "http://example.com:80/en/"), (15, "http://x.com/" + "a" * 20000), (16, "http://ÄB.com/ü#f")]


def judge(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[:min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [(len(h) + len(p), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_url_filter_edges(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
    pages = spark.createDataFrame([(i, u, "h", "p", "r", 1) for i, u in URLS],
                                  "page_id bigint, url string, host string, path string, rule string, at int")
    listed = spark.createDataFrame([*rules, ("com", "/", "allow"), (None, "/", "block"), ("org", None, "block")],
                                   "host string, path string, verdict string")
    for max_blocks in (1 << 10, 1):
        got = [tuple(r) for r in filter_urls(pages, listed, max_blocks=max_blocks).collect()]
        assert sorted(got, key=str) == sorted(((i, *judge(u, rules)) for i, u in URLS), key=str)
    assert filter_urls(pages.limit(0), listed).count() == 0
    assert {r["verdict"] for r in filter_urls(pages, listed.limit(0)).collect()} == {"allow"}


def test_bloom_filter_never_misses_and_rarely_lies(spark):
    keys = spark.range(2000).select((F.col("id") * 7).alias("k"))
    words = filter_words(keys, key_hashes(F.col("k")), 1 << 10)
    h = spark.range(14000).select(F.col("id").alias("k"), key_hashes(F.col("id")).alias("h")).orderBy("k").toPandas()["h"]
    h = np.array(h.tolist(), np.int64)
    passed = probe(words, h[:, 0], h[:, 1])
    assert passed[::7].all() and passed.mean() - 1 / 7 < 0.02
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("__may_"))
    maybe, never = split_by_keys(rows.withColumn("j", F.col("k")), spark.createDataFrame([(5, 5)], "k bigint, j bigint"), ["k", "j"])
    assert maybe.where("k = 5").count() == 1 and maybe.count() + never.count() == 100


def test_url_query_covers_the_table(spark):
    assert op10_url_filter(spark, SF_SMALL).count() == spark.read.parquet(SF_SMALL + "/pages.parquet").count()


# --- url filter: long hosts and lists

def test_very_long_hosts_and_many_path_lengths(spark):
    host = "x." * 20_000 + "bad.example.com"
    pages = spark.createDataFrame([(1, f"http://{host}/en/a"), (2, f"http://{'y.' * 20_000}org/en/"), (3, "http://bad.example.com/" + "p" * 3000),
                                   (4, "http://example.com/q")], "page_id bigint, url string")
    rules = spark.createDataFrame([("example.com", "/en/", "block")] + [("bad.example.com", "/" + "p" * n, "block") for n in range(3000)]
                                  + [("com", "/", "allow")], "host string, path string, verdict string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in filter_urls(pages, rules).collect()}
    assert got == {1: ("bad.example.com/", "block"),           # longer than example.com/en/
                   2: (None, "allow"), 3: ("bad.example.com/" + "p" * 2999, "block"), 4: ("com/", "allow")}
