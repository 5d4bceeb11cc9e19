"""Leases, changes between snapshots, the registry, exact splits and modes, encoding by tables."""

import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from larder.operators import encoding, exact
from larder.operators import registry as reg
from larder.operators.diff import apply_changes, row_changes, snapshot_diff
from larder.operators.feature_table import (
    drop_feature_table, get_feature_table, lease_snapshot, leases, move_lease, read_snapshot, release_snapshot, save_features,
    write_feature_table)
from larder.operators.lookup import FeatureLookup, SkewPolicy, attach_features, create_training_set
from larder.operators.model import bundle_holder, build_pipeline, load_bundle, release_bundle, save_bundle, score_batch
from larder.operators.prepare import fit_one_hot, mode_imputer
from larder.session import scratch_path
from larder.sources import jdbc
from larder.sources.storage import create_exclusively, path_exists

SCHEMA = "id bigint, name string, x double, tags map<string,int>"
OLD = [(1, "a", 1.0, {"k": 1}), (2, None, float("nan"), None), (3, "c", None, {"a": 1, "b": 2}), (4, "d", 4.0, {}), (5, "e", 5.0, None)]
NEW = [(1, "a", 1.0, {"k": 1}), (2, None, float("nan"), None), (3, "c", None, {"b": 2, "a": 1}), (4, "d", None, {}), (6, None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain(df):
    return sorted(((r["id"], r["name"], str(r["x"]), str(sorted((r["tags"] or {}).items()))) for r in df.collect()))


# --- changes

def test_row_changes(spark):
    changes = row_changes(frame(spark, OLD), frame(spark, NEW), "id")
    got = {r["id"]: (r["change"], r["name"], r["x"]) for r in changes.collect()}
    assert got == {4: ("update", "d", None), 5: ("remove", None, None), 6: ("insert", None, None)}
    assert plain(apply_changes(frame(spark, OLD), changes, "id")) == plain(frame(spark, NEW))
    assert row_changes(frame(spark, OLD), frame(spark, OLD), "id").count() == 0
    assert {r["change"] for r in row_changes(frame(spark, []), frame(spark, NEW), "id").collect()} == {"insert"}
    keys = [spark.createDataFrame([(k,) for k in ks], "id int") for ks in ([1, 2], [2, 3])]      # a table of keys only
    assert sorted(map(tuple, row_changes(*keys, "id").collect())) == [("insert", 3), ("remove", 1)]
    with pytest.raises(ValueError):
        row_changes(frame(spark, OLD), frame(spark, OLD).drop("x"), "id")


def test_snapshot_diff_shuffles_nothing(spark, db):
    name = f"{db}.t"
    save_features(spark, name, frame(spark, OLD), "id")
    lease_snapshot(spark, name, "p")
    write_feature_table(spark, name, frame(spark, NEW), mode="overwrite", retain=0)
    diff = snapshot_diff(spark, name, "p")
    assert "Exchange" not in diff._jdf.queryExecution().executedPlan().toString()
    assert {r["id"]: r["change"] for r in diff.collect()} == {4: "update", 5: "remove", 6: "insert"}
    with pytest.raises(ValueError):
        snapshot_diff(spark, name, "nobody")


def test_changes_to_publish_and_their_statements(spark, db):
    name = f"{db}.t"
    save_features(spark, name, frame(spark, OLD).drop("tags"), "id")
    lease_snapshot(spark, name, "sending")
    assert jdbc.changes_to_publish(spark, name, "published", "sending") is None         # the first publish sends all
    move_lease(spark, name, "sending", "published")
    write_feature_table(spark, name, frame(spark, NEW).drop("tags"), mode="overwrite")
    lease_snapshot(spark, name, "sending")
    write_feature_table(spark, name, frame(spark, []).drop("tags"), mode="overwrite", retain=0)     # written while it is sent
    rows, gone = jdbc.changes_to_publish(spark, name, "published", "sending")
    assert sorted(r["id"] for r in rows.collect()) == [4, 6] and [tuple(r) for r in gone.collect()] == [(5,)]
    assert rows.columns == ["id", "name", "x"]
    first, second = jdbc.change_statements("postgresql", "s.t", "s.up", "s.rm", ["id", "x"], ["id"])
    assert first == 'DELETE FROM "s"."t" t USING "s"."rm" s WHERE t."id" = s."id"' and second.startswith("INSERT INTO")
    assert jdbc.delete_statement("mysql", "t", "rm", ["a", "b"]) == \
        "DELETE t FROM `t` t JOIN `rm` s ON t.`a` = s.`a` AND t.`b` = s.`b`"
    assert jdbc.delete_statement("ansi", "t", "rm", ["a"]) == \
        'DELETE FROM "t" WHERE EXISTS (SELECT 1 FROM "rm" s WHERE s."a" = "t"."a")'


def test_key_batches(spark):
    keys = spark.createDataFrame([(i % 25,) for i in range(100)] + [(None,)], "id bigint").repartition(3)
    found = [r["predicate"] for r in jdbc.key_batches(keys, "id", 10).collect()]
    lists = [p[len("id IN ("):-1].split(", ") for p in found]
    assert sorted(int(v) for x in lists for v in x) == list(range(25)) and max(map(len, lists)) <= 10
    text = spark.createDataFrame([("o'x",), ("b",)], "k string").coalesce(1)
    assert [r["predicate"] for r in jdbc.key_batches(text, "k").collect()] == ["k IN ('b', 'o''x')"]
    with pytest.raises(ValueError):
        jdbc.key_batches(spark.createDataFrame([(1.5,)], "k double"), "k")


# --- leases

def test_leased_snapshots_stay_and_go(spark, db):
    name = f"{db}.t"
    rows = frame(spark, OLD).drop("tags")
    save_features(spark, name, rows, "id")
    a = lease_snapshot(spark, name, "a")
    for _ in range(2):
        write_feature_table(spark, name, rows.withColumn("name", F.lit("later")), retain=0)
    assert path_exists(spark, a.folder) and a.version == 1 and get_feature_table(spark, name).version == 3
    assert {r["name"] for r in read_snapshot(spark, name, "a").collect()} == {"a", None, "c", "d", "e"}
    lease_snapshot(spark, name, "b")
    with pytest.raises(ValueError):
        write_feature_table(spark, a.entry, rows)                   # a snapshot is not written
    with pytest.raises(ValueError):
        drop_feature_table(spark, name)
    assert release_snapshot(spark, name, "a") and not release_snapshot(spark, name, "a")
    assert not spark.catalog.tableExists(a.entry) and sorted(leases(spark, name)) == ["b"]
    write_feature_table(spark, name, rows, retain=0)
    assert not path_exists(spark, a.folder)
    with pytest.raises(ValueError):
        read_snapshot(spark, name, "a")
    assert drop_feature_table(spark, name, force=True)


def rule(sql):
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {sql} AS prediction FROM __THIS__")])


def test_pinned_bundles_score_the_same_after_an_upsert(spark, db):
    name = f"{db}.t"
    rows = frame(spark, OLD).drop("tags")
    save_features(spark, name, rows, "id")
    ids = rows.select("id")
    ts = create_training_set(spark, ids, [FeatureLookup(name, ["x"], "id")], label=None)
    pinned = save_bundle(spark, rule("coalesce(nanvl(x, -1.0D), -2.0D)"), scratch_path(spark, "b"), ts, pin=True)
    loose = save_bundle(spark, rule("coalesce(nanvl(x, -1.0D), -2.0D)"), scratch_path(spark, "b"), ts)

    def scores(path):
        return {r["id"]: r["prediction"] for r in score_batch(spark, path, ids).collect()}
    before = scores(pinned)
    for x in (7.0, 8.0):
        write_feature_table(spark, name, rows.withColumn("x", F.lit(x)), retain=0)
    assert scores(pinned) == before and set(scores(loose).values()) == {8.0}
    assert load_bundle(spark, pinned).snapshots == {name: 1} and bundle_holder(pinned) in leases(spark, name)
    assert release_bundle(spark, pinned) == [name] and not leases(spark, name)


# --- registry

def test_versions_and_stages(spark):
    r = reg.ModelRegistry(spark, scratch_path(spark, "registry"))
    assert r.versions().count() == 0 and r.state("m") == []
    assert [r.register("m", f"p{i}", f"d{i}") for i in (1, 2, 3)] == [1, 2, 3] and r.register("other", "q") == 1
    assert r.set_stage("m", 1, "production") == [] and r.set_stage("m", 2, "production") == [1]
    assert r.set_stage("m", 3, "production", archive_existing=False) == []
    assert r.find("m", "production").version == 3 and r.find("m", 1).stage == "archived"
    r.set_stage("m", 1, "staging")
    want = [(v.name, v.version, v.bundle, v.stage, v.description) for n in ("m", "other") for v in r.state(n)]
    assert sorted(map(tuple, r.versions().collect())) == sorted(want)
    assert [w[3] for w in want] == ["staging", "production", "production", "none"]
    for bad in (lambda: r.set_stage("m", 9, "staging"), lambda: r.set_stage("m", 1, "best"), lambda: r.find("m", "none"),
                lambda: r.find("nobody", 1), lambda: r.register("a/b", "p")):
        with pytest.raises(ValueError):
            bad()


def test_concurrent_writers_get_different_versions(spark, monkeypatch):
    root = scratch_path(spark, "registry")
    a, b = reg.ModelRegistry(spark, root), reg.ModelRegistry(spark, root)
    real, raced = reg.create_exclusively, []

    def raced_by_b(spark_, path, text):
        if not raced:                       # another writer comes between reading the log and writing
            raced.append(1)
            b.register("m", "from b")
        return real(spark_, path, text)
    monkeypatch.setattr(reg, "create_exclusively", raced_by_b)
    assert a.register("m", "from a") == 2
    monkeypatch.undo()
    assert [(v.version, v.bundle) for v in a.state("m")] == [(1, "from b"), (2, "from a")]
    monkeypatch.setattr(reg, "create_exclusively", lambda *x: False)
    with pytest.raises(reg.ConcurrentWriter):
        a.register("m", "never", tries=3)


def test_an_unfinished_event_counts_as_void(spark):
    root = scratch_path(spark, "registry")
    r = reg.ModelRegistry(spark, root)
    r.register("m", "p1")
    assert create_exclusively(spark, f"{root}/m/000002.json", '{"event": "regis')
    assert not create_exclusively(spark, f"{root}/m/000002.json", "x")
    assert r.register("m", "p2") == 2 and r.versions().count() == 2


# --- exact split

@pytest.mark.parametrize("n,share", [(0, 0.25), (1, 0.25), (10, 0.25), (1001, 0.25), (30, 0.0), (30, 1.0), (7, 0.5)])
def test_split_has_the_exact_size(spark, n, share):
    df = spark.range(n).withColumn("v", F.col("id") * 2)
    train, test = exact.split_exact(df, "id", test_share=share)
    assert test.count() == math.ceil(share * n) and train.count() + test.count() == n
    want = {r["id"] for r in df.withColumn("d", exact.split_digest("id")).orderBy("d").limit(math.ceil(share * n)).collect()}
    assert {r["id"] for r in test.collect()} == want
    assert {r["id"] for r in exact.split_exact(df.repartition(7), "id", test_share=share)[1].collect()} == want


def test_split_of_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(None, i) for i in range(50)] + [("k", i) for i in range(30)] + [("z", 1)], "k string, i int")
    for share in (0.1, 0.37, 0.5, 0.9):
        train, test = exact.split_exact(df.repartition(5), "k", test_share=share)
        assert test.count() == math.ceil(81 * share) and train.columns == test.columns == ["k", "i"]
        assert sorted(map(tuple, train.unionByName(test).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_border_is_found_by_refinement(spark, monkeypatch):
    monkeypatch.setattr(exact, "_FEW", 3)
    digests = spark.range(5000).select(exact.split_digest("id").alias("d"))
    ordered = sorted(r["d"] for r in digests.collect())
    for k in (1, 2, 1250, 4999, 5000):
        assert exact.smallest_digests(digests, k) == (ordered[k - 1], 1)


# --- mode

@pytest.mark.parametrize("values,how", [
    ([1.0] * 5 + [2.0] * 5 + [None, float("nan")] * 9, "summary"),              # ties: the smallest
    ([float(i) for i in range(60)], "full"), ([3.0] * 40 + [float(i) for i in range(50)], "summary"),
    ([-0.0] * 3 + [0.0] * 3 + [1.0] * 5, "summary"), ([7.0, 7.0] + [float(i) for i in range(100, 140)], "full")])
def test_mode_equals_the_estimator(spark, values, how):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    value, by = exact.most_frequent(df, "v", counters=8)
    assert by == how
    want = mode_imputer(["v"]).fit(df).surrogateDF.first()[0]
    assert value == want and exact.exact_mode_imputer(df, ["v"], counters=8).surrogateDF.first()[0] == want


def test_mode_of_texts_and_of_nothing(spark):
    df = spark.createDataFrame([("hot",)] * 300 + [(f"w{i}",) for i in range(400)] + [(None,)] * 500, "v string").repartition(4)
    assert exact.most_frequent(df, "v", counters=20) == ("hot", "summary")
    assert exact.most_frequent(df.where("v IS NULL"), "v") == (None, "empty")
    with pytest.raises(ValueError):
        exact.exact_mode_imputer(spark.createDataFrame([(None,)], "v double"), ["v"])


# --- encoding

@pytest.mark.parametrize("skew", [None, SkewPolicy(hot_key_rows=4, point_lookup_keys=0)], ids=["plain", "hot"])
def test_encoding_by_table_equals_the_fitted_encoder(spark, db, skew):
    fit = spark.createDataFrame([("b", "x"), (None, "y"), ("a", None), ("b", "x")], "c string, d string")
    df = spark.createDataFrame([("a", "x"), ("new", "y"), (None, None), ("b", "q")] * 5, "c string, d string")
    encoder = encoding.fit_encoder(spark, fit, ["c", "d"], f"{db}.v")
    assert encoder.sizes == (3, 3) and encoding.TableEncoder.from_dict(encoder.to_dict()) == encoder
    vecs = ["c__filled__idx__vec", "d__filled__idx__vec"]
    got = encoding.encode(spark, df, encoder, skew).select("c", "d", *vecs).collect()
    want = fit_one_hot(fit, ["c", "d"]).transform(df).select("c", "d", *vecs).collect()

    def slots(rows):                # the fitted encoder has one more slot, for unseen values
        return sorted(((r[0], r[1], *[tuple(r[v].toArray()[:3]) for v in vecs]) for r in rows), key=str)
    assert slots(got) == slots(want) and all(r[v].size == 3 for r in got for v in vecs)


def test_bundle_with_vocabulary_tables(spark, db):
    rows = spark.createDataFrame([(i, "ab"[i % 2], float(i % 2)) for i in range(40)], "id bigint, c string, label double")
    save_features(spark, f"{db}.t", rows.select("id", "c"), "id")
    ts = create_training_set(spark, rows.select("id", "label"), [FeatureLookup(f"{db}.t", ["c"], "id")], label="label")
    data = ts.load_df()
    encoder = encoding.fit_encoder(spark, data, ["c"], f"{db}.voc")
    model = build_pipeline(["c"], [], [], "label", max_iter=2, encoded=True).fit(encoding.encode(spark, data, encoder))
    path = save_bundle(spark, model, scratch_path(spark, "b"), ts, pin=True, encoder=encoder)
    encoding.fit_encoder(spark, spark.createDataFrame([("z",)], "c string"), ["c"], f"{db}.voc")      # written anew: the pin holds
    scored = score_batch(spark, path, rows.select("id", F.col("label").alias("want")))
    assert scored.columns == ["id", "want", "c", "prediction"] and scored.where("prediction != want").count() == 0


# --- lookups read their input once

def test_hot_lookups_evaluate_their_input_once(spark, db):
    path = scratch_path(spark, "input")
    (spark.range(400).select(F.when(F.col("id") < 150, "hot").when(F.col("id") < 300, None).otherwise(F.col("id").cast("string"))
                             .alias("k"), "id").write.parquet(path))
    df = spark.read.parquet(path)
    save_features(spark, f"{db}.f", spark.createDataFrame([("hot", 1), ("310", 2), ("399", 3)], "k string, v int"), "k")
    lookups = [FeatureLookup(f"{db}.f", ["v"], "k")]
    out = attach_features(spark, df, lookups, SkewPolicy(hot_key_rows=100, point_lookup_keys=0))
    assert not any(f.startswith(path) or path in f for f in out.inputFiles())       # parts are read, not the input again
    want = attach_features(spark, df, lookups, SkewPolicy(enabled=False))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
