"""Bucket-local upserts: what is written, what a dead writer leaves, what order deltas arrive in."""

import itertools

import pytest
from pyspark.sql import functions as F

from larder.operators import partitioned_table as pt
from larder.operators.feature_table import create_feature_table, write_feature_table
from larder.streaming import upsert_batch_writer

SCHEMA = "id bigint, name string, ts bigint"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def make(spark, db, rows, buckets=16, order_by=None):
    name = f"{db}.t"
    pt.create_partitioned_table(spark, name, "id", frame(spark, []).schema, buckets, "a table", order_by)
    pt.write_partitioned(spark, name, frame(spark, rows))
    return name


def rows_of(spark, name):
    return sorted(map(tuple, pt.read_partitioned(spark, name).collect()))


def folders(spark, name):
    return {b: r["folder"] for b, r in pt.commit_record(spark, pt.get_partitioned_table(spark, name)).items()}


def test_an_upsert_writes_only_the_buckets_it_touches(spark, db):
    name = make(spark, db, [(i, f"n{i}", 1) for i in range(500)])
    before = folders(spark, name)
    delta = [(3, "new", 2), (7, None, 2), (10_000, "added", 2)]
    pt.write_partitioned(spark, name, frame(spark, delta))
    touched = {r[0] for r in frame(spark, delta).select(pt.bucket_of(["id"], 16)).collect()}
    after = folders(spark, name)
    assert {b for b in after if after[b] != before.get(b)} == touched and len(touched) <= 3
    want = {i: (i, f"n{i}", 1) for i in range(500)} | {r[0]: r for r in delta}
    assert rows_of(spark, name) == sorted(want.values())
    assert sorted(map(tuple, spark.table(name).drop(pt.BUCKET).collect())) == sorted(want.values())
    record = pt.commit_record(spark, pt.get_partitioned_table(spark, name))
    assert sum(r["rows"] for r in record.values()) == 501 and all(r["bytes"] > 0 for r in record.values())


def test_plain_reads_prune_to_one_bucket(spark, db):
    name = make(spark, db, [(i, f"n{i}", 1) for i in range(100)])
    read = spark.table(name).where(F.col(pt.BUCKET) == 5)
    assert len(read.inputFiles()) >= 1 and all(f"{pt.BUCKET}=5" in f for f in
                                               read.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])


@pytest.mark.parametrize("dies_after", [0, 1, 2])
def test_a_writer_that_dies_between_two_switches_leaves_the_old_table(spark, db, monkeypatch, dies_after):
    old = [(i, "old", 1) for i in range(60)]
    name = make(spark, db, old, buckets=8)
    real, done = pt.switch_partition, []

    def dying(*args):
        if len(done) == dies_after:
            raise RuntimeError("died")
        done.append(args)
        real(*args)
    monkeypatch.setattr(pt, "switch_partition", dying)
    monkeypatch.setattr(pt, "delete_path", lambda *a: None)         # a dead writer tidies nothing
    with pytest.raises(RuntimeError):
        pt.write_partitioned(spark, name, frame(spark, [(i, "new", 2) for i in range(60)]))
    monkeypatch.undo()
    assert rows_of(spark, name) == old
    assert pt.repair_partitions(spark, name) == dies_after
    assert sorted(map(tuple, spark.table(name).drop(pt.BUCKET).collect())) == old
    pt.write_partitioned(spark, name, frame(spark, [(0, "new", 2)]))
    assert rows_of(spark, name) == [(0, "new", 2), *old[1:]]


def test_errors_leave_the_table_as_it_was(spark, db):
    name = make(spark, db, [(1, "a", 1)])
    before = folders(spark, name)
    for bad in ([(2, "x", 1), (2, "y", 1)], [(None, "x", 1)]):
        with pytest.raises(ValueError):
            pt.write_partitioned(spark, name, frame(spark, bad))
    with pytest.raises(ValueError):
        pt.write_partitioned(spark, name, frame(spark, [(1, "x", 1)]).drop("ts"))
    with pytest.raises(ValueError):
        pt.write_partitioned(spark, name, frame(spark, [(1, "x", 1)]), mode="append")
    assert rows_of(spark, name) == [(1, "a", 1)] and folders(spark, name) == before
    with pytest.raises(ValueError):
        pt.create_partitioned_table(spark, f"{db}.u", "id", frame(spark, []).schema, 4, order_by="id")


def test_empty_deltas_overwrite_and_pruning(spark, db):
    name = make(spark, db, [])
    assert rows_of(spark, name) == []
    pt.write_partitioned(spark, name, frame(spark, [(1, "a", 1), (2, "b", 1)]))
    pt.write_partitioned(spark, name, frame(spark, []))
    assert rows_of(spark, name) == [(1, "a", 1), (2, "b", 1)]
    pt.write_partitioned(spark, name, frame(spark, [(3, "c", 1)]), mode="overwrite", retain=0)
    assert rows_of(spark, name) == [(3, "c", 1)] == sorted(map(tuple, spark.table(name).drop(pt.BUCKET).collect()))
    base = pt.get_partitioned_table(spark, name).base
    left = [p for p in pt.list_children(spark, base) if p.rsplit("/", 1)[-1][0] in "sw"]
    assert len(left) == 1
    assert pt.drop_partitioned_table(spark, name) and not pt.drop_partitioned_table(spark, name)


def test_rebucket_keeps_the_rows(spark, db):
    name = make(spark, db, [(i, "x", i) for i in range(50)], buckets=3)
    pt.rebucket(spark, name, 11)
    table = pt.get_partitioned_table(spark, name)
    assert table.buckets == 11 and rows_of(spark, name) == [(i, "x", i) for i in range(50)]
    pt.write_partitioned(spark, name, frame(spark, [(4, "y", 1)]))
    assert (4, "y", 1) in rows_of(spark, name) and len(rows_of(spark, name)) == 50
    assert pt.rebucket(spark, name).buckets == 1


DELTAS = [[(1, "b", 5), (2, "b", 1)], [(1, "a", 9), (3, "x", None)], [(1, "c", 5), (3, "w", None), (2, "z", 1)], [(3, "n", 0)]]
NEWEST = [(1, "a", 9), (2, "z", 1), (3, "n", 0)]


def test_deltas_in_any_order_give_one_table(spark, db):
    for n, order in enumerate(itertools.islice(itertools.permutations(range(4)), 0, 24, 7)):
        name = f"{db}.o{n}"
        pt.create_partitioned_table(spark, name, "id", frame(spark, []).schema, 2, order_by="ts")
        for k in [*order, order[0]]:                                # one arrives twice
            pt.write_partitioned(spark, name, frame(spark, DELTAS[k]))
        assert rows_of(spark, name) == NEWEST


@pytest.mark.parametrize("partitioned", [True, False])
def test_late_batches_do_not_replace_newer_rows(spark, db, partitioned):
    name = f"{db}.s"
    if partitioned:
        pt.create_partitioned_table(spark, name, "id", frame(spark, []).schema, 4, order_by="ts")
    else:
        create_feature_table(spark, name, "id", frame(spark, []).schema)
    write = upsert_batch_writer(name, latest_by="ts")
    for epoch, rows in enumerate(([(1, "new", 10), (1, "mid", 7)], [(1, "old", 5), (2, "x", 1)], [(1, "newer", 11)])):
        write(frame(spark, rows), epoch)
    read = pt.read_partitioned(spark, name) if partitioned else spark.table(name)
    assert sorted(map(tuple, read.collect())) == [(1, "newer", 11), (2, "x", 1)]


def test_newer_by_must_name_a_value_column(spark, db):
    create_feature_table(spark, f"{db}.k", "id", frame(spark, []).schema)
    for column in ("id", "other"):
        with pytest.raises(ValueError):
            write_feature_table(spark, f"{db}.k", frame(spark, [(1, "a", 1)]), newer_by=column)
