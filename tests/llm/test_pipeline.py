"""The pipeline stage by stage against plain-Python versions, and edge tables through every stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from larder.llm.common import written
from larder.llm.mixing import mixture
from larder.llm.quality import classify_quality
from larder.llm.queries import fold
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm import edge
from tests.llm.test_scans import brute_leaks


def rows_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=str)


def test_stages_are_the_named_ones():
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "repeated_passages", "decontamination", "mixing"]


def test_pipeline_equals_plain_python(spark):
    docs = spark.read.parquet(SF_SMALL + "/documents.parquet")
    labels = spark.read.parquet(SF_SMALL + "/labels.parquet")
    accepted = {r["doc_id"] for r in classify_quality(docs, labels, *fold(5, 0)).where("predicted = 1").collect()}
    rows = [(i, t) for i, t in rows_of(docs) if i in accepted]
    one = written(cp.quality(spark, docs, SF_SMALL), "test")
    assert rows_of(one) == sorted(rows, key=str) and one.columns == docs.columns

    rows = [(i, t) for (i, t), (_, _, c) in zip(rows, edge.near_rows(rows, 5), strict=True) if i == c]
    two = written(cp.near_duplicates(spark, one, SF_SMALL), "test")
    assert rows_of(two) == sorted(rows, key=str) and two.columns == docs.columns

    raw = [(i, (t or "").encode()) for i, t in rows]
    cut = [(i, bytes(b for b, x in zip(t, m, strict=True) if not x).decode("utf-8", "ignore"))
           for (i, t), m in zip(raw, edge.repeated_bytes(raw), strict=True)]
    rows = [(i, t) for (i, t), (_, before) in zip(cut, raw, strict=True) if t or not before]
    three = written(cp.repeated_passages(spark, two, SF_SMALL), "test")
    assert rows_of(three) == sorted(rows, key=str) and three.columns == docs.columns

    items = [tuple(r) for r in spark.read.parquet(SF_SMALL + "/benchmark.parquet").collect()]
    leaky = {i for i, _ in brute_leaks(rows, items)}
    rows = [(i, t) for i, t in rows if i not in leaky]
    four = written(cp.decontamination(spark, three, SF_SMALL), "test")
    assert rows_of(four) == sorted(rows, key=str) and four.columns == docs.columns

    copies = {r["doc_id"]: r["n_copies"] for r in mixture(four).collect()}
    want = sorted(((i, t) for i, t in rows for _ in range(copies[i])), key=str)
    assert rows_of(cp.mixing(spark, four, SF_SMALL)) == want
    assert rows_of(cp.run(spark, SF_SMALL)) == want


@pytest.mark.parametrize("name,stage", cp.STAGES, ids=[n for n, _ in cp.STAGES])
def test_stage_edges(spark, name, stage):
    docs = edge.documents(spark)
    out = stage(spark, docs, SF_ORACLE)
    extra = {"mix_epoch", "mix_order"} if name == "mixing" else set()
    assert set(out.columns) == set(docs.columns) | extra
    n = out.count()
    assert n > 0 and (name == "mixing" or n <= docs.count())
    if name != "mixing":
        assert out.where("sig != 's' OR component != 3").count() == 0
        assert out.where(F.col("text").isNull()).count() == 2       # rows without a text are no ground to go
    assert stage(spark, edge.documents(spark, []), SF_ORACLE).count() == 0
