"""Property tests: upsert is a dictionary merge; text helpers match plain-Python definitions."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.functions import first_char, letters_token, null_if_empty, part_count, title_before_dot
from larder.operators import save_features, write_feature_table

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

rows = st.dictionaries(st.integers(0, 30).map(str),
                       st.tuples(st.one_of(st.none(), st.floats(-5, 5, allow_nan=False)),
                                 st.one_of(st.none(), st.text("ab ", max_size=3))),
                       max_size=12)


@SLOW
@given(target=rows, source=rows)
def test_upsert_is_dict_merge(spark, db, target, source):
    import uuid
    name = f"{db}.p{uuid.uuid4().hex[:8]}"
    schema = "k string, a double, b string"
    to_df = lambda d: spark.createDataFrame([(k, *v) for k, v in d.items()], schema)
    save_features(spark, name, to_df(target), "k")
    write_feature_table(spark, name, to_df(source))
    got = spark.table(name).collect()
    assert len(got) == len({r["k"] for r in got})                       # keys stay unique
    assert {r["k"]: (r["a"], r["b"]) for r in got} == {**target, **source}


def _py_letters(s):
    if s is None:
        return None
    m = re.search(r"[A-Za-z]+", s)
    return m.group(0).upper() if m else None


def _py_title(s):
    if s is None:
        return None
    m = re.search(r"([A-Za-z]+)\.", s)
    return m.group(1) if m else ""


def _py_parts(s):
    return "0" if s is None else str(len(s.split(" ")))


texts = st.lists(st.one_of(st.none(), st.text("aZ9 ./(-", max_size=12)), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=texts)
def test_text_helpers_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = df.select("i", letters_token("v").alias("l"), title_before_dot("v").alias("t"),
                    part_count("v").alias("p"), first_char("v").alias("f"),
                    null_if_empty("v").alias("n")).orderBy("i").collect()
    for v, r in zip(values, out):
        assert r["l"] == _py_letters(v)
        assert r["t"] == _py_title(v)
        assert r["p"] == _py_parts(v)
        assert r["f"] == (None if v is None else v[:1])
        assert r["n"] == (None if v is None or v == "" else v)


def test_split_keeps_trailing_empty_parts(spark):
    df = spark.createDataFrame([("a ",), (" ",), ("a b  ",)], "v string")
    assert [r[0] for r in df.select(part_count(F.col("v"))).collect()] == ["2", "2", "4"]
