"""The corpus queries that have SQL, against DuckDB on the same tables."""

import pytest

from larder.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tools.check import duck, rows_of

import __spark_entry__ as entry_module


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    result = duck(SF_SMALL).execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, result.fetchall())


def test_every_numbered_query_and_the_pipeline_are_registered():
    names = entry_module.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(entry_module.oracle_sql()) <= set(names)
