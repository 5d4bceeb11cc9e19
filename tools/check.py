"""Compare a registered query with its SQL oracle (DuckDB over the same Parquet files).

Column names, row counts and the multiset of rows must agree; floats are
compared after rounding to 9 significant digits, NULL and NaN are kept apart.
"""

from __future__ import annotations

import math
import time

import duckdb

from larder.plans.oracles import ORACLES
from larder.plans.queries import QUERIES
from larder.plans.tables import TABLES


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<nan>"
        return f"{v:.9g}"
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    took = time.time() - t0
    if name not in ORACLES:
        return True, f"rows={len(srows)} (no oracle) {took:.1f}s"
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return False, f"row count spark={len(srows)} duck={len(drows)}"
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, first: {diff}"
    return True, f"rows={len(srows)} {took:.1f}s"
