"""Run registered queries in Spark and their SQL oracles in DuckDB; compare results.

    python tools/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tools.check import compare, duck  # noqa: E402
from larder.plans.queries import QUERIES  # noqa: E402


def main(argv: list[str]) -> int:
    from larder import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, con, sf_dir, n)
        except Exception as e:  # report and continue
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n}: {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
