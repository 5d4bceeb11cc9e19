"""Print the formatted physical plan of registered queries.

    python tools/explain.py /root/testdata/sf0.1 [--large] [query ...]

``--large`` turns broadcast joins off, which shows the plan Spark picks when
the feature tables are too large to broadcast (the 100 TB case): sort-merge
joins, with bucketed feature tables read without a shuffle.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from larder import get_session  # noqa: E402
from larder.plans.queries import QUERIES  # noqa: E402


def main(argv: list[str]) -> int:
    args = [a for a in argv[1:] if not a.startswith("--")]
    large = "--large" in argv
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    names = args[1:] or list(QUERIES)
    spark = get_session("local[8]", 8)
    if large:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()     # run it, so AQE shows its final plan
        print(f"==================== {name}")
        print(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
