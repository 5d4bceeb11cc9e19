"""Regenerate PLANS.md: final physical plans of the key operators at sf0.1.

    python tools/plans_doc.py [/root/testdata/sf0.1] > PLANS.md

Broadcast joins are turned off where the text says so, to show what Spark runs
when feature tables are too large to broadcast (the 100 TB case).
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from larder import get_session  # noqa: E402
from larder.operators import FeatureLookup, SkewPolicy, attach_features, save_features  # noqa: E402
from larder.operators.feature_table import upsert_plan  # noqa: E402
from larder.plans.derive import customer_demographic_features, doc_meta_features, doc_text_features  # noqa: E402
from larder.plans.queries import TEXT_FEATURES, META_FEATURES, _segment_versions  # noqa: E402
from larder.plans.tables import scratch_database, table  # noqa: E402


def final_plan(df) -> str:
    df.collect()          # run this very query, so AQE reports its final plan
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    out = []
    for ln in text.splitlines():
        ln = re.sub(r", \[plan_id=\d+\]", "", ln)
        ln = re.sub(r"Location: InMemoryFileIndex\(\d+ paths\)\[[^\]]*\], ", "", ln)
        ln = re.sub(r"#\d+L?", "", ln)
        ln = re.sub(r"spark_catalog\.larder_[a-z0-9]+_[0-9a-f]+\.", "", ln)
        ln = re.sub(r" Batched: true,| Format: Parquet,| PartitionFilters: \[\],| DataFilters: \[[^\]]*\],", "", ln)
        ln = re.sub(r"In\((\w+), \[([^\]]{60})[^\]]*\]\)", r"In(\1, [\2...])", ln)
        ln = re.sub(r"INSET ([0-9, ]{40})[0-9, ]*[0-9]", r"INSET \1...", ln)
        out.append(ln.rstrip()[:220])
    return "\n".join(x for x in out if x.strip() and "ResultQueryStage" not in x).strip()


def main(argv: list[str]) -> int:
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 8)
    db = scratch_database(spark, "plansdoc")
    docs = table(spark, sf, "documents")
    save_features(spark, f"{db}.doc_text", doc_text_features(docs), "doc_id")
    save_features(spark, f"{db}.doc_meta", doc_meta_features(docs), "doc_id")
    lookups = [FeatureLookup(f"{db}.doc_text", TEXT_FEATURES, "doc_id"),
               FeatureLookup(f"{db}.doc_meta", META_FEATURES, "doc_id")]
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    sections = []

    ids20 = labels.select("doc_id").orderBy("doc_id").limit(20)
    sections.append(("Scoring a batch of 20 ids: literal point lookup", """
The reference scores 20 ids at a time. The key profile counts the distinct ids at no extra pass (an
`Observation`). With at most `literal_keys` (256) of them, the ids are collected and pushed into each
feature-table scan as `doc_id IN (...)`: `PushedFilters: [In(doc_id, ...)]`. Bucket pruning then reads only the
buckets that can hold the ids; a test deletes the other buckets' files and the lookup still runs. Parquet
row-group statistics on the key-sorted bucket files skip the rest. The few remaining rows are broadcast.""",
                     final_plan(attach_features(spark, ids20, lookups))))

    sections.append(("Lookup of a label frame with up to 10 000 keys: semi-join point lookup", """
With at most `point_lookup_keys` (10 000) distinct ids, the count being observed by the key profile, each
feature table is cut down by a broadcast semi join with the distinct input ids. The result is bounded by that
many rows and is broadcast into the LEFT join. The label frame is not shuffled and the large table is not
sorted. Hot keys cost nothing extra here: a broadcast join has no skew.""", final_plan(attach_features(spark, labels, lookups))))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    many = SkewPolicy(point_lookup_keys=0)
    sections.append(("Lookup of a label frame with many keys, large tables (broadcast off)", """
One exchange in the whole plan, on the labels side. Both feature tables are bucketed by `doc_id`
(`Bucketed: true`), so they are read in place. The second join reuses the first one's partitioning. Each scan
reads only the key and the requested columns (`ReadSchema`), with `IsNotNull` pushed into the scan.""",
                     final_plan(attach_features(spark, labels, lookups, many))))

    target, source = _segment_versions(spark, sf)
    save_features(spark, f"{db}.cust", target, "PassengerId")
    save_features(spark, f"{db}.staged", source, "PassengerId")      # as write_feature_table stages it
    sections.append(("Upsert into a bucketed feature table: the merge step (broadcast off)", """
The source has been evaluated once and staged in the table's buckets (one shuffle of the source by key). The merge
reads table and staged source in place: no exchange at all. The key check is one aggregate over the staged key
columns, without an exchange either.""",
                     final_plan(upsert_plan(spark.table(f"{db}.cust"), spark.table(f"{db}.staged"), ["PassengerId"]))))

    save_features(spark, f"{db}.custf", customer_demographic_features(table(spark, sf, "customer")), "PassengerId")
    orders = table(spark, sf, "orders")
    cust = (F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).when(F.col("o_orderkey") % 10 == 1, F.lit(None))
            .otherwise(F.col("o_custkey")))
    skewed = orders.select("o_orderkey", cust.cast("string").alias("cust_id"))
    hot = SkewPolicy(hot_key_rows=10000, point_lookup_keys=0)
    lk = [FeatureLookup(f"{db}.custf", ["NamePrefix", "Age"], "cust_id")]
    sections.append(("Skewed lookup key: hot rows and the rest (broadcast off)", """
A third of the orders carry customer 7 and a tenth carry no customer. The hot keys come from the key profile as a
small table. Rows with a hot key are joined with the feature rows of the hot keys by broadcast, where they were
read; rows without a customer get NULL features without a join. Only the rest is shuffled, and the bucketed table
not at all.""", final_plan(attach_features(spark, skewed, lk, hot))))

    print("# Physical plans\n")
    print("Generated by `python tools/plans_doc.py /root/testdata/sf0.1 > PLANS.md`. These are the final AQE plans, "
          "with expression ids, paths and long literal lists trimmed.\n")
    for title, text, plan in sections:
        print(f"## {title}\n{text}\n\n```\n{plan}\n```\n")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
