"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import written

_TASK_LINKS = 1 << 19       # links to a task


def tasks_for(df: DataFrame, rows: int, per_task: int) -> int:
    """Tasks for so many rows: one per ``per_task``, at most the session's shuffle partitions."""
    return min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), max(1, -(-rows // per_task)))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of ``links`` (columns a, b); label: the smallest node it reaches.

    Each round takes the smallest label among a node and its neighbours and then the label
    of that label, so chains shorten by more than half a round; rounds are written tables.
    Raises if ``max_rounds`` do not suffice. An empty table gives an empty result.
    """
    links = written(links.where(F.col("a") != F.col("b")), "links")
    tasks = tasks_for(links, links.count(), _TASK_LINKS)        # few links: few tasks and files in every round
    edges = links.select("a", "b").union(links.select("b", "a"))
    labels = written(edges.groupBy("a").agg(F.min("b").alias("m"))
                     .select(F.col("a").alias("node"), F.least("a", "m").alias("label")).coalesce(tasks), "labels")
    for _ in range(max_rounds):
        near = (edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
                .withColumnRenamed("a", "node"))
        low = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("jump"))
        new = written(low.join(jump, "low").select("node", F.least("low", "jump").alias("new"), "label")
                      .coalesce(tasks), "labels")
        labels = new.select("node", F.col("new").alias("label"))
        if not new.where(F.col("new") != F.col("label")).limit(1).count():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
