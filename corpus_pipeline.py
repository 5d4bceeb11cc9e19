"""Corpus pipeline: quality, near-duplicates, repeated passages, benchmark leaks, source mixing.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` that calls one operator
of ``larder.llm`` on all rows of its predecessor; every stage but the last returns the
columns of ``documents``. ``run`` writes each stage as Parquet into the shared folder and
reads it back, so a lost executor costs no finished stage. See the operators for nulls,
empty and repeated rows, and empty tables (an empty table passes through every stage).

1. ``quality``: documents whose quality score is below 0.3 go. The classifier is fitted on
   labelled rows outside the held-out fold of ``op8_quality``.
2. ``near_duplicates``: of each group of near-duplicates (five-word shingles, similarity
   0.8) the document with the smallest id stays.
3. ``repeated_passages``: bytes covered by 50-byte strings that also start in a document with
   a smaller id are cut out of the text; documents left without text go.
4. ``decontamination``: documents that hold a benchmark item go.
5. ``mixing``: the documents are read by source weights; one row per reading, with
   ``mix_epoch`` and ``mix_order``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.llm.common import written
from larder.llm.decontaminate import drop_contaminated
from larder.llm.mixing import mixed_documents
from larder.llm.near_dedup import keep_one_of_each
from larder.llm.quality import reject_low_quality
from larder.llm.queries import fold
from larder.llm.suffix_dedup import remove_repeats
from larder.plans.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return reject_low_quality(docs, table(spark, sf_dir, "labels"), *fold(5, 0))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# A trained classifier decides which rows stay, which SQL can't express; see tests/llm.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES = {}
