"""Registered queries of the corpus operators: thin wrappers over whole tables."""

from __future__ import annotations

import os
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import id_remainder
from larder.llm.decontaminate import contaminated_pairs
from larder.llm.embedding_dedup import linked_vectors
from larder.llm.licenses import scan_licenses
from larder.llm.merkle import verified_manifest
from larder.llm.mixing import mixture
from larder.llm.near_dedup import NearParams, near_duplicates
from larder.llm.oracles import ORACLES  # noqa: F401  (read by __spark_entry__)
from larder.llm.periodic import periodic_runs
from larder.llm.quality import classify_quality
from larder.llm.suffix_dedup import dedup_report
from larder.llm.syncmers import compare_with_next
from larder.llm.token_counts import count_tokens
from larder.llm.toxicity import classify_toxicity
from larder.llm.url_filter import filter_urls
from larder.plans.tables import table

# Host, path and verdict of the url rules.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file: ``LARDER_TOKENIZERS`` if set, else the installed package."""
    folder = os.environ.get("LARDER_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def fold(modulus: int, held: int):
    """(held_out, trainable) conditions of a fold; rows with a NULL id are held out."""
    held_out = F.coalesce(id_remainder(F.col("doc_id"), modulus) == held, F.lit(True))
    return held_out, ~held_out


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), *fold(4, 2))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_report(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), NearParams(words=4))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), *fold(5, 0))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary_path())


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(table(spark, sf_dir, "pages"), rules)


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document, with the tail of every tenth one (by the hash of its id) made periodic."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    return words[:a] + [words[a + i % (1 + (n - a) // (3 + g % 8))] for i in range(n - a)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), rewrite=repeated_tail)


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_manifest(table(spark, sf_dir, "documents"), id_remainder(F.col("doc_id"), 2) == 0)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_near_dedup": op4_near_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_fingerprints": op6_fingerprints,
    "op7_source_mixing": op7_source_mixing,
    "op8_quality": op8_quality,
    "op9_token_counts": op9_token_counts,
    "op10_url_filter": op10_url_filter,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}
