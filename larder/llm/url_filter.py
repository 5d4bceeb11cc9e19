"""URL filter: blocked Bloom filter in front of an exact hash join.

The list holds rules ``(host, path, verdict)``; a rule's canonical key is its
host followed by its path. A rule fits a url whose host is the rule's or a
subdomain of it and whose path starts with the rule's path; of several the
longest key wins. Every url has few possible keys: each parent domain of its
host of no more labels than a listed host has, with each path prefix of a length
that occurs in the list.

1. The listed keys set bits in a filter of 512-bit blocks (one block per key,
   one bit in each of its eight words). It is built by an aggregate and has at
   most ``max_blocks`` blocks, so its broadcast is bounded for any list; a longer
   list only means more false positives.
2. Possible keys that the filter passes go to a hash join with the list on host
   and path, which removes the false positives. Urls without any hit skip it.
3. A url that no rule fits gets the default verdict.

The verdict depends on host and path alone, so hits are joined once per distinct pair.

Nulls, edges: NULL urls and urls without ``://`` have empty host and path and
get the default verdict. Repeated rows stay. Rules with a NULL host or path are
left out, repeated rules count once, and of contradicting rules for one key
``block`` wins. An empty list leaves every url with the default verdict.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.bloom import filter_words, key_hashes, probe
from larder.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", max_blocks: int = 1 << 18) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (columns page_id, url).

    ``rules``: host, path, verdict. ``max_blocks`` x 64 bytes bounds the broadcast filter.
    """
    spark = pages.sparkSession
    rules = (rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
             .where(F.col("host").isNotNull() & F.col("path").isNotNull())
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))   # "block" > "allow"
    shared = spark.sparkContext.broadcast(filter_words(rules, key_hashes(F.col("host"), F.col("path")), max_blocks))
    shape = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("labels"),
                      F.sort_array(F.collect_set(F.length("path"))).alias("lengths")).first()      # one number per path length
    most_labels, lengths = shape["labels"] or 1, ",".join(map(str, shape["lengths"]))

    # a rule's host has at most so many labels, so no longer end of a host can be one
    labels = F.split("host", r"\.")
    ends = F.slice(labels, F.greatest(F.size(labels) - F.lit(most_labels - 1), F.lit(1)), F.lit(most_labels))
    # the lengths, ascending, are one constant, however many they are
    known = F.split(F.lit(lengths), ",").cast("array<int>") if lengths else F.array().cast("array<int>")
    fitting = F.filter(known, lambda n: n <= F.col("n_path"))

    def domain(first: Column) -> Column:
        return F.concat_ws(".", F.slice(ends, first, F.size(ends)))

    def possible_keys() -> Column:
        """Domain by domain, from the longest, every prefix, from the shortest."""
        domains = F.transform(F.sequence(F.lit(1), F.size(ends)), domain)
        prefixes = F.transform(fitting, lambda n: F.substring(F.col("path"), F.lit(1), n))
        return F.flatten(F.transform(domains, lambda d: F.transform(
            prefixes, lambda p: F.named_struct(F.lit("host"), d, F.lit("path"), p))))

    sizes = np.array(shape["lengths"], np.int64)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(3)
            flat = keys.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(keys.value_lengths().to_numpy(zero_copy_only=False) // 2)
            hit = np.flatnonzero(probe(shared.value, flat[0::2], flat[1::2])) if len(flat) else np.zeros(0, np.int64)
            row = np.searchsorted(ends, hit, side="right")
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            # the place of a key among its row's gives the number of its domain and the length of its prefix
            per_domain = np.searchsorted(sizes, batch.column(4).to_numpy(), side="right")[row]
            place = hit - starts[row]
            found = ((place // np.maximum(per_domain, 1) + 1) << 32) | sizes[place % np.maximum(per_domain, 1)] if len(hit) else place
            cuts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(ends)))]).astype(np.int32)
            at = pa.ListArray.from_arrays(pa.array(cuts), pa.array(found.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], at], names=["page_id", "host", "path", "at"])

    # written once: hosts and paths are read three times below, and once per possible key if their patterns were inlined
    base = written(pages.select(F.col("page_id").cast("bigint"), url_host(F.col("url")).alias("host"),
                                url_path(F.col("url")).alias("path")).withColumn("n_path", F.length("path")), "urls")
    hashed = base.select("page_id", "host", "path", F.flatten(F.transform(
        possible_keys(), lambda k: key_hashes(k["host"], k["path"]))).alias("keys"), "n_path")
    marked = hashed.mapInArrow(passing, "page_id bigint, host string, path string, at array<bigint>")

    found = (marked.where(F.size("at") > 0).select("host", "path", "at").distinct()
             .select(F.struct("host", "path").alias("of"), "host", "path", F.explode("at").alias("at"))
             .select("of", domain(F.shiftright("at", 32).cast("int")).alias("host"),
                     F.substring(F.col("path"), F.lit(1), F.col("at").bitwiseAND(0xFFFFFFFF).cast("int")).alias("path"))
             .join(rules, ["host", "path"])                    # exact: drops the filter's false positives
             .groupBy("of").agg(F.max(F.struct(
                 (F.length("host") + F.length("path")).alias("n"),
                 F.concat("host", "path").alias("rule"), "verdict")).alias("best"))
             .select(F.col("of.host").alias("host"), F.col("of.path").alias("path"), "best.rule", "best.verdict"))
    hit = marked.where(F.size("at") > 0).drop("at").join(found, ["host", "path"], "left")
    none = marked.where(F.size("at") == 0).select(
        "host", "path", "page_id", F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("verdict"))
    return hit.unionByName(none).select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
