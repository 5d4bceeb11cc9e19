"""Feature derivations of the driver tables, shaped like the reference's two
domain feature sets (ticket-style and name-style features) and their document
counterparts.  Each returns a keyed frame; the SQL oracles in ``oracles.py``
state the same rules in DuckDB's dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import letters_token, null_if_empty, presence_flag
from larder.operators.transforms import demographic_features, ticket_features

# The patterns used on the driver tables.
DIGITS_PATTERN = r"([0-9]{3,})"        # first run of at least three digits
UTM_PATTERN = r"utm_source=([A-Za-z]+)"  # campaign source in a URL query


def doc_text_features(documents: DataFrame) -> DataFrame:
    """Per document: first letter run (upper), line count, first digit run, rounded size,
    and a ``'1'``/``'0'`` flag for the digit run."""
    first = documents.select(
        "doc_id",
        letters_token("text").alias("first_word"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).alias("n_lines"),
        null_if_empty(F.regexp_extract("text", DIGITS_PATTERN, 1)).alias("digits"),
        F.round(F.col("n_chars") / F.lit(100.0), 0).alias("size_rounded"),
    )
    return first.select("*", presence_flag("digits").alias("has_digits"))


def doc_meta_features(documents: DataFrame) -> DataFrame:
    """Per document: language, source and the letter part of the source."""
    return documents.select("doc_id", "lang", "source", letters_token("source").alias("source_kind"))


def label_features(labels: DataFrame) -> DataFrame:
    """Label-side features: the toxic mark as a ``'0'``/``'1'`` flag."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "1").otherwise("0").alias("toxic_flag"))


def ticket_like(part: DataFrame) -> DataFrame:
    """Raw ticket-shaped rows built from ``part``.

    Ticket: digits only for small parts, else ``type/brand``; cabin: the part
    name for large parts, NULL otherwise; fare: the retail price.
    """
    return part.select(
        F.col("p_partkey").cast("string").alias("PassengerId"),
        F.when(F.col("p_size") <= 10, F.col("p_partkey").cast("string"))
         .otherwise(F.concat(F.col("p_type"), F.lit("/"), F.col("p_brand"))).alias("Ticket"),
        F.col("p_retailprice").alias("Fare"),
        F.when(F.col("p_size") > 30, F.col("p_name")).alias("Cabin"),
        F.col("p_brand").alias("Embarked"),
        F.col("p_size").cast("string").alias("Pclass"),
        F.col("p_type").alias("Parch"),
    )


def name_like(customer: DataFrame) -> DataFrame:
    """Raw name-shaped rows built from ``customer``.

    Name: ``<c_name>, <Title>. <segment>`` with a bracketed second name of
    letters (nation key % 3 = 0), with a hyphen (% 3 = 1) or none; no title for
    MACHINERY; NULL for nation 0.  Age: balance / 100, NaN for negative balances.
    """
    title = (F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Mr. "))
             .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("Mrs. "))
             .when(F.col("c_mktsegment") == "MACHINERY", F.lit(""))
             .otherwise(F.lit("Miss. ")))
    bracket = (F.when(F.col("c_nationkey") % 3 == 0, F.lit(" (Ann Lee)"))
               .when(F.col("c_nationkey") % 3 == 1, F.lit(" (Ann-Lee)"))
               .otherwise(F.lit("")))
    name = F.when(F.col("c_nationkey") != 0,
                  F.concat(F.col("c_name"), F.lit(", "), title, F.lower(F.col("c_mktsegment")), bracket))
    age = F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal") / F.lit(100.0))
    return customer.select(
        F.col("c_custkey").cast("string").alias("PassengerId"),
        name.alias("Name"),
        F.col("c_mktsegment").alias("Sex"),
        age.alias("Age"),
        (F.col("c_nationkey") % 5).cast("string").alias("SibSp"),
    )


def part_ticket_features(part: DataFrame) -> DataFrame:
    return ticket_features(ticket_like(part))


def customer_demographic_features(customer: DataFrame) -> DataFrame:
    return demographic_features(name_like(customer))


def utm_source(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", letters_token("url", UTM_PATTERN).alias("utm_source"))
