"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver tables in full.  Queries that exercise table
writes (feature tables, sinks, bundles) write into a fresh scratch database in
the shared folder and return a read of what they wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import (
    fill_constant,
    first_char,
    flag_to_double,
    nan_to_null,
    null_if_empty,
    part_count,
    presence_flag,
    round_half_up,
)
from larder.operators.evaluate import weighted_prf
from larder.operators.feature_table import (
    create_feature_table,
    drop_feature_table,
    get_feature_table,
    save_features,
    write_feature_table,
)
from larder.operators.lookup import FeatureLookup, attach_features, create_training_set
from larder.operators.model import (
    build_pipeline,
    fit_and_evaluate,
    fit_pipeline,
    load_bundle,
    save_bundle,
    score_batch,
)
from larder.operators.prepare import (
    fit_one_hot,
    mode_imputer,
    one_hot_columns,
    split_is_test,
    split_train_test,
    take_ids,
    vocabulary,
)
from larder.operators.transforms import prejoin
from larder.plans.derive import (
    DIGITS_PATTERN,
    customer_demographic_features,
    doc_meta_features,
    doc_text_features,
    label_features,
    part_ticket_features,
    utm_source,
)
from larder.plans.tables import scratch_database, table
from larder.session import scratch_path
from larder.sources.files import cast_columns, read_tables, write_table
from larder.sources.schema import make_schema

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the query definitions.
LARGE_ORDER = 400000.0                      # "large" pending order total
UPSERT_TARGET_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE")
UPSERT_SOURCE_SEGMENTS = ("FURNITURE", "HOUSEHOLD", "MACHINERY")
UNSEEN_SEGMENT = "MACHINERY"
UNKNOWN_ID = -1
TEXT_FEATURES = ("first_word", "n_lines", "digits", "size_rounded", "has_digits")
META_FEATURES = ("lang", "source")
ID_LIMIT = 20


# ---------------------------------------------------------------- sources / sinks

def q_src_typed_cast(spark: SparkSession, sf: str) -> DataFrame:
    return cast_columns(table(spark, sf, "customer"), {"c_custkey": "string", "c_nationkey": "string"})


CUSTOMER_CSV_SCHEMA = make_schema([("c_custkey", "string"), ("c_name", "string"), ("c_nationkey", "string"),
                                   ("c_acctbal", "double"), ("c_mktsegment", "string")])


def q_src_csv_typed(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv-customer")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    return read_tables(spark, {"customer": path}, {"customer": CUSTOMER_CSV_SCHEMA})["customer"]


def q_sink_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    db = scratch_database(spark, "sink")
    nation = table(spark, sf, "nation")
    write_table(nation, f"{db}.nation")
    write_table(nation, f"{db}.nation")      # second write replaces the first
    return spark.table(f"{db}.nation")


# ---------------------------------------------------------------- scalar functions

def q_token_extract(spark: SparkSession, sf: str) -> DataFrame:
    return utm_source(table(spark, sf, "pages"))


def q_null_if_empty(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        null_if_empty(F.regexp_extract("text", DIGITS_PATTERN, 1)).alias("digits"),
        null_if_empty(F.regexp_replace("source", "[0-9]+", "")).alias("source_kind"),
    )


def q_first_char(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    return part.select(
        "p_partkey",
        first_char("p_type").alias("type_initial"),
        first_char(F.when(F.col("p_size") > 30, F.col("p_name"))).alias("name_initial"),
    )


def _pending_priority(spark: SparkSession, sf: str) -> DataFrame:
    """Every order; the priority is there for large pending orders only (NULL otherwise)."""
    large = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > LARGE_ORDER)
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.when(large, F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(large, F.col("o_totalprice")).alias("o_totalprice"))


def q_token_count(spark: SparkSession, sf: str) -> DataFrame:
    return _pending_priority(spark, sf).select(
        "c_custkey", "o_orderkey", "o_orderpriority", part_count("o_orderpriority").alias("priority_parts"))


def q_presence_flag(spark: SparkSession, sf: str) -> DataFrame:
    return _pending_priority(spark, sf).select(
        "c_custkey", "o_orderkey", presence_flag("o_orderpriority").alias("has_priority"))


def q_round_half_up(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", round_half_up("o_totalprice", 0).alias("price_rounded"),
                         round_half_up(F.col("o_totalprice") / F.lit(1000.0), 0).alias("price_k"))


def q_nan_to_null(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    with_nan = F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    return customer.select("c_custkey", nan_to_null(with_nan).alias("acctbal_clean"))


# ---------------------------------------------------------------- derivations and joins

def q_ticket_features(spark: SparkSession, sf: str) -> DataFrame:
    return part_ticket_features(table(spark, sf, "part"))


def q_demographic_features(spark: SparkSession, sf: str) -> DataFrame:
    return customer_demographic_features(table(spark, sf, "customer"))


def _document_tables(spark: SparkSession, sf: str, purpose: str) -> tuple[str, str]:
    """Two feature tables over ``documents`` (text and meta features), keyed by ``doc_id``."""
    db = scratch_database(spark, purpose)
    docs = table(spark, sf, "documents")
    text_t, meta_t = f"{db}.doc_text_features", f"{db}.doc_meta_features"
    save_features(spark, text_t, doc_text_features(docs), "doc_id", "Text features of documents")
    save_features(spark, meta_t, doc_meta_features(docs), "doc_id", "Language and source of documents")
    return text_t, meta_t


def _document_lookups(text_t: str, meta_t: str) -> list[FeatureLookup]:
    return [FeatureLookup(text_t, TEXT_FEATURES, "doc_id"), FeatureLookup(meta_t, META_FEATURES, "doc_id")]


def q_prejoin_inner(spark: SparkSession, sf: str) -> DataFrame:
    db = scratch_database(spark, "prejoin")
    docs = table(spark, sf, "documents")
    text_t, lab_t, joined_t = f"{db}.doc_text_features", f"{db}.label_features", f"{db}.online_features"
    save_features(spark, text_t, doc_text_features(docs), "doc_id")
    save_features(spark, lab_t, label_features(table(spark, sf, "labels")), "doc_id")
    joined = prejoin(spark.table(text_t), spark.table(lab_t), ["doc_id"],
                     ["first_word", "n_lines", "size_rounded"], ["toxic_flag"])
    save_features(spark, joined_t, joined, "doc_id", "Pre-joined document and label features")
    return spark.table(joined_t)


def q_training_set(spark: SparkSession, sf: str) -> DataFrame:
    text_t, meta_t = _document_tables(spark, sf, "training")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    ts = create_training_set(spark, labels, _document_lookups(text_t, meta_t), label="quality",
                             exclude_columns=["doc_id"])
    return ts.load_df()


def q_lookup_many_to_one(spark: SparkSession, sf: str) -> DataFrame:
    db = scratch_database(spark, "many2one")
    cust_t = f"{db}.customer_features"
    save_features(spark, cust_t, customer_demographic_features(table(spark, sf, "customer")), "PassengerId")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_custkey").cast("string").alias("cust_id"))
    return attach_features(spark, orders, [FeatureLookup(cust_t, ["NamePrefix", "NameMultiple", "Age"], "cust_id")])


def q_score_lookup(spark: SparkSession, sf: str) -> DataFrame:
    text_t, meta_t = _document_tables(spark, sf, "scorelookup")
    ids = table(spark, sf, "labels").select("doc_id")
    ids = ids.unionByName(spark.range(1).select(F.lit(UNKNOWN_ID).cast("bigint").alias("doc_id")))
    return attach_features(spark, ids, _document_lookups(text_t, meta_t))


def q_limit_ids(spark: SparkSession, sf: str) -> DataFrame:
    return take_ids(table(spark, sf, "labels"), "doc_id", ID_LIMIT)


# ---------------------------------------------------------------- feature tables

def _segment_versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Target rows (three segments) and updated source rows (overlapping on one segment)."""
    feats = customer_demographic_features(table(spark, sf, "customer"))
    target = feats.where(F.col("Sex").isin(*UPSERT_TARGET_SEGMENTS))
    source = (feats.where(F.col("Sex").isin(*UPSERT_SOURCE_SEGMENTS))
              .withColumn("Age", F.col("Age") + F.lit(1.0)))
    return target, source


def _upsert(spark: SparkSession, sf: str, purpose: str, times: int, mode: str = "merge") -> DataFrame:
    db = scratch_database(spark, purpose)
    name = f"{db}.customer_features"
    target, source = _segment_versions(spark, sf)
    save_features(spark, name, target, "PassengerId", "Customer name features")
    for _ in range(times):
        write_feature_table(spark, name, source, mode=mode)
    return spark.table(name)


def q_merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _upsert(spark, sf, "upsert", 1)


def q_merge_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    return _upsert(spark, sf, "upsert2", 2)


def q_merge_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    return _upsert(spark, sf, "overwrite", 1, mode="overwrite")


def q_feature_table_create(spark: SparkSession, sf: str) -> DataFrame:
    db = scratch_database(spark, "ftcreate")
    name = f"{db}.doc_meta_features"
    feats = doc_meta_features(table(spark, sf, "documents"))
    create_feature_table(spark, name, "doc_id", feats.schema, "Language and source of documents")
    create_feature_table(spark, name, "doc_id", feats.schema, "ignored: the table exists")
    write_feature_table(spark, name, feats)
    return spark.table(name)


def q_feature_table_drop(spark: SparkSession, sf: str) -> DataFrame:
    db = scratch_database(spark, "ftdrop")
    name = f"{db}.doc_meta_features"
    feats = doc_meta_features(table(spark, sf, "documents"))
    save_features(spark, name, feats, "doc_id")
    drop_feature_table(spark, name)
    # re-created with other values: had the table not been dropped, a merge would keep the description and version
    save_features(spark, name, feats.withColumn("source", F.upper("source")), "doc_id", mode="overwrite")
    version = get_feature_table(spark, name).version            # 1: a new table's first load
    return spark.table(name).withColumn("version", F.lit(version))


# ---------------------------------------------------------------- model preparation

def q_split_train_test(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", F.when(split_is_test("o_orderkey"), "test").otherwise("train").alias("part"))


def q_impute_constant(spark: SparkSession, sf: str) -> DataFrame:
    rows = _pending_priority(spark, sf)
    flag = F.when(F.col("o_totalprice").isNotNull(),
                  F.when(F.col("o_totalprice") > F.lit(450000.0), "1").otherwise("0"))
    return rows.select("c_custkey", "o_orderkey",
                       fill_constant("o_orderpriority").alias("priority_filled"),
                       flag_to_double(flag).alias("flag_num"))


def _balance_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    bal = (F.when(F.col("c_acctbal") < 0, F.lit(None).cast("double"))
           .when(F.col("c_nationkey") == 1, F.lit(float("nan")))
           .otherwise(F.round(F.col("c_acctbal") / F.lit(1000.0), 0)))
    return customer.select("c_custkey", bal.alias("bal"))


def q_impute_mode(spark: SparkSession, sf: str) -> DataFrame:
    rows = _balance_with_gaps(spark, sf)
    train, _ = split_train_test(rows, "c_custkey")
    model = mode_imputer(["bal"]).fit(train)
    return model.transform(rows).select("c_custkey", F.col("bal__imputed").alias("bal_filled"))


def q_category_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"])


def _segments(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    return customer.select("c_custkey", F.when(F.col("c_nationkey") != 0, F.col("c_mktsegment")).alias("segment"))


def q_encode_onehot(spark: SparkSession, sf: str) -> DataFrame:
    rows = _segments(spark, sf)
    fit_part = rows.where((F.col("segment") != UNSEEN_SEGMENT) | F.col("segment").isNull())
    model = fit_one_hot(fit_part, ["segment"])
    return one_hot_columns(model, rows, ["segment"], keep=["c_custkey"])


def q_weighted_prf(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels")
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    scored = labels.join(docs, "doc_id").select(
        "quality", F.when(F.col("n_chars") > 1000, 1).otherwise(0).alias("prediction"))
    return weighted_prf(scored, label="quality", prediction="prediction")


# ---------------------------------------------------------------- models

# Model inputs, shaped like the reference's: low-cardinality categories,
# two numbers with gaps filled by the mode, one presence flag.
CATEGORICAL = ("lang", "source")
NUMERIC = ("n_lines", "size_rounded")
BINARY = ("has_digits",)


# The label of the model queries is an exact function of one feature (whether the text has a run of
# digits), so the right prediction of every row is known and SQL can state it.
LABEL = "digits_label"


def _doc_training(spark: SparkSession, sf: str, purpose: str):
    text_t, meta_t = _document_tables(spark, sf, purpose)
    labels = table(spark, sf, "documents").select(
        "doc_id", F.when(F.regexp_extract("text", DIGITS_PATTERN, 1) != "", 1).otherwise(0).alias(LABEL))
    return create_training_set(spark, labels, _document_lookups(text_t, meta_t), label=LABEL, exclude_columns=[])


def q_gbt_fit_score(spark: SparkSession, sf: str) -> DataFrame:
    ts = _doc_training(spark, sf, "gbt")
    train, test = split_train_test(ts.load_df(), "doc_id")
    _, metrics = fit_and_evaluate(build_pipeline(CATEGORICAL, NUMERIC, BINARY, LABEL), train, test, LABEL,
                                  categorical=CATEGORICAL)
    return metrics


def _bundle(spark: SparkSession, sf: str, purpose: str) -> str:
    ts = _doc_training(spark, sf, purpose)
    model = fit_pipeline(build_pipeline(CATEGORICAL, NUMERIC, BINARY, LABEL), ts.load_df(), CATEGORICAL)
    return save_bundle(spark, model, scratch_path(spark, f"bundle-{purpose}"), ts)


def q_model_bundle(spark: SparkSession, sf: str) -> DataFrame:
    """Fit, save, load, and score every labelled id by its id alone."""
    path = _bundle(spark, sf, "bundle")
    bundle = load_bundle(spark, path)
    ids = table(spark, sf, "labels").select("doc_id", "quality")
    return score_batch(spark, bundle, ids).select("doc_id", "quality", "prediction")


def q_score_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Score every document and one unknown id, whose features are NULL."""
    path = _bundle(spark, sf, "score")
    ids = table(spark, sf, "documents").select("doc_id")
    ids = ids.unionByName(spark.range(1).select(F.lit(UNKNOWN_ID).cast("bigint").alias("doc_id")))
    return score_batch(spark, path, ids)


QUERIES: dict[str, Query] = {
    "src_typed_cast": q_src_typed_cast,
    "src_csv_typed": q_src_csv_typed,
    "sink_overwrite": q_sink_overwrite,
    "token_extract": q_token_extract,
    "null_if_empty": q_null_if_empty,
    "first_char": q_first_char,
    "token_count": q_token_count,
    "round_half_up": q_round_half_up,
    "nan_to_null": q_nan_to_null,
    "presence_flag": q_presence_flag,
    "ticket_features": q_ticket_features,
    "demographic_features": q_demographic_features,
    "prejoin_inner": q_prejoin_inner,
    "training_set": q_training_set,
    "lookup_many_to_one": q_lookup_many_to_one,
    "score_lookup": q_score_lookup,
    "limit_ids": q_limit_ids,
    "merge_upsert": q_merge_upsert,
    "merge_idempotent": q_merge_idempotent,
    "merge_overwrite": q_merge_overwrite,
    "feature_table_create": q_feature_table_create,
    "feature_table_drop": q_feature_table_drop,
    "split_train_test": q_split_train_test,
    "impute_constant": q_impute_constant,
    "impute_mode": q_impute_mode,
    "category_vocab": q_category_vocab,
    "encode_onehot": q_encode_onehot,
    "weighted_prf": q_weighted_prf,
    "gbt_fit_score": q_gbt_fit_score,
    "model_bundle": q_model_bundle,
    "score_batch": q_score_batch,
}

# Table lifecycle, exact preparation and the registry are in a module of their own.
from larder.plans.lifecycle import LIFECYCLE  # noqa: E402

QUERIES.update(LIFECYCLE)
