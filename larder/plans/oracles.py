"""DuckDB SQL equivalents of the registered queries (views named like the driver tables).

The model queries fit a label that is an exact function of one feature, so SQL states
the metrics and predictions that a right fit, save, load and lookup must give.
"""

from __future__ import annotations

# Shared derivations, written once and reused as CTEs.
DOC_TEXT = r"""
  SELECT doc_id,
         CASE WHEN length(regexp_extract(text, '([A-Za-z]+)', 1)) > 0
              THEN upper(regexp_extract(text, '([A-Za-z]+)', 1)) END AS first_word,
         CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lines,
         NULLIF(regexp_extract(text, '([0-9]{3,})', 1), '') AS digits,
         round(CAST(n_chars AS DOUBLE) / CAST(100 AS DOUBLE), 0) AS size_rounded,
         CASE WHEN regexp_extract(text, '([0-9]{3,})', 1) <> '' THEN '1' ELSE '0' END AS has_digits
  FROM documents"""

DOC_META = r"""
  SELECT doc_id, lang, source,
         CASE WHEN length(regexp_extract(source, '([A-Za-z]+)', 1)) > 0
              THEN upper(regexp_extract(source, '([A-Za-z]+)', 1)) END AS source_kind
  FROM documents"""

DEMOGRAPHIC = r"""
  raw_names AS (
    SELECT CAST(c_custkey AS VARCHAR) AS PassengerId,
           CASE WHEN c_nationkey <> 0 THEN
                c_name || ', ' ||
                CASE WHEN c_mktsegment = 'BUILDING' THEN 'Mr. '
                     WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Mrs. '
                     WHEN c_mktsegment = 'MACHINERY' THEN ''
                     ELSE 'Miss. ' END ||
                lower(c_mktsegment) ||
                CASE WHEN c_nationkey % 3 = 0 THEN ' (Ann Lee)'
                     WHEN c_nationkey % 3 = 1 THEN ' (Ann-Lee)'
                     ELSE '' END
           END AS Name,
           c_mktsegment AS Sex,
           CASE WHEN c_acctbal < 0 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal / CAST(100 AS DOUBLE) END AS Age,
           CAST(c_nationkey % 5 AS VARCHAR) AS SibSp
    FROM customer),
  names_b AS (
    SELECT PassengerId, Name, Sex,
           CASE WHEN isnan(Age) THEN NULL ELSE Age END AS Age,
           SibSp,
           regexp_extract(Name, '([A-Za-z]+)\.', 1) AS NamePrefix,
           NULLIF(regexp_extract(Name, '\(([A-Za-z ]+)\)', 1), '') AS NameSecondary
    FROM raw_names),
  demo AS (
    SELECT *, CASE WHEN NameSecondary IS NOT NULL THEN '1' ELSE '0' END AS NameMultiple FROM names_b)"""

PENDING = r"""
  pending AS (
    SELECT o_custkey AS c_custkey, o_orderkey,
           CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000.0 THEN o_orderpriority END AS o_orderpriority,
           CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000.0 THEN o_totalprice END AS o_totalprice
    FROM orders)"""

# The label of the model queries, which a fitted model must reproduce exactly.
HAS_DIGITS = "CASE WHEN regexp_extract(text, '([0-9]{3,})', 1) <> '' THEN 1 ELSE 0 END"

IS_TEST = "substr(md5('123:' || CAST({k} AS VARCHAR)), 1, 8) < '40000000'"

UPSERT_PARTS = DEMOGRAPHIC + r""",
  target AS (SELECT * FROM demo WHERE Sex IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')),
  source AS (
    SELECT PassengerId, Name, Sex, Age + CAST(1 AS DOUBLE) AS Age, SibSp, NamePrefix, NameSecondary, NameMultiple
    FROM demo WHERE Sex IN ('FURNITURE', 'HOUSEHOLD', 'MACHINERY'))"""

UPSERT_RESULT = "WITH" + UPSERT_PARTS + r"""
SELECT * FROM target WHERE PassengerId NOT IN (SELECT PassengerId FROM source)
UNION ALL
SELECT * FROM source"""

CUSTOMER_TEXT_IDS = r"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       c_acctbal, c_mktsegment
FROM customer"""


def _vocab(col: str) -> str:
    return f"""
SELECT '{col}' AS column_name, category,
       CAST(row_number() OVER (ORDER BY category) - 1 AS DOUBLE) AS category_index
FROM (SELECT DISTINCT {col} AS category FROM orders WHERE {col} IS NOT NULL)"""


def _metric_rows() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{m}' AS metric, {m} AS value, round({m}, 2) AS value_rounded FROM w"
        for m in ("precision", "recall", "f1"))


ORACLES: dict[str, str] = {
    "src_typed_cast": CUSTOMER_TEXT_IDS,
    "src_csv_typed": CUSTOMER_TEXT_IDS,
    "sink_overwrite": "SELECT * FROM nation",
    "token_extract": r"""
SELECT page_id,
       CASE WHEN length(regexp_extract(url, 'utm_source=([A-Za-z]+)', 1)) > 0
            THEN upper(regexp_extract(url, 'utm_source=([A-Za-z]+)', 1)) END AS utm_source
FROM pages""",
    "null_if_empty": r"""
SELECT doc_id,
       NULLIF(regexp_extract(text, '([0-9]{3,})', 1), '') AS digits,
       NULLIF(regexp_replace(source, '[0-9]+', '', 'g'), '') AS source_kind
FROM documents""",
    "first_char": r"""
SELECT p_partkey,
       substr(p_type, 1, 1) AS type_initial,
       substr(CASE WHEN p_size > 30 THEN p_name END, 1, 1) AS name_initial
FROM part""",
    "token_count": "WITH" + PENDING + r"""
SELECT c_custkey, o_orderkey, o_orderpriority,
       CASE WHEN o_orderpriority IS NULL THEN '0'
            ELSE CAST(len(string_split(o_orderpriority, ' ')) AS VARCHAR) END AS priority_parts
FROM pending""",
    "presence_flag": "WITH" + PENDING + r"""
SELECT c_custkey, o_orderkey,
       CASE WHEN o_orderpriority IS NOT NULL THEN '1' ELSE '0' END AS has_priority
FROM pending""",
    "round_half_up": r"""
SELECT o_orderkey, round(o_totalprice, 0) AS price_rounded,
       round(o_totalprice / CAST(1000 AS DOUBLE), 0) AS price_k
FROM orders""",
    "nan_to_null": r"""
WITH t AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS x
           FROM customer)
SELECT c_custkey, CASE WHEN isnan(x) THEN NULL ELSE x END AS acctbal_clean FROM t""",
    "ticket_features": r"""
WITH raw AS (
  SELECT CAST(p_partkey AS VARCHAR) AS PassengerId,
         CASE WHEN p_size <= 10 THEN CAST(p_partkey AS VARCHAR) ELSE p_type || '/' || p_brand END AS Ticket,
         p_retailprice AS Fare,
         CASE WHEN p_size > 30 THEN p_name END AS Cabin,
         p_brand AS Embarked,
         CAST(p_size AS VARCHAR) AS Pclass,
         p_type AS Parch
  FROM part)
SELECT PassengerId, Fare, Embarked, Pclass, Parch,
       CASE WHEN length(regexp_extract(Ticket, '([A-Za-z]+)', 1)) > 0
            THEN upper(regexp_extract(Ticket, '([A-Za-z]+)', 1)) END AS TicketChars,
       substr(Cabin, 1, 1) AS CabinChar,
       CASE WHEN Cabin IS NULL THEN '0' ELSE CAST(len(string_split(Cabin, ' ')) AS VARCHAR) END AS CabinMulti,
       round(Fare, 0) AS FareRounded
FROM raw""",
    "demographic_features": "WITH" + DEMOGRAPHIC + "\nSELECT * FROM demo",
    "prejoin_inner": f"""
WITH t AS ({DOC_TEXT}),
lf AS (SELECT doc_id, CASE WHEN toxic = 1 THEN '1' ELSE '0' END AS toxic_flag FROM labels)
SELECT t.doc_id, t.first_word, t.n_lines, t.size_rounded, lf.toxic_flag
FROM t JOIN lf ON t.doc_id = lf.doc_id""",
    "training_set": f"""
WITH t AS ({DOC_TEXT}), m AS ({DOC_META})
SELECT l.quality, t.first_word, t.n_lines, t.digits, t.size_rounded, t.has_digits, m.lang, m.source
FROM labels l LEFT JOIN t ON l.doc_id = t.doc_id LEFT JOIN m ON l.doc_id = m.doc_id""",
    "lookup_many_to_one": "WITH" + DEMOGRAPHIC + r"""
SELECT o.o_orderkey, o.o_totalprice, CAST(o.o_custkey AS VARCHAR) AS cust_id,
       d.NamePrefix, d.NameMultiple, d.Age
FROM orders o LEFT JOIN demo d ON CAST(o.o_custkey AS VARCHAR) = d.PassengerId""",
    "score_lookup": f"""
WITH ids AS (SELECT doc_id FROM labels UNION ALL SELECT CAST(-1 AS BIGINT) AS doc_id),
t AS ({DOC_TEXT}), m AS ({DOC_META})
SELECT ids.doc_id, t.first_word, t.n_lines, t.digits, t.size_rounded, t.has_digits, m.lang, m.source
FROM ids LEFT JOIN t ON ids.doc_id = t.doc_id LEFT JOIN m ON ids.doc_id = m.doc_id""",
    "limit_ids": "SELECT doc_id FROM labels ORDER BY doc_id LIMIT 20",
    "merge_upsert": UPSERT_RESULT,
    "merge_idempotent": UPSERT_RESULT,
    "merge_overwrite": "WITH" + UPSERT_PARTS + "\nSELECT * FROM source",
    "feature_table_create": DOC_META,
    "feature_table_drop": f"""
WITH m AS ({DOC_META})
SELECT doc_id, lang, upper(source) AS source, source_kind, 1 AS version FROM m""",
    "split_train_test": f"""
SELECT o_orderkey, CASE WHEN {IS_TEST.format(k='o_orderkey')} THEN 'test' ELSE 'train' END AS part
FROM orders""",
    "impute_constant": "WITH" + PENDING + r"""
SELECT c_custkey, o_orderkey,
       coalesce(o_orderpriority, 'missing') AS priority_filled,
       CAST(coalesce(CASE WHEN o_totalprice IS NOT NULL THEN
                          CASE WHEN o_totalprice > 450000.0 THEN '1' ELSE '0' END END, '0') AS DOUBLE) AS flag_num
FROM pending""",
    "impute_mode": f"""
WITH base AS (
  SELECT c_custkey,
         CASE WHEN c_acctbal < 0 THEN NULL
              WHEN c_nationkey = 1 THEN CAST('NaN' AS DOUBLE)
              ELSE round(c_acctbal / CAST(1000 AS DOUBLE), 0) END AS bal
  FROM customer),
train AS (SELECT * FROM base WHERE NOT ({IS_TEST.format(k='c_custkey')})),
m AS (SELECT bal FROM train WHERE bal IS NOT NULL AND NOT isnan(bal)
      GROUP BY bal ORDER BY count(*) DESC, bal LIMIT 1)
SELECT c_custkey, CASE WHEN bal IS NULL OR isnan(bal) THEN (SELECT bal FROM m) ELSE bal END AS bal_filled
FROM base""",
    "category_vocab": _vocab("o_orderpriority") + "\nUNION ALL" + _vocab("o_orderstatus"),
    "encode_onehot": r"""
WITH s AS (SELECT c_custkey, coalesce(CASE WHEN c_nationkey <> 0 THEN c_mktsegment END, 'missing') AS seg
           FROM customer)
SELECT c_custkey,
       CAST(seg = 'AUTOMOBILE' AS DOUBLE) AS segment_AUTOMOBILE,
       CAST(seg = 'BUILDING' AS DOUBLE) AS segment_BUILDING,
       CAST(seg = 'FURNITURE' AS DOUBLE) AS segment_FURNITURE,
       CAST(seg = 'HOUSEHOLD' AS DOUBLE) AS segment_HOUSEHOLD,
       CAST(seg = 'missing' AS DOUBLE) AS segment_missing
FROM s""",
    "weighted_prf": r"""
WITH s AS (
  SELECT CAST(l.quality AS DOUBLE) AS y,
         CAST(CASE WHEN d.n_chars > 1000 THEN 1 ELSE 0 END AS DOUBLE) AS p
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
counts AS (SELECT y, p, CAST(count(*) AS DOUBLE) AS n FROM s GROUP BY y, p),
support AS (SELECT y AS c, sum(n) AS support FROM counts GROUP BY y),
predicted AS (SELECT p AS c, sum(n) AS predicted FROM counts GROUP BY p),
tp AS (SELECT y AS c, n AS tp FROM counts WHERE y = p),
pc AS (SELECT su.c, su.support, coalesce(pr.predicted, CAST(0 AS DOUBLE)) AS predicted,
              coalesce(tp.tp, CAST(0 AS DOUBLE)) AS tp
       FROM support su LEFT JOIN predicted pr ON su.c = pr.c LEFT JOIN tp ON su.c = tp.c),
r AS (SELECT c, support,
             CASE WHEN predicted > 0 THEN tp / predicted ELSE CAST(0 AS DOUBLE) END AS precision,
             tp / support AS recall
      FROM pc),
f AS (SELECT c, support, precision, recall,
             CASE WHEN precision + recall > 0
                  THEN CAST(2 AS DOUBLE) * precision * recall / (precision + recall)
                  ELSE CAST(0 AS DOUBLE) END AS f1
      FROM r),
w AS (SELECT sum(support * precision) / sum(support) AS precision,
             sum(support * recall) / sum(support) AS recall,
             sum(support * f1) / sum(support) AS f1
      FROM f)
""" + _metric_rows(),
    "gbt_fit_score": f"""
WITH parts AS (
  SELECT DISTINCT CASE WHEN {IS_TEST.format(k='doc_id')} THEN 'testing' ELSE 'training' END AS part FROM documents),
metrics(metric) AS (VALUES ('precision'), ('recall'), ('f1'))
SELECT part, metric, CAST(1 AS DOUBLE) AS value, CAST(1 AS DOUBLE) AS value_rounded FROM parts, metrics""",
    "model_bundle": f"""
SELECT l.doc_id, l.quality, CAST(coalesce({HAS_DIGITS}, 0) AS DOUBLE) AS prediction
FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id""",
    "score_batch": f"""
WITH ids AS (SELECT doc_id FROM documents UNION ALL SELECT CAST(-1 AS BIGINT) AS doc_id),
t AS ({DOC_TEXT}), m AS ({DOC_META})
SELECT ids.doc_id, t.first_word, t.n_lines, t.digits, t.size_rounded, t.has_digits, m.lang, m.source,
       CAST(coalesce(t.has_digits, '0') AS DOUBLE) AS prediction
FROM ids LEFT JOIN t ON ids.doc_id = t.doc_id LEFT JOIN m ON ids.doc_id = m.doc_id""",
}

ORACLES |= {
    "merge_partitioned": UPSERT_RESULT,
    "merge_ordered": r"""
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) AS k
      FROM orders)
WHERE k = 1""",
    "snapshot_diff": "WITH" + UPSERT_PARTS + r""",
  joined AS (
    SELECT t.PassengerId AS old_id, s.PassengerId AS new_id, t.Age AS old_age, s.*
    FROM target t FULL JOIN source s ON t.PassengerId = s.PassengerId)
SELECT CASE WHEN old_id IS NULL THEN 'insert' WHEN new_id IS NULL THEN 'remove' ELSE 'update' END AS change,
       coalesce(new_id, old_id) AS PassengerId, Name, Sex, Age, SibSp, NamePrefix, NameSecondary, NameMultiple
FROM joined
WHERE old_id IS NULL OR new_id IS NULL OR old_age IS DISTINCT FROM Age""",
    "split_exact": r"""
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5('123:' || CAST(o_orderkey AS VARCHAR)))
                             <= ceil(0.25 * (SELECT count(*) FROM orders)) THEN 'test' ELSE 'train' END AS part
FROM orders""",
    "impute_mode_exact": ORACLES["impute_mode"],
    "encode_by_table": r"""
WITH s AS (SELECT c_custkey, coalesce(CASE WHEN c_nationkey <> 0 THEN c_mktsegment END, 'missing') AS seg FROM customer)
SELECT c_custkey,
       concat_ws(',', (seg = 'AUTOMOBILE')::INT, (seg = 'BUILDING')::INT, (seg = 'FURNITURE')::INT, (seg = 'HOUSEHOLD')::INT,
                 (seg = 'missing')::INT) AS encoded
FROM s""",
    "pinned_scores": f"""
WITH t AS ({DOC_TEXT})
SELECT doc_id, first_word, n_lines, digits, size_rounded, has_digits,
       CAST(has_digits AS DOUBLE) + n_lines AS prediction, 1 AS version, 3 AS table_version
FROM t""",
    "registry_production": f"""
WITH t AS ({DOC_TEXT}),
v(version, stage) AS (VALUES (1, 'archived'), (2, 'production'), (3, 'staging'))
SELECT t.doc_id, t.n_lines, CAST(t.n_lines AS DOUBLE) AS prediction, v.version, v.stage
FROM t JOIN v ON v.stage = 'production'""",
}
