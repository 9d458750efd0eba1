"""Views over the driver's tables: a taxonomy, transactions, predictions, gold labels, a store.

One SQL text per view serves Spark and DuckDB. ``{G}`` is the flag that DuckDB
needs for a global replace, ``{part}`` and the like name the base tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from taxoweave.operators.retrieval import Lexicon

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

VIEWS = {
    "fx_taxonomy": """
SELECT CAST(row_number() OVER (ORDER BY L1, L2, L3) AS BIGINT) AS ordinal, L1, L2, L3, L4,
       concat(L1, ' > ', L2, ' > ', L3, ' > ', L4) AS full_path,
       CASE WHEN L3 = 'gizmo' AND L1 = 'PROMO' THEN 'urgent promo items classify here'
            WHEN L2 = 'hot' THEN 'Handle with care' ELSE '' END AS boundary_note
FROM (SELECT DISTINCT p_type AS L1, split_part(p_name, ' ', 1) AS L2,
             split_part(p_name, ' ', 2) AS L3, p_name AS L4 FROM {part}) t""",
    # A taxonomy that grows with the data: one leaf per part.
    "fx_parts": """
SELECT p_partkey + 1 AS ordinal, p_type AS L1, p_brand AS L2, p_name AS L3, concat(p_name, ' ', p_partkey) AS L4,
       concat(p_type, ' > ', p_brand, ' > ', p_name, ' > ', p_name, ' ', p_partkey) AS full_path,
       CASE WHEN p_size = 7 THEN 'seventh shelf' ELSE '' END AS boundary_note
FROM {part}""",
    "fx_part_orders": """
SELECT o.o_orderkey AS transaction_id,
       CASE WHEN o.o_orderkey % 5 = 0 THEN concat(p.p_name, ' ', p.p_brand)
            WHEN o.o_orderkey % 5 = 1 THEN concat('seventh ', split_part(p.p_name, ' ', 2), ' ', p.p_type)
            ELSE concat(p.p_name, ' ', p.p_partkey, ', ', o.o_orderpriority) END AS text
FROM {orders} o JOIN {part} p ON p.p_partkey = o.o_custkey % (SELECT count(*) FROM {part})""",
    "fx_base": """
SELECT o.o_orderkey AS transaction_id, p.p_type AS t1, split_part(p.p_name, ' ', 1) AS t2,
       split_part(p.p_name, ' ', 2) AS t3, p.p_name AS t4, s.s_name AS vendor,
       o.o_orderpriority AS prio, o.o_orderstatus AS source_type
FROM {orders} o
JOIN {part} p ON p.p_partkey = o.o_orderkey % (SELECT count(*) FROM {part})
JOIN {supplier} s ON s.s_suppkey = o.o_custkey % (SELECT count(*) FROM {supplier})""",
    "fx_transactions_raw": """
SELECT transaction_id,
       CASE WHEN transaction_id % 17 = 0 THEN CAST(NULL AS VARCHAR(200))
            WHEN transaction_id % 19 = 0 THEN '   '
            WHEN transaction_id % 11 = 0 THEN concat('  misc   invoice ', prio)
            WHEN transaction_id % 7 = 0 THEN concat(t2, ' item  ', prio)
            ELSE concat(t4, ' - annual  contract ', lower(t1), ', ', prio) END AS spend_description,
       CASE WHEN transaction_id % 23 = 0 THEN NULL ELSE vendor END AS vendor, source_type
FROM fx_base""",
    "fx_transactions": """
SELECT transaction_id,
       CASE WHEN trim(regexp_replace(spend_description, '[ ]+', ' '{G})) IN ('', 'nan') THEN 'MISSING_DESCRIPTION'
            ELSE trim(regexp_replace(spend_description, '[ ]+', ' '{G})) END AS spend_description,
       coalesce(vendor, 'nan') AS vendor, source_type
FROM fx_transactions_raw WHERE spend_description IS NOT NULL""",
    "fx_predictions": """
SELECT b.transaction_id,
       CASE WHEN b.transaction_id % 41 = 0 THEN NULL ELSE b.t1 END AS l1,
       CASE WHEN b.transaction_id % 41 = 0 THEN NULL WHEN b.transaction_id % 29 = 0 THEN 'purple' ELSE b.t2 END AS l2,
       CASE WHEN b.transaction_id % 41 = 0 THEN NULL ELSE b.t3 END AS l3,
       CASE WHEN b.transaction_id % 41 = 0 THEN NULL WHEN b.transaction_id % 31 = 0 THEN 'invented leaf'
            ELSE b.t4 END AS l4,
       concat('matched ', b.t4) AS classification_reason,
       CASE WHEN b.transaction_id % 41 = 0 THEN NULL WHEN b.transaction_id % 10 < 7 THEN 'HIGH'
            WHEN b.transaction_id % 10 < 9 THEN 'MEDIUM' ELSE 'low' END AS confidence_level,
       CASE WHEN b.transaction_id % 43 = 0 THEN NULL ELSE b.transaction_id % 13 = 0 END AS human_review_required,
       CASE WHEN b.transaction_id % 41 = 0 THEN 'RuntimeError: quota' WHEN b.transaction_id % 2 = 0 THEN ''
            ELSE NULL END AS api_error,
       b.transaction_id % 5 = 0 AS from_cache
FROM fx_base b JOIN fx_transactions t ON t.transaction_id = b.transaction_id""",
    # Labels exist for orders that are open or filled, with case and space noise.
    "fx_gold": """
SELECT transaction_id,
       t1 AS final_ground_truth_L1,
       CASE WHEN transaction_id % 9 = 0 THEN 'other' ELSE upper(t2) END AS final_ground_truth_L2,
       t3 AS final_ground_truth_L3,
       CASE WHEN transaction_id % 6 = 0 THEN 'other' ELSE concat(' ', t4) END AS final_ground_truth_L4,
       concat(t1, ' > ', t2, ' > ', t3, ' > ', t4) AS final_full_path
FROM fx_base WHERE source_type <> 'P'""",
    # Earlier results by key: an empty l1 counts as not classified.
    "fx_store": """
SELECT cache_key, min(l1) AS l1, min(l2) AS l2, min(l3) AS l3, min(l4) AS l4,
       min(classification_reason) AS classification_reason, min(confidence_level) AS confidence_level,
       CAST(NULL AS BOOLEAN) AS human_review_required, concat('stored > ', min(l4)) AS retrieved_taxonomy
FROM (
  SELECT concat('v2__||__', trim(t.spend_description), '__||__', trim(t.vendor)) AS cache_key,
         CASE WHEN p.transaction_id % 12 = 0 THEN '' ELSE p.l1 END AS l1, p.l2, p.l3, p.l4,
         p.classification_reason, p.confidence_level
  FROM fx_predictions p JOIN fx_transactions t ON t.transaction_id = p.transaction_id
  WHERE p.from_cache AND p.l1 IS NOT NULL) x GROUP BY cache_key""",
    # One worked example per segment: its first transaction with an own description.
    "fx_examples": """
SELECT row_number() OVER (ORDER BY b.t1) AS example_no, t.spend_description, t.vendor,
       b.t1 AS l1, b.t2 AS l2, b.t3 AS l3, b.t4 AS l4, concat('The text names ', b.t4, '.') AS classification_reason,
       'HIGH' AS confidence_level, false AS human_review_required
FROM fx_base b JOIN fx_transactions t ON t.transaction_id = b.transaction_id
JOIN (SELECT b2.t1 AS segment, min(b2.transaction_id) AS first_id
      FROM fx_base b2 JOIN fx_transactions t2 ON t2.transaction_id = b2.transaction_id
      WHERE t2.spend_description <> 'MISSING_DESCRIPTION' GROUP BY b2.t1) f ON f.first_id = b.transaction_id""",
    "fx_synonyms": """
SELECT * FROM (VALUES ('urgent', 'hot'), ('urgent', 'plate'), ('low', 'old'),
                      ('not specified', 'cold'), ('not specified', 'rod')) AS s(syn_key, token)""",
    "fx_rules": """
SELECT * FROM (VALUES
 (1, 'ring', 'ring', CAST(NULL AS VARCHAR(50)), 'spring-like text is not a ring leaf'),
 (2, 'urgent', 'bolt', CAST(NULL AS VARCHAR(50)), 'urgent purchases are never bolts'),
 (3, 'plate', CAST(NULL AS VARCHAR(50)), 'promo', 'plates are never promo'),
 (4, 'misc', '', CAST(NULL AS VARCHAR(50)), 'bundled text needs review')) AS r(rule_id, trigger_term, l4_term, l1_term, reason)""",
}

# The same synonyms and rules as library arguments.
LEXICON = Lexicon(synonyms={"urgent": ("hot", "plate"), "low": ("old",), "not specified": ("cold", "rod")})
RULES = [
    (1, ["ring"], ["ring"], [], "spring-like text is not a ring leaf"),
    (2, ["urgent"], ["bolt"], [], "urgent purchases are never bolts"),
    (3, ["plate"], [], ["promo"], "plates are never promo"),
    (4, ["misc"], [], [], "bundled text needs review"),
]


def _needed(text: str) -> list[str]:
    """Views that a text refers to, in definition order."""
    wanted, queue = set(), [text]
    while queue:
        found = set(re.findall(r"\bfx_\w+", queue.pop())) & VIEWS.keys() - wanted
        wanted |= found
        queue.extend(VIEWS[name] for name in found)
    return [name for name in VIEWS if name in wanted]


def duck_sql(query: str, extra: str = "") -> str:
    """A query over the views as one DuckDB statement.

    ``extra`` is a comma-separated list of further common table expressions.
    """
    names = {t: t for t in TABLES} | {"G": ", 'g'"}
    parts = [f"{view} AS ({VIEWS[view].format(**names)})" for view in _needed(extra + " " + query)]
    if extra.strip():
        parts.append(extra.strip())
    return (f"WITH {', '.join(parts)} " if parts else "") + query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views as a DataFrame."""
    names = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES} | {"G": ""}
    parts = [f"{v} AS ({VIEWS[v].format(**names)})" for v in _needed(VIEWS[name])]
    head = f"WITH {', '.join(parts)} " if parts else ""
    return spark.sql(head + VIEWS[name].format(**names))
