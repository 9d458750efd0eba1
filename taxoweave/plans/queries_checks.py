"""Queries over validation, routing and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxoweave import fixed_values as fv
from taxoweave.functions.text import join_text
from taxoweave.operators import reporting, validation
from taxoweave.operators.cleaning import clean_transactions
from taxoweave.plans.fixtures import RULES, duck_sql, view
from taxoweave.plans.oracles import DEFAULT_RUN, rule_case, validated
from taxoweave.plans.queries_run import SETTINGS, seeded_store
from taxoweave.plans.queries_retrieval import index
from taxoweave.plans import classify as runs
from taxoweave.plans.registry import query
from taxoweave.session import scratch_path
from taxoweave.sources import sinks

FINAL = validated(RULES)


def checked(spark, d, rules=RULES):
    results = view(spark, d, "fx_predictions")
    return validation.validate_and_route(
        results, view(spark, d, "fx_transactions"), view(spark, d, "fx_taxonomy"), rules
    )


@query(duck_sql("""
SELECT transaction_id, l1_valid, l2_valid, l3_valid, l4_valid, full_path_valid FROM (
  SELECT p.transaction_id,
    EXISTS (SELECT 1 FROM fx_taxonomy x WHERE x.L1 = p.l1) AS l1_valid,
    EXISTS (SELECT 1 FROM fx_taxonomy x WHERE x.L1 = p.l1 AND x.L2 = p.l2) AS l2_valid,
    EXISTS (SELECT 1 FROM fx_taxonomy x WHERE x.L1 = p.l1 AND x.L2 = p.l2 AND x.L3 = p.l3) AS l3_valid,
    EXISTS (SELECT 1 FROM fx_taxonomy x WHERE x.L1 = p.l1 AND x.L2 = p.l2 AND x.L3 = p.l3 AND x.L4 = p.l4) AS l4_valid,
    EXISTS (SELECT 1 FROM fx_taxonomy x WHERE x.L1 = p.l1 AND x.L2 = p.l2 AND x.L3 = p.l3 AND x.L4 = p.l4)
      AS full_path_valid
  FROM fx_predictions p) f"""))
def level_flags(spark, d):
    flagged = validation.level_flags(view(spark, d, "fx_predictions"), view(spark, d, "fx_taxonomy"))
    return flagged.select("transaction_id", "l1_valid", "l2_valid", "l3_valid", "l4_valid", "full_path_valid")


@query(duck_sql("SELECT transaction_id, rule_id, reason FROM (SELECT *, row_number() OVER ("
                "PARTITION BY transaction_id ORDER BY rule_id) AS nth FROM h) x WHERE nth = 1", """
h AS (
  SELECT p.transaction_id, r.rule_id, r.reason FROM fx_predictions p
  JOIN fx_transactions t ON t.transaction_id = p.transaction_id
  JOIN fx_rules r ON contains(lower(concat(t.spend_description, ' ', t.vendor)), r.trigger_term)
    AND (r.l4_term = '' OR contains(lower(p.l4), r.l4_term) OR contains(lower(p.l1), r.l1_term))
  WHERE coalesce(p.l4, '') <> '')"""))
def rule_table_hits(spark, d):
    rules = view(spark, d, "fx_rules")
    results = validation.with_texts(view(spark, d, "fx_predictions"), view(spark, d, "fx_transactions"))
    return validation.match_rule_table(results, rules)


# The default rules, against the free text of documents and the part names as leaves.
@query(f"""
SELECT doc_id, {rule_case(fv.SEMANTIC_RULES)} AS reason FROM (
  SELECT d.doc_id, lower(trim(d.text)) AS txt, lower(concat('waste ', p.p_name)) AS a4, lower(p.p_type) AS a1
  FROM documents d JOIN part p ON p.p_partkey = d.doc_id) x""")
def semantic_mismatches(spark, d):
    docs, part = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "part"))
    pairs = docs.join(part, docs.doc_id == part.p_partkey)
    leaf = F.concat(F.lit("waste "), F.col("p_name"))
    reason = validation.mismatch_reason(join_text(F.col("text")), F.col("p_type"), leaf)
    return pairs.select("doc_id", reason.alias("reason"))


_STATUS = (
    "transaction_id, l1_valid, l2_valid, l3_valid, l4_valid, full_path_valid, semantic_mismatch, "
    "semantic_mismatch_reason, validation_status, validation_notes, final_status, human_review_required"
)


@query(duck_sql(f"SELECT {_STATUS} FROM final", FINAL))
def validated_results(spark, d):
    return checked(spark, d).select(_STATUS.split(", "))


@query(duck_sql(f"SELECT {_STATUS} FROM final WHERE final_status <> 'ACCEPTED'", FINAL))
def review_queue(spark, d):
    return validation.review_queue(checked(spark, d)).select(_STATUS.split(", "))


@query(duck_sql("""
SELECT count(*) AS total_transactions, count(*) - count(*) FILTER (bad) AS successfully_classified,
  count(*) FILTER (final_status = 'ACCEPTED') AS accepted,
  count(*) FILTER (final_status = 'REVIEW_REQUIRED') AS review_required,
  count(*) FILTER (final_status = 'INVALID') AS invalid, count(*) FILTER (bad) AS api_errors,
  round(100.0 * count(*) FILTER (final_status = 'ACCEPTED') / count(*), 1)::DOUBLE AS pct_accepted,
  round(100.0 * count(*) FILTER (final_status = 'REVIEW_REQUIRED') / count(*), 1)::DOUBLE AS pct_review_required
FROM (SELECT *, trim(coalesce(api_error, '')) NOT IN ('', 'nan', 'None') AS bad FROM final) f""", FINAL))
def status_summary(spark, d):
    return reporting.status_summary(checked(spark, d))


_GROUPS = {
    "cached": "from_cache", "newly_classified": "NOT coalesce(from_cache, false)",
    "high_confidence": "upper(confidence_level) = 'HIGH'", "medium_confidence": "upper(confidence_level) = 'MEDIUM'",
    "low_confidence": "upper(confidence_level) = 'LOW'", "accepted": "final_status = 'ACCEPTED'",
    "review_required": "final_status = 'REVIEW_REQUIRED' OR human_review_required",
    "invalid": "final_status = 'INVALID' OR coalesce(api_error, '') <> ''",
}
_QUALITY = "SELECT count(*) AS total_transactions, " + ", ".join(
    f"count(*) FILTER ({c}) AS {n}, round(100.0 * count(*) FILTER ({c}) / count(*), 1)::DOUBLE AS pct_{n}"
    for n, c in _GROUPS.items()
) + ", count(*) FILTER (semantic_mismatch) AS semantic_mismatches FROM final"


@query(duck_sql(_QUALITY, FINAL))
def quality_report(spark, d):
    return reporting.quality_report(checked(spark, d))


_LABELS = {
    "cached": "Cached", "newly_classified": "Newly Classified", "high_confidence": "HIGH Confidence",
    "medium_confidence": "MEDIUM Confidence", "low_confidence": "LOW Confidence", "accepted": "ACCEPTED",
    "review_required": "REVIEW REQUIRED", "invalid": "INVALID / Errors",
}


@query(duck_sql(
    "SELECT 0 AS line_no, 'Total Transactions Processed: ' || total_transactions AS line FROM r "
    + " ".join(
        f"UNION ALL SELECT {i}, printf('{label}: %d (%.1f%%)', {n}, pct_{n}) FROM r"
        for i, (n, label) in enumerate(_LABELS.items(), 1)
    )
    + " UNION ALL SELECT 9, 'Semantic Mismatches: ' || semantic_mismatches FROM r",
    f"{FINAL}, r AS ({_QUALITY})",
))
def quality_lines(spark, d):
    return reporting.quality_lines(reporting.quality_report(checked(spark, d)))


# -- deliverable -------------------------------------------------------------


@query(duck_sql("""
SELECT m.transaction_id, m.spend_description, m.vendor, m.source_type, f.l1, f.l2, f.l3, f.l4,
       f.classification_reason, f.confidence_level, f.validation_status, f.human_review_required, f.final_status
FROM fx_transactions m LEFT JOIN final f ON f.transaction_id = m.transaction_id""", FINAL))
def final_deliverable(spark, d):
    shaped = validation.deliverable(view(spark, d, "fx_transactions"), checked(spark, d))
    return spark.read.schema(shaped.schema).parquet(sinks.write_parquet(shaped, scratch_path(spark, "final")))


# From raw transactions to the deliverable: clean, classify, validate, route.
@query(duck_sql("""
SELECT m.transaction_id, m.spend_description, m.vendor, m.source_type, f.l1, f.l2, f.l3, f.l4,
       f.classification_reason, f.confidence_level, f.validation_status, f.human_review_required, f.final_status,
       g.retrieved_taxonomy
FROM fx_transactions m JOIN final f ON f.transaction_id = m.transaction_id
JOIN merged g ON g.transaction_id = m.transaction_id""", f"""{DEFAULT_RUN},
run AS (SELECT * EXCLUDE (spend_description, vendor, retrieved_taxonomy) FROM merged),{validated(RULES, "run")}"""))
def full_run(spark, d):
    rows = clean_transactions(view(spark, d, "fx_transactions_raw"))
    results = runs.classify(rows, index(spark, d), seeded_store(spark, d), SETTINGS)
    return runs.finalise(results, rows, view(spark, d, "fx_taxonomy"), RULES)


# -- accuracy ----------------------------------------------------------------


def _same(level: str) -> str:
    return f"lower(trim(l{level})) IS NOT DISTINCT FROM lower(trim(final_ground_truth_L{level}))"


_SCORED = f"""{FINAL},
g AS (
  SELECT final.*, {", ".join(f"{_same(n)} AS l{n}_correct" for n in "1234")},
         {" AND ".join(f"({_same(n)})" for n in "1234")} AS full_path_correct
  FROM final JOIN fx_gold ON fx_gold.transaction_id = final.transaction_id)"""


@query(duck_sql("SELECT transaction_id, l1_correct, l2_correct, l3_correct, l4_correct, full_path_correct FROM g", _SCORED))
def gold_comparison(spark, d):
    scored = reporting.scored_against_gold(checked(spark, d), view(spark, d, "fx_gold"))
    return scored.select(
        "transaction_id", "l1_correct", "l2_correct", "l3_correct", "l4_correct", "full_path_correct"
    )


_TIERS = ["l1", "l2", "l3", "l4", "full_path"]
_SUBSETS = {
    "auto_accepted": "final_status = 'ACCEPTED'", "review_required": "final_status = 'REVIEW_REQUIRED'",
    "high_confidence": "confidence_level = 'HIGH'", "medium_confidence": "confidence_level = 'MEDIUM'",
}


@query(duck_sql("SELECT count(*) AS total_evaluated, " + ", ".join(
    f"round(avg({t}_correct::INT) * 100, 2) AS {t}_accuracy_pct, count(*) FILTER ({t}_correct) AS {t}_correct_count"
    for t in _TIERS
) + ", " + ", ".join(
    f"round(avg(l4_correct::INT) FILTER ({c}) * 100, 2) AS {n}_precision_pct, count(*) FILTER ({c}) AS {n}_count"
    for n, c in _SUBSETS.items()
) + " FROM g", _SCORED))
def accuracy_report(spark, d):
    return runs.evaluate(checked(spark, d), view(spark, d, "fx_gold"))
