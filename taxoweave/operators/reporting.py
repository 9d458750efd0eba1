"""Reports: each one is a single aggregation with partial combine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoweave.functions.text import is_error, percent, present, same_text
from taxoweave.schemas import LEVELS


def status_summary(finalised: DataFrame) -> DataFrame:
    """One row: totals by final status, errors and shares."""
    def status(name: str) -> Column:
        return F.count_if(F.col("final_status") == name)

    total, errors = F.count(F.lit(1)), F.count_if(is_error(F.col("api_error")))
    return finalised.agg(
        total.alias("total_transactions"),
        (total - errors).alias("successfully_classified"),
        status("ACCEPTED").alias("accepted"),
        status("REVIEW_REQUIRED").alias("review_required"),
        status("INVALID").alias("invalid"),
        errors.alias("api_errors"),
        percent(status("ACCEPTED"), total).alias("pct_accepted"),
        percent(status("REVIEW_REQUIRED"), total).alias("pct_review_required"),
    )


def quality_report(finalised: DataFrame) -> DataFrame:
    """One row: cache use, confidence, routing and mismatches, with shares.

    The routing groups overlap: every invalid row also asks for review.
    """
    def confidence(name: str) -> Column:
        return F.count_if(F.upper("confidence_level") == name)

    total = F.count(F.lit(1))
    cached = F.count_if("from_cache")
    status = F.col("final_status")
    counts = {
        "cached": cached,
        "newly_classified": total - cached,
        "high_confidence": confidence("HIGH"),
        "medium_confidence": confidence("MEDIUM"),
        "low_confidence": confidence("LOW"),
        "accepted": F.count_if(status == "ACCEPTED"),
        "review_required": F.count_if((status == "REVIEW_REQUIRED") | F.col("human_review_required")),
        "invalid": F.count_if((status == "INVALID") | present(F.col("api_error"))),
    }
    return finalised.agg(
        total.alias("total_transactions"),
        *[c.alias(name) for name, c in counts.items()],
        *[percent(c, total).alias(f"pct_{name}") for name, c in counts.items()],
        F.count_if("semantic_mismatch").alias("semantic_mismatches"),
    )


def quality_lines(report: DataFrame) -> DataFrame:
    """The report as ``(line_no, line)`` rows of formatted text."""
    shown = [
        ("cached", "Cached"), ("newly_classified", "Newly Classified"),
        ("high_confidence", "HIGH Confidence"), ("medium_confidence", "MEDIUM Confidence"),
        ("low_confidence", "LOW Confidence"), ("accepted", "ACCEPTED"),
        ("review_required", "REVIEW REQUIRED"), ("invalid", "INVALID / Errors"),
    ]
    lines = [
        F.format_string(f"{label}: %d (%.1f%%)", F.col(name), F.col(f"pct_{name}")) for name, label in shown
    ]
    texts = F.array(
        F.format_string("Total Transactions Processed: %d", F.col("total_transactions")),
        *lines,
        F.format_string("Semantic Mismatches: %d", F.col("semantic_mismatches")),
    )
    return report.select(F.posexplode(texts).alias("line_no", "line"))


def scored_against_gold(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """Predictions inner-joined with gold, with one correctness flag per level."""
    joined = predictions.join(gold, "transaction_id", "inner")
    flags = {f"{c.lower()}_correct": same_text(F.col(c.lower()), F.col(f"final_ground_truth_{c}")) for c in LEVELS}
    scored = joined.withColumns(flags)
    path = F.col("l1_correct") & F.col("l2_correct") & F.col("l3_correct") & F.col("l4_correct")
    return scored.withColumn("full_path_correct", path)


def accuracy_report(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """One row: accuracy per level, and L4 precision per confidence and routing group.

    Shares are null when their group is empty.
    """
    def share(flag: str, group: Column | None = None) -> Column:
        hit = F.col(flag).cast("double")
        return F.round(F.avg(hit if group is None else F.when(group, hit)) * 100, 2)

    scored = scored_against_gold(predictions, gold)
    tiers = ["l1", "l2", "l3", "l4", "full_path"]
    groups = {
        "auto_accepted": F.col("final_status") == "ACCEPTED",
        "review_required": F.col("final_status") == "REVIEW_REQUIRED",
        "high_confidence": F.col("confidence_level") == "HIGH",
        "medium_confidence": F.col("confidence_level") == "MEDIUM",
    }
    return scored.agg(
        F.count(F.lit(1)).alias("total_evaluated"),
        *[share(f"{t}_correct").alias(f"{t}_accuracy_pct") for t in tiers],
        *[F.count_if(f"{t}_correct").alias(f"{t}_correct_count") for t in tiers],
        *[share("l4_correct", g).alias(f"{name}_precision_pct") for name, g in groups.items()],
        *[F.count_if(g).alias(f"{name}_count") for name, g in groups.items()],
    )
