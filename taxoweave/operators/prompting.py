"""Prompt text as columns: candidate blocks, examples, single and batch prompts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULE = "-" * 74


@dataclass(frozen=True)
class PromptStyle:
    """The fixed paragraphs of a prompt; replace them with your own."""

    task: str = (
        "You sort purchases into a four-level taxonomy.\n"
        "Choose one of the paths listed under each purchase and copy its wording.\n"
        "Judge by what is bought; the vendor is context. A boundary note binds.\n"
        "State HIGH, MEDIUM or LOW confidence, and ask for human review when the\n"
        "purchase bundles several services or no path fits.\n"
        "Answer every purchase, and keep its transaction_id."
    )
    single_task: str = (
        "You sort one purchase into a four-level taxonomy.\n"
        "Choose one of the candidate paths and copy its wording; a boundary note binds.\n"
        "Judge by what is bought; the vendor is context.\n"
        "State HIGH, MEDIUM or LOW confidence, and answer with one JSON object."
    )
    closing: str = (
        "Pick the path above that fits best. If the purchase is a bundle or no path fits,\n"
        "pick the closest and set human_review_required to true."
    )


def candidate_block(paths: Column) -> Column:
    """One ``- path`` line per candidate; the paths carry their notes already."""
    return F.array_join(F.transform(paths, lambda p: F.concat(F.lit("- "), p)), "\n")


def example_text() -> Column:
    """One worked example as text."""
    return F.concat(
        F.lit("Transaction:\n  Description: "), F.col("spend_description"),
        F.lit("\n  Vendor: "), F.col("vendor"),
        F.lit("\nClassification:\n  Path: "), F.concat_ws(" > ", "l1", "l2", "l3", "l4"),
        F.lit("\n  Reason: "), F.col("classification_reason"),
        F.lit("\n  Confidence: "), F.col("confidence_level"),
        F.lit("\n  Human Review Required: "), F.col("human_review_required").cast("string"),
    )


def few_shot_block(examples: DataFrame) -> DataFrame:
    """One row, one text: all examples in order. Meant for a handful of rows."""
    ordered = F.sort_array(F.collect_list(F.struct("example_no", example_text().alias("text"))))
    return examples.agg(F.array_join(F.transform(ordered, lambda e: e["text"]), "\n\n").alias("few_shot_block"))


def single_prompts(rows: DataFrame, examples: DataFrame, style: PromptStyle = PromptStyle()) -> DataFrame:
    """``(transaction_id, prompt)`` for rows that carry their candidate ``paths``."""
    def heading(title: str) -> str:
        return f"\n\n{RULE}\n{title}\n{RULE}\n"

    prompt = F.concat(
        F.lit(style.single_task + "\n\nExamples of correct classifications:\n\n"), few_shot_block(examples).scalar(),
        F.lit(heading("CANDIDATE TAXONOMY PATHS FOR THIS TRANSACTION")), candidate_block(F.col("paths")),
        F.lit(heading("TRANSACTION TO CLASSIFY")),
        F.lit("Spend Description: "), F.col("spend_description"),
        F.lit("\nVendor / Supplier: "), F.col("vendor"),
        F.lit("\nSource Type: "), F.col("source_type"),
        F.lit(heading("INSTRUCTIONS") + style.closing + "\n"),
    )
    return rows.select("transaction_id", prompt.alias("prompt"))


def batch_prompts(rows: DataFrame, examples: DataFrame, style: PromptStyle = PromptStyle()) -> DataFrame:
    """``(batch_no, n_rows, prompt)``: one section per transaction of the batch."""
    section = F.concat(
        F.lit("TRANSACTION ID: "), F.col("transaction_id").cast("string"),
        F.lit("\nSpend Description: "), F.col("spend_description"),
        F.lit("\nVendor: "), F.col("vendor"),
        F.lit("\nSource Type: "), F.col("source_type"),
        F.lit("\n\nCANDIDATE TAXONOMY PATHS:\n"), candidate_block(F.col("paths")),
        F.lit("\n"),
    )
    # A group is one batch, and a batch has a fixed size.
    gathered = rows.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sort_array(F.collect_list(F.struct("transaction_id", section.alias("text")))).alias("sections"),
    )
    body = F.array_join(F.transform("sections", lambda s: s["text"]), RULE + "\n")
    prompt = F.concat(
        F.lit(style.task + "\n\nFEW-SHOT EXAMPLES:\n"), few_shot_block(examples).scalar(),
        F.lit("\n\nTRANSACTIONS TO CLASSIFY:\n"), body, F.lit("\n"),
    )
    return gathered.select("batch_no", "n_rows", prompt.alias("prompt"))


def prompt_preview(prompts: DataFrame, chars: int = 750) -> DataFrame:
    """Length and opening of every prompt."""
    return prompts.select(
        "batch_no", F.length("prompt").alias("n_chars"), F.substring("prompt", 1, chars).alias("opening")
    )
