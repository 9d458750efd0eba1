"""Check results against the taxonomy and the rules, then route them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoweave import fixed_values as fv
from taxoweave.functions.text import contains_any, is_error, join_text, present
from taxoweave.operators.joins import dimension_join
from taxoweave.operators.matching import substring_hits
from taxoweave.operators.retrieval import BROADCAST_CHARS, BROADCAST_LEAVES
from taxoweave.schemas import LEVELS

Rule = tuple[int, Sequence[str], Sequence[str], Sequence[str], str]


def fits_broadcast(dimension: DataFrame, most_rows: int = BROADCAST_LEAVES, most_chars: int = BROADCAST_CHARS) -> bool:
    """Measure rows and characters of a table's texts, and tell whether it may be broadcast."""
    texts = [F.coalesce(F.length(c), F.lit(0)) for c, kind in dimension.dtypes if kind == "string"]
    size = dimension.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(sum(texts, F.lit(0))), F.lit(0)).alias("chars")).first()
    return size["rows"] <= most_rows and size["chars"] <= most_chars


def level_flags(results: DataFrame, taxonomy: DataFrame, *, bounded: bool | None = None) -> DataFrame:
    """Add ``l1_valid`` to ``l4_valid`` and ``full_path_valid``.

    A level is valid when the prefix down to it exists, exactly as written. With
    a taxonomy that may be broadcast, rows are checked where they are. Otherwise
    the distinct answers are, and every row is shuffled once, to join its own.
    """
    leaves = taxonomy.select(*LEVELS)
    if fits_broadcast(leaves) if bounded is None else bounded:
        return _flagged(results, leaves, bounded=True)
    keyed = results.withColumn("_path", F.to_json(F.array(*[c.lower() for c in LEVELS]), {"ignoreNullFields": "false"}))
    paths = keyed.select("_path", *[c.lower() for c in LEVELS]).groupBy("_path").agg(*[F.any_value(c.lower()).alias(c.lower()) for c in LEVELS])
    flags = _flagged(paths, leaves, bounded=False).drop(*[c.lower() for c in LEVELS])
    return dimension_join(keyed, flags, ["_path"], bounded=False, how="left").drop("_path")


def _flagged(results: DataFrame, taxonomy: DataFrame, *, bounded: bool) -> DataFrame:
    """The flags, by a join for each level."""
    for depth in range(1, 5):
        names = [c.lower() for c in LEVELS[:depth]]
        flag = f"l{depth}_valid"
        nodes = taxonomy.select([F.col(c).alias(c.lower()) for c in LEVELS[:depth]]).distinct()
        results = dimension_join(
            results, nodes.withColumn(flag, F.lit(True)), names, bounded=bounded, how="left"
        ).withColumn(flag, F.coalesce(flag, F.lit(False)))
    return results.withColumn("full_path_valid", F.col("l4_valid"))


def mismatch_reason(text: Column, l1: Column, l4: Column, rules: Sequence[Rule] = fv.SEMANTIC_RULES) -> Column:
    """The reason of the first rule that the pair of text and leaf breaks, or null.

    The rules become one expression, evaluated in generated code.
    """
    text, l1, l4 = F.lower(text), F.lower(F.coalesce(l1, F.lit("None"))), F.lower(l4)
    reasons = [
        F.when(
            contains_any(text, triggers)
            & ((contains_any(l4, l4_terms) | contains_any(l1, l1_terms)) if l4_terms or l1_terms else F.lit(True)),
            F.lit(reason),
        )
        for _, triggers, l4_terms, l1_terms, reason in sorted(rules, key=lambda r: r[0])
    ]
    return F.when((text != "") & present(l4), F.coalesce(*reasons, F.lit(None).cast("string")))


def match_rule_table(results: DataFrame, rules: DataFrame) -> DataFrame:
    """``(transaction_id, rule_id, reason)`` of the first rule broken, for rules in a table.

    For rule tables too large for one expression. ``rules`` holds one term per
    row: ``rule_id, trigger_term, l4_term, l1_term, reason``; an empty
    ``l4_term`` always blocks. Triggers are found by substring equi-join, and
    the leaf's terms are checked on the rows that meet.
    """
    texts = results.filter(present(F.col("l4"))).select(
        "transaction_id",
        F.lower("l4").alias("_l4"),
        F.lower(F.coalesce("l1", F.lit("None"))).alias("_l1"),
        F.lower(join_text(F.col("spend_description"), F.col("vendor"))).alias("_text"),
    )
    needles = rules.select(F.lower("trigger_term").alias("needle"), "rule_id", "l4_term", "l1_term", "reason")
    hits = substring_hits(texts, "_text", needles, bounded=fits_broadcast(rules))
    blocked = (F.col("l4_term") == "") | F.contains("_l4", "l4_term") | (
        (F.col("l1_term") != "") & F.contains("_l1", "l1_term")
    )
    first = F.min(F.struct("rule_id", "reason")).alias("first")
    return hits.filter(F.coalesce(blocked, F.lit(False))).groupBy("transaction_id").agg(first).select(
        "transaction_id", "first.*"
    )


def validate(
    results: DataFrame, taxonomy: DataFrame, rules: Sequence[Rule] = fv.SEMANTIC_RULES, *, bounded: bool | None = None
) -> DataFrame:
    """Add level flags, the semantic check, ``validation_status`` and ``validation_notes``.

    ``results`` carries the transaction's texts, which the rules read.
    """
    error = is_error(F.col("api_error"))
    flagged = level_flags(results, taxonomy, bounded=bounded)
    flags = ["l1_valid", "l2_valid", "l3_valid", "l4_valid", "full_path_valid"]
    text = join_text(F.col("spend_description"), F.col("vendor"))
    reason = F.when(~error, mismatch_reason(text, F.col("l1"), F.col("l4"), rules))
    checked = flagged.withColumns({c: F.col(c) & ~error for c in flags} | {"semantic_mismatch_reason": reason})
    mismatch = F.col("semantic_mismatch_reason").isNotNull()
    # A missing flag never lets a result pass.
    asks_review = F.coalesce(F.col("human_review_required"), F.lit(True))
    status = (
        F.when(error | ~F.col("full_path_valid"), "INVALID").when(mismatch | asks_review, "REVIEW").otherwise("VALID")
    )
    notes = (
        F.when(error, F.concat(F.lit(fv.NOTE_ERROR), F.col("api_error")))
        .when(~F.col("full_path_valid"), F.lit(fv.NOTE_BAD_PATH))
        .when(mismatch, F.concat(F.lit(fv.NOTE_MISMATCH), F.col("semantic_mismatch_reason")))
        .when(asks_review, F.lit(fv.NOTE_FLAGGED))
        .otherwise(F.lit(fv.NOTE_VALID))
    )
    return checked.withColumns(
        {"semantic_mismatch": mismatch, "validation_status": status, "validation_notes": notes}
    )


def route(validated: DataFrame) -> DataFrame:
    """Add ``final_status`` and recompute ``human_review_required``."""
    final = (
        F.when(F.col("validation_status") == "INVALID", "INVALID")
        .when(F.col("validation_status") == "REVIEW", "REVIEW_REQUIRED")
        .when(F.col("confidence_level") == "HIGH", "ACCEPTED")
        .otherwise("REVIEW_REQUIRED")
    )
    return validated.withColumn("final_status", final).withColumn(
        "human_review_required", F.col("final_status") != "ACCEPTED"
    )


def with_texts(results: DataFrame, transactions: DataFrame) -> DataFrame:
    """Give results the description and vendor of their transaction."""
    return results.join(transactions.select("transaction_id", "spend_description", "vendor"), "transaction_id", "left")


def validate_and_route(
    results: DataFrame, transactions: DataFrame, taxonomy: DataFrame, rules: Sequence[Rule] = fv.SEMANTIC_RULES
) -> DataFrame:
    """The whole check: texts, hierarchy, rules, routing."""
    return with_texts(results, transactions).transform(validate, taxonomy, rules).transform(route)


def review_queue(finalised: DataFrame) -> DataFrame:
    """Everything that was not accepted, rows without a status included."""
    return finalised.filter(~F.col("final_status").eqNullSafe("ACCEPTED"))


def deliverable(
    transactions: DataFrame, finalised: DataFrame, columns: Sequence[str] = fv.FINAL_COLUMNS
) -> DataFrame:
    """Transactions left-joined with their result, reduced to the known columns.

    Result columns that clash with transaction columns get the suffix ``_val``.
    """
    clashes = {c: f"{c}_val" for c in finalised.columns if c in transactions.columns and c != "transaction_id"}
    joined = transactions.join(finalised.withColumnsRenamed(clashes), "transaction_id", "left")
    return joined.select([c for c in columns if c in joined.columns])
