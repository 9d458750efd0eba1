"""Clean transactions and taxonomy, and report on their quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxoweave import fixed_values as fv
from taxoweave.functions.text import squeeze, strip
from taxoweave.operators.joins import forward_fill
from taxoweave.schemas import LEVELS
from taxoweave.session import settle


def rename_sheet(raw: DataFrame, headers: dict[str, str] = fv.SHEET_HEADERS) -> DataFrame:
    """Keep the known sheet columns under their short names."""
    return raw.select([F.col(f"`{old}`").alias(new) for old, new in headers.items()])


def clean_transactions(raw: DataFrame, *, strict_ids: bool = True) -> DataFrame:
    """One clean row per transaction that has a description.

    Null vendors and source types become the text ``nan``; a description that
    is blank after cleaning becomes a sentinel. A bad id fails the job, or
    becomes null when ``strict_ids`` is off.
    """
    tidy = squeeze(F.col("spend_description"))
    row_id = F.col("transaction_id")
    return raw.na.drop(how="all", subset=["spend_description"]).select(
        (row_id.cast("bigint") if strict_ids else row_id.try_cast("bigint")).alias("transaction_id"),
        F.when(tidy.isin("", fv.NULL_TEXT), F.lit(fv.MISSING_DESCRIPTION)).otherwise(tidy).alias("spend_description"),
        *[F.coalesce(squeeze(F.col(c)), F.lit(fv.NULL_TEXT)).alias(c) for c in ("vendor", "source_type")],
    )


def clean_taxonomy(raw: DataFrame) -> DataFrame:
    """Fill the merged upper levels down, strip every text, drop blank rows."""
    texts = [*LEVELS, "full_path", "boundary_note"]
    kept = raw.na.drop(how="all", subset=texts)
    filled = forward_fill(kept, LEVELS[:3], "ordinal")
    return filled.select(
        F.col("ordinal").cast("bigint").alias("ordinal"),
        *[F.coalesce(strip(F.col(c)), F.lit(fv.NULL_TEXT)).alias(c) for c in texts[:-1]],
        strip(F.coalesce(F.col("boundary_note"), F.lit(""))).alias("boundary_note"),
    )


def flag_duplicates(transactions: DataFrame) -> DataFrame:
    """Mark every row but the first of its (description, vendor).

    The first id per pair is aggregated before the shuffle; a window would send
    all copies of a hot pair to one task. Rows without an id, which the lenient
    lane lets pass, come after those with one, in the table's order; they are
    numbered apart.
    """
    pair = ["spend_description", "vendor"]
    first = transactions.groupBy(*pair).agg(F.min("transaction_id").alias("transaction_id"))
    marked = first.filter(F.col("transaction_id").isNotNull()).select("transaction_id", F.lit(False).alias("is_duplicate"))
    named = transactions.filter(F.col("transaction_id").isNotNull()).join(marked, "transaction_id", "left")
    nameless = settle(transactions.filter(F.col("transaction_id").isNull()).withColumn("_row", F.monotonically_increasing_id()), "nameless")
    # Pairs that only rows without an id have; their first row stands for itself.
    alone = first.filter(F.col("transaction_id").isNull()).select(*[F.col(c).alias(f"_{c}") for c in pair])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in pair]
    firsts = nameless.groupBy(*pair).agg(F.min("_row").alias("_row")).join(alone, same, "left_semi").select("_row", F.lit(False).alias("is_duplicate"))
    rest = nameless.join(firsts, "_row", "left").select(*transactions.columns, "is_duplicate")
    return named.select(*transactions.columns, "is_duplicate").unionByName(rest).withColumn("is_duplicate", F.coalesce("is_duplicate", F.lit(True)))


def data_quality_report(transactions: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """One row of counts over both tables."""
    pair = F.struct("spend_description", "vendor")
    rows = F.count(F.lit(1))
    on_transactions = transactions.agg(
        rows.alias("n_transactions"),
        F.count_if(F.col("spend_description") == fv.MISSING_DESCRIPTION).alias("missing_descriptions"),
        (rows - F.count_distinct(pair)).alias("duplicate_transaction_rows"),
    )
    on_taxonomy = taxonomy.agg(
        rows.alias("n_taxonomy_leaf_nodes"),
        F.count_distinct("L1").alias("n_unique_l1_segments"),
        F.count_if(F.col("boundary_note") != "").alias("n_boundary_notes"),
    )
    both = on_transactions.unionByName(on_taxonomy, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def rows_per_segment(taxonomy: DataFrame) -> DataFrame:
    """Number of leaves per L1, largest first."""
    return taxonomy.groupBy("L1").agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), "L1")


def path_differences(taxonomy: DataFrame, dropdown: DataFrame) -> DataFrame:
    """Paths that only one of the two sides has; empty when the sets are equal."""
    ours = taxonomy.select("full_path")
    listed = dropdown.na.drop(subset=["full_path"]).select(strip(F.col("full_path")).alias("full_path"))
    return (
        ours.subtract(listed).withColumn("side", F.lit("taxonomy"))
        .unionByName(listed.subtract(ours).withColumn("side", F.lit("dropdown")))
    )


def paths_match(taxonomy: DataFrame, dropdown: DataFrame) -> bool:
    """True when taxonomy and dropdown list hold the same paths."""
    return path_differences(taxonomy, dropdown).isEmpty()


def taxonomy_nodes(taxonomy: DataFrame) -> DataFrame:
    """Every node of the tree with its depth and its number of leaves."""
    sets = [LEVELS[:depth] for depth in range(1, 5)]
    return taxonomy.groupingSets(sets, *LEVELS).agg(
        (F.lit(4) - sum((F.grouping(c).cast("int") for c in LEVELS[1:]), F.grouping("L1").cast("int"))).alias("depth"),
        F.count(F.lit(1)).alias("n_leaves"),
    )


def cross_section(taxonomy: DataFrame, per_segment: int = fv.CROSS_SECTION_PER_L1) -> DataFrame:
    """The first few leaves of every L1, in taxonomy order."""
    rank = F.row_number().over(Window.partitionBy("L1").orderBy("ordinal"))
    return taxonomy.withColumn("_rank", rank).filter(F.col("_rank") <= per_segment).drop("_rank")
