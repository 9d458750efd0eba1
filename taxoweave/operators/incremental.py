"""Classify only what is new: dedupe, look up, batch, merge, store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoweave import fixed_values as fv
from taxoweave.functions.text import cache_key, is_error, present
from taxoweave.operators.joins import global_position, hot_key_join, one_row_per_key
from taxoweave.schemas import RESULT_BODY

BODY = RESULT_BODY.fieldNames()


def with_key(transactions: DataFrame) -> DataFrame:
    """Add the store key of every transaction."""
    return transactions.withColumn("cache_key", cache_key(F.col("spend_description"), F.col("vendor")))


def first_rows(transactions: DataFrame) -> DataFrame:
    """The first transaction (lowest id) of every key, with its number of rows.

    Ids and counts are aggregated before the shuffle; the rows are looked up.
    """
    rows = with_key(transactions.select("transaction_id", "spend_description", "vendor", "source_type"))
    return one_row_per_key(rows, ["cache_key"], "transaction_id", count="n_rows").select(
        "cache_key", "transaction_id", "spend_description", "vendor", "source_type", "n_rows"
    )


def rows_per_key(transactions: DataFrame) -> DataFrame:
    """``(cache_key, n_rows)``."""
    return with_key(transactions).groupBy("cache_key").agg(F.count(F.lit(1)).alias("n_rows"))


def usable(store: DataFrame) -> DataFrame:
    """Stored results that count as classified."""
    return store.filter(present(F.col("l1")))


def plan_run(transactions: DataFrame, store: DataFrame) -> DataFrame:
    """First rows with a flag that says whether the store already answers them."""
    known = usable(store).select("cache_key", F.lit(True).alias("cached"))
    return first_rows(transactions).join(known, "cache_key", "left").withColumn(
        "cached", F.coalesce("cached", F.lit(False))
    )


def uncached_rows(transactions: DataFrame, store: DataFrame) -> DataFrame:
    """First rows whose key the store does not answer."""
    return first_rows(transactions).join(usable(store).select("cache_key"), "cache_key", "left_anti")


def assign_batches(rows: DataFrame, batch_size: int = 10) -> DataFrame:
    """Number the rows by id and cut them into batches of ``batch_size``."""
    return global_position(rows, "transaction_id").withColumn(
        "batch_no", F.floor(F.col("position") / F.lit(batch_size)).cast("long")
    )


def run_counters(plan: DataFrame, batch_size: int = 10) -> DataFrame:
    """One row: total, unique, cached, needed and number of batches."""
    needed = F.count_if(~F.col("cached"))
    return plan.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_transactions"),
        F.count(F.lit(1)).alias("unique_transactions"),
        F.count_if("cached").alias("already_cached"),
        needed.alias("need_classification"),
        F.ceil(needed / F.lit(batch_size)).cast("long").alias("batches"),
    )


def store_hits(transactions: DataFrame, store: DataFrame) -> DataFrame:
    """Transactions that the store answers, with the stored result."""
    keyed = with_key(transactions)
    return hot_key_join(
        keyed.select("transaction_id", "cache_key"), usable(store), ["cache_key"],
        counts=rows_per_key(transactions), rows="n_rows", spread=["transaction_id"], how="inner",
    )


def newest_good(results: DataFrame) -> DataFrame:
    """What a run adds to the store: its good results, of several per key the one with the highest id.

    ``results`` carries ``cache_key``; rows with an error or without ``l1`` do
    not enter, and the transaction id is not part of the stored identity.
    """
    good = results.filter(~is_error(F.col("api_error")) & present(F.col("l1")))
    rows = good.select("cache_key", "transaction_id", *BODY)
    return one_row_per_key(rows, ["cache_key"], "transaction_id", last=True).select("cache_key", *BODY)


def upsert_store(store: DataFrame, results: DataFrame) -> DataFrame:
    """The store after a run: good new results replace stored ones by key."""
    latest = newest_good(results)
    kept = store.select("cache_key", *BODY).join(latest.select("cache_key"), "cache_key", "left_anti")
    return kept.unionByName(latest)


def _default(name: str) -> Column:
    """The value of a result field when no lane has an answer."""
    return F.lit({"human_review_required": True, "api_error": fv.NO_RESULT, "from_cache": False}.get(name))


def merge_results(transactions: DataFrame, new: DataFrame, store: DataFrame) -> DataFrame:
    """One result per transaction: new by id, else stored by key, else an error row.

    ``store`` is the store after the run, so copies of a newly classified row
    find its result there and count as cached.
    """
    body = [F.col(c) for c in BODY]
    fresh = new.select(
        "transaction_id", F.struct(*body, F.col("api_error"), F.lit(False).alias("from_cache")).alias("fresh")
    )
    stored = store.select(
        "cache_key",
        F.struct(*body, F.lit(None).cast("string").alias("api_error"), F.lit(True).alias("from_cache")).alias("stored"),
    )
    by_id = with_key(transactions).select("transaction_id", "cache_key").join(fresh, "transaction_id", "left")
    by_key = hot_key_join(
        by_id, stored, ["cache_key"], counts=rows_per_key(transactions), rows="n_rows", spread=["transaction_id"]
    )
    fields = [*BODY, "api_error", "from_cache"]
    return by_key.select(
        "transaction_id",
        *[
            F.when(F.col("fresh").isNotNull(), F.col(f"fresh.{c}"))
            .when(F.col("stored").isNotNull(), F.col(f"stored.{c}"))
            .otherwise(_default(c))
            .alias(c)
            for c in fields
        ],
    )


def success_counters(results: DataFrame) -> DataFrame:
    """One row: results with and without an ``l1``."""
    good = F.count_if(present(F.col("l1")))
    rows = F.count(F.lit(1))
    return results.agg(rows.alias("total_results"), good.alias("successful"), (rows - good).alias("failed"))
