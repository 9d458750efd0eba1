"""Model responses: JSON text to rows, with an error lane."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoweave import fixed_values as fv
from taxoweave.functions.text import path_of, present
from taxoweave.operators.incremental import BODY
from taxoweave.operators.joins import one_row_per_key
from taxoweave.schemas import RESPONSE_ITEM, RESPONSE_LIST, RESPONSE_OBJECT
from taxoweave.session import settle

FIELDS = RESPONSE_ITEM.fieldNames()


def is_one_value(response: Column) -> Column:
    """Whether a text is one JSON value and nothing else.

    The parser stops at the end of a value; inside a list and inside an object
    it has to meet the closing bracket behind it.
    """
    within = F.from_json(F.concat(F.lit('{"value":'), response, F.lit("}")), "value string, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    return F.coalesce((F.json_array_length(F.concat(F.lit("["), response, F.lit("]"))) == 1) & within["_bad"].isNull(), F.lit(False))


def response_items(response: Column) -> Column:
    """The list of classifications: under its key, or as a bare list; else null, also if other text follows."""
    bare = F.startswith(F.ltrim(response), F.lit("["))
    items = F.when(bare, F.from_json(response, RESPONSE_LIST)).otherwise(F.from_json(response, RESPONSE_OBJECT)["classifications"])
    return F.when(is_one_value(response), items)


#: What makes a batch fail beside the documented cases.
CUT_OFF = "JSONDecodeError: The response is cut off or followed by other text."
UNUSABLE_ID = "ValueError: A transaction_id of the response is no whole number."


def parse_responses(responses: DataFrame) -> DataFrame:
    """``(batch_no, error, items)``: a batch either has items or an error.

    A response that is no list of classifications, or that holds an item
    without a usable id, spoils its whole batch; the error says which.
    """
    parsed = responses.select("batch_no", "response", "error", response_items(F.col("response")).alias("items"))
    no_id = F.coalesce(F.exists("items", lambda i: i["transaction_id"].isNull()), F.lit(False))
    bad_id = F.coalesce(F.exists("items", lambda i: i["transaction_id"].try_cast("bigint").isNull()), F.lit(False))
    opened = F.coalesce(F.ltrim("response").rlike(r"^[\[{]"), F.lit(False))
    problem = (
        F.when(F.col("items").isNull() & opened & ~is_one_value(F.col("response")), CUT_OFF)
        .when(F.col("items").isNull(), fv.BAD_RESPONSE)
        .when(no_id, fv.MISSING_ID)
        .when(bad_id, UNUSABLE_ID)
    )
    told = parsed.select("batch_no", F.coalesce("error", problem).alias("error"), "items")
    return told.select("batch_no", "error", F.when(F.col("error").isNull(), F.col("items")).alias("items"))


def explode_items(parsed: DataFrame) -> DataFrame:
    """One typed row per classification, in response order."""
    rows = parsed.filter(F.col("items").isNotNull()).select("batch_no", F.posexplode("items").alias("item_no", "item"))
    plain = [c for c in FIELDS if c not in ("transaction_id", "human_review_required")]
    return rows.select(
        "batch_no",
        "item_no",
        F.col("item.transaction_id").try_cast("bigint").alias("transaction_id"),
        *[F.col(f"item.{c}").alias(c) for c in plain],
        F.col("item.human_review_required").try_cast("boolean").alias("human_review_required"),
    )


def last_per_id(items: DataFrame) -> DataFrame:
    """Of several answers to one id, the last one: of the highest batch, and there of the highest place.

    Batch and place make one number; a batch holds fewer than 2**20 items. The
    items are written down, for they are read twice and parsing them is most of the work.
    """
    order = F.col("batch_no") * F.lit(1 << 20) + F.col("item_no") + 1  # rows of failed batches have the place -1
    newest = one_row_per_key(settle(items.withColumn("_order", order), "items"), ["transaction_id"], "_order", last=True).drop("_order")
    return newest.select("transaction_id", *[c for c in items.columns if c != "transaction_id"])


def batch_results(batches: DataFrame, responses: DataFrame) -> DataFrame:
    """New results by transaction id from batches and the responses to them.

    ``batches`` has one row per transaction with ``batch_no`` and ``raw_paths``.
    An answered id keeps its answer; every row of a failed batch becomes an
    error row; ids without an answer are left to the merge.
    """
    parsed = parse_responses(responses)
    places = batches.select("batch_no", "transaction_id", F.get("raw_paths", F.lit(0)).alias("top_path"))
    answered = (
        explode_items(parsed)
        .join(places, ["batch_no", "transaction_id"], "left")
        .withColumn(
            "retrieved_taxonomy",
            F.coalesce(path_of(*[F.col(c) for c in ("l1", "l2", "l3", "l4")]), F.col("top_path")),
        )
        .withColumn("api_error", F.lit(None).cast("string"))
    )
    failed = places.join(parsed.filter(F.col("error").isNotNull()).select("batch_no", "error"), "batch_no").select(
        "batch_no",
        F.lit(-1).alias("item_no"),
        "transaction_id",
        *[F.lit(None).cast("string").alias(c) for c in BODY if c != "human_review_required"],
        F.lit(True).alias("human_review_required"),
        F.col("error").alias("api_error"),
    )
    columns = ["batch_no", "item_no", "transaction_id", *BODY, "api_error"]
    everything = answered.select(columns).unionByName(failed.select(columns))
    return last_per_id(everything).select("transaction_id", *BODY, "api_error")


def conformance(responses: DataFrame) -> DataFrame:
    """Check every item of well-formed responses against the declared response schema.

    ``(batch_no, item_no, has_required, confidence_allowed, no_extra_keys, conforms)``
    """
    items = F.from_json(
        F.coalesce(F.get_json_object("response", "$.classifications"), F.col("response")), "array<string>"
    )
    rows = responses.filter(is_one_value(F.col("response"))).select("batch_no", F.posexplode(items).alias("item_no", "item"))
    # Items that came back as text are parsed one by one.
    parsed = rows.select("batch_no", "item_no", F.from_json("item", RESPONSE_ITEM).alias("f"), F.json_object_keys("item").alias("keys"))
    required = F.lit(True)
    for name in FIELDS:
        required = required & F.col(f"f.{name}").isNotNull()
    checked = parsed.select(
        "batch_no",
        "item_no",
        required.alias("has_required"),
        F.coalesce(F.col("f.confidence_level").isin(fv.CONFIDENCE_LEVELS), F.lit(False)).alias("confidence_allowed"),
        (F.size(F.array_except("keys", F.array(*[F.lit(c) for c in FIELDS]))) == 0).alias("no_extra_keys"),
    )
    return checked.withColumn(
        "conforms", F.col("has_required") & F.col("confidence_allowed") & F.col("no_extra_keys")
    )


def parse_single(responses: DataFrame) -> DataFrame:
    """One object per response (the single-transaction lane) as result columns."""
    item = F.when(is_one_value(F.col("response")), F.from_json("response", RESPONSE_ITEM))
    rows = responses.select("transaction_id", "top_path", "error", item.alias("f"))
    flag = F.col("f.human_review_required").try_cast("boolean")
    failed = F.col("error").isNotNull() | ~present(F.coalesce(*[F.col(f"f.{c}") for c in FIELDS[1:]]))
    texts = [c for c in BODY if c not in ("human_review_required", "retrieved_taxonomy")]
    path = path_of(*[F.col(f"f.{c}") for c in ("l1", "l2", "l3", "l4")])
    return rows.select(
        "transaction_id",
        *[F.when(~failed, F.col(f"f.{c}")).alias(c) for c in texts],
        F.when(failed, F.lit(True)).otherwise(flag).alias("human_review_required"),
        F.when(~failed, F.coalesce(path, F.col("top_path"))).alias("retrieved_taxonomy"),
        F.when(failed, F.coalesce("error", F.lit(fv.BAD_RESPONSE))).alias("api_error"),
        F.lit(False).alias("from_cache"),
    )


def quarantine(results: DataFrame) -> DataFrame:
    """New results with an error on those that break the response schema.

    A result must have all four levels, a reason, an allowed confidence and a
    review flag. Others keep what was answered, ask for review and carry
    ``api_error``, which keeps them out of the store.
    """
    missing = [F.when(~present(F.col(c)), F.lit(c)) for c in ("l1", "l2", "l3", "l4", "classification_reason")]
    wrong = [
        *missing,
        F.when(~F.coalesce(F.col("confidence_level").isin(fv.CONFIDENCE_LEVELS), F.lit(False)), F.lit("confidence_level")),
        F.when(F.col("human_review_required").isNull(), F.lit("human_review_required")),
    ]
    broken = F.array_compact(F.array(*wrong))
    held = F.col("api_error").isNull() & (F.size(broken) > 0)
    note = F.concat(F.lit("ValueError: The result breaks the response schema: "), F.array_join(broken, ", "))
    return results.withColumns({
        "human_review_required": F.when(held, F.lit(True)).otherwise(F.col("human_review_required")),
        "api_error": F.when(held, note).otherwise(F.col("api_error")),
    })
