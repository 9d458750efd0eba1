"""Declared schemas; nothing in the library infers one."""

from pyspark.sql import types as T


_TYPES = {"STRING": T.StringType(), "BIGINT": T.LongType(), "BOOLEAN": T.BooleanType()}


def _schema(spec: str) -> T.StructType:
    """``"a STRING, b BIGINT"`` as a struct, without a running session."""
    pairs = (column.strip().rsplit(" ", 1) for column in spec.split(","))
    return T.StructType([T.StructField(name.strip("`"), _TYPES[kind]) for name, kind in pairs])


TRANSACTIONS = _schema("transaction_id BIGINT, spend_description STRING, vendor STRING, source_type STRING")
RAW_SHEET = _schema("`#` STRING, `Spend Description` STRING, `Vendor / Supplier` STRING, `Source Type` STRING")
TAXONOMY = _schema(
    "ordinal BIGINT, L1 STRING, L2 STRING, L3 STRING, L4 STRING, full_path STRING, boundary_note STRING"
)
DROPDOWN = _schema("full_path STRING")
LEVELS = ["L1", "L2", "L3", "L4"]

# One classification, without the transaction it belongs to.
RESULT_BODY = _schema(
    "l1 STRING, l2 STRING, l3 STRING, l4 STRING, classification_reason STRING, confidence_level STRING, "
    "human_review_required BOOLEAN, retrieved_taxonomy STRING"
)
RESULTS = T.StructType(
    [T.StructField("transaction_id", T.LongType())]
    + RESULT_BODY.fields
    + _schema("api_error STRING, from_cache BOOLEAN").fields
)
# New results of a run: what is not yet known to come from the store.
RUN_RESULTS = T.StructType([f for f in RESULTS.fields if f.name != "from_cache"])
STORE = T.StructType([T.StructField("cache_key", T.StringType())] + RESULT_BODY.fields)
GOLD = _schema(
    "transaction_id BIGINT, final_ground_truth_L1 STRING, final_ground_truth_L2 STRING, "
    "final_ground_truth_L3 STRING, final_ground_truth_L4 STRING, final_full_path STRING"
)
EXAMPLES = _schema(
    "example_no BIGINT, spend_description STRING, vendor STRING, l1 STRING, l2 STRING, l3 STRING, l4 STRING, "
    "classification_reason STRING, confidence_level STRING, human_review_required BOOLEAN"
)

# Response items are read as text so that quoted numbers and booleans survive.
RESPONSE_ITEM = _schema(
    "transaction_id STRING, l1 STRING, l2 STRING, l3 STRING, l4 STRING, classification_reason STRING, "
    "confidence_level STRING, human_review_required STRING"
)
RESPONSE_OBJECT = T.StructType([T.StructField("classifications", T.ArrayType(RESPONSE_ITEM))])
RESPONSE_LIST = T.ArrayType(RESPONSE_ITEM)
