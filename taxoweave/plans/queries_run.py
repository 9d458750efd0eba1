"""Queries over the incremental run, prompts, responses and streams."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from taxoweave.operators import incremental, inference, prompting, responses
from taxoweave.operators.inference import first_path_classifier
from taxoweave.operators.retrieval import transaction_queries
from taxoweave.plans import classify as runs
from taxoweave.plans.fixtures import LEXICON, duck_sql, table, view
from taxoweave.plans.oracles import DEFAULT_RUN, RUN, retrieval
from taxoweave.plans.queries_retrieval import index
from taxoweave.plans.registry import query
from taxoweave.session import scratch_path, settle
from taxoweave.sources.store import ResultStore
from taxoweave.streaming.incremental import classify_stream, unique_stream

SETTINGS = runs.Settings(lexicon=LEXICON)
RESULT_COLUMNS = (
    "transaction_id, l1, l2, l3, l4, classification_reason, confidence_level, human_review_required, "
    "retrieved_taxonomy, api_error, from_cache"
)


def transactions(spark, d):
    return view(spark, d, "fx_transactions")


def needed_rows(spark, d):
    return incremental.uncached_rows(transactions(spark, d), view(spark, d, "fx_store"))


def seeded_store(spark, d):
    store = ResultStore(spark, scratch_path(spark, "store"))
    store.write(view(spark, d, "fx_store"))
    return store


def batches(spark, d, size=10):
    settings = runs.Settings(batch_size=size, lexicon=LEXICON)
    return runs.batches_with_context(settle(needed_rows(spark, d), "needed"), index(spark, d), settings)


# -- dedupe, lookup, batches -------------------------------------------------


@query(duck_sql("SELECT cache_key, transaction_id, spend_description, vendor, source_type, n_rows FROM uniq", RUN))
def first_rows(spark, d):
    return incremental.first_rows(transactions(spark, d))


@query(duck_sql("SELECT cache_key, transaction_id, spend_description, vendor, source_type, n_rows FROM needed", RUN))
def uncached_rows(spark, d):
    return needed_rows(spark, d)


@query(duck_sql("""
SELECT k.transaction_id, k.cache_key, s.l1, s.l4, s.retrieved_taxonomy FROM keyed k
JOIN store s ON s.cache_key = k.cache_key AND coalesce(s.l1, '') <> ''""", RUN))
def store_hits(spark, d):
    hits = incremental.store_hits(transactions(spark, d), view(spark, d, "fx_store"))
    return hits.select("transaction_id", "cache_key", "l1", "l4", "retrieved_taxonomy")


@query(duck_sql("SELECT transaction_id, position, CAST(floor(position / 10) AS BIGINT) AS batch_no FROM needed", RUN))
def batch_numbers(spark, d):
    rows = incremental.assign_batches(settle(needed_rows(spark, d), "needed"))
    return rows.select("transaction_id", "position", "batch_no")


@query(duck_sql("""
SELECT (SELECT count(*) FROM keyed) AS total_transactions, (SELECT count(*) FROM uniq) AS unique_transactions,
       (SELECT count(*) FROM uniq) - (SELECT count(*) FROM needed) AS already_cached,
       (SELECT count(*) FROM needed) AS need_classification,
       CAST(ceil((SELECT count(*) FROM needed) / 10.0) AS BIGINT) AS batches""", RUN))
def run_counters(spark, d):
    return incremental.run_counters(incremental.plan_run(transactions(spark, d), view(spark, d, "fx_store")))


# Every copy of a (description, vendor) pair reuses the answer to its first row.
@query(duck_sql("""
SELECT transaction_id, min(transaction_id) OVER (PARTITION BY spend_description, vendor) AS answered_by
FROM fx_transactions"""))
def pair_reuse(spark, d):
    rows = transactions(spark, d)
    pair = ["spend_description", "vendor"]
    first = rows.groupBy(*pair).agg(
        F.min("transaction_id").alias("answered_by"), F.count(F.lit(1)).alias("n_rows")
    ).withColumn("pair", F.struct(*pair))
    return incremental.hot_key_join(
        rows.select("transaction_id", F.struct(*pair).alias("pair")), first.select("pair", "answered_by"), ["pair"],
        counts=first, rows="n_rows", spread=["transaction_id"], how="inner",
    ).select("transaction_id", "answered_by")


# -- whole runs --------------------------------------------------------------


@query(duck_sql(f"SELECT {RESULT_COLUMNS} FROM merged", DEFAULT_RUN))
def classified_transactions(spark, d):
    return runs.classify(transactions(spark, d), index(spark, d), seeded_store(spark, d), SETTINGS)


# A second run over the store of the first one has nothing left to classify.
@query(duck_sql("SELECT transaction_id, l1, l4, true AS from_cache FROM merged", DEFAULT_RUN))
def second_run(spark, d):
    store, built, rows = seeded_store(spark, d), index(spark, d), transactions(spark, d)
    runs.classify(rows, built, store, SETTINGS)
    return runs.classify(rows, built, store, SETTINGS).select("transaction_id", "l1", "l4", "from_cache")


@query(duck_sql("""
SELECT count(*) AS total_results, count(*) FILTER (coalesce(l1, '') <> '') AS successful,
       count(*) FILTER (coalesce(l1, '') = '') AS failed FROM fx_predictions"""))
def success_counters(spark, d):
    return incremental.success_counters(view(spark, d, "fx_predictions"))


# Predictions serve as new results for open orders only: other rows fall to the store, or to the default.
@query(duck_sql("""
SELECT k.transaction_id, CASE WHEN n.transaction_id IS NOT NULL THEN n.l1 ELSE s.l1 END AS l1,
  CASE WHEN n.transaction_id IS NOT NULL THEN n.l4 ELSE s.l4 END AS l4,
  CASE WHEN n.transaction_id IS NOT NULL THEN n.api_error WHEN s.cache_key IS NOT NULL THEN NULL
       ELSE 'No classification result returned.' END AS api_error,
  CASE WHEN n.transaction_id IS NOT NULL THEN n.human_review_required WHEN s.cache_key IS NOT NULL THEN NULL
       ELSE true END AS human_review_required,
  n.transaction_id IS NULL AND s.cache_key IS NOT NULL AS from_cache
FROM keyed k LEFT JOIN store s ON s.cache_key = k.cache_key
LEFT JOIN (SELECT p.* FROM fx_predictions p JOIN fx_transactions t ON t.transaction_id = p.transaction_id
           WHERE t.source_type = 'O') n ON n.transaction_id = k.transaction_id""", RUN))
def merged_results(spark, d):
    rows = transactions(spark, d)
    opened = rows.filter("source_type = 'O'").select("transaction_id")
    new = view(spark, d, "fx_predictions").join(opened, "transaction_id", "left_semi").withColumn(
        "retrieved_taxonomy", F.lit(None).cast("string")
    )
    merged = incremental.merge_results(rows, new, view(spark, d, "fx_store"))
    return merged.select("transaction_id", "l1", "l4", "api_error", "human_review_required", "from_cache")


@query(duck_sql("""
SELECT cache_key, l1, l4 FROM store WHERE cache_key NOT IN (SELECT cache_key FROM good)
UNION ALL SELECT cache_key, l1, l4 FROM good""", RUN + """,
good AS (
  SELECT * FROM (SELECT k.cache_key, p.l1, p.l4,
    row_number() OVER (PARTITION BY k.cache_key ORDER BY p.transaction_id DESC) AS nth
    FROM fx_predictions p JOIN keyed k ON k.transaction_id = p.transaction_id
    WHERE trim(coalesce(p.api_error, '')) IN ('', 'nan', 'None') AND coalesce(p.l1, '') <> '') g WHERE nth = 1)"""))
def store_upsert(spark, d):
    keys = incremental.with_key(transactions(spark, d)).select("transaction_id", "cache_key")
    results = view(spark, d, "fx_predictions").join(keys, "transaction_id").withColumn(
        "retrieved_taxonomy", F.lit(None).cast("string")
    )
    return seeded_store(spark, d).upsert(results).select("cache_key", "l1", "l4")


# -- the pandas hook ---------------------------------------------------------

_NEW = "transaction_id, l1, l2, l3, l4, classification_reason, confidence_level, human_review_required, retrieved_taxonomy"


def classified_now(spark, d, settings, **hooks):
    """The rows of a whole run that did not come from the store."""
    results = runs.classify(transactions(spark, d), index(spark, d), seeded_store(spark, d), settings, **hooks)
    return results.filter("NOT from_cache")


@query(duck_sql(f"SELECT {_NEW} FROM fresh", DEFAULT_RUN))
def batch_hook(spark, d):
    return classified_now(spark, d, SETTINGS, frame=first_path_classifier).select(_NEW.split(", "))


@query(duck_sql(f"SELECT {_NEW} FROM fresh", DEFAULT_RUN))
def single_row_lane(spark, d):
    return classified_now(spark, d, replace(SETTINGS, lane="single")).select(_NEW.split(", "))


def _careless():
    """A model that forgets a level, or writes a confidence in lower case, for two kinds of purchases."""
    answer = first_path_classifier()

    def classify(batch):
        found = answer(batch)
        texts = batch["spend_description"].tolist()
        found["confidence_level"] = ["low" if "URGENT" in text else level for text, level in zip(texts, found["confidence_level"].tolist())]
        found["l3"] = [None if "HIGH" in text else level for text, level in zip(texts, found["l3"].tolist())]
        return found

    return classify


# Results that break the response schema become error rows; only the others enter the store.
@query(duck_sql("""
SELECT n.transaction_id, f.l1, CASE WHEN contains(n.spend_description, 'HIGH') THEN NULL ELSE f.l3 END AS l3, f.l4,
       f.human_review_required OR contains(n.spend_description, 'HIGH') OR contains(n.spend_description, 'URGENT') AS human_review_required,
       CASE WHEN contains(n.spend_description, 'HIGH') THEN 'ValueError: The result breaks the response schema: l3'
            WHEN contains(n.spend_description, 'URGENT') THEN 'ValueError: The result breaks the response schema: confidence_level'
       END AS api_error
FROM needed n JOIN fresh f ON f.transaction_id = n.transaction_id""", DEFAULT_RUN))
def quarantined_results(spark, d):
    results = classified_now(spark, d, replace(SETTINGS, enforce_schema=True), frame=_careless)
    return results.filter("coalesce(api_error, '') <> 'No classification result returned.'").select(
        "transaction_id", "l1", "l3", "l4", "human_review_required", "api_error")


def _refuses_urgent():
    """A model that fails on batches with an urgent, promotional purchase."""
    answer = first_path_classifier()

    def classify(batch):
        if any("URGENT" in text and "promo" in text for text in batch["spend_description"]):
            raise RuntimeError("refused")
        return answer(batch)

    return classify


@query(duck_sql("""
SELECT n.transaction_id, CASE WHEN b.bad THEN NULL ELSE f.l1 END AS l1, CASE WHEN b.bad THEN NULL ELSE f.l4 END AS l4,
       CASE WHEN b.bad THEN true ELSE f.human_review_required END AS human_review_required,
       CASE WHEN b.bad THEN NULL ELSE f.retrieved_taxonomy END AS retrieved_taxonomy,
       CASE WHEN b.bad THEN 'RuntimeError: refused' END AS api_error
FROM needed n JOIN fresh f ON f.transaction_id = n.transaction_id
JOIN (SELECT floor(position / 10) AS batch_no,
             bool_or(contains(spend_description, 'URGENT') AND contains(spend_description, 'promo')) AS bad
      FROM needed GROUP BY 1) b ON b.batch_no = floor(n.position / 10)""", DEFAULT_RUN))
def failed_batches(spark, d):
    answers = inference.classify_batches(batches(spark, d), _refuses_urgent)
    return answers.select("transaction_id", "l1", "l4", "human_review_required", "retrieved_taxonomy", "api_error")


# -- prompts -----------------------------------------------------------------

_EXAMPLE = """concat('Transaction:', chr(10), '  Description: ', spend_description, chr(10), '  Vendor: ', vendor, chr(10),
  'Classification:', chr(10), '  Path: ', l1, ' > ', l2, ' > ', l3, ' > ', l4, chr(10),
  '  Reason: ', classification_reason, chr(10), '  Confidence: ', confidence_level, chr(10),
  '  Human Review Required: ', CAST(human_review_required AS VARCHAR))"""
_SHOTS = f"shots AS (SELECT string_agg({_EXAMPLE}, chr(10) || chr(10) ORDER BY example_no) AS block FROM fx_examples)"
_STYLE = prompting.PromptStyle()


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(duck_sql("SELECT block AS few_shot_block FROM shots", _SHOTS))
def few_shot_block(spark, d):
    return prompting.few_shot_block(view(spark, d, "fx_examples"))


_HEAD = f"chr(10) || chr(10) || '{prompting.RULE}' || chr(10) || '%s' || chr(10) || '{prompting.RULE}' || chr(10)"


@query(duck_sql(f"""
SELECT t.transaction_id, concat({_lit(_STYLE.single_task)}, chr(10), chr(10), 'Examples of correct classifications:', chr(10), chr(10), (SELECT block FROM shots),
  {_HEAD % 'CANDIDATE TAXONOMY PATHS FOR THIS TRANSACTION'}, c.lines,
  {_HEAD % 'TRANSACTION TO CLASSIFY'}, 'Spend Description: ', t.spend_description, chr(10),
  'Vendor / Supplier: ', t.vendor, chr(10), 'Source Type: ', t.source_type,
  {_HEAD % 'INSTRUCTIONS'}, {_lit(_STYLE.closing)}, chr(10)) AS prompt
FROM fx_transactions t JOIN q ON q.transaction_id = t.transaction_id
JOIN (SELECT text, string_agg('- ' || line, chr(10) ORDER BY rank) AS lines FROM cand GROUP BY text) c
  ON c.text = q.text""", f"{retrieval()},{_SHOTS}"))
def single_prompts(spark, d):
    rows = transactions(spark, d)
    contexts = index(spark, d).contexts(transaction_queries(rows)).withColumnRenamed("query_id", "transaction_id")
    return prompting.single_prompts(rows.join(contexts, "transaction_id"), view(spark, d, "fx_examples"))


_BATCH_PROMPTS = f"{RUN},{retrieval(rows='needed')},{_SHOTS}," + f"""
bp AS (
  SELECT CAST(floor(n.position / 10) AS BIGINT) AS batch_no, count(*) AS n_rows,
    concat({_lit(_STYLE.task)}, chr(10), chr(10), 'FEW-SHOT EXAMPLES:', chr(10), (SELECT block FROM shots),
      chr(10), chr(10), 'TRANSACTIONS TO CLASSIFY:', chr(10),
      string_agg(concat('TRANSACTION ID: ', n.transaction_id, chr(10), 'Spend Description: ', n.spend_description,
        chr(10), 'Vendor: ', n.vendor, chr(10), 'Source Type: ', n.source_type, chr(10), chr(10),
        'CANDIDATE TAXONOMY PATHS:', chr(10), c.lines, chr(10)),
        '{prompting.RULE}' || chr(10) ORDER BY n.transaction_id), chr(10)) AS prompt
  FROM needed n JOIN q ON q.transaction_id = n.transaction_id
  JOIN (SELECT text, string_agg('- ' || line, chr(10) ORDER BY rank) AS lines FROM cand GROUP BY text) c
    ON c.text = q.text
  GROUP BY 1)"""


@query(duck_sql("SELECT batch_no, n_rows, prompt FROM bp", _BATCH_PROMPTS))
def batch_prompts(spark, d):
    return prompting.batch_prompts(batches(spark, d), view(spark, d, "fx_examples"))


@query(duck_sql("SELECT batch_no, CAST(length(prompt) AS INTEGER) AS n_chars, left(prompt, 750) AS opening FROM bp", _BATCH_PROMPTS))
def prompt_preview(spark, d):
    return prompting.prompt_preview(prompting.batch_prompts(batches(spark, d), view(spark, d, "fx_examples")))


# -- responses ---------------------------------------------------------------

# Responses made from predictions, twenty neighbouring ids per batch: most as an object, some as
# a bare list, some broken or failed, quoted ids and an extra key on medium confidence.


def answered(spark, d):
    """``(batch_no, response, error)`` from the predictions."""
    rows = view(spark, d, "fx_predictions")
    number = F.floor(F.col("transaction_id") / 20).cast("long")
    base = ["l1", "l2", "l3", "l4", "classification_reason", "confidence_level", "human_review_required"]
    item = F.when(
        F.col("confidence_level") == "MEDIUM",
        F.to_json(F.struct(F.col("transaction_id").cast("string").alias("transaction_id"), *base,
                           F.coalesce("api_error", F.lit("-")).alias("comment"))),
    ).otherwise(F.to_json(F.struct("transaction_id", *base)))
    # Ids are unique, so a group holds at most twenty rows.
    gathered = rows.select(number.alias("batch_no"), "transaction_id", item.alias("item")).groupBy("batch_no").agg(
        F.sort_array(F.collect_list(F.struct("transaction_id", "item"))).alias("items")
    )
    body = F.concat(F.lit("["), F.array_join(F.transform("items", lambda i: i["item"]), ","), F.lit("]"))
    kind = F.substring(F.col("batch_no").cast("string"), -1, 1)
    response = (
        F.when(kind == "3", body)
        .when(kind == "7", F.concat(F.lit("Sorry: "), body))
        .otherwise(F.concat(F.lit('{"classifications":'), body, F.lit("}")))
    )
    return gathered.select(
        "batch_no",
        response.alias("response"),
        F.when(kind == "5", F.lit("TimeoutError: no answer")).alias("error"),
    )


_ANSWERED = """
av AS (SELECT *, CAST(floor(transaction_id / 20) AS BIGINT) AS batch_no FROM fx_predictions),
ak AS (SELECT *, right(CAST(batch_no AS VARCHAR), 1) AS kind,
       row_number() OVER (PARTITION BY batch_no ORDER BY transaction_id) - 1 AS item_no FROM av)"""


@query(duck_sql("""
SELECT batch_no, CAST(item_no AS INTEGER) AS item_no, transaction_id, l1, l2, l3, l4, classification_reason,
       confidence_level, human_review_required, CAST(NULL AS VARCHAR) AS error
FROM ak WHERE kind NOT IN ('5', '7')
UNION ALL
SELECT DISTINCT batch_no, CAST(NULL AS INTEGER), CAST(NULL AS BIGINT), NULL, NULL, NULL, NULL, NULL, NULL, CAST(NULL AS BOOLEAN),
       CASE kind WHEN '5' THEN 'TimeoutError: no answer'
         ELSE 'ValueError: Batch LLM response did not contain a valid list of classifications.' END
FROM ak WHERE kind IN ('5', '7')""", _ANSWERED))
def parsed_responses(spark, d):
    parsed = responses.parse_responses(settle(answered(spark, d), "answered"))
    items = responses.explode_items(parsed).withColumn("error", F.lit(None).cast("string"))
    errors = parsed.filter("error IS NOT NULL").select("batch_no", "error")
    return items.unionByName(errors, allowMissingColumns=True)


# Two rounds of answers to the same ids, in any order: the later round counts.
@query(duck_sql("""
SELECT transaction_id, batch_no + 1000000 AS batch_no, CAST(item_no AS INTEGER) AS item_no, upper(l4) AS l4
FROM ak WHERE kind NOT IN ('5', '7')""", _ANSWERED))
def last_answer(spark, d):
    items = responses.explode_items(responses.parse_responses(settle(answered(spark, d), "answered")))
    again = items.withColumn("batch_no", F.col("batch_no") + 1_000_000).withColumn("l4", F.upper("l4"))
    return responses.last_per_id(again.unionByName(items)).select("transaction_id", "batch_no", "item_no", "l4")


@query(duck_sql("""
SELECT *, has_required AND confidence_allowed AND no_extra_keys AS conforms FROM (
  SELECT batch_no, CAST(item_no AS INTEGER) AS item_no,
    l1 IS NOT NULL AND confidence_level IS NOT NULL AND human_review_required IS NOT NULL AS has_required,
    coalesce(confidence_level, '') IN ('HIGH', 'MEDIUM', 'LOW') AS confidence_allowed,
    coalesce(confidence_level, '') <> 'MEDIUM' AS no_extra_keys FROM ak WHERE kind <> '7') c""", _ANSWERED))
def schema_conformance(spark, d):
    return responses.conformance(settle(answered(spark, d), "answered"))


# -- streams -----------------------------------------------------------------


def _as_stream(spark, d):
    """The transactions as a stream of several files."""
    path = scratch_path(spark, "arrivals")
    rows = transactions(spark, d)
    rows.repartition(4, "transaction_id").write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)


# Two arrivals, even and odd ids, one micro-batch each: what the first one learnt, the second finds in the store.
@query(duck_sql("""
SELECT m.transaction_id, m.l1, m.l2, m.l3, m.l4, m.retrieved_taxonomy, CAST(NULL AS VARCHAR) AS api_error,
       a.first_id IS NULL AS from_cache
FROM merged m LEFT JOIN (
  SELECT k.cache_key, coalesce(min(k.transaction_id) FILTER (k.transaction_id % 2 = 0), min(k.transaction_id)) AS first_id
  FROM keyed k WHERE k.cache_key IN (SELECT cache_key FROM needed) GROUP BY k.cache_key) a ON a.first_id = m.transaction_id""", DEFAULT_RUN))
def stream_classify(spark, d):
    arrivals, output, state = (scratch_path(spark, name) for name in ("arrivals", "stream-results", "stream-state"))
    rows, built, store = transactions(spark, d), index(spark, d), seeded_store(spark, d)
    for part in (0, 1):
        rows.filter(F.col("transaction_id") % 2 == part).write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(rows.schema).parquet(arrivals)
        classify_stream(stream, built, store, output, state, SETTINGS).awaitTermination()
    return spark.read.parquet(output).select("transaction_id", "l1", "l2", "l3", "l4", "retrieved_taxonomy", "api_error", "from_cache")


@query(duck_sql("SELECT cache_key, spend_description, vendor FROM uniq", RUN))
def stream_unique(spark, d):
    output = scratch_path(spark, "stream-unique")
    unique_stream(_as_stream(spark, d), output, scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(output).select("cache_key", "spend_description", "vendor")


# The same with keys that expire: all events of a user, type and day arrive together, so each is kept once.
@query("SELECT DISTINCT user_id, event_type, date_trunc('day', ts)::DATE AS day FROM events")
def stream_unique_events(spark, d):
    path, output = scratch_path(spark, "arrivals"), scratch_path(spark, "stream-unique")
    events = table(spark, d, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts")).withColumn("day", F.to_date("ts"))
    events.write.parquet(path)
    stream = spark.readStream.schema(events.schema).parquet(path)
    unique_stream(stream, output, scratch_path(spark, "stream-state"), keys=["user_id", "event_type", "day"], event_time="ts", delay="2 days").awaitTermination()
    return spark.read.parquet(output).select("user_id", "event_type", "day")
