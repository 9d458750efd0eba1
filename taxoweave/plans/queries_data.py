"""Queries over sources, sinks, cleaning, text functions and simple joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from taxoweave import schemas
from taxoweave.functions import text as tx
from taxoweave.operators import cleaning, incremental
from taxoweave.operators.joins import forward_fill
from taxoweave.plans.fixtures import TABLES, duck_sql, table, view
from taxoweave.plans.oracles import tok
from taxoweave.operators.joins import file_ordinals
from taxoweave.plans.registry import query
from taxoweave.session import scratch_path
from taxoweave.sources import readers, sinks

SHEET_NAMES = {
    "transaction_id": "#", "spend_description": "Spend Description",
    "vendor": "Vendor / Supplier", "source_type": "Source Type",
}
TAXONOMY_ROWS = duck_sql("SELECT * FROM fx_taxonomy")
CLEAN_ROWS = duck_sql("SELECT * FROM fx_transactions")


def merged_cells(taxonomy):
    """The taxonomy as a sheet shows it: a repeated upper level is blank."""
    above = Window.orderBy("ordinal")
    return taxonomy.withColumns({
        c: F.when(F.lag(c).over(above).eqNullSafe(F.col(c)), F.lit(None).cast("string")).otherwise(F.col(c))
        for c in ("L1", "L2", "L3")
    })


# -- sources and sinks -------------------------------------------------------


@query(CLEAN_ROWS)
def load_transactions(spark, d):
    raw = view(spark, d, "fx_transactions_raw").withColumnsRenamed(SHEET_NAMES)
    path = sinks.write_csv(raw.withColumn("note", F.lit("ignored")), scratch_path(spark, "sheet"))
    return readers.clean_transactions(readers.rename_sheet(
        readers.read_table(spark, path, schemas.RAW_SHEET.add("note", "string"), "csv")
    ))


@query(TAXONOMY_ROWS)
def load_taxonomy(spark, d):
    sheet = merged_cells(view(spark, d, "fx_taxonomy"))
    blank = sheet.limit(1).select([F.lit(None).cast(f.dataType).alias(f.name) for f in sheet.schema])
    path = sinks.write_csv(sheet.unionByName(blank), scratch_path(spark, "taxonomy-sheet"))
    return readers.read_taxonomy(spark, path, "csv")


# A sheet of several files without numbers: the places of the rows number them.
@query(TAXONOMY_ROWS)
def load_taxonomy_sheet(spark, d):
    sheet, path = merged_cells(view(spark, d, "fx_taxonomy")), scratch_path(spark, "taxonomy-sheet")
    sheet.repartitionByRange(5, "ordinal").sortWithinPartitions("ordinal").drop("ordinal").write.options(**readers.CSV).csv(path)
    return readers.read_taxonomy(spark, path, "csv", numbered=False)


# Rows in the order of a sink, read back by the places where they lie.
@query(duck_sql("SELECT row_number() OVER (ORDER BY vendor, transaction_id) AS place, transaction_id, vendor FROM fx_transactions"))
def ordered_sink(spark, d):
    rows = view(spark, d, "fx_transactions").select("transaction_id", "vendor")
    path = sinks.write_parquet(rows, scratch_path(spark, "ordered"), order_by=["vendor", "transaction_id"])
    return file_ordinals(spark.read.schema(rows.schema).parquet(path), "place")


@query(duck_sql("SELECT full_path FROM fx_taxonomy"))
def load_dropdown_list(spark, d):
    paths = view(spark, d, "fx_taxonomy").select("full_path")
    return readers.read_dropdown(spark, sinks.write_csv(paths, scratch_path(spark, "dropdown"), header=False))


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS n_rows, "
    f"(SELECT count(*) FROM (DESCRIBE {t})) AS n_cols FROM {t}" for t in TABLES
))
def profile_tables(spark, d):
    return readers.profile_tables({t: table(spark, d, t) for t in TABLES})


@query(duck_sql("SELECT * FROM fx_predictions"))
def raw_results_csv(spark, d):
    results = view(spark, d, "fx_predictions")
    path = sinks.write_csv(results, scratch_path(spark, "raw-results"))
    return readers.read_predictions(spark, f"{path}-absent", results.schema, fallback=path, fmt="csv")


@query(CLEAN_ROWS)
def clean_transactions_csv(spark, d):
    clean = cleaning.clean_transactions(view(spark, d, "fx_transactions_raw"))
    path = sinks.write_csv(clean, scratch_path(spark, "clean-transactions"))
    return readers.read_table(spark, path, schemas.TRANSACTIONS, "csv")


@query(duck_sql("SELECT cache_key, l1, l2, l3, l4, retrieved_taxonomy FROM fx_store"))
def store_json(spark, d):
    path = sinks.write_store_json(view(spark, d, "fx_store"), scratch_path(spark, "store-json"))
    body = schemas.STORE.fields[1:]
    shape = schemas.T.StructType([schemas.STORE.fields[0], schemas.T.StructField("result", schemas.T.StructType(body))])
    names = ["l1", "l2", "l3", "l4", "retrieved_taxonomy"]
    return readers.read_table(spark, path, shape, "json").select("cache_key", *[f"result.{n}" for n in names])


# -- cleaning ----------------------------------------------------------------


@query(CLEAN_ROWS)
def clean_transactions(spark, d):
    return cleaning.clean_transactions(view(spark, d, "fx_transactions_raw"))


@query(duck_sql("""
SELECT TRY_CAST(CASE WHEN source_type = 'P' THEN concat('#', transaction_id) ELSE CAST(transaction_id AS VARCHAR) END
                AS BIGINT) AS transaction_id, spend_description, vendor, source_type FROM fx_transactions"""))
def lenient_ids(spark, d):
    raw = view(spark, d, "fx_transactions_raw")
    as_text = F.col("transaction_id").cast("string")
    marked = F.when(F.col("source_type") == "P", F.concat(F.lit("#"), as_text)).otherwise(as_text)
    return cleaning.clean_transactions(raw.withColumn("transaction_id", marked), strict_ids=False)


@query(duck_sql("""
SELECT * FROM (
  SELECT count(*) AS n_transactions,
         count(*) FILTER (spend_description = 'MISSING_DESCRIPTION') AS missing_descriptions,
         count(*) - count(DISTINCT (spend_description, vendor)) AS duplicate_transaction_rows FROM fx_transactions) a,
 (SELECT count(*) AS n_taxonomy_leaf_nodes, count(DISTINCT L1) AS n_unique_l1_segments,
         count(*) FILTER (boundary_note <> '') AS n_boundary_notes FROM fx_taxonomy) b"""))
def data_quality_report(spark, d):
    return cleaning.data_quality_report(view(spark, d, "fx_transactions"), view(spark, d, "fx_taxonomy"))


@query(duck_sql("SELECT L1, count(*) AS n_rows FROM fx_taxonomy GROUP BY L1"))
def rows_per_segment(spark, d):
    return cleaning.rows_per_segment(view(spark, d, "fx_taxonomy"))


@query(duck_sql("""
SELECT L1, L2, L3, L4, count(*) AS n_leaves,
       CAST(4 - grouping(L1) - grouping(L2) - grouping(L3) - grouping(L4) AS INTEGER) AS depth
FROM fx_taxonomy GROUP BY GROUPING SETS ((L1), (L1, L2), (L1, L2, L3), (L1, L2, L3, L4))"""))
def taxonomy_nodes(spark, d):
    return cleaning.taxonomy_nodes(view(spark, d, "fx_taxonomy"))


# Descriptions are null on some orders: the last one above fills them.
@query(duck_sql("""
SELECT transaction_id, last_value(spend_description IGNORE NULLS) OVER (ORDER BY transaction_id) AS spend_description,
       last_value(vendor IGNORE NULLS) OVER (ORDER BY transaction_id) AS vendor FROM fx_transactions_raw"""))
def forward_filled(spark, d):
    raw = view(spark, d, "fx_transactions_raw").select("transaction_id", "spend_description", "vendor")
    return forward_fill(raw, ["spend_description", "vendor"], "transaction_id", block=1_000)


@query(duck_sql("""
SELECT *, row_number() OVER (PARTITION BY spend_description, vendor ORDER BY transaction_id) > 1 AS is_duplicate
FROM fx_transactions"""))
def flag_duplicates(spark, d):
    return cleaning.flag_duplicates(view(spark, d, "fx_transactions"))


# The list is taken from the predictions, so it has invented paths and lacks others.
@query(duck_sql("""
SELECT *, 'taxonomy' AS side FROM (SELECT full_path FROM fx_taxonomy EXCEPT SELECT trim(full_path) FROM listed) a
UNION ALL
SELECT *, 'dropdown' AS side FROM (SELECT trim(full_path) AS full_path FROM listed WHERE full_path IS NOT NULL
                                   EXCEPT SELECT full_path FROM fx_taxonomy) b""", """
listed AS (SELECT CASE WHEN l1 IS NULL THEN NULL ELSE concat(' ', l1, ' > ', l2, ' > ', l3, ' > ', l4) END AS full_path
           FROM fx_predictions WHERE l1 <> 'PROMO' OR l1 IS NULL)"""))
def path_differences(spark, d):
    listed = view(spark, d, "fx_predictions").filter("l1 <> 'PROMO' OR l1 IS NULL").select(
        F.when(F.col("l1").isNotNull(), F.concat(F.lit(" "), F.concat_ws(" > ", "l1", "l2", "l3", "l4"))).alias("full_path")
    )
    return cleaning.path_differences(view(spark, d, "fx_taxonomy"), listed)


@query(duck_sql("""
SELECT ordinal, L1, L2, L3, L4, full_path, boundary_note FROM (
  SELECT *, row_number() OVER (PARTITION BY L1 ORDER BY ordinal) AS n FROM fx_taxonomy) t WHERE n <= 2"""))
def cross_section(spark, d):
    return cleaning.cross_section(view(spark, d, "fx_taxonomy"))


@query(duck_sql("SELECT * FROM fx_predictions WHERE confidence_level = 'HIGH'"))
def level_filter(spark, d):
    return view(spark, d, "fx_predictions").filter(F.col("confidence_level") == "HIGH")


@query(duck_sql("SELECT * FROM fx_transactions ORDER BY transaction_id LIMIT 10"))
def preview(spark, d):
    return view(spark, d, "fx_transactions").orderBy("transaction_id").limit(10)


# -- text functions ----------------------------------------------------------


@query(f"""
SELECT doc_id, len(ts) AS n_tokens, array_to_string(ts, ' ') AS tokens, len(list_distinct(ts)) AS n_distinct FROM (
  SELECT doc_id, {tok('text').removeprefix('list_distinct(')[:-1]} AS ts FROM documents) t""")
def tokenize_documents(spark, d):
    found = table(spark, d, "documents").select("doc_id", tx.tokens(F.col("text")).alias("ts"), tx.token_set(F.col("text")).alias("tset"))
    return found.select(
        "doc_id", F.size("ts").cast("long").alias("n_tokens"), F.array_join("ts", " ").alias("tokens"),
        F.size("tset").cast("long").alias("n_distinct"),
    )


@query(r"""
SELECT conv_id, turn, upper(role) AS role, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM conversations""")
def squeezed_turns(spark, d):
    return table(spark, d, "conversations").select(
        "conv_id", "turn", F.upper("role").alias("role"), tx.squeeze(F.col("text")).alias("text")
    )


@query(duck_sql("""
SELECT transaction_id, concat('v2__||__', trim(spend_description), '__||__', trim(vendor)) AS cache_key
FROM fx_transactions"""))
def cache_keys(spark, d):
    return incremental.with_key(view(spark, d, "fx_transactions")).select("transaction_id", "cache_key")


@query(duck_sql("""
SELECT transaction_id, CASE WHEN coalesce(l1, '') <> '' AND coalesce(l4, '') <> ''
  THEN concat(l1, ' > ', coalesce(l2, 'None'), ' > ', coalesce(l3, 'None'), ' > ', l4) END AS path
FROM fx_predictions"""))
def chosen_paths(spark, d):
    levels = [F.col(c) for c in ("l1", "l2", "l3", "l4")]
    return view(spark, d, "fx_predictions").select("transaction_id", tx.path_of(*levels).alias("path"))


@query(duck_sql("""
SELECT ordinal, CASE WHEN trim(boundary_note) <> '' THEN concat(full_path, '  [Boundary note: ', trim(boundary_note), ']')
                     ELSE full_path END AS line FROM fx_taxonomy"""))
def candidate_lines(spark, d):
    return view(spark, d, "fx_taxonomy").select(
        "ordinal", tx.with_note(F.col("full_path"), F.col("boundary_note")).alias("line")
    )


# How many tokens of every document are benchmark tokens, without a pair of texts.
@query(f"""
SELECT d.doc_id, coalesce(n, 0) AS n_shared FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest({tok('text')}) AS token FROM documents) a
  WHERE token IN (SELECT unnest({tok('text')}) FROM benchmark) GROUP BY doc_id) s ON s.doc_id = d.doc_id""")
def token_overlap(spark, d):
    docs = table(spark, d, "documents")
    words = docs.select("doc_id", F.explode(tx.token_set(F.col("text"))).alias("token"))
    known = table(spark, d, "benchmark").select(F.explode(tx.token_set(F.col("text"))).alias("token")).distinct()
    shared = words.join(known, "token", "left_semi").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_shared"))
    return docs.select("doc_id").join(shared, "doc_id", "left").withColumn("n_shared", F.coalesce("n_shared", F.lit(0)))
