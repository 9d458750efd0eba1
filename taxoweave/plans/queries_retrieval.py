"""Queries over retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxoweave.operators.matching import substring_hits
from taxoweave.operators.retrieval import Lexicon, TaxonomyIndex, expand_tokens, transaction_queries
from taxoweave.plans.fixtures import LEXICON, duck_sql, table, view
from taxoweave.plans.oracles import DEFAULT_SYNONYMS, retrieval, retrieval_of
from taxoweave.plans.registry import query


def index(spark, d):
    return TaxonomyIndex(view(spark, d, "fx_taxonomy"), LEXICON)


def texts(spark, d):
    return transaction_queries(view(spark, d, "fx_transactions"))


def named(df):
    return df.withColumnRenamed("query_id", "transaction_id")


_CANDIDATES = """
SELECT q.transaction_id, c.branch, c.rank, c.ordinal, c.score, c.full_path, c.boundary_note
FROM q JOIN cand c ON c.text = q.text"""


# Checked against a comparison of every text with every leaf.
@query(duck_sql(_CANDIDATES, retrieval(brute=True)))
def retrieve_candidates(spark, d):
    return named(index(spark, d).candidates(texts(spark, d))).withColumn("rank", F.col("rank").cast("long"))


@query(duck_sql(_CANDIDATES, retrieval(5)))
def retrieve_top_five(spark, d):
    return named(index(spark, d).candidates(texts(spark, d), 5)).withColumn("rank", F.col("rank").cast("long"))


@query(duck_sql("""
SELECT q.transaction_id, c.branch, c.max_score, count(*) AS n_candidates
FROM q JOIN cand c ON c.text = q.text GROUP BY ALL""", retrieval()))
def retrieval_branches(spark, d):
    contexts = named(index(spark, d).contexts(texts(spark, d)))
    return contexts.select(
        "transaction_id", "branch", "max_score", F.size("paths").cast("long").alias("n_candidates")
    )


@query(duck_sql("""
SELECT q.transaction_id, c.branch, c.full_path, c.score FROM q JOIN cand c ON c.text = q.text WHERE c.rank = 1""",
                retrieval()))
def top_candidate(spark, d):
    return named(index(spark, d).top_candidate(texts(spark, d)))


@query(duck_sql("""
SELECT q.transaction_id, c.rank, c.ordinal, c.full_path, p.signal, p.term, CAST(p.points AS INTEGER) AS points
FROM q JOIN cand c ON c.text = q.text JOIN pts p ON p.text = c.text AND p.ordinal = c.ordinal""", retrieval()))
def explain_candidates(spark, d):
    return named(index(spark, d).explain(texts(spark, d))).withColumn("rank", F.col("rank").cast("long"))


@query(duck_sql("""
SELECT q.transaction_id, c.paths, c.raw_paths FROM q JOIN (
  SELECT text, string_agg(line, chr(10) ORDER BY rank) AS paths,
         string_agg(full_path, chr(10) ORDER BY rank) AS raw_paths FROM cand GROUP BY text) c ON c.text = q.text""",
                retrieval()))
def candidate_contexts(spark, d):
    return named(index(spark, d).contexts(texts(spark, d))).select(
        "transaction_id", F.array_join("paths", "\n").alias("paths"), F.array_join("raw_paths", "\n").alias("raw_paths")
    )


@query(duck_sql("""
SELECT q.transaction_id, t.tokens FROM q JOIN (
  SELECT text, string_agg(token, ' ' ORDER BY token) AS tokens FROM qt GROUP BY text) t ON t.text = q.text""",
                retrieval()))
def expanded_tokens(spark, d):
    return named(expand_tokens(texts(spark, d), LEXICON)).select(
        "transaction_id", F.array_join("tokens", " ").alias("tokens")
    )


@query(duck_sql("""
SELECT q.transaction_id, n.level, n.name FROM q
JOIN (SELECT DISTINCT 'L4' AS level, lower(L4) AS name FROM fx_taxonomy
      UNION SELECT DISTINCT 'L3', lower(L3) FROM fx_taxonomy) n ON contains(lower(q.text), n.name)""",
                "q AS (SELECT transaction_id, concat(spend_description, ' ', vendor) AS text FROM fx_transactions)"))
def name_hits(spark, d):
    built = index(spark, d)
    names = built.taxonomy.select(F.inline(F.array(*[
        F.struct(F.lit(level).alias("level"), F.lower(level).alias("name")) for level in ("L4", "L3")
    ]))).distinct()
    lowered = texts(spark, d).withColumn("text", F.lower("text"))
    needles = names.withColumn("needle", F.col("name"))
    return named(substring_hits(lowered, "text", needles, bounded=built.bounded)).drop("needle")


# Whole documents against the taxonomy, with the default lexicon.
@query(duck_sql("""
SELECT q.transaction_id AS doc_id, c.branch, c.rank, c.ordinal, c.score, c.full_path FROM q JOIN cand c ON c.text = q.text""",
                f"{DEFAULT_SYNONYMS}, " + retrieval_of(
                    "SELECT doc_id AS transaction_id, coalesce(text, '') AS text FROM documents", synonyms="default_synonyms")))
def retrieve_documents(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("query_id"), "text")
    found = TaxonomyIndex(view(spark, d, "fx_taxonomy")).candidates(docs)
    return found.select(F.col("query_id").alias("doc_id"), "branch", F.col("rank").cast("long").alias("rank"), "ordinal", "score", "full_path")


# A taxonomy large enough to be ranked by bounds.
@query(duck_sql("""
SELECT q.transaction_id, c.branch, c.rank, c.ordinal, c.score, c.full_path FROM q JOIN cand c ON c.text = q.text""",
                retrieval_of("SELECT transaction_id, text FROM fx_part_orders", "fx_parts")))
def retrieve_parts(spark, d):
    texts_of_orders = view(spark, d, "fx_part_orders").withColumnRenamed("transaction_id", "query_id")
    found = named(TaxonomyIndex(view(spark, d, "fx_parts"), LEXICON).candidates(texts_of_orders))
    return found.select("transaction_id", "branch", F.col("rank").cast("long").alias("rank"), "ordinal", "score", "full_path")


# The default lexicon over whole documents.
@query(duck_sql("""
SELECT q.transaction_id AS doc_id, t.tokens FROM q JOIN (
  SELECT text, string_agg(token, ' ' ORDER BY token) AS tokens FROM qt GROUP BY text) t ON t.text = q.text""",
                f"{DEFAULT_SYNONYMS}, " + retrieval_of(
                    "SELECT doc_id AS transaction_id, coalesce(text, '') AS text FROM documents", synonyms="default_synonyms")))
def expanded_documents(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("query_id"), F.coalesce("text", F.lit("")).alias("text"))
    return expand_tokens(docs, Lexicon()).select(F.col("query_id").alias("doc_id"), F.array_join("tokens", " ").alias("tokens"))
