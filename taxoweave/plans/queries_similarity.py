"""Queries over TF-IDF, vectors, the hybrid score and linear models."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxoweave.operators import similarity
from taxoweave.plans.fixtures import duck_sql, table, view
from taxoweave.plans.registry import query
from taxoweave.session import settle

_TFIDF = r"""
words AS MATERIALIZED (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS w FROM documents),
occ AS (
  SELECT doc_id, unnest(w) AS term FROM words
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words WHERE len(w) > 1),
cnt AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM occ GROUP BY ALL),
vocab AS MATERIALIZED (
  SELECT term, sum(tf) AS total, count(*) AS df FROM cnt GROUP BY term ORDER BY total DESC, term LIMIT 5000),
raw AS (
  SELECT doc_id, cnt.term, (1 + ln(tf)) * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1) AS r
  FROM cnt JOIN vocab ON vocab.term = cnt.term),
tfidf AS MATERIALIZED (SELECT doc_id, term, r / sqrt(sum(r * r) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""

_NEAREST = """
flat AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
mean AS (SELECT label, i, avg(x) AS x FROM flat GROUP BY ALL),
cent AS MATERIALIZED (SELECT label, list(x ORDER BY i) AS c FROM mean GROUP BY label),
cos AS (
  SELECT vec_id, cent.label, list_cosine_similarity(embedding::DOUBLE[], c) AS cosine FROM embeddings, cent),
near AS MATERIALIZED (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, label) AS rank FROM cos) n
  WHERE rank <= 5)"""

BOOSTS = [("with", 3, 0.4), ("und", 5, 0.4), ("les", 7, 0.3)]
BUNDLED = ("src3", "worthless")


@query(f"WITH {_TFIDF} SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf")
def tfidf_terms(spark, d):
    weights = similarity.tfidf(table(spark, d, "documents"))
    return weights.withColumn("weight", F.round("weight", 6))


@query(f"WITH {_NEAREST} SELECT vec_id, rank, label, round(cosine, 6) AS cosine FROM near")
def nearest_labels(spark, d):
    vectors = table(spark, d, "embeddings")
    found = similarity.nearest_labels(vectors, similarity.label_centroids(vectors))
    return found.withColumn("cosine", F.round("cosine", 6)).withColumn("rank", F.col("rank").cast("long"))


@query(f"""
WITH {_TFIDF},{_NEAREST},
sums AS (SELECT e.label, t.term, sum(t.weight) AS s FROM tfidf t JOIN embeddings e ON e.vec_id = t.doc_id GROUP BY ALL),
sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
prof AS MATERIALIZED (
  SELECT label, term, (s / n) / sqrt(sum((s / n) * (s / n)) OVER (PARTITION BY label)) AS weight
  FROM sums JOIN sizes USING (label)),
lap AS (
  SELECT t.doc_id, n.label, sum(t.weight * p.weight) AS tfidf FROM near n JOIN tfidf t ON t.doc_id = n.vec_id
  JOIN prof p ON p.label = n.label AND p.term = t.term GROUP BY ALL),
parts AS (
  SELECT d.doc_id, n.label, n.cosine, coalesce(lap.tfidf, 0) AS tfidf,
    {" + ".join(f"CASE WHEN contains(lower(d.text), '{t}') AND n.label = {l} THEN {b} ELSE 0 END" for t, l, b in BOOSTS)}
      AS boost,
    d.source = '{BUNDLED[0]}' AND contains(lower(d.text), '{BUNDLED[1]}') AS bundled
  FROM near n JOIN documents d ON d.doc_id = n.vec_id LEFT JOIN lap ON lap.doc_id = d.doc_id AND lap.label = n.label)
SELECT doc_id, label, round(cosine, 6) AS cosine, round(tfidf, 6) AS tfidf, round(boost::DOUBLE, 6) AS boost, bundled,
       round(0.5 * cosine + 0.3 * tfidf + 0.2 * boost, 6) AS score FROM parts""")
def hybrid_scores(spark, d):
    docs, vectors = table(spark, d, "documents"), table(spark, d, "embeddings")
    weights = settle(similarity.tfidf(docs), "weights")
    labelled = vectors.select(F.col("vec_id").alias("doc_id"), "label")
    nearest = similarity.nearest_labels(vectors, similarity.label_centroids(vectors)).select(
        F.col("vec_id").alias("doc_id"), "label", "cosine"
    )
    scores = similarity.hybrid_scores(
        docs, settle(nearest, "nearest"), weights, similarity.label_profiles(weights, labelled), BOOSTS, BUNDLED
    )
    return scores.withColumns({c: F.round(c, 6) for c in ("cosine", "tfidf", "boost", "score")})


# Every label of every document is scored here; the library stops at a bound.
@query(f"""
WITH {_TFIDF},{_NEAREST},
sums AS (SELECT e.label, t.term, sum(t.weight) AS s FROM tfidf t JOIN embeddings e ON e.vec_id = t.doc_id GROUP BY ALL),
sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
prof AS MATERIALIZED (
  SELECT label, term, (s / n) / sqrt(sum((s / n) * (s / n)) OVER (PARTITION BY label)) AS weight
  FROM sums JOIN sizes USING (label)),
lap AS (
  SELECT t.doc_id, p.label, sum(t.weight * p.weight) AS tfidf FROM tfidf t JOIN prof p ON p.term = t.term GROUP BY ALL),
parts AS (
  SELECT d.doc_id, n.label, n.cosine, coalesce(lap.tfidf, 0) AS tfidf,
    {" + ".join(f"CASE WHEN contains(lower(d.text), '{t}') AND n.label = {l} THEN {b} ELSE 0 END" for t, l, b in BOOSTS)}
      AS boost
  FROM cos n JOIN documents d ON d.doc_id = n.vec_id LEFT JOIN lap ON lap.doc_id = d.doc_id AND lap.label = n.label),
scored AS (SELECT *, 0.5 * cosine + 0.3 * tfidf + 0.2 * boost AS score FROM parts)
SELECT doc_id, rank, label, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rank FROM scored) r WHERE rank <= 3""")
def hybrid_best(spark, d):
    docs, vectors = table(spark, d, "documents"), table(spark, d, "embeddings")
    weights = settle(similarity.tfidf(docs), "weights")
    labelled = vectors.select(F.col("vec_id").alias("doc_id"), "label")
    profiles = settle(similarity.label_profiles(weights, labelled), "profiles")
    centroids = settle(similarity.label_centroids(vectors), "centroids")
    best = similarity.hybrid_best(docs, vectors, centroids, weights, profiles, BOOSTS, BUNDLED, top_k=3)
    return best.select("doc_id", F.col("rank").cast("long").alias("rank"), "label", F.round("score", 6).alias("score"))


def _trained(spark, d, kind):
    """A classifier trained on the names of the taxonomy, and its sentences."""
    corpus = settle(similarity.label_corpus(view(spark, d, "fx_taxonomy")), "corpus")
    return similarity.TextClassifier(corpus, kind), corpus


def _predict(spark, d, kind):
    """The leaf of every transaction."""
    rows = view(spark, d, "fx_transactions").select(
        F.col("transaction_id").alias("doc_id"), F.concat_ws(" ", "spend_description", "vendor").alias("text")
    )
    return _trained(spark, d, kind)[0].predict(rows)


# Iterative training has no SQL form: these are checked by row count and by tests, and below on the leaves' own sentences.
@query()
def logistic_predictions(spark, d):
    return _predict(spark, d, "logistic")


@query()
def svm_predictions(spark, d):
    return _predict(spark, d, "svm")


@query()
def cross_validated(spark, d):
    corpus = similarity.label_corpus(view(spark, d, "fx_taxonomy"))
    return similarity.cross_validated(corpus, "logistic")


_OWN = duck_sql("SELECT full_path AS doc_id, full_path AS predicted_label FROM fx_taxonomy")


@query(_OWN)
def logistic_own_sentences(spark, d):
    model, corpus = _trained(spark, d, "logistic")
    return model.predict(corpus)


@query(_OWN)
def svm_own_sentences(spark, d):
    model, corpus = _trained(spark, d, "svm")
    return model.predict(corpus)
