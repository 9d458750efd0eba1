import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxoweave.operators import similarity as S


def data(n=60, labels=40, dim=6, seed=0):
    rng = random.Random(seed)
    vectors = [(i, [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    centroids = [(f"l{k:02d}", [rng.gauss(0, 1) for _ in range(dim)]) for k in range(labels)]
    return vectors, centroids


def cosine(a, b):
    size = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
    return sum(x * y for x, y in zip(a, b)) / size if size else 0.0


@pytest.mark.parametrize("block", [1_024, 7, 1])
def test_nearest_labels_in_rounds(spark, monkeypatch, block):
    monkeypatch.setattr(S, "LABELS_PER_BLOCK", block)
    vectors, centroids = data(labels=20)
    centroids += [("l05x", centroids[5][1]), ("zero", [0.0] * 6)]
    rows = [*vectors, (900, [0.0] * 6), (901, None)]
    found = {}
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    for r in S.nearest_labels(df, spark.createDataFrame(centroids, "label string, centroid array<double>"), 4).collect():
        found.setdefault(r.vec_id, {})[r.rank] = r.label
    assert 901 not in found
    for i, v in rows[:-1]:
        v = [float(np.float32(x)) for x in v]
        want = [x for _, x in sorted((-round(cosine(v, c), 12), name) for name, c in centroids)[:4]]
        assert [found[i][k] for k in (1, 2, 3, 4)] == want


def test_no_vector_is_shuffled(spark):
    vectors, centroids = data()
    df = S.nearest_labels(spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>"),
                          spark.createDataFrame(centroids, "label string, centroid array<double>"))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_hybrid_over_all_labels(spark):
    """Equal to scoring every label; a boosted label and one with a large overlap win from far down the cosine list."""
    vectors, centroids = data(30, 40)
    rng = random.Random(3)
    words = [f"w{k}" for k in range(30)]
    texts = {i: " ".join(rng.choices(words, k=12)) + (" urgent" if i % 3 == 0 else "") for i, _ in vectors}
    docs = spark.createDataFrame([(i, t, "s") for i, t in texts.items()], "doc_id bigint, text string, source string")
    far = {i: sorted((cosine(v, c), name) for name, c in centroids)[0][1] for i, v in vectors}
    rules = [("urgent", far[0], 20.0), ("w1", "l07", 0.3)]
    weights = S.tfidf(docs)
    labelled = spark.createDataFrame([(i, f"l{rng.randrange(40):02d}") for i in texts], "doc_id bigint, label string")
    profiles = S.label_profiles(weights, labelled)
    got = {}
    frames = (spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>"), spark.createDataFrame(centroids, "label string, centroid array<double>"))
    for r in S.hybrid_best(docs, *frames, weights, profiles, rules, ("x", "y"), top_k=3).collect():
        got.setdefault(r.doc_id, {})[r.rank] = (r.label, round(r.score, 6))
    every = frames[0].crossJoin(frames[1]).select(F.col("vec_id").alias("doc_id"), "label")
    cosines = spark.createDataFrame([(i, name, cosine(v, c)) for i, v in vectors for name, c in centroids], "doc_id bigint, label string, cosine double")
    want = {}
    assert every.count() == cosines.count()
    for r in S.hybrid_scores(docs, cosines, weights, profiles, rules, ("x", "y")).collect():
        want.setdefault(r.doc_id, []).append((-r.score, r.label))
    for i, rows in want.items():
        assert [got[i][k] for k in (1, 2, 3)] == [(name, round(-s, 6)) for s, name in sorted(rows)[:3]]
    assert got[0][1][0] == far[0]


# -- linear models -----------------------------------------------------------

SENTENCES = [(f"{part} > {leaf}", f"{part} goods {leaf} {leaf} things", part, f"{part} > {leaf}")
             for part, leaves in (("Office", "paper pens desks"), ("Travel", "rail air hotels taxis"), ("Plant", "pumps")) for leaf in leaves.split()]


def corpus(spark, rows=SENTENCES):
    return spark.createDataFrame(rows, "doc_id string, text string, part string, label string")


def test_vectors_weigh_as_tfidf(spark):
    docs = corpus(spark).select("doc_id", "text")
    vectors = S.TermVectors(docs)
    names = vectors.counter.vocabulary
    want = {(r.doc_id, r.term): r.weight for r in S.tfidf(docs).collect()}
    got = {(r.doc_id, names[i]): v for r in vectors.transform(docs).collect() for i, v in zip(r.features.indices, r.features.values)}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("kind", ["logistic", "svm"])
def test_fit_stands_at_the_minimum(kind):
    rng = np.random.default_rng(3)
    x, y, cost = rng.normal(size=(30, 6)), np.arange(30) % 4, S.fv.CLASSIFIER_COST[kind]

    def loss(w):
        scores, mine = x @ w, y[:, None] == np.arange(4)
        if kind == "svm":
            return 0.5 * (w * w).sum() + cost * (np.maximum(0, 1 - np.where(mine, 1, -1) * scores) ** 2).sum()
        return 0.5 * (w * w).sum() + cost * (np.log(np.exp(scores).sum(axis=1)) - scores[mine]).sum()

    found = S._fit_linear(x, y, 4, kind)
    best = loss(found)
    for _ in range(200):
        assert loss(found + rng.normal(size=found.shape) * 1e-3) > best


@pytest.mark.parametrize("kind", ["logistic", "svm"])
def test_classifier_in_two_levels(spark, monkeypatch, kind):
    monkeypatch.setattr(S, "ROWS_PER_GROUP", 2)
    model = S.TextClassifier(corpus(spark), kind)
    assert model.models.count() == 3
    texts = [(1, "paper for the office"), (2, "Rail travel"), (3, "pumps"), (4, "hotels hotels travel"), (4, "travel by AIR"), (5, None), (6, ""), (7, "zzz")]
    got = model.predict(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    told = sorted((r.doc_id, r.predicted_label) for r in got)
    assert told[:5] == [(1, "Office > paper"), (2, "Travel > rail"), (3, "Plant > pumps"), (4, "Travel > air"), (4, "Travel > hotels")]
    assert [i for i, _ in told[5:]] == [5, 6, 7] and {label for _, label in told[5:]} <= {r[3] for r in SENTENCES}
    own = model.predict(corpus(spark)).collect()
    assert len(own) == len(SENTENCES) and all(r.doc_id == r.predicted_label for r in own)
    assert model.predict(corpus(spark).limit(0)).collect() == []


def test_svm_parts_are_told_where_texts_are_weighed(spark):
    model = S.TextClassifier(corpus(spark), "svm")
    rows = [(1, "paper for the office"), (2, "Rail travel"), (2, "pumps"), (None, "hotels hotels"), (4, None), (5, ""), (6, "zzz")]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    one_by_one = model.names.transform(model.root.transform(model.vectors.transform(texts)))
    want = sorted(map(str, one_by_one.select("doc_id", "part").collect()))
    model.root = None  # its models are not asked one after the other
    assert sorted(map(str, model.predict_parts(texts).select("doc_id", "part").collect())) == want


def test_classifier_of_one_part_and_wrong_input(spark):
    one = S.TextClassifier(corpus(spark, SENTENCES[:3]), "svm")
    assert {r.predicted_label for r in one.predict(corpus(spark, SENTENCES[:3])).collect()} == {r[3] for r in SENTENCES[:3]}
    with pytest.raises(ValueError):
        S.TextClassifier(corpus(spark), "forest")
    with pytest.raises(ValueError):
        S.TextClassifier(corpus(spark, []))


def test_cross_validation_predicts_every_sentence_once(spark):
    rows = [(f"{i}", f"{part} goods number {i}", part, f"{part} {i}") for i in range(20) for part in ("Office", "Travel")]
    rows = [(f"{r[2]}{r[0]}", *r[1:]) for r in rows]
    got = S.cross_validated(corpus(spark, rows), "logistic", 3).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows) and len({r.fold for r in got}) == 3
    assert all(r.part == r.predicted_part for r in got)


def test_terms_in_few_buckets_and_shared_ids_equal_plain_counts(spark, monkeypatch):
    rows = [(i, f"w{i % 7} common w{i % 3} common rare{i} w{i % 7}") for i in range(40)]
    rows += [(3, "common again"), (3, "w1 common"), (None, "w2 w2"), (None, "common w2"), (90, None), (91, ""), (92, "a b"), (93, "\u00c9t\u00e9 \u00c9t\u00e9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = S.term_counts(docs)
    for most in (1, 30, 1_000):
        for buckets, first in ((1, 1), (16, 1), (1 << 20, 1)):
            monkeypatch.setattr(S, "BUCKETS", buckets)
            monkeypatch.setattr(S, "FIRST_BUCKETS", first)
            want = sorted(map(tuple, S.vocabulary(counts, most).collect()))
            assert sorted(map(tuple, S.frequent_terms(docs, most).collect())) == want
    vocab = {r.term: r.df for r in S.vocabulary(counts, 30).collect()}
    raw = {(r.doc_id, r.term): (math.log(r.tf) + 1) * (math.log((len(rows) + 1) / (vocab[r.term] + 1)) + 1) for r in counts.collect() if r.term in vocab}
    length = {i: math.sqrt(sum(x * x for (k, _), x in raw.items() if k == i)) for i, _ in raw}
    got = {(r.doc_id, r.term): r.weight for r in S.tfidf(docs, 30).collect()}
    assert got == pytest.approx({k: x / length[k[0]] for k, x in raw.items()})


def test_texts_of_their_own_are_not_shuffled_for_their_weights(spark):
    docs = spark.createDataFrame([(i, f"w{i} common") for i in range(9)], "doc_id long, text string")
    plan = S.tfidf(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
