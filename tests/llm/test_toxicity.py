import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxoweave.llm import queries, toxicity

SCHEMA = "doc_id long, text string, lang string, toxic string, grade string"


def sample(n, seed):
    """Texts of grade 0, 1 or 2: the higher, the more rude stems they hold."""
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(200)]
    out = []
    for i in range(n):
        grade = rng.choices([0, 1, 2], [8, 2, 1])[0]
        words = rng.choices(plain, k=rng.randint(5, 80))
        for _ in range({0: 0, 1: 1, 2: 4}[grade]):
            words.insert(rng.randrange(len(words)), rng.choice(["zzrude", "qqmean", "xxvile"]) + rng.choice(["", "er", "ung"]))
        out.append((i, " ".join(words).capitalize(), grade))
    return out


def test_held_out_accuracy_and_order():
    data = toxicity.TrainingSet()
    rows = sample(3000, 1)
    for _, text, grade in rows[:2000]:
        data.add(text, grade)
    model = toxicity.fit(data, 3)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 2
    rows = rows[2000:]
    above = model.above(np.array([model.score(t) for _, t, _ in rows]))
    grades = np.array([g for *_, g in rows])
    assert ((above[:, 0] >= 0.5) == (grades > 0)).mean() > 0.98
    assert (above[:, 0] >= above[:, 1]).all()
    expected = above.sum(axis=1)
    assert expected[grades == 0].mean() < expected[grades == 1].mean() < expected[grades == 2].mean()


def test_gradient_reaches_the_best_likelihood():
    data = toxicity.TrainingSet()
    for i in range(100):
        data.add("plain words", ([0] * 6 + [1] * 3 + [2])[i % 10])
    model = toxicity.fit(data, 3, ridge=0.0)
    assert model.above(np.array([model.score("plain words")]))[0] == pytest.approx([0.4, 0.1], abs=0.01)


def test_features_of_long_texts_are_those_of_their_words():
    text = "word " * 300_000 + "unbroken" * 400_000 + " End"
    assert {"word", "end", "unbroken" * 400_000} <= toxicity.features(text)
    assert toxicity.features("") == set() and toxicity.features("Ab12cd") == {"ab", "cd"}


def test_rows(spark):
    rows = [(i, t, "x", "clash", "clash") for i, t, _ in sample(800, 2)]
    grades = spark.createDataFrame([(i, g) for i, _, g in sample(800, 2)], "doc_id long, grade int")
    docs = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.train(docs, grades, 3)
    odd = spark.createDataFrame([(1, None, "", "", ""), (1, "", "", "", ""), (None, "zzrude qqmean", "", "", ""), (3, "x" * 2_000_000, "", "", "")], SCHEMA)
    got = toxicity.severity(odd, model).collect()
    assert sorted((str(r.doc_id), r.toxic, r.kept) for r in got) == [("1", False, True), ("1", False, True), ("3", False, True), ("None", True, False)]
    kept = toxicity.drop_toxic(odd, model)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "3"]
    assert toxicity.severity(odd.limit(0), model).collect() == []
    assert toxicity.train(docs, grades.limit(0)) is None
    assert not any(r.toxic for r in toxicity.severity(odd, None).collect())
    again = toxicity.train(docs.repartition(7), grades, 3)
    assert again.weights.keys() == model.weights.keys()


def test_labels_with_nulls_and_repeats(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, 1), (None, 1, 1), (3, 1, None), (4, 0, 0)], "doc_id long, quality int, toxic int")
    assert {tuple(r) for r in toxicity.graded(labels).collect()} == {(1, 1), (2, 1), (4, 0)}


def test_two_grades_are_split_by_dose():
    data = toxicity.TrainingSet()
    for i in range(120):
        data.add(f"plain words {i}", 0)
    for i in range(30):
        data.add("plain rude" if i % 3 else "plain rude mean vile", 1)
    assert toxicity.by_dose(data).grades == [0] * 120 + [1 if i % 3 else 2 for i in range(30)]
    empty = toxicity.TrainingSet()
    empty.add("plain", 0)
    assert toxicity.by_dose(empty).grades == [0]


def test_query_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op4_toxicity(spark, folder).collect()}
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r.doc_id in got}
    right = sum(got[i].toxic == bool(t) for i, t in labels.items())
    assert right / len(labels) > 0.9


def test_features_found_in_spark_equal_those_of_a_whole_training_set(spark):
    rng = random.Random(4)
    words = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(6)]
    rows = []
    for k in range(900):
        grade = int(rng.random() < 0.3)
        text = " ".join(rng.choices(words[:40] if grade else words[20:], k=12))
        rows.append((text, grade))
    data = toxicity.TrainingSet()
    for text, grade in rows:
        data.add(text, grade)
    want = toxicity.select_features(data)
    assert len(want) > 10
    found = toxicity.telling_features(spark.createDataFrame(rows, "text string, grade int").repartition(3))
    assert sorted(found) == sorted(want)


def test_repeated_ids_train_once(spark):
    docs = [(1, "foul words here"), (1, "foul words here"), (1, "a longer one"), (2, "kind words"), (None, "foul"), (3, None)]
    grades = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, grade int")
    model = toxicity.train(spark.createDataFrame(docs, "doc_id long, text string"), grades)
    assert model is not None and len(model.thresholds) == 2


def test_all_labelled_documents_are_fitted_on(spark):
    """Only the 2,000 labels whose hashed ids come last, behind 20,000 others, have toxic documents."""
    ids = [r.id for r in spark.range(22_000).orderBy(F.xxhash64("id"), "id").collect()]
    rude = {i: ("zzrude" if n % 2 else "zzrude qqmean xxvile") for n, i in enumerate(ids[20_000:])}
    docs = spark.createDataFrame([(i, f"plain words {rude.get(i, '')}") for i in ids], "doc_id long, text string").repartition(5)
    grades = spark.createDataFrame([(i, int(i in rude)) for i in ids], "doc_id long, grade int")
    got = toxicity.severity(docs, toxicity.train(docs, grades)).collect()
    assert {r.doc_id for r in got if r.toxic} == set(rude)
    assert all(r.grade == (2 if "xxvile" in rude[r.doc_id] else 1) for r in got if r.toxic)


def test_fit_in_parts_reaches_the_likelihood_of_one_task(spark):
    rows = [(t, int(g > 0)) for _, t, g in sample(3000, 5)]
    data = toxicity.TrainingSet()
    for text, grade in rows:
        data.add(text, grade)
    alone = toxicity.fit(toxicity.by_dose(data), 3)
    parts = toxicity.fit_in_parts(spark.createDataFrame(rows, "text string, grade int").repartition(6), 2)
    assert parts.weights.keys() == alone.weights.keys() and list(parts.thresholds) == sorted(parts.thresholds)
    names = sorted(alone.weights)
    number = {f: i for i, f in enumerate(names)}
    found = [[number[f] for f in toxicity.features(t) if f in number] for t, _ in rows]
    cols, owner = np.array([c for r in found for c in r]), np.repeat(np.arange(len(rows)), [len(r) for r in found])

    def value(model):
        params = np.array([*(model.weights[f] for f in names), model.thresholds[0], np.log(model.thresholds[1] - model.thresholds[0])])
        goal = toxicity.Likelihood(names, np.bincount(data.grades), lambda p: toxicity.sums(p, cols, owner, np.array(data.grades), 2))
        return goal.at(params)[0]

    assert value(parts) <= 1.01 * value(alone)
    above = [m.above(np.array([m.score(t) for t, _ in rows])) >= toxicity.CUT for m in (alone, parts)]
    assert (above[0] == above[1]).mean() > 0.99


def test_every_telling_feature_is_kept():
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c for a in letters for b in letters for c in letters][:5000]
    data = toxicity.TrainingSet()
    for k in range(40):  # every word in four toxic documents
        data.add(" ".join(words[i] for i in range(k % 10, 5000, 10)), 1)
    for _ in range(500):
        data.add("plain", 0)
    assert set(toxicity.select_features(data)) == {*words, "plain", "plai*"}
