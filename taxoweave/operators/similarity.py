"""Earlier ways to match texts with labels: TF-IDF, linear models, vectors, and a hybrid."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.feature import CountVectorizerModel, IndexToString, SQLTransformer, StringIndexer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from taxoweave import fixed_values as fv
from taxoweave.session import settle, ship_package

# Runs of two or more letters, digits or underscores, in any script.
WORD = r"[\p{L}\p{N}_]{2,}"
LABELS_PER_BLOCK = 1_024
# Hashes of terms whose occurrences are added up, and how many for each wanted term are counted exactly at once.
BUCKETS = 1 << 20
FIRST_BUCKETS = 8
# Ids that several rows share, up to which they are broadcast.
BROADCAST_IDS = 100_000
# Texts whose weights leave a task as one batch.
TEXTS_PER_BATCH = 512
# Texts that meet a part's model in one group.
ROWS_PER_GROUP = 100_000


# -- TF-IDF ------------------------------------------------------------------


def terms(text: Column) -> Column:
    """Words and pairs of neighbouring words, repeats kept."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    bigrams = F.zip_with(
        F.slice(words, F.lit(1), pairs), F.slice(words, F.lit(2), pairs), lambda a, b: F.concat_ws(" ", a, b)
    )
    return F.concat(words, bigrams)


def term_counts(docs: DataFrame) -> DataFrame:
    """``(doc_id, term, tf)``; the texts stay where they are, counts of terms travel."""
    exploded = docs.select("doc_id", F.explode(terms(F.col("text"))).alias("term"))
    return exploded.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(counts: DataFrame, max_features: int = fv.TFIDF_MAX_FEATURES) -> DataFrame:
    """The most frequent terms ``(term, total, df)``; ties go to the earlier term."""
    totals = counts.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
    return totals.orderBy(F.desc("total"), "term").limit(max_features)


def _counted(listed: Column) -> Column:
    """``(term, tf)`` of each different term of an array: lengths of the runs in its sorted form."""
    def runs(ordered: Column) -> Column:
        some = F.when(F.size(ordered) > 0, F.sequence(F.lit(0), F.size(ordered) - 1))
        places = F.filter(some, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        return _let(places, lambda starts: F.transform(starts, lambda at, k: F.struct(
            F.get(ordered, at).alias("term"), (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - at).cast("long").alias("tf"))))

    return _let(F.sort_array(listed), runs)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_by_id(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``(doc_id, text)`` of rows whose id is their own, and of rows that share one or have none; None if there are no such rows."""
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col("doc_id").isNull())
    shared = settle(ids.select(F.col("doc_id").alias("_shared")), "shared")
    texts, n = docs.select("doc_id", "text"), shared.count()
    if n == 0:
        return texts, None
    keys = F.broadcast(shared) if n <= BROADCAST_IDS else shared
    same = F.col("doc_id").eqNullSafe(F.col("_shared"))
    return texts.join(keys, same, "left_anti"), texts.join(keys, same, "left_semi")


def frequent_terms(docs: DataFrame, max_features: int = fv.TFIDF_MAX_FEATURES) -> DataFrame:
    """:func:`vocabulary` of the counts of ``docs``, written down, without a shuffle of all terms.

    Occurrences are added up over hashes of terms first, which gives each term a
    limit. Terms with the largest limits are counted exactly; the last one of
    the best tells which other limits are still to be looked at. A text with an
    id of its own is counted inside its row.
    """
    alone, met = split_by_id(docs)
    bucket = F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int").alias("bucket")
    occurrences = docs.select(F.explode(terms(F.col("text"))).alias("term")).select(bucket)
    limits = settle(occurrences.groupBy("bucket").agg(F.count(F.lit(1)).alias("most")), "limits")

    def exact(buckets: DataFrame) -> DataFrame:
        few = F.broadcast(buckets.select("bucket"))  # one number each, BUCKETS at most

        def asked(rows: DataFrame) -> DataFrame:
            return rows.withColumn("bucket", bucket).join(few, "bucket", "left_semi").drop("bucket")

        counts = asked(alone.select("doc_id", F.inline(_counted(terms(F.col("text"))))))
        if met is not None:
            repeated = asked(met.select("doc_id", F.explode(terms(F.col("text"))).alias("term")))
            counts = counts.unionByName(repeated.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf")))
        return settle(vocabulary(counts, max_features), "vocabulary")

    first = settle(limits.orderBy(F.desc("most"), "bucket").limit(FIRST_BUCKETS * max_features), "buckets")
    found = exact(first)
    last = found.agg(F.count(F.lit(1)).alias("n"), F.min("total").alias("total")).first()
    least = last["total"] if last["n"] == max_features else 0
    if limits.join(F.broadcast(first), "bucket", "left_anti").filter(F.col("most") >= least).isEmpty():
        return found
    return exact(limits.filter(F.col("most") >= least))


def tfidf(docs: DataFrame, max_features: int = fv.TFIDF_MAX_FEATURES) -> DataFrame:
    """``(doc_id, term, weight)`` with sublinear tf, smooth idf and unit length per document.

    Texts with an id of their own are weighed where they are, whole batches at
    once; rows that share an id are one document, whose counts meet by key.
    """
    vocab = frequent_terms(docs, max_features)
    alone, met = split_by_id(docs)
    kind = docs.schema["doc_id"].dataType
    learnt = TermVectors(docs, max_features, vocab) if not vocab.isEmpty() else None
    if learnt is None:
        return docs.select("doc_id", F.lit("").alias("term"), F.lit(0.0).alias("weight")).filter("false")
    weights = learnt.weights(alone, kind)
    if met is None:
        return weights
    total = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    idf = F.log((total + 1) / (F.col("df") + 1)) + 1
    # Limited to max_features rows, so it may be broadcast.
    raw = term_counts(met).join(F.broadcast(vocab), "term").select("doc_id", "term", ((F.log("tf") + 1) * idf).alias("raw"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("doc_id")))
    return weights.unionByName(raw.withColumn("weight", F.col("raw") / length).drop("raw"))


# -- vectors -----------------------------------------------------------------


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, p: total + p)


def label_centroids(vectors: DataFrame) -> DataFrame:
    """``(label, centroid)``: the mean vector of every label."""
    parts = vectors.select("label", F.posexplode(F.col("embedding").cast("array<double>")).alias("dim", "value"))
    means = parts.groupBy("label", "dim").agg(F.avg("value").alias("mean"))
    gathered = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("dim", "mean"))).alias("dims"))
    return gathered.select("label", F.transform("dims", lambda d: d["mean"]).alias("centroid"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _cosines(vectors: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Cosines of all pairs; with a zero vector 0."""
    sizes = np.linalg.norm(vectors, axis=1)[:, None] * np.linalg.norm(labels, axis=1)[None, :]
    return np.divide(vectors @ labels.T, sizes, out=np.zeros(sizes.shape), where=sizes > 0)


def nearest_labels(vectors: DataFrame, labels: DataFrame, top_k: int = 5) -> DataFrame:
    """``(vec_id, rank, label, cosine)``: the closest labels of every vector, ties to the smaller label.

    The labels go round in blocks of bounded size. In a round every task
    multiplies its vectors with the block at once and keeps the ``top_k`` found so
    far, so the vectors stay where they are and no key gathers them. Rows without
    a vector have no labels.
    """
    ship_package(vectors.sparkSession)
    rounds = -(-labels.count() // LABELS_PER_BLOCK) or 1
    dealt = settle(labels.withColumn("_block", F.pmod(F.xxhash64("label"), F.lit(rounds)).cast("int")), "labels")
    kinds = dict(labels.dtypes) | dict(vectors.dtypes)
    schema = f"vec_id {kinds['vec_id']}, embedding array<double>, best array<struct<minus:double,label:{kinds['label']}>>"
    best_type = to_arrow_type(T.ArrayType(T.StructType([T.StructField("minus", T.DoubleType()), T.StructField("label", labels.schema["label"].dataType)])))

    def meet(block: list) -> Callable:
        """A function that holds vectors against one block."""
        names = [r.label for r in block]
        matrix = np.array([r.centroid for r in block], float)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for start in range(0, whole.num_rows, LABELS_PER_BLOCK):
                    batch = whole.slice(start, LABELS_PER_BLOCK)
                    minus = -_cosines(_matrix(batch.column("embedding")), matrix)
                    # Names ascend, so a stable sort gives ties to the smaller one.
                    order = minus.argsort(axis=1, kind="stable")[:, :top_k]
                    found = [[(float(minus[i, k]), names[k]) for k in row] for i, row in enumerate(order)]
                    merged = [
                        sorted([*((e["minus"], e["label"]) for e in before), *now])[:top_k]
                        for before, now in zip(batch.column("best").to_pylist(), found)
                    ]
                    listed = pa.array([[{"minus": m, "label": x} for m, x in row] for row in merged], best_type)
                    yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), listed], ["vec_id", "embedding", "best"])

        return run

    state = vectors.filter(F.col("embedding").isNotNull()).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.from_json(F.lit("[]"), schema.split("best ")[1]).alias("best")
    )
    for number in range(rounds):
        block = sorted(dealt.filter(F.col("_block") == number).select("label", "centroid").collect(), key=lambda r: r.label)  # LABELS_PER_BLOCK rows on average
        if block:
            state = state.mapInArrow(meet(block), schema)
            state = settle(state, "nearest") if rounds > 1 else state
    return state.select("vec_id", F.posexplode("best").alias("place", "e")).select(
        "vec_id", (F.col("place") + 1).alias("rank"), "e.label", (-F.col("e.minus")).alias("cosine")
    )


# -- hybrid ------------------------------------------------------------------


def label_profiles(weights: DataFrame, labelled: DataFrame) -> DataFrame:
    """``(label, term, weight)``: mean term weights of a label's documents, at unit length."""
    sizes = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    sums = weights.join(labelled, "doc_id").groupBy("label", "term").agg(F.sum("weight").alias("total"))
    means = sums.join(sizes, "label").select("label", "term", (F.col("total") / F.col("n")).alias("mean"))
    length = F.sqrt(F.sum(F.col("mean") * F.col("mean")).over(Window.partitionBy("label")))
    return means.select("label", "term", (F.col("mean") / length).alias("weight"))


def hybrid_scores(
    docs: DataFrame,
    nearest: DataFrame,
    weights: DataFrame,
    profiles: DataFrame,
    rules: Sequence[tuple[str, object, float]],
    bundled: tuple[str, str],
) -> DataFrame:
    """Weighted sum of cosine, TF-IDF overlap and rule boost per candidate label.

    ``nearest`` holds the candidates ``(doc_id, label, cosine)``. ``bundled`` is
    a pair (source, term): a document of that source with that term is flagged.
    """
    lowered = F.lower("text")
    marked = docs.select(
        "doc_id",
        ((F.col("source") == bundled[0]) & F.contains(lowered, F.lit(bundled[1]))).alias("bundled"),
        *[F.contains(lowered, F.lit(term)).alias(f"_hit{i}") for i, (term, _, _) in enumerate(rules)],
    )
    pairs = nearest.join(marked, "doc_id")
    boosted = sum(
        (
            F.when(F.col(f"_hit{i}") & (F.col("label") == F.lit(target)), F.lit(float(value))).otherwise(0.0)
            for i, (_, target, value) in enumerate(rules)
        ),
        F.lit(0.0),
    )
    overlap = (
        nearest.select("doc_id", "label")
        .join(weights, "doc_id")
        .join(profiles.withColumnRenamed("weight", "profile"), ["label", "term"])
        .groupBy("doc_id", "label")
        .agg(F.sum(F.col("weight") * F.col("profile")).alias("tfidf"))
    )
    w = fv.HYBRID_WEIGHTS
    tf = F.coalesce("tfidf", F.lit(0.0))
    return pairs.join(overlap, ["doc_id", "label"], "left").select(
        "doc_id", "label", "cosine", tf.alias("tfidf"), boosted.alias("boost"), "bundled",
        (F.col("cosine") * w["cosine"] + tf * w["tfidf"] + boosted * w["boost"]).alias("score"),
    )


def rule_boosts(docs: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, object, float]]) -> DataFrame:
    """``(doc_id, label)``: the labels that a rule boosts for a document."""
    hits = F.array_compact(F.array(*[F.when(F.contains(F.lower("text"), F.lit(term)), F.lit(i)) for i, (term, _, _) in enumerate(rules)]))
    kind = labels.schema["label"].dataType
    target = F.get(F.array(*[F.lit(t).cast(kind) for _, t, _ in rules]), F.col("rule"))
    return docs.select("doc_id", F.explode(hits).alias("rule")).select("doc_id", target.alias("label")).distinct()


def hybrid_best(
    docs: DataFrame,
    vectors: DataFrame,
    labels: DataFrame,
    weights: DataFrame,
    profiles: DataFrame,
    rules: Sequence[tuple[str, object, float]],
    bundled: tuple[str, str],
    top_k: int = 5,
) -> DataFrame:
    """The ``top_k`` labels of every document by the hybrid score over *all* labels, with ``rank``.

    A threshold search over three ranked lists: the nearest labels by cosine, the
    largest TF-IDF overlaps, and the boosted labels, which are few and all taken.
    A label in none of the lists' heads scores at most what the last ones of the
    two heads do together; a document is done when its ``top_k`` th score beats
    that, and the heads of the others are read twice as deep.
    """
    total = labels.count()
    overlaps = settle(
        weights.join(profiles.withColumnRenamed("weight", "profile"), "term")
        .groupBy("doc_id", "label").agg(F.sum(F.col("weight") * F.col("profile")).alias("overlap")), "overlaps")
    boosted = settle(rule_boosts(docs, labels, rules), "boosts")
    w = fv.HYBRID_WEIGHTS
    todo, depth, finished = vectors.join(docs.select(F.col("doc_id").alias("vec_id")), "vec_id", "left_semi"), top_k, []
    by_overlap = Window.partitionBy("doc_id").orderBy(F.desc("overlap"), "label")
    by_score = Window.partitionBy("doc_id").orderBy(F.desc("score"), "label")
    while True:
        ids = todo.select(F.col("vec_id").alias("doc_id"))
        near = settle(nearest_labels(todo, labels, depth).withColumnRenamed("vec_id", "doc_id"), "near")
        head = overlaps.join(ids, "doc_id", "left_semi").withColumn("place", F.row_number().over(by_overlap)).filter(F.col("place") <= depth)
        others = head.select("doc_id", "label").unionByName(boosted.join(ids, "doc_id", "left_semi")).distinct().join(near, ["doc_id", "label"], "left_anti")
        looked_up = others.join(todo.select(F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>").alias("v")), "doc_id").join(labels, "label")
        size = F.sqrt(_dot(F.col("v"), F.col("v"))) * F.sqrt(_dot(F.col("centroid"), F.col("centroid")))
        looked_up = looked_up.select("doc_id", "label", F.when(size > 0, _dot(F.col("v"), F.col("centroid")) / size).otherwise(0.0).alias("cosine"))
        candidates = settle(near.select("doc_id", "label", "cosine").unionByName(looked_up), "candidates")
        ranked = hybrid_scores(docs, candidates, weights, profiles, rules, bundled).withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= top_k)
        last_near = near.filter(F.col("rank") == depth).select("doc_id", F.col("cosine").alias("unseen_cosine"))
        last_head = head.filter(F.col("place") == depth).select("doc_id", F.col("overlap").alias("unseen_overlap"))
        known = settle(ranked.join(last_near, "doc_id", "left").join(last_head, "doc_id", "left"), "ranked")
        bound = F.col("unseen_cosine") * w["cosine"] + F.coalesce("unseen_overlap", F.lit(0.0)) * w["tfidf"]
        beaten = known.filter((F.col("rank") == top_k) & (F.col("score") > bound)).select("doc_id")
        if depth >= total:
            finished.append(known)
            break
        beaten = settle(beaten, "beaten")
        finished.append(known.join(beaten, "doc_id", "left_semi"))
        todo = settle(todo.join(beaten.withColumnRenamed("doc_id", "vec_id"), "vec_id", "left_anti"), "todo")
        if todo.isEmpty():
            break
        depth = min(2 * depth, total)
    return reduce(DataFrame.unionByName, finished).drop("unseen_cosine", "unseen_overlap")


# -- linear models -----------------------------------------------------------


class TermVectors:
    """TF-IDF vectors with the weights of :func:`tfidf`, learnt from ``docs`` (``doc_id, text``).

    Counting runs in the JVM; one pass over Arrow batches weighs whole batches.
    The vocabulary has ``max_features`` terms at most.
    """

    def __init__(self, docs: DataFrame, max_features: int = fv.TFIDF_MAX_FEATURES, vocab: DataFrame | None = None):
        ship_package(docs.sparkSession)
        found = (frequent_terms(docs, max_features) if vocab is None else vocab).orderBy(F.desc("total"), "term").collect()
        if not found:
            raise ValueError("The documents hold no terms to learn from.")
        self.counter = CountVectorizerModel.from_vocabulary([r.term for r in found], inputCol="_terms", outputCol="features")
        self.terms = [r.term for r in found]
        self.idf = np.log((docs.count() + 1) / (np.array([r.df for r in found]) + 1)) + 1

    def transform(self, texts: DataFrame, best: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
        """``texts`` with sparse ``features`` of unit length; a text without known terms has none.

        With ``best``, weights (labels by terms) and intercepts of linear models, also ``prediction``:
        the label of the largest score, the first of equals, found in the same pass.
        """
        listed = texts.withColumn("_terms", F.coalesce(terms(F.col("text")), F.array().cast("array<string>")))
        counted = self.counter.transform(listed).drop("_terms")
        idf, names = self.idf, counted.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = batch.column("features")
                places, counts, rows = _flat(vectors)
                raw = (np.log(counts) + 1) * idf[places]
                length = np.sqrt(np.bincount(rows, raw * raw, len(vectors)))
                kind, size, indices, values = vectors.flatten()
                starts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(vectors)))])
                weights = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(raw / length[rows]), type=values.type)
                weighed = pa.StructArray.from_arrays([kind, size, indices, weights], fields=list(vectors.type))
                columns = [*(batch.column(c) for c in names[:-1]), weighed]
                if best is not None:
                    columns.append(pa.array(_largest(places, raw / length[rows], rows, len(vectors), *best)))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        schema = counted.schema if best is None else T.StructType([*counted.schema, T.StructField("prediction", T.DoubleType())])
        return counted.mapInArrow(run, schema)


    def weights(self, texts: DataFrame, kind: T.DataType) -> DataFrame:
        """``(doc_id, term, weight)`` of ``(doc_id, text)``, a row for each known term of a text."""
        listed = texts.select("doc_id", F.coalesce(terms(F.col("text")), F.array().cast("array<string>")).alias("_terms"))
        counted = self.counter.transform(listed).drop("_terms")
        idf, names = self.idf, self.terms

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = pa.array(names, pa.string())
            for whole in batches:
                for start in range(0, whole.num_rows, TEXTS_PER_BATCH):
                    batch = whole.slice(start, TEXTS_PER_BATCH)
                    places, counts, rows = _flat(batch.column("features"))
                    raw = (np.log(counts) + 1) * idf[places]
                    length = np.sqrt(np.bincount(rows, raw * raw, batch.num_rows))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(rows)), known.take(pa.array(places)), pa.array(raw / length[rows])], ["doc_id", "term", "weight"])

        return counted.mapInArrow(run, f"doc_id {kind.simpleString()}, term string, weight double")


def _flat(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, values and row numbers of the entries of sparse vectors."""
    _, _, indices, values = vectors.flatten()
    lengths = np.diff(indices.offsets.to_numpy())
    return indices.flatten().to_numpy(), values.flatten().to_numpy(), np.repeat(np.arange(len(vectors)), lengths)


def _largest(places: np.ndarray, values: np.ndarray, rows: np.ndarray, n: int, weights: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
    """The label of the largest score of each of ``n`` sparse rows, whose entries are added up in their order."""
    most, found = np.full(n, -np.inf), np.zeros(n)
    for k, (w, b) in enumerate(zip(weights, intercepts)):
        score = np.bincount(rows, values * w[places], n) + b
        better = score > most
        most[better], found[better] = score[better], k
    return found


def _dense(vectors: pa.StructArray, columns: np.ndarray) -> np.ndarray:
    """A matrix of the wanted columns, and a last one of ones for the intercept."""
    places, values, rows = _flat(vectors)
    matrix = np.zeros((len(vectors), len(columns) + 1))
    at = np.searchsorted(columns, places)
    known = at < len(columns)
    known[known] = columns[at[known]] == places[known]
    matrix[rows[known], at[known]] = values[known]
    matrix[:, -1] = 1
    return matrix


def _fit_linear(x: np.ndarray, y: np.ndarray, kinds: int, kind: str) -> np.ndarray:
    """Weights (columns by labels) of a regularised linear model, by accelerated gradient steps.

    ``svm`` has the squared hinge of every label against the rest, ``logistic``
    the log loss over all labels. The step follows from the largest singular value.
    """
    cost = fv.CLASSIFIER_COST[kind]
    mine = y[:, None] == np.arange(kinds)
    sign = np.where(mine, 1.0, -1.0)
    steep = 1 + cost * (2.0 if kind == "svm" else 0.5) * np.linalg.norm(x, 2) ** 2
    momentum = (np.sqrt(steep) - 1) / (np.sqrt(steep) + 1)
    weights = ahead = np.zeros((x.shape[1], kinds))
    for _ in range(int(30 * np.sqrt(steep)) + 1):
        scores = x @ ahead
        if kind == "svm":
            slope = -2 * sign * np.maximum(0, 1 - sign * scores)
        else:
            slope = np.exp(scores - scores.max(axis=1, keepdims=True))
            slope = slope / slope.sum(axis=1, keepdims=True) - mine
        step = ahead - (ahead + cost * (x.T @ slope)) / steep
        weights, ahead = step, step + momentum * (step - weights)
    return weights


class TextClassifier:
    """A linear classifier in two levels over ``(doc_id, text, part, label)``.

    One model, fitted by Spark, tells the parts apart (a taxonomy's L1). The
    labels of each part have a model of their own, all fitted side by side in
    tasks and kept as rows of a table, so that their weights never meet on the
    driver. A part's task holds its sentences only, one for each leaf.
    ``kind`` is ``svm`` or ``logistic``. Ties go to the smaller label.
    """

    def __init__(self, corpus: DataFrame, kind: str = "logistic", max_features: int = fv.TFIDF_MAX_FEATURES):
        if kind not in fv.CLASSIFIER_COST:
            raise ValueError(f"unknown kind of classifier: {kind}")
        self.vectors = TermVectors(corpus.select("doc_id", "text"), max_features)
        rows = settle(self.vectors.transform(corpus.select("part", "label", "text")).drop("text"), "vectors")
        indexer = StringIndexer(inputCol="part", outputCol="target", stringOrderType="alphabetAsc").fit(rows)
        penalty = 1 / (fv.CLASSIFIER_COST[kind] * rows.count())
        self.best = None
        if len(indexer.labels) == 1:
            self.root = Pipeline(stages=[SQLTransformer(statement="SELECT *, 0D AS prediction FROM __THIS__")]).fit(rows)
        elif kind == "svm":
            one = LinearSVC(maxIter=50, tol=1e-4, regParam=penalty, standardization=False)
            self.root = OneVsRest(classifier=one, labelCol="target", parallelism=8).fit(indexer.transform(rows))
            self.best = np.array([m.coefficients.toArray() for m in self.root.models]), np.array([m.intercept for m in self.root.models])
        else:
            self.root = LogisticRegression(labelCol="target", family="multinomial", maxIter=1000, regParam=penalty, standardization=False).fit(indexer.transform(rows))
        self.names = IndexToString(inputCol="prediction", outputCol="part", labels=indexer.labels)

        def fit(table: pa.Table) -> pa.Table:
            vectors = table.column("features").combine_chunks()
            labels, y = np.unique(np.array(table.column("label").to_pylist(), object), return_inverse=True)
            columns = np.unique(_flat(vectors)[0])
            weights = _fit_linear(_dense(vectors, columns), y, len(labels), kind)
            return pa.table({"part": table.column("part")[:1], "labels": [list(labels)], "columns": pa.array([columns.tolist()], pa.list_(pa.int32())),
                             "weights": pa.array([weights.ravel().tolist()], pa.list_(pa.float64()))})

        fitted = rows.groupBy("part").applyInArrow(fit, "part string, labels array<string>, columns array<int>, weights array<double>")
        self.models = settle(fitted, "models")

    def predict_parts(self, texts: DataFrame) -> DataFrame:
        """``texts`` with ``features`` and the predicted ``part``.

        The models of one label against the rest score a batch where it is weighed, not one after the other row by row.
        """
        scored = self.root.transform(self.vectors.transform(texts)) if self.best is None else self.vectors.transform(texts, self.best)
        scored = self.names.transform(scored)
        return scored.select(*texts.columns, "features", "part")

    def predict(self, texts: DataFrame) -> DataFrame:
        """``(doc_id, predicted_label)``, one row for each text, null and empty ones included.

        The rows of a part meet its model in groups of bounded size, whose
        number follows from the part's measured rows.
        """
        rows = settle(self.predict_parts(texts.select("doc_id", "text")).drop("text"), "parts")
        # One row for each part.
        groups = F.broadcast(rows.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_GROUP).alias("groups")))
        dealt = rows.join(groups, "part").withColumn("slot", F.pmod(F.monotonically_increasing_id(), F.col("groups"))).drop("groups")
        models = self.models.join(groups, "part").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("slot")).drop("groups")
        id_type = to_arrow_type(rows.schema["doc_id"].dataType)

        def score(table: pa.Table, model: pa.Table) -> pa.Table:
            found = []
            if len(table):
                labels, columns, weights = (model.column(c)[0].as_py() for c in ("labels", "columns", "weights"))
                matrix, columns = np.array(weights).reshape(-1, len(labels)), np.array(columns, int)
                for start in range(0, len(table), LABELS_PER_BLOCK):
                    chunk = table.column("features").slice(start, LABELS_PER_BLOCK).combine_chunks()
                    found += [labels[k] for k in (_dense(chunk, columns) @ matrix).argmax(axis=1)]
            return pa.table({"doc_id": table.column("doc_id").cast(id_type), "predicted_label": pa.array(found, pa.string())})

        kind = rows.schema["doc_id"].dataType.simpleString()
        return dealt.groupBy("part", "slot").cogroup(models.groupBy("part", "slot")).applyInArrow(score, f"doc_id {kind}, predicted_label string")


def cross_validated(corpus: DataFrame, kind: str = "logistic", folds: int = 5) -> DataFrame:
    """``(doc_id, part, predicted_part, fold)``: every sentence's part, predicted by a model that has not seen it."""
    dealt = settle(corpus.withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(folds)).cast("int")), "folds")
    held_out = []
    for fold in range(folds):
        seen, rest = dealt.filter(F.col("fold") != fold), dealt.filter(F.col("fold") == fold)
        if seen.isEmpty() or rest.isEmpty():
            continue
        model = TextClassifier(seen, kind)
        told = model.predict_parts(rest.select("doc_id", "text", F.col("part").alias("truth"), "fold"))
        held_out.append(told.select("doc_id", F.col("truth").alias("part"), F.col("part").alias("predicted_part"), "fold"))
    if not held_out:
        raise ValueError("The corpus is too small for folds.")
    return reduce(DataFrame.unionByName, held_out)


def label_corpus(taxonomy: DataFrame) -> DataFrame:
    """One training sentence per leaf: its level names, labelled with its path and, as ``part``, its L1."""
    return taxonomy.select(F.col("full_path").alias("doc_id"), F.concat_ws(" ", "L1", "L2", "L3", "L4").alias("text"),
                           F.col("L1").alias("part"), F.col("full_path").alias("label"))
