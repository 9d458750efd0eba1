"""Toxicity as a severity grade, by cumulative-link ordinal regression.

A document's features are the words it holds and the first letters of its
words, so that a stem counts in all its forms. ``P(grade <= k)`` is the logistic
function of ``threshold_k - score``: the weights are shared by all thresholds,
and the thresholds are ordered because each is the one before plus a positive
step. The expected severity is the sum over ``k`` of ``P(grade > k)``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import or_empty, settle, ship_package, small, tidy, worker_cache

#: Labelled documents up to which one task fits the model; more are fitted in as many tasks as hold them.
ALONE_ROWS = 20_000
#: Features kept for the fit are those that tell grades apart: the chi-squared statistic each must reach (chance
#: gives one such in ten million), and the documents each must occur in.
LEAST_STATISTIC = 28.4
LEAST_DOCUMENTS = 4
PREFIXES = (4, 5, 6)
STEPS = 300
#: Of the likelihood's value; with less gained the fit in parts ends.
LEAST_GAIN = 1e-3
EVIDENCE_SHARE = 0.9
RIDGE = 1e-4
#: Documents whose probability of any grade above 0 reaches this are toxic.
CUT = 0.4
PIECE = 1 << 20
BATCH_BYTES = 2 << 20
LETTERS = re.compile(r"[^\W\d_]+")
#: Some documents of the training set, all as 32-bit numbers: feature numbers one behind the other, how many each document has, grades, doses.
PART = ["cols", "sizes", "grades", "doses"]


def features(text: str) -> set[str]:
    """Words in lower case, and the prefixes of longer ones with a mark behind them."""
    words: set[str] = set()
    for start in range(0, len(text), PIECE):
        end = start + PIECE
        # A piece ends where a word ends, so that no word is cut.
        begin = start
        while 0 < begin < len(text) and text[begin - 1].isalpha() and text[begin].isalpha() and begin < end:
            begin += 1
        while end < len(text) and text[end - 1].isalpha() and text[end].isalpha():
            end += 1
        words.update(LETTERS.findall(text[begin:end].lower()))
    return words | {w[:n] + "*" for n in PREFIXES for w in words if len(w) > n}


@dataclass(frozen=True)
class OrdinalModel:
    """Weights of features, shared by the thresholds between neighbouring grades."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def score(self, text: str) -> float:
        weights = self.weights
        return math.fsum(weights[f] for f in features(text) if f in weights)

    def above(self, score: np.ndarray) -> np.ndarray:
        """``P(grade > k)`` for each score and threshold."""
        return 1 / (1 + np.exp(np.clip(np.asarray(self.thresholds)[None, :] - np.asarray(score)[:, None], -60, 60)))


class TrainingSet:
    """Documents as arrays of feature numbers; with ``names`` of these features only."""

    def __init__(self, names: list[str] | None = None) -> None:
        self.numbers: dict[str, int] = {f: i for i, f in enumerate(names or ())}
        self.fixed = names is not None
        self.rows: list[np.ndarray] = []
        self.grades: list[int] = []

    def add(self, text: str, grade: int) -> None:
        numbers = self.numbers
        if self.fixed:
            found = [numbers[f] for f in features(text) if f in numbers]
        else:
            found = [numbers.setdefault(f, len(numbers)) for f in features(text)]
        self.rows.append(np.array(found, np.int32))
        self.grades.append(grade)


def select_features(data: TrainingSet, least: int = LEAST_DOCUMENTS) -> list[str]:
    """The features whose presence says most about whether the grade is above 0, by their chi-squared statistic."""
    flat = np.concatenate(data.rows) if data.rows else np.empty(0, np.int32)
    toxic = np.array(data.grades) > 0
    owner_toxic = np.repeat(toxic, [len(r) for r in data.rows])
    size = len(data.numbers)
    count, positive = np.bincount(flat, minlength=size), np.bincount(flat[owner_toxic], minlength=size)
    share = toxic.mean() if len(toxic) else 0.0
    expected = count * share
    statistic = (positive - expected) ** 2 / (expected * (1 - share) * (1 - count / max(len(toxic), 1)) + 1e-9)
    names = [(-round(float(statistic[i]), 6), f) for f, i in data.numbers.items() if count[i] >= least and statistic[i] >= LEAST_STATISTIC]
    return [f for _, f in sorted(names)]


def by_dose(data: TrainingSet, share: float = EVIDENCE_SHARE) -> TrainingSet:
    """Split grade 1 of a two-grade set: documents with more than the median evidence get grade 2.

    Evidence are the selected features that occur in documents of grade 1
    almost alone; a document's evidence is their number.
    """
    chosen = np.zeros(len(data.numbers), bool)
    chosen[[data.numbers[f] for f in select_features(data)]] = True
    toxic = np.array(data.grades) > 0
    flat = np.concatenate(data.rows)
    count = np.bincount(flat, minlength=len(chosen))
    positive = np.bincount(flat[np.repeat(toxic, [len(r) for r in data.rows])], minlength=len(chosen))
    evidence = chosen & (positive >= share * count)
    dose = np.array([evidence[r].sum() for r in data.rows])
    data.grades = np.where(toxic, np.where(dose > np.median(dose[toxic]) if toxic.any() else False, 2, 1), 0).tolist()
    return data


def sums(params: np.ndarray, cols: np.ndarray, rows: np.ndarray, grades: np.ndarray, k: int) -> np.ndarray:
    """Over documents: their negative log-likelihood, then its slopes by weight and by each of the ``k`` thresholds."""
    m = len(params) - k
    weights, base, gaps = params[:m], params[m], np.exp(params[m + 1:])
    limits = np.concatenate([[-np.inf, base], base + np.cumsum(gaps), [np.inf]])
    score = np.bincount(rows, weights[cols], len(grades))
    upper = 1 / (1 + np.exp(-np.clip(limits[grades + 1] - score, -40, 40)))
    lower = 1 / (1 + np.exp(-np.clip(limits[grades] - score, -40, 40)))
    upper, lower = np.where(grades == k, 1.0, upper), np.where(grades == 0, 0.0, lower)
    likely = np.maximum(upper - lower, 1e-12)
    up, low = upper * (1 - upper) / likely, lower * (1 - lower) / likely
    by_limit = [low[grades == j + 1].sum() - up[grades == j].sum() for j in range(k)]
    return np.concatenate([[-np.log(likely).sum()], np.bincount(cols, (up - low)[rows], m), by_limit])


@dataclass(frozen=True)
class Likelihood:
    """The ridged mean negative log-likelihood of a training set, over weights, the first threshold and the logs of the steps between thresholds.

    ``counts`` has the number of documents of each grade, ``total`` gives the
    :func:`sums` of all documents at the parameters it is asked for.
    """

    names: list[str]
    counts: np.ndarray
    total: Callable[[np.ndarray], np.ndarray]
    ridge: float = RIDGE

    def start(self) -> np.ndarray:
        n, k = int(self.counts.sum()), len(self.counts) - 1
        share = np.array([(self.counts[j + 1:].sum() + 0.5) / (n + 1) for j in range(k)])
        start = np.log((1 - share) / share)
        # Steps between thresholds are exponentials, so they stay ordered.
        return np.concatenate([np.zeros(len(self.names)), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])

    def at(self, params: np.ndarray) -> tuple[float, np.ndarray]:
        """Its value and slopes."""
        n, m, k = int(self.counts.sum()), len(self.names), len(self.counts) - 1
        summed, gaps = self.total(params), np.exp(params[m + 1:])
        by_limit = summed[1 + m:] / n
        slope = np.zeros_like(params)
        slope[:m] = summed[1:1 + m] / n + self.ridge * params[:m]
        slope[m] = by_limit.sum()
        slope[m + 1:] = [by_limit[j + 1:].sum() * gaps[j] for j in range(k - 1)]
        return float(summed[0] / n + self.ridge / 2 * (params[:m] @ params[:m])), slope

    def model(self, params: np.ndarray) -> OrdinalModel:
        m = len(self.names)
        limits = params[m] + np.concatenate([[0.0], np.cumsum(np.exp(params[m + 1:]))])
        return OrdinalModel({f: float(w) for f, w in zip(self.names, params[:m])}, tuple(float(t) for t in limits[:len(self.counts) - 1]))


def descend(goal: Likelihood, steps: int = STEPS) -> OrdinalModel:
    """Full gradient steps with momentum and a step for each coordinate."""
    params = goal.start()
    first, second = np.zeros_like(params), np.zeros_like(params)
    for turn in range(1, steps + 1):
        _, slope = goal.at(params)
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        rate = 0.1 * (0.1 ** (turn / steps))
        params = params - rate * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
    return goal.model(params)


def descend_by_curvature(goal: Likelihood, steps: int = STEPS, remembered: int = 10) -> OrdinalModel:
    """Quasi-Newton steps (L-BFGS), which need fewer readings of the training set, until ``remembered`` steps gain less than ``LEAST_GAIN``."""
    params = goal.start()
    value, slope = goal.at(params)
    values, pairs = [value], []
    for _ in range(steps):
        way, shares = -slope, []
        for s, y in reversed(pairs):
            shares.append((s @ way) / (s @ y))
            way = way - shares[-1] * y
        # Without pairs no coordinate moves by more than a tenth.
        way = way * ((pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 0.1 / max(np.abs(slope).max(), 1e-30))
        for (s, y), share in zip(pairs, reversed(shares)):
            way = way + s * (share - (y @ way) / (s @ y))
        length = 1.0
        after, next_slope = goal.at(params + way)
        while after > value + 1e-4 * length * (slope @ way) and length > 1e-6:
            length /= 2
            after, next_slope = goal.at(params + length * way)
        if after >= value:
            break
        s, y = length * way, next_slope - slope
        if s @ y > 1e-12 * np.sqrt((s @ s) * (y @ y)):
            pairs = [*pairs, (s, y)][-remembered:]
        params, value, slope = params + s, after, next_slope
        values.append(value)
        if len(values) > remembered and values[-1 - remembered] - value < LEAST_GAIN * value:
            break
    return goal.model(params)


def fit(data: TrainingSet, n_grades: int, steps: int = STEPS, ridge: float = RIDGE) -> OrdinalModel:
    """Fit to documents in memory."""
    names = sorted(select_features(data))
    column = np.full(len(data.numbers), -1, np.int64)
    column[[data.numbers[f] for f in names]] = np.arange(len(names))
    grades = np.array(data.grades, np.int64)
    cols = column[np.concatenate(data.rows)]
    rows = np.repeat(np.arange(len(data.rows)), [len(r) for r in data.rows])[cols >= 0]
    cols = cols[cols >= 0]
    order = np.lexsort((cols, rows))
    rows, cols = rows[order], cols[order]
    counts = np.bincount(grades, minlength=n_grades)
    return descend(Likelihood(names, counts, lambda params: sums(params, cols, rows, grades, n_grades - 1), ridge), steps)


def fit_in_parts(labelled: DataFrame, n_grades: int) -> OrdinalModel:
    """Fit the likelihood of :func:`fit`, for two grades after :func:`by_dose`, to all rows of ``text`` and ``grade`` where they lie.

    The texts are read once to count features and once to turn them into
    numbers. Every step then sums over these in many tasks; only sums come to
    the driver.
    """
    told = sorted(tell(labelled).select("feature", "n", "positive").collect())
    names, evidence = [r.feature for r in told], np.array([r.positive >= EVIDENCE_SHARE * r.n for r in told], bool)
    split = n_grades == 2

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {f: i for i, f in enumerate(names)}
        for batch in _slices(batches):
            found = [np.sort(np.array([numbers[f] for f in features(t) if f in numbers], np.int32)) for t in batch.column("text").to_pylist()]
            doses = np.array([evidence[r].sum() for r in found], np.int32)
            sizes = np.array([len(r) for r in found], np.int32)
            grades = batch.column("grade").to_numpy(zero_copy_only=False).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (np.concatenate(found), sizes, grades, doses)], PART)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for batch in batches:
            for row in zip(*(batch.column(c) for c in PART)):
                yield [np.frombuffer(x.as_buffer(), np.int32) for x in row]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, grades, doses in parts(batches):
            pairs, n = np.unique(np.stack([grades, doses]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (*pairs, n)], ["grade", "dose", "n"])

    training = settle(labelled.mapInArrow(tidy(number), ", ".join(f"{c} binary" for c in PART)), "training")
    tallied = settle(training.mapInArrow(tidy(tally), "grade long, dose long, n long").groupBy("grade", "dose").agg(F.sum("n").alias("n")), "tallied")
    middle = tallied.where("grade > 0").agg(F.expr("percentile(dose, 0.5, n)")).first()[0] if split else None
    grade = F.col("grade") + F.when((F.col("grade") > 0) & (F.col("dose") > middle), 1).otherwise(0) if middle is not None else F.col("grade")
    by_grade = {r.grade: r.n for r in tallied.groupBy(grade.alias("grade")).agg(F.sum("n").alias("n")).collect()}
    counts = np.array([by_grade.get(g, 0) for g in range(3 if split else n_grades)])

    def total(params: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            summed = np.zeros(1 + len(params))
            for cols, sizes, grades, doses in parts(batches):
                if middle is not None:
                    grades = grades + ((grades > 0) & (doses > middle))
                summed += sums(params, cols, np.repeat(np.arange(len(sizes)), sizes), grades, len(counts) - 1)
            yield pa.RecordBatch.from_arrays([pa.array([summed.tobytes()], pa.binary())], ["sums"])

        return np.sum([np.frombuffer(r.sums) for r in training.mapInArrow(tidy(run), "sums binary").collect()], axis=0)

    return descend_by_curvature(Likelihood(names, counts, total))


def graded(labels: DataFrame) -> DataFrame:
    """``doc_id``, ``grade``: 0 for documents that are not toxic, 1 for toxic ones.

    Labels without an id or a toxic mark take no part. Of several labels of a
    document the worst holds.
    """
    return labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("grade"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in parts of bounded size, with what other operators remembered in this worker let go."""
    worker_cache("toxicity")
    for batch in batches:
        step = max(1, min(batch.num_rows, batch.num_rows * BATCH_BYTES // max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def tell(labelled: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``feature``, ``n``, ``positive``, ``statistic``: the features of ``text`` that tell grades apart, with their documents, of any grade and above 0."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            counts: dict[str, list[int]] = {}
            for text, grade in zip(batch.column("text").to_pylist(), batch.column("grade").to_pylist()):
                for f in features(text):
                    entry = counts.setdefault(f, [0, 0])
                    entry[0] += 1
                    entry[1] += grade > 0
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), *(pa.array([c[k] for c in counts.values()], pa.int64()) for k in (0, 1))], ["feature", "n", "positive"])

    size = labelled.agg(F.count(F.lit(1)).alias("rows"), F.avg((F.col("grade") > 0).cast("double")).alias("share")).first()
    counted = labelled.mapInArrow(tidy(count), "feature string, n long, positive long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive"))
    expected = F.col("n") * F.lit(size["share"] or 0.0)
    statistic = (F.col("positive") - expected) ** 2 / (expected * F.lit(1 - (size["share"] or 0.0)) * (1 - F.col("n") / F.lit(max(size["rows"], 1))) + 1e-9)
    return counted.where(F.col("n") >= least).withColumn("statistic", statistic).where(F.col("statistic") >= LEAST_STATISTIC)


def telling_features(labelled: DataFrame, least: int = LEAST_DOCUMENTS) -> list[str]:
    """The features of ``text`` that :func:`select_features` takes, found by counting them over all rows in Spark."""
    return [r.feature for r in tell(labelled, least).orderBy(F.round("statistic", 6).desc(), "feature").collect()]


def train(docs: DataFrame, grades: DataFrame, n_grades: int = 2, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel | None:
    """Fit on all labelled documents; only the weights come back.

    ``grades`` has ``doc_id`` and ``grade`` from 0 to ``n_grades - 1``; of two
    grades the upper one is split by :func:`by_dose`, which makes three. Of rows
    that repeat an id the smallest text is taken. The features that tell grades
    apart are found in Spark. Up to ``ALONE_ROWS`` documents are fitted in one
    task, more by :func:`fit_in_parts`. None if no document has a label.
    """
    ship_package(docs.sparkSession)
    grades = settle(grades, "grades")
    n = grades.count()
    labelled = docs.select(F.col(id_col).alias("doc_id"), or_empty(text_col).alias("text")).join(small(grades, n, 16 * n), "doc_id")
    labelled = settle(labelled.select("doc_id", "text", "grade"), "labelled")
    counted = labelled.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("doc_id").alias("ids")).first()
    if counted["rows"] != counted["ids"]:
        labelled = settle(labelled.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("grade").alias("grade")), "labelled")
    labelled = labelled.select("text", "grade")
    if counted["ids"] > ALONE_ROWS:
        return fit_in_parts(labelled, n_grades)
    names = telling_features(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = TrainingSet(names)
        for batch in _slices(batches):
            for text, grade in zip(batch.column("text").to_pylist(), batch.column("grade").to_pylist()):
                data.add(text, grade)
        if data.rows:
            model = fit(by_dose(data), 3) if n_grades == 2 else fit(data, n_grades)
            named = [*model.weights, *[None] * len(model.thresholds)]
            yield pa.RecordBatch.from_arrays([pa.array(named, pa.string()), pa.array([*model.weights.values(), *model.thresholds], pa.float64())], ["feature", "value"])

    values = labelled.repartition(1).mapInArrow(tidy(run), "feature string, value double").collect()
    if not values:
        return None
    return OrdinalModel({r.feature: r.value for r in values if r.feature is not None}, tuple(sorted(r.value for r in values if r.feature is None)))


def severity(docs: DataFrame, model: OrdinalModel | None, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """Severity of each document: ``id_col``, ``expected_severity``, ``grade``, ``toxic``, ``kept``.

    ``grade`` is the largest whose probability of being reached is ``cut`` or
    more, ``toxic`` is whether that is above 0. One row for each input row;
    null and empty texts have no features and score 0. Without a model nothing
    is toxic. Other columns are ignored; an empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col), or_empty(text_col).alias("text"))
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = batch.column(1).to_pylist()
            if model is None:
                expected, grade = np.zeros(len(texts)), np.zeros(len(texts), np.int32)
            else:
                above = model.above(np.array([model.score(t) if t else 0.0 for t in texts]))
                expected, grade = above.sum(axis=1), (above >= cut).sum(axis=1).astype(np.int32)
                for i, t in enumerate(texts):
                    if not t:
                        expected[i] = grade[i] = 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.round(expected, 9)), pa.array(grade), pa.array(grade > 0), pa.array(grade == 0)],
                [id_col, "expected_severity", "grade", "toxic", "kept"])

    return rows.mapInArrow(tidy(run), f"`{id_col}` {kind}, expected_severity double, grade int, toxic boolean, kept boolean")


def drop_toxic(docs: DataFrame, model: OrdinalModel | None, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows whose text is not toxic, with all their columns.

    A text decides alone: rows that repeat an id, or have none, are judged each
    for itself, equal texts alike. Null and empty texts stay; so does everything
    without a model, and an empty table is empty again. Only hashes of toxic
    texts (128 bits) come back from Python, and drop their rows.
    """
    if model is None:
        return docs
    ship_package(docs.sparkSession)
    hashes = {"__toxic_a": F.xxhash64(text_col), "__toxic_b": F.xxhash64(F.lit(1), text_col)}
    keys = [*hashes]
    texts = docs.where(F.length(text_col) > 0).select(*[h.alias(c) for c, h in hashes.items()], F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            above = model.above(np.array([model.score(t) for t in batch.column("text").to_pylist()]))[:, 0]
            yield batch.select(keys).filter(pa.array(above >= cut))

    toxic = settle(texts.mapInArrow(tidy(run), ", ".join(f"{c} long" for c in keys)).distinct(), "toxic")
    n = toxic.count()
    return docs.withColumns(hashes).join(small(toxic, n, 16 * n), keys, "left_anti").drop(*keys)
