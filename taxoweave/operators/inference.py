"""Where a model plugs in.

The model call is the only Python in the flow. A factory is called once per
Python worker and returns the function that does the work, so a client is built
once and not per batch. Failures stay inside their batch: the error text is a
column, and the job goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxoweave import fixed_values as fv
from taxoweave.functions.text import path_of
from taxoweave.operators.joins import dimension_join
from taxoweave.operators.retrieval import TaxonomyIndex
from taxoweave.session import ship_package

Complete = Callable[[str], str]
Classify = Callable[[pd.DataFrame], pd.DataFrame]

ANSWER_COLUMNS = (
    "transaction_id bigint, l1 string, l2 string, l3 string, l4 string, classification_reason string, "
    "confidence_level string, human_review_required boolean"
)


def complete_prompts(prompts: DataFrame, factory: Callable[[], Complete], *, in_flight: int | None = None) -> DataFrame:
    """``(batch_no, response, error)``: one model call per prompt.

    ``in_flight`` bounds the calls that run at once, through the number of
    partitions. Write the result down before using it twice, so that no prompt
    is sent again; ``plans.classify`` does.
    """
    ship_package(prompts.sparkSession)
    rows = prompts.select("batch_no", "prompt")
    if in_flight:
        rows = rows.repartition(in_flight, "batch_no")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        complete = factory()

        def call(prompt: str) -> tuple[str | None, str | None]:
            try:
                return complete(prompt), None
            except Exception as exc:  # the batch fails, the job does not
                return None, f"{type(exc).__name__}: {exc}"

        for frame in frames:
            answers = [call(p) for p in frame["prompt"]]
            yield pd.DataFrame({
                "batch_no": frame["batch_no"],
                "response": [a[0] for a in answers],
                "error": [a[1] for a in answers],
            })

    return rows.mapInPandas(run, "batch_no bigint, response string, error string")


def _same(a: object, b: object) -> bool:
    """Whether two batch numbers are equal, a missing one being a number of its own."""
    return a == b or (pd.isna(a) and pd.isna(b))


def _starts(numbers: pd.Series) -> list[int]:
    """Places behind the first where another batch number begins."""
    before = numbers.shift()
    other = (numbers != before) & ~(numbers.isna() & before.isna())
    return [int(i) for i in other.to_numpy().nonzero()[0] if i]


def classify_batches(rows: DataFrame, factory: Callable[[], Classify]) -> DataFrame:
    """New results from a function over the rows of one batch.

    The function receives the batch as a frame (id, texts, ``paths``,
    ``raw_paths``) and returns the answer columns. A batch whose function
    raises becomes error rows.
    """
    ship_package(rows.sparkSession)
    columns = [field.split()[0] for field in f"{ANSWER_COLUMNS}, api_error string".split(", ")]
    whole_numbers = [c for c, kind in rows.dtypes if kind in ("bigint", "int")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classify = None

        def answer(batch: pd.DataFrame) -> pd.DataFrame:
            nonlocal classify
            try:
                classify = classify or factory()
                found = classify(batch).assign(api_error=None)
            except Exception as exc:
                found = pd.DataFrame({"transaction_id": batch["transaction_id"]}).assign(
                    l1=None, l2=None, l3=None, l4=None, classification_reason=None, confidence_level=None,
                    human_review_required=True, api_error=f"{type(exc).__name__}: {exc}",
                )
            return found[columns]

        def whole(pieces: list[pd.DataFrame]) -> pd.DataFrame:
            batch = pieces[0].reset_index(drop=True) if len(pieces) == 1 else pd.concat(pieces, ignore_index=True)
            # A missing number elsewhere in a frame makes a column float; a batch without one has whole numbers.
            return batch.astype({c: "int64" for c in whole_numbers if batch[c].dtype == float and batch[c].notna().all()}, copy=False)

        def together(answers: list[pd.DataFrame]) -> pd.DataFrame:
            return pd.DataFrame({c: [x for a in answers for x in a[c].tolist()] for c in columns}, dtype=object)

        rest = []
        for frame in frames:
            # A batch ends where another number begins; the last one may go on in the next frame.
            cuts = [0, *(_starts(frame["batch_no"])), len(frame)]
            pieces = [frame.iloc[a:b] for a, b in zip(cuts, cuts[1:])]
            answers = []
            for piece in pieces:
                if rest and not _same(rest[-1]["batch_no"].iloc[-1], piece["batch_no"].iloc[0]):
                    answers.append(answer(whole(rest)))
                    rest = []
                rest.append(piece)
            if answers:
                yield together(answers)
        if rest:
            yield together([answer(whole(rest))])

    # The rows of a batch come to one partition side by side; a partition's batches go through one call of Python.
    dealt = rows.repartition("batch_no").sortWithinPartitions("batch_no")
    answers = dealt.mapInPandas(run, f"{ANSWER_COLUMNS}, api_error string")
    tops = rows.select("transaction_id", F.get("raw_paths", F.lit(0)).alias("top_path"))
    levels = [F.col(c) for c in ("l1", "l2", "l3", "l4")]
    full = (F.coalesce(levels[0], F.lit("")) != "") & (F.coalesce(levels[3], F.lit("")) != "")
    chosen = F.when(full, path_of(*levels)).when(F.col("api_error").isNull(), F.col("top_path"))
    return answers.join(tops, "transaction_id", "left").withColumn("retrieved_taxonomy", chosen).drop("top_path")


def _first_candidates(rows: DataFrame, index: TaxonomyIndex) -> DataFrame:
    """Rows with the levels of their first candidate, a reason, a confidence and a review flag.

    Confidence follows the cut-off branch, and weak matches ask for review.
    """
    leaf = index.taxonomy.select("full_path", *[F.col(c).alias(c.lower()) for c in ("L1", "L2", "L3", "L4")])
    # Paths may repeat in a taxonomy; the default needs one row per path.
    leaf = leaf.dropDuplicates(["full_path"])
    topped = dimension_join(
        rows.withColumn("full_path", F.get("raw_paths", F.lit(0))), leaf, ["full_path"], bounded=index.bounded, how="left"
    )
    return topped.withColumns({
        "classification_reason": F.lit("first candidate"),
        "confidence_level": F.when(F.col("branch") == "strong", "HIGH").when(F.col("branch") == "moderate", "MEDIUM").otherwise("LOW"),
        "human_review_required": F.col("branch") == "weak",
    })


_ANSWER = ["l1", "l2", "l3", "l4", "classification_reason", "confidence_level", "human_review_required"]


def top_candidate_answers(rows: DataFrame, index: TaxonomyIndex) -> DataFrame:
    """``(batch_no, response, error)``: the offline default, without Python.

    Answers every transaction of a batch with its first candidate.
    """
    item = F.to_json(F.struct("transaction_id", *_ANSWER))
    gathered = _first_candidates(rows, index).groupBy("batch_no").agg(
        F.sort_array(F.collect_list(F.struct("transaction_id", item.alias("item")))).alias("items")
    )
    body = F.array_join(F.transform("items", lambda i: i["item"]), ",")
    return gathered.select(
        "batch_no",
        F.concat(F.lit('{"classifications":['), body, F.lit("]}")).alias("response"),
        F.lit(None).cast("string").alias("error"),
    )


def top_candidate_objects(rows: DataFrame, index: TaxonomyIndex) -> DataFrame:
    """``(transaction_id, response, error)``: the same, one response per transaction."""
    return _first_candidates(rows, index).select(
        "transaction_id", F.to_json(F.struct(*_ANSWER)).alias("response"), F.lit(None).cast("string").alias("error")
    )


def first_path_classifier() -> Classify:
    """The same default as a batch function, for the pandas hook."""

    def classify(batch: pd.DataFrame) -> pd.DataFrame:
        levels = [paths[0].split(fv.PATH_SEPARATOR) if len(paths) else [None] * 4 for paths in batch["raw_paths"]]
        width = max(map(len, levels))
        if width != 4:
            raise ValueError(f"4 columns passed, passed data had {width} columns")
        levels = [found + [None] * (4 - len(found)) for found in levels]
        names = {"strong": "HIGH", "moderate": "MEDIUM", "weak": "LOW"}
        branches = batch["branch"].tolist()
        return pd.DataFrame({
            "transaction_id": batch["transaction_id"], **{f"l{k + 1}": [found[k] for found in levels] for k in range(4)},
            "classification_reason": "first candidate", "confidence_level": [names.get(b) for b in branches],
            "human_review_required": [b == "weak" for b in branches],
        }, index=batch.index)

    return classify
