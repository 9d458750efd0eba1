"""Whole runs: classify, validate, evaluate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxoweave import fixed_values as fv
from taxoweave.operators import incremental, inference, prompting, reporting, responses, validation
from taxoweave.operators.retrieval import Lexicon, TaxonomyIndex, transaction_queries
from taxoweave.schemas import RUN_RESULTS
from taxoweave.session import settle
from taxoweave.sources.store import ResultStore


@dataclass(frozen=True)
class Settings:
    """How a run works.

    ``lane`` is ``batch`` or ``single``: prompts for ``batch_size`` rows or for
    one. ``enforce_schema`` keeps results that break the response schema out of
    the store, as error rows.
    """

    batch_size: int = 10
    top_n: int = fv.DEFAULT_TOP_N
    lexicon: Lexicon = field(default_factory=Lexicon)
    style: prompting.PromptStyle = field(default_factory=prompting.PromptStyle)
    in_flight: int | None = None
    lane: str = "batch"
    enforce_schema: bool = False

    def __post_init__(self):
        if self.lane not in ("batch", "single"):
            raise ValueError(f"no lane {self.lane!r}")


def with_context(rows: DataFrame, index: TaxonomyIndex, settings: Settings = Settings()) -> DataFrame:
    """Rows with their candidates."""
    return index.with_contexts(rows, "transaction_id", transaction_queries(rows), settings.top_n)


def batches_with_context(rows: DataFrame, index: TaxonomyIndex, settings: Settings = Settings()) -> DataFrame:
    """Rows with ``batch_no`` and their candidates."""
    return with_context(incremental.assign_batches(rows, settings.batch_size), index, settings)


def _examples(examples: DataFrame | None) -> DataFrame:
    if examples is None:
        raise ValueError("a model needs a table of examples for its prompts")
    return examples


def single_results(
    rows: DataFrame,
    index: TaxonomyIndex,
    settings: Settings,
    model: Callable[[], inference.Complete] | None,
    examples: DataFrame | None,
) -> DataFrame:
    """Results of one prompt per row; a failed call or an unreadable answer is an error row."""
    asked = settle(with_context(rows, index, settings), "asked")
    if model is None:
        answers = inference.top_candidate_objects(asked, index)
    else:
        prompts = prompting.single_prompts(asked, _examples(examples), settings.style).withColumnRenamed("transaction_id", "batch_no")
        answers = settle(inference.complete_prompts(prompts, model, in_flight=settings.in_flight), "responses").withColumnRenamed("batch_no", "transaction_id")
    tops = asked.select("transaction_id", F.get("raw_paths", F.lit(0)).alias("top_path"))
    return responses.parse_single(answers.join(tops, "transaction_id")).drop("from_cache")


def new_results(
    rows: DataFrame,
    index: TaxonomyIndex,
    settings: Settings = Settings(),
    *,
    model: Callable[[], inference.Complete] | None = None,
    frame: Callable[[], inference.Classify] | None = None,
    examples: DataFrame | None = None,
) -> DataFrame:
    """Results for rows that need classification.

    A ``model`` answers prompts, a ``frame`` function answers the rows of a
    batch as a table; without either every row gets its first candidate. The
    responses are written down once, so that neither a retry nor a second read
    calls the model again.
    """
    if model and frame:
        raise ValueError("give a model for prompts or a function for frames, not both")
    if settings.lane == "single" and not frame:
        results = single_results(rows, index, settings, model, examples)
    else:
        batches = settle(batches_with_context(rows, index, settings), "batches")
        if frame:
            results = inference.classify_batches(batches, frame)
        elif model:
            prompts = prompting.batch_prompts(batches, _examples(examples), settings.style)
            answers = settle(inference.complete_prompts(prompts, model, in_flight=settings.in_flight), "responses")
            results = responses.batch_results(batches, answers)
        else:
            results = responses.batch_results(batches, inference.top_candidate_answers(batches, index))
    return responses.quarantine(results) if settings.enforce_schema else results


def classify(
    transactions: DataFrame,
    taxonomy: DataFrame | TaxonomyIndex,
    store: ResultStore,
    settings: Settings = Settings(),
    *,
    model: Callable[[], inference.Complete] | None = None,
    frame: Callable[[], inference.Classify] | None = None,
    examples: DataFrame | None = None,
    run: str | None = None,
) -> DataFrame:
    """One result per transaction; only rows the store cannot answer are classified.

    A ``run`` with a name is recorded in the store. Started again under that
    name, over the same transactions, it calls no model and gives the same rows.
    """
    index = taxonomy if isinstance(taxonomy, TaxonomyIndex) else TaxonomyIndex(taxonomy, settings.lexicon)
    fresh = store.recorded(run) if run else None
    if fresh is None:
        needed = settle(incremental.uncached_rows(transactions, store.read()), "needed")
        if needed.isEmpty():
            fresh = transactions.sparkSession.createDataFrame([], RUN_RESULTS)
        else:
            fresh = new_results(needed, index, settings, model=model, frame=frame, examples=examples)
            # Only answers to rows that were asked for count.
            fresh = fresh.join(needed.select("transaction_id"), "transaction_id", "left_semi")
        fresh = store.record(run, fresh) if run else settle(fresh.select(RUN_RESULTS.fieldNames()), "results")
    keyed = incremental.with_key(transactions).select("transaction_id", "cache_key").join(fresh, "transaction_id")
    return incremental.merge_results(transactions, fresh, store.upsert(keyed, run))


def responses_schema():
    """Schema of new results: a result without the cache flag."""
    return RUN_RESULTS


def finalise(results: DataFrame, transactions: DataFrame, taxonomy: DataFrame, rules=fv.SEMANTIC_RULES) -> DataFrame:
    """Validate, route, and shape the deliverable."""
    return validation.deliverable(
        transactions, validation.validate_and_route(results, transactions, taxonomy, rules)
    )


def evaluate(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """The accuracy report of finalised predictions."""
    return reporting.accuracy_report(predictions, gold)
