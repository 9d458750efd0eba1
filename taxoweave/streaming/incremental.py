"""The same incremental run over a stream of transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from taxoweave.operators.incremental import with_key
from taxoweave.operators.retrieval import TaxonomyIndex
from taxoweave.plans.classify import Settings, classify
from taxoweave.session import settle
from taxoweave.sources.store import ResultStore


def classify_stream(
    transactions: DataFrame,
    index: TaxonomyIndex,
    store: ResultStore,
    output: str,
    checkpoint: str,
    settings: Settings = Settings(),
    *,
    name: str = "stream",
    **hooks,
) -> StreamingQuery:
    """Classify every micro-batch against the store and write results to ``output``.

    A micro-batch is a run of its own number in the store's log. One that is
    started again after a failure reads what it had recorded: it calls no model,
    adds nothing to the store, and replaces its folder by the same rows. The
    store remembers keys across micro-batches. ``name`` tells streams apart that
    share a store; ``hooks`` go to :func:`classify`.
    """

    def run(batch: DataFrame, number: int) -> None:
        classify_micro_batch(batch, number, index, store, output, settings, name=name, **hooks)

    return (
        transactions.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def classify_micro_batch(
    batch: DataFrame, number: int, index: TaxonomyIndex, store: ResultStore, output: str,
    settings: Settings = Settings(), *, name: str = "stream", **hooks,
) -> None:
    """One micro-batch of :func:`classify_stream`."""
    rows = settle(batch, "micro-batch")  # read by several steps
    results = classify(rows, index, store, settings, run=f"{name}-{number}", **hooks)
    results.write.mode("overwrite").parquet(f"{output}/micro_batch={number}")


def unique_stream(
    rows: DataFrame, output: str, checkpoint: str, *, keys: Sequence[str] | None = None, event_time: str | None = None, delay: str = "1 day"
) -> StreamingQuery:
    """Keep the first row of every key across the stream.

    Without ``keys`` the rows are transactions and have their store key. With an
    event time the state is bounded: a key is remembered for ``delay`` after its
    row's time, as the watermark passes, and rows later than the watermark are
    dropped. Without one every key is remembered, which is exact and grows with
    the number of keys.
    """
    keyed = rows if keys else with_key(rows)
    keys = list(keys or ["cache_key"])
    if event_time:
        unique = keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    else:
        unique = keyed.dropDuplicates(keys)
    return (
        unique.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
