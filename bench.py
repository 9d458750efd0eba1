"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query
runs in full through a sink that keeps nothing; the inputs that the queries
share (transactions, taxonomy, predictions, gold) are written once beforehand,
as a cluster would find them: in several files.
"""

from __future__ import annotations

import json
import os
import time

from taxoweave.operators import reporting, similarity, validation
from taxoweave.operators.cleaning import data_quality_report
from taxoweave.operators.incremental import assign_batches, merge_results, plan_run, run_counters, uncached_rows
from taxoweave.operators.retrieval import TaxonomyIndex, transaction_queries
from taxoweave.plans.classify import Settings, classify
from taxoweave.plans.fixtures import LEXICON, RULES, table, view
from taxoweave.session import local_session, scratch_path, settle
from taxoweave.sources.store import ResultStore


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8, name="bench")

    def prepared(name: str):
        return settle(view(spark, folder, name).repartition(8), name)

    tx, pred, gold, stored = (prepared(n) for n in ("fx_transactions", "fx_predictions", "fx_gold", "fx_store"))
    taxonomy = settle(view(spark, folder, "fx_taxonomy"), "fx_taxonomy")
    index = TaxonomyIndex(taxonomy, LEXICON)
    routed = settle(validation.validate_and_route(pred, tx, taxonomy, RULES), "routed")
    new = pred.withColumn("retrieved_taxonomy", pred.l4)
    needed = settle(uncached_rows(tx, stored), "needed")

    parts_index = TaxonomyIndex(settle(view(spark, folder, "fx_parts"), "fx_parts"), LEXICON)
    part_orders = prepared("fx_part_orders").withColumnRenamed("transaction_id", "query_id")

    def full_run():
        store = ResultStore(spark, scratch_path(spark, "bench-store"))
        store.write(stored)
        return classify(tx, index, store, Settings(lexicon=LEXICON))

    queries = {
        "data_quality": lambda: data_quality_report(tx, taxonomy),
        "retrieve_candidates": lambda: index.candidates(transaction_queries(tx)),
        "candidate_contexts": lambda: index.contexts(transaction_queries(tx)),
        "retrieve_parts": lambda: parts_index.candidates(part_orders),
        "uncached_rows": lambda: uncached_rows(tx, stored),
        "batch_numbers": lambda: assign_batches(needed),
        "run_counters": lambda: run_counters(plan_run(tx, stored)),
        "merge_results": lambda: merge_results(tx, new, stored),
        "classify_run": full_run,
        "validate_and_route": lambda: validation.validate_and_route(pred, tx, taxonomy, RULES),
        "status_summary": lambda: reporting.status_summary(routed),
        "accuracy_report": lambda: reporting.accuracy_report(routed, gold),
        "tfidf": lambda: similarity.tfidf(table(spark, folder, "documents")),
    }
    consume(queries["data_quality"]())  # start-up is not part of any query
    seconds = {}
    for name, build in queries.items():
        started = time.perf_counter()
        consume(build())
        seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
