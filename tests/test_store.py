import json

import pytest
from pyspark.sql import functions as F

from taxoweave.operators import incremental, responses
from taxoweave.operators.joins import one_row_per_key
from taxoweave.operators.retrieval import TaxonomyIndex
from taxoweave.plans.classify import Settings, classify
from taxoweave.schemas import STORE
from taxoweave.session import scratch_path
from taxoweave.sources import store as store_module
from taxoweave.sources.store import ResultStore
from taxoweave.streaming.incremental import classify_micro_batch, unique_stream

BODY = "l1 string, l2 string, l3 string, l4 string, classification_reason string, confidence_level string, human_review_required boolean, retrieved_taxonomy string"


def results(spark, rows):
    """Results ``(cache_key, transaction_id, l1, api_error)``."""
    full = [(k, i, l1, "b", "c", "d", "r", "HIGH", False, "p", error) for k, i, l1, error in rows]
    return spark.createDataFrame(full, f"cache_key string, transaction_id bigint, {BODY}, api_error string")


def content(store):
    return {r.cache_key: r.l1 for r in store.read().collect()}


def test_an_upsert_writes_its_own_rows_only(spark):
    store = ResultStore(spark, scratch_path(spark, "store"))
    assert store.version() == 0 and content(store) == {}
    store.write(spark.range(500).select(F.concat(F.lit("k"), "id").alias("cache_key"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in STORE.fields[1:]]))
    store.upsert(results(spark, [(f"k{i}", i, "new", None) for i in range(10)] + [("k3", 99, "newest", None), ("k4", 98, None, None), ("k5", 97, "x", "E: y")]))
    written = [spark.read.parquet(f"{store.path}/rows/{m.folder}").count() for m in store._log().appends]
    assert written == [10]
    found = content(store)
    assert len(found) == 500 and found["k3"] == "newest" and found["k4"] == found["k5"] == "new" and found["k10"] is None


def test_two_writers_lose_nothing(spark):
    path = scratch_path(spark, "store")
    one, two = ResultStore(spark, path), ResultStore(spark, path)
    one.upsert(results(spark, [("a", 1, "one", None)]))
    log = one._log()
    # Both have read the same log before either writes.
    two._commit(incremental.newest_good(results(spark, [("b", 1, "two", None), ("a", 2, "two", None)])), "append", log)
    one._commit(incremental.newest_good(results(spark, [("c", 1, "one", None)])), "append", log)
    assert content(one) == {"a": "two", "b": "two", "c": "one"}
    # An append that comes while the log is compacted stays on top of the new base.
    old = one._log()
    two.upsert(results(spark, [("a", 3, "late", None)]))
    one._commit(one._read(old), "base", old)
    assert content(two) == {"a": "late", "b": "two", "c": "one"}
    assert len(two._log().appends) == 1


def test_compaction_and_vacuum(spark, monkeypatch):
    monkeypatch.setattr(store_module, "COMPACT_AFTER", 3)
    store = ResultStore(spark, scratch_path(spark, "store"))
    for n in range(4):
        store.upsert(results(spark, [("same", n, f"v{n}", None), (f"own{n}", n, "x", None)]), run=f"r{n}")
    want = {"same": "v3", "own0": "x", "own1": "x", "own2": "x", "own3": "x"}
    assert content(store) == want and len(store._log().appends) == 1
    store.record("r9", results(spark, []).drop("cache_key"))
    assert store.vacuum(keep_runs=0) == 4
    assert content(store) == want and store.recorded("r9") is None
    store.upsert(results(spark, [("same", 0, "again", None)]), run="r3")
    assert content(store) == want, "a run that is in the log adds nothing"


CALLS = """l1 l2 l3 l4 classification_reason confidence_level""".split()


def counting_model(path):
    """A model that leaves a file for every call."""
    def factory():
        import uuid

        def complete(prompt):
            open(f"{path}/{uuid.uuid4().hex}", "w").close()
            ids = [line.split(": ")[1] for line in prompt.splitlines() if line.startswith("TRANSACTION ID: ")]
            if "1" in ids:
                raise TimeoutError("slow")
            return json.dumps({"classifications": [{"transaction_id": int(i), "l1": "Estate", "l2": "Safety", "l3": "HR", "l4": "Gas", "classification_reason": "r",
                                                    "confidence_level": "HIGH", "human_review_required": False} for i in ids]})

        return complete

    return factory


def test_a_replayed_micro_batch_calls_no_model(spark, taxonomy, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    rows = [(i, f"Gas check {i % 4}", "V", "PO") for i in range(8)]
    batch = spark.createDataFrame(rows, "transaction_id bigint, spend_description string, vendor string, source_type string")
    examples = spark.createDataFrame([(1, "Gas", "A", "Estate", "Safety", "HR", "Gas", "It is gas.", "HIGH", False)],
                                     "example_no bigint, spend_description string, vendor string, l1 string, l2 string, l3 string, l4 string, classification_reason string, confidence_level string, human_review_required boolean")
    store, out = ResultStore(spark, scratch_path(spark, "store")), scratch_path(spark, "out")
    index = TaxonomyIndex(taxonomy)
    hooks = {"model": counting_model(str(calls)), "examples": examples}
    classify_micro_batch(batch, 7, index, store, out, Settings(batch_size=2), **hooks)
    first = sorted(map(str, spark.read.parquet(out).collect()))
    made, version = len(list(calls.iterdir())), store.version()
    assert made == 2 and sum("slow" in r for r in first) == 2
    classify_micro_batch(batch, 7, index, store, out, Settings(batch_size=2), **hooks)
    assert sorted(map(str, spark.read.parquet(out).collect())) == first
    assert len(list(calls.iterdir())) == made and store.version() == version


def test_late_rows_and_expired_keys(spark):
    """Keys are forgotten behind the watermark, and rows that come later than it are dropped."""
    path, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    schema = "id int, k string, ts timestamp"

    def arrive(*rows):
        spark.createDataFrame(rows, "id int, k string, ts string").select("id", "k", F.to_timestamp("ts").alias("ts")).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        unique_stream(stream, out, state, keys=["k"], event_time="ts", delay="1 hour").awaitTermination()
        return sorted(r.id for r in spark.read.schema(schema).parquet(out).collect())

    assert arrive((1, "a", "2024-01-01 00:00:00"), (2, "b", "2024-01-01 00:10:00")) == [1, 2]
    assert arrive((3, "a", "2024-01-01 00:30:00"), (4, "c", "2024-01-01 05:00:00")) == [1, 2, 4]
    # The watermark stands at 04:00 now: 01:00 is late, and a is new again.
    assert arrive((5, "d", "2024-01-01 01:00:00"), (6, "a", "2024-01-01 05:10:00")) == [1, 2, 4, 6]


def test_one_row_per_key_by_hash_aggregate(spark):
    rows = [(1, "k", 5, "x"), (2, "k", 3, "y"), (3, None, 9, "z"), (4, None, 9, "z"), (5, "m", -7, "w"), (5, "m", -7, "w"), (6, "k", 3, "a")]
    df = spark.createDataFrame(rows, "id int, k string, n bigint, t string")
    low = {r.k: (r.n, r.rows) for r in one_row_per_key(df, ["k"], "n", count="rows").collect()}
    assert low == {"k": (3, 3), None: (9, 2), "m": (-7, 2)}
    assert one_row_per_key(df, ["k"], "n").count() == 3
    assert {r.k: r.n for r in one_row_per_key(df, ["k"], "n", last=True).collect()} == {"k": 5, None: 9, "m": -7}


def test_no_sort_aggregates(spark):
    tx = spark.createDataFrame([(1, "a", "b", "c")], "transaction_id bigint, spend_description string, vendor string, source_type string")
    res = results(spark, [("a", 1, "x", None)])
    items = spark.createDataFrame([(1, 0, 7, "x")], "batch_no bigint, item_no int, transaction_id bigint, l4 string")
    for df in (incremental.first_rows(tx), incremental.upsert_store(res, res), responses.last_per_id(items)):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_three_hooks_and_the_gate(spark, taxonomy):
    tx = spark.createDataFrame([(1, "Gas check", "V", "PO"), (2, "Uniforms", "V", "PO")], "transaction_id bigint, spend_description string, vendor string, source_type string")

    def frame():
        def run(batch):
            return batch[["transaction_id"]].assign(l1="Estate", l2="Safety", l3=None, l4="Gas", classification_reason="r", confidence_level="HIGH", human_review_required=False)
        return run

    for settings, hooks, stored in ((Settings(lane="single"), {}, 2), (Settings(), {"frame": frame}, 2), (Settings(enforce_schema=True), {"frame": frame}, 0)):
        store = ResultStore(spark, scratch_path(spark, "store"))
        found = classify(tx, taxonomy, store, settings, **hooks).collect()
        assert len(found) == 2 and store.read().count() == stored
        assert all(bool(r.api_error and "l3" in r.api_error) is (stored == 0) for r in found)
    with pytest.raises(ValueError):
        Settings(lane="other")
    with pytest.raises(ValueError):
        classify(tx, taxonomy, ResultStore(spark, scratch_path(spark, "store")), frame=frame, model=frame)


@pytest.mark.parametrize("text, error", [
    ('{"classifications":[{"transaction_id":1,"l1":"a"}', "JSONDecodeError"), ('[{"l1":"a"}]', "KeyError: 'transaction_id'"),
    ('[{"transaction_id":"x"}]', "whole number"), ('{"other":1}', "valid list"), ("Sorry", "valid list"), (None, "valid list"),
])
def test_errors_tell_what_went_wrong(spark, text, error):
    df = spark.createDataFrame([(1, text, None)], "batch_no bigint, response string, error string")
    row = responses.parse_responses(df).first()
    assert error in row.error and row["items"] is None


def test_trailing_text_is_refused_in_every_lane(spark):
    body = '{"l1":"a","l2":"b","l3":"c","l4":"d","classification_reason":"r","confidence_level":"HIGH","human_review_required":false}'
    df = spark.createDataFrame([(1, "p", None, body), (2, "p", None, body + " and more")], "transaction_id bigint, top_path string, error string, response string")
    found = {r.transaction_id: r for r in responses.parse_single(df).collect()}
    assert found[1].l4 == "d" and found[1].api_error is None and found[2].l4 is None and found[2].api_error
    listed = spark.createDataFrame([(1, f"[{body}]"), (2, f"[{body}] and more")], "batch_no bigint, response string")
    assert {r.batch_no for r in responses.conformance(listed).collect()} == {1}
