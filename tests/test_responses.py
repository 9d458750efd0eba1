from pyspark.sql import functions as F

from taxoweave.operators.responses import response_items

ITEM = '{"transaction_id": 1, "l1": "A"}'


def test_only_one_whole_value_is_a_response(spark):
    good = [f"[{ITEM}]", f" [{ITEM}]\n", f'{{"classifications": [{ITEM}]}}', f'{{"note": "]}}", "classifications": [{ITEM}]}}']
    bad = [f"[{ITEM}] and more", f"[{ITEM}]]", f"[{ITEM}", f'{{"classifications": [{ITEM}]}} }}', f"[{ITEM}] [{ITEM}]", "no JSON", "", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(good + bad)], "i int, x string")
    got = {r.i: r.n for r in df.select("i", F.size(response_items(F.col("x"))).alias("n")).collect()}
    assert [got[i] for i in range(len(good))] == [1] * len(good)
    assert all(got[i + len(good)] in (None, -1) for i in range(len(bad)))


def test_last_answers_are_parsed_once(spark):
    """The items, read twice to find and to look up the last one, are not parsed twice."""
    from taxoweave.operators import responses

    rows = [(1, '[{"transaction_id": 7, "l4": "a"}, {"transaction_id": 7, "l4": "b"}]', None), (2, '[{"transaction_id": 7, "l4": "c"}]', None)]
    answered = spark.createDataFrame(rows, "batch_no bigint, response string, error string")
    found = responses.last_per_id(responses.explode_items(responses.parse_responses(answered)))
    assert [(r.transaction_id, r.batch_no, r.item_no, r.l4) for r in found.collect()] == [(7, 2, 0, "c")]
    assert "from_json" not in found._jdf.queryExecution().executedPlan().toString().lower()
