"""A few registered queries against their SQL at the smallest scale; the checker tool runs them all."""

import duckdb
import pytest

import __spark_entry__ as entry
from taxoweave.plans.fixtures import TABLES
from taxoweave.plans.registry import ORACLES, QUERIES
from tools.check_queries import rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", [
    "retrieve_candidates", "clean_transactions", "raw_results_csv", "validated_results", "accuracy_report",
    "merged_results", "store_upsert", "parsed_responses", "tfidf_terms", "nearest_labels", "svm_own_sentences", "level_flags",
])
def test_same_rows_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())


def test_every_query_but_training_has_sql():
    assert set(QUERIES) - set(ORACLES) == {"logistic_predictions", "svm_predictions", "cross_validated"}
