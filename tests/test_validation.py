from taxoweave.operators import validation as V
from taxoweave.operators.cleaning import flag_duplicates

LEAVES = [("A", "B", "C", "D"), ("A", "B", "C", "E"), ("F", "G", "H", "I")]
ANSWERS = [("A", "B", "C", "D"), ("A", "B", "C", "I"), ("A", None, "C", "D"), ("A", "C", None, "D"), (None, None, None, None), ("a", "B", "C", "D"),
           ("F", "G", "H", None), ("A", "B", "C", "D"), ('A"', "B,", "", "D"), ("F", "", "H", "I")]
FLAGS = ["l1_valid", "l2_valid", "l3_valid", "l4_valid", "full_path_valid"]


def test_level_flags_by_broadcast_and_by_distinct_answers(spark):
    taxonomy = spark.createDataFrame(LEAVES, "L1 string, L2 string, L3 string, L4 string")
    results = spark.createDataFrame([(i, *a) for i, a in enumerate(ANSWERS)], "id bigint, l1 string, l2 string, l3 string, l4 string")
    prefixes = {leaf[:d] for leaf in LEAVES for d in range(1, 5)}
    want = [(i, *(a[:d] in prefixes for d in (1, 2, 3, 4, 4))) for i, a in enumerate(ANSWERS)]
    for bounded in (True, False, None):
        got = V.level_flags(results, taxonomy, bounded=bounded)
        assert sorted(got.columns) == sorted([*results.columns, *FLAGS])
        assert sorted(tuple(r) for r in got.select("id", *FLAGS).collect()) == want
        assert V.level_flags(results.limit(0), taxonomy, bounded=bounded).collect() == []


def test_broadcasts_are_measured_in_rows_and_characters(spark):
    taxonomy = spark.createDataFrame(LEAVES, "L1 string, L2 string, L3 string, L4 string")
    assert V.fits_broadcast(taxonomy) and V.fits_broadcast(taxonomy.limit(0))
    assert not V.fits_broadcast(taxonomy, most_rows=2)
    assert V.fits_broadcast(taxonomy, most_chars=12) and not V.fits_broadcast(taxonomy, most_chars=11)


def test_duplicates_without_ids(spark):
    rows = [(2, "x", "v"), (1, "x", "v"), (None, "x", "v"), (None, "y", None), (None, "y", None), (None, "z", "v"), (3, None, None), (None, None, None), (4, "w", "v")]
    got = flag_duplicates(spark.createDataFrame(rows, "transaction_id bigint, spend_description string, vendor string")).collect()
    assert len(got) == len(rows)
    kept = sorted((str(r.transaction_id), str(r.spend_description)) for r in got if not r.is_duplicate)
    assert kept == [("1", "x"), ("3", "None"), ("4", "w"), ("None", "y"), ("None", "z")]
