import hashlib
import re

from pyspark.sql import functions as F

from taxoweave.llm import exact_dedup, queries

SCHEMA = "doc_id long, text string, hashes string, keep_id int"
LONG = "".join(f"sentence number {i}, with words. " for i in range(5000))


def brute(rows):
    norm = [(i, re.sub("[ \t-\r]+", " ", t or "")) for i, t in rows]
    out = []
    for i, n in norm:
        ids = [j for j, m in norm if m == n and j is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, sum(m == n for _, m in norm), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [
    (5, "a b"), (3, "a\t\x0b b"), (9, " a b"), (4, None), (2, ""), (8, LONG), (7, LONG.replace(" ", "\n\n")),
    (6, LONG + "x"), (1, "x" * 50_000), (10, "x" * 50_000), (11, "x" * 49_999), (10, "x" * 50_000), (12, "é b"),
    (None, "a b"), (None, "only here"), (13, "𝔘.𝔘" * 3000), (14, "𝔘.𝔘" * 3000), (15, " "), (16, "\t \r"),
]


def result(spark, rows):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)
    got = exact_dedup.exact_groups(df)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_groups_equal_brute_force(spark):
    assert result(spark, ROWS) == brute(ROWS)


def test_hash_clashes_are_verified(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda c: F.length(c).cast("long"))
    assert result(spark, ROWS) == brute(ROWS)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_chunks_join_to_the_text_and_resynchronise(spark):
    df = spark.createDataFrame([(LONG,), ("new start " + LONG,), ("y" * 20_000,)], "t string")
    cut = [r[0] for r in df.select(exact_dedup.chunks(F.col("t"))).collect()]
    assert ["".join(c) for c in cut] == [LONG, "new start " + LONG, "y" * 20_000]
    assert len(set(cut[0]) & set(cut[1])) > 0.5 * len(cut[0])
    assert max(map(len, cut[2])) <= exact_dedup.MAX_CHUNK


def test_drop_keeps_all_columns(spark):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in ROWS], SCHEMA)
    kept = exact_dedup.drop_exact_copies(df)
    assert kept.columns == df.columns
    want = sorted((i for i, _, _, keep, _ in brute(ROWS) if keep or i is None), key=str)
    assert sorted((r[0] for r in kept.collect()), key=str) == want


def test_query_reads_every_document(spark, folder):
    got = queries.op5_exact_dedup(spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
