import random
from collections import defaultdict

import numpy as np
import pytest

from taxoweave.llm import near_dedup, queries

SCHEMA = "doc_id long, text string, id long, keys string, component string"


def brute(rows, k, percent):
    def words(text):
        return [w.decode() for w in (text or "").encode().lower().split()]

    sets = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] or "")):
        w = words(t)
        if i is not None:
            sets.setdefault(i, {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_shingle = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by_shingle[x].append(i)
    pairs = {(a, b) for ids in by_shingle.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    out = []
    for i, t in rows:
        w = words(t)
        n = len({tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))}) if w else 0
        out.append((i, n, None if i is None else root(i), i is None or root(i) == i))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    rows, n = [], 100
    for _ in range(12):
        base = rng.choices(vocab, k=rng.choice([3, 20, 80, 200]))
        for _ in range(rng.randint(1, 14)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                text[rng.randrange(len(text))] = rng.choice(vocab)
            rows.append((n, rng.choice([" ", "\n ", "\t"]).join(text)))
            n += rng.randint(1, 3)
            if rng.random() < 0.2:
                base = text  # chains drift away from their start
    rows += [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "É a"), (8, "é a"), (9, "x" * 100_000), (10, "X" * 100_000), (11, "a " * 20_000)]
    return rows + [rows[5], rows[5], (None, rows[0][1]), (None, None)]


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, k, percent):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], SCHEMA)
    got = near_dedup.near_groups(df, k, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, k, percent)


def test_one_large_group_of_variants(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        text = list(base)
        text[rng.randrange(120)] = f"v{i}"
        rows.append((i, " ".join(text)))
    got = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1


def test_different_texts_under_one_id(spark):
    rows = [(1, "a b c d e f"), (1, "z y x w v u"), (2, "z y x w v u"), (3, "a b c d e f")]
    got = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (1, 1), (2, 2), (3, 1)]


def test_leftovers_hold_every_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "RARE", 2)
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(1)
    sets, component, odd = {}, {}, set()
    for family in range(4):
        base = [rng.randrange(10**6) for _ in range(60)]
        for _ in range(40):
            own = rng.choice([0, 2, 20])
            odd |= {len(sets)} if own == 20 else set()
            sets[len(sets)] = {*[s for s in base if rng.random() > 0.04], *[rng.randrange(10**6) for _ in range(own)], rng.randrange(30)}
    linked = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    for i in sets:
        component[i] = rng.choice([i, i % 3])
    members = [(i // 40, i, len(s), component[i]) for i, s in sets.items()]
    shingles = spark.createDataFrame([(i, x) for i, s in sets.items() for x in s], "id long, shingle long")
    got = {tuple(r) for r in near_dedup.leftovers(spark.createDataFrame(members, "bucket long, id long, n_shingles long, component long"), shingles, 80).collect()}
    want = {(a, b) for a, b in linked if component[a] != component[b]}
    assert want and want <= got
    # A quarter of its shingles to itself rules any link out.
    assert odd and not odd & {i for pair in got for i in pair}


def test_signature_estimates_similarity():
    factors = near_dedup.multipliers(400)
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 1500, np.uint64)
    a, b = near_dedup.min_max_signature(pool[:1000], factors), near_dedup.min_max_signature(pool[500:], factors)
    assert abs((a == b).mean() - 1 / 3) < 0.08


def test_empty_and_single(spark):
    assert near_dedup.near_groups(spark.createDataFrame([], SCHEMA)).collect() == []
    got = near_dedup.near_groups(spark.createDataFrame([(3, "a b")], "doc_id long, text string")).collect()
    assert [tuple(r) for r in got] == [(3, 1, 3, True)]


def test_drop_keeps_one_of_each_group(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], SCHEMA)
    kept = near_dedup.drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted((r[0] for r in kept.collect()), key=str) == sorted((i for i, _, _, keep in brute(rows, 5, 80) if keep), key=str)


def test_query_equals_brute_force(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op9_near_dedup(spark, folder).collect()), key=str) == brute(rows, 3, 85)
