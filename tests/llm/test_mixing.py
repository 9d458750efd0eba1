import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxoweave.llm import mixing, queries

SCHEMA = "doc_id long, source string, text string, words string, row int, block string"


def brute_targets(sizes):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, target, open_ = mixing.SHARE * sum(sizes.values()), dict.fromkeys(order, 0.0), set(order)
    while open_ and left > 1e-9:
        level = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            target[s] += level * weight[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def corpus(n=400, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 6 + ["b", "c", "\U0001D518", "￿", None, "", "small"])
        size = rng.choice([0, 1, 5, 40, 300, 1000]) if source != "small" else rng.randint(0, 2)
        rows.append((i, source, " \n".join(f"w{k}" for k in range(size)), "x", 1, "y"))
    return rows + [(1000, "b", None, "x", 1, "y"), (2000, "b", "twice the id", "x", 1, "y"), (2000, "b", "twice the id", "x", 1, "y"), (None, "c", "no id here", "x", 1, "y")]


def test_targets_and_taken_words(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mixed_sizes(df).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, s, t, *_ in rows:
        sizes[s] += len(re.findall("[^ \t-\r]+", t or ""))
    want = brute_targets(sizes)
    source = {i: s for i, s, *_ in rows}
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        assert 0 <= r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6
    again = mixing.mixed_sizes(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_shards_of_documents_are_those_of_their_draws(spark, monkeypatch):
    rows = [(i, "ab"[i % 2], "some words " * (1 + 40 * i), "x", 1, "y") for i in range(60)] + [(60, "a", " ", "x", 1, "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = mixing.mix
    monkeypatch.setattr(mixing, "mix", lambda sized: whole(sized, shard_draws=64))
    got = {r.doc_id: r.shards for r in mixing.mixed_sizes(df).collect()}
    want = defaultdict(set)
    for r in mixing.mixed_documents(df).collect():
        want[r.doc_id].add(r.mix_shard)
    assert got == {i: sorted(want[i]) for i in range(61)}
    assert len(set().union(*want.values())) > 3 and got[60] == []


def test_draws_are_disjoint_and_shards_even(spark):
    rows = [(i, s, z) for i, (s, z) in enumerate([("a", 900), ("b", 70), ("c", 3), ("a", 2000), ("b", 0)] * 20)]
    sized = spark.createDataFrame([(i, i, s, z) for i, s, z in rows], "row long, id long, source string, size long")
    draws, _ = mixing.mix(sized, block_words=32, shard_draws=100)
    got = draws.collect()
    assert len({(r.row, r.block, r["pass"]) for r in got}) == len(got)
    assert max(Counter((r.row, r.block) for r in got).values()) <= 2
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r.order)
    assert len(shards) > 20 and max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    assert all(sorted(o) == list(range(len(o))) for o in shards.values())


def test_tree_keeps_quotas_and_deals_them_evenly(spark):
    quotas = {0: 5000, 1: 1, 2: 300, 3: 0, 4: 77}
    df = spark.createDataFrame(list(quotas.items()), "place int, quota long")
    total = sum(quotas.values())
    dealt = mixing.splitting_tree(df, 7, total).collect()
    assert {p: sum(r.draws for r in dealt if r.place == p) for p in quotas} == quotas
    per_shard = Counter()
    for r in dealt:
        per_shard[r.shard] += r.draws
    assert max(per_shard.values()) - min(per_shard.values()) <= 1 and len(per_shard) == 7
    hot = np.array([r.draws for r in dealt if r.place == 0])
    assert abs(hot - 5000 / 7).max() < 6 * np.sqrt(5000 / 7 * 0.07) + 3


def test_hypergeometric_follows_its_distribution(spark):
    for total, marked, drawn in [(20, 7, 9), (1000, 400, 333), (50, 50, 20), (10, 1, 1), (2_000_000, 700_000, 900_000)]:
        x = spark.range(3000).select(mixing.hypergeometric(
            *[F.lit(v).cast("long") for v in (total, marked, drawn)], (F.col("id") + 0.5) / 3000).alias("x")).toPandas().x
        mean = drawn * marked / total
        var = mean * (1 - marked / total) * (total - drawn) / max(total - 1, 1)
        assert abs(x.mean() - mean) <= 0.02 * max(var, 1e-9) ** 0.5 + 1e-9
        assert abs(x.var() - var) <= 0.03 * var + 1e-9
        assert x.max() <= min(marked, drawn) and x.min() >= max(0, drawn + marked - total)
        assert x.is_monotonic_increasing


def test_mixed_documents(spark):
    rows = corpus(120)
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mixed_documents(df).collect()
    words = Counter()
    for r in got:
        words[r.doc_id] += len((r.text or "").split())
    want = Counter()
    for r in mixing.mixed_sizes(df).collect():
        want[r.doc_id] += r.taken
    assert words == +want
    texts = defaultdict(list)
    for i, _, t, *_ in rows:
        texts[i].append(t or "")
    assert all(any(r.text in t or r.text.split() == t.split()[t.split().index(r.text.split()[0]):][:len(r.text.split())] for t in texts[r.doc_id]) for r in got)


def test_blocks_join_to_the_text(spark):
    texts = ["", " ", " a  b ", "w " * 1000, "\t" + "x" * 100_000 + " y"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", mixing.block_texts(F.col("t")).alias("b")).collect()
    assert all("".join(r.b) == (r.t if r.t.strip() else "") for r in got)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mixed_sizes(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []
    blank = spark.createDataFrame([(1, None, None, "", 1, ""), (2, "a", " ", "", 1, "")], SCHEMA)
    assert [r.taken for r in mixing.mixed_sizes(blank).collect()] == [0, 0]
    assert mixing.mixed_documents(blank).collect() == []


def test_query_takes_every_document(spark, folder):
    got = queries.op3_mixing(spark, folder)
    assert got.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
