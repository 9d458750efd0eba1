import math
import random

import numpy as np
import pytest

from taxoweave.llm import queries, topk

SCHEMA = "vec_id long, embedding array<float>, score string, rank string, shard int"


def brute(rows, k):
    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in good:
        if i % 100 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def table(n=1500, dim=5, seed=0):
    rng = random.Random(seed)
    common = [0.5] * dim
    rows = [(i, common if rng.random() < 0.3 else [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    rows += [(-100, rows[1][1]), (7, rows[7][1]), (200, rows[3][1]), (None, common), (5000, None), (5100, [1.0] * (dim - 1) + [None]),
             (5200, [float("nan")] * dim), (5300, [float("-inf")] * dim), (5400, [1.0, 2.0]), (5401, [3.0, 4.0]), (5500, [9.0]), (5600, []), (5601, [])]
    return [(i, v, "x", "y", 3) for i, v in rows]


@pytest.mark.parametrize("points,block,k", [(8192, 256, 10), (100, 3, 10), (100, 4, 1), (50, 2, 3000)])
def test_equals_brute_force(spark, monkeypatch, points, block, k):
    monkeypatch.setattr(topk, "SHARD_POINTS", points)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", block)
    rows = table(400 if k > 100 else 1500)
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(df, df.where("vec_id % 100 = 0"), k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, k)


def test_boxes_are_tight_and_leaves_cover_all():
    rng = np.random.default_rng(0)
    points = rng.integers(-1000, 1000, (999, 4))
    tree = topk.build_tree(np.arange(999), points)
    assert sorted(tree["ids"].tolist()) == list(range(999))
    for (start, end, left, right), low, high in zip(tree["nodes"], tree["low"], tree["high"]):
        part = tree["points"][start:end]
        assert (part.min(axis=0) == low).all() and (part.max(axis=0) == high).all()
        assert left < 0 or tree["nodes"][left][1] == tree["nodes"][right][0]


def test_traversal_skips_points_that_cannot_win():
    rng = np.random.default_rng(1)
    points = rng.integers(-1000, 1000, (4000, 3))
    tree = topk.build_tree(np.arange(4000), points)
    seen = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                seen.append(key.stop - key.start)
            return super().__getitem__(key)

    whole = topk._exact
    try:
        topk._exact = lambda *a: [x.view(Counted) if i == 1 else x for i, x in enumerate(whole(*a))]
        got = topk.search_tree(tree, [-1], np.array([[3, -5, 2]]), [None], 5)
    finally:
        topk._exact = whole
    scores = points @ np.array([3, -5, 2])
    assert [s for *_, s in sorted(got, key=lambda r: (-r[2], r[1]))] == sorted(scores.tolist(), reverse=True)[:5]
    assert sum(seen) < 1000


def test_large_components_stay_exact():
    points = np.array([[2**40, 2**40 + 1], [2**40 + 1, 2**40 - 1]])
    got = topk.search_tree(topk.build_tree(np.array([1, 2]), points), [9], np.array([[2**20, 2**20 + 1]]), [None], 2)
    assert sorted(got) == [(9, i, int(p[0]) * 2**20 + int(p[1]) * (2**20 + 1)) for i, p in ((1, points[0]), (2, points[1]))]


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(df, df).collect() == []
    one = spark.createDataFrame([(100, [1.0], "", "", 1)], SCHEMA)
    assert topk.top_k(one, one).collect() == []


def test_query_equals_brute_force(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in queries.op1_topk(spark, folder).collect()) == brute(rows, 10)
