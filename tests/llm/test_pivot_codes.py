import hashlib
import math
import random

import numpy as np
import pytest

from taxoweave.llm import pivot_codes, queries

SCHEMA = "vec_id long, embedding array<float>, label int, code string, v int, error string"


def brute(rows, parts=4, entries=256, rounds=4):
    kept = [(i, lab, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, lab, *_ in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for *_, v in kept), default=0) // parts)) * parts
    kept = [(i, lab, v + [0] * (width - len(v))) for i, lab, v in kept]
    size = width // parts
    cut = [[v[p * size:(p + 1) * size] for p in range(parts)] for *_, v in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][2]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p])) for p, x in enumerate(c)] for c in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, f in zip(cut, found) if f[p][1] == k]
                if mine:
                    books[p][k] = [sum(col) // len(mine) for col in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = assign()
    errors = [min(sum(d for d, _ in f), 2**63 - 1) for f in found]
    totals = {}
    for (_, lab, _), e in zip(kept, errors):
        totals[lab] = totals.get(lab, 0) + e
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), e, min(totals[lab], 2**63 - 1), digest) for (i, lab, _), f, e in zip(kept, found, errors)), key=str)


def table(n=300, dim=8, seed=0):
    rng = random.Random(seed)
    common = [0.25] * dim
    rows = [(i, common if rng.random() < 0.3 else [rng.gauss(0, 1) for _ in range(dim)], rng.choice([1, 1, 2, None])) for i in range(n)]
    rows += [(7, rows[1][1], 3), (7, rows[7][1], 1), (None, rows[2][1], 1), (None, None, 2), (900, None, 1), (901, [1.0] * (dim - 1) + [None], 1),
             (902, [float("nan")] * dim, 1), (903, [float("-inf")] * dim, 1), (904, [1.0, 2.0], 1), (905, [], None), (906, [0.5] * (dim + 1), 4)]
    return [(i, v, lab, "x", 3, "y") for i, v, lab in rows]


def result(df, **options):
    got = pivot_codes.compress(df, **options)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("entries,rounds,pivots", [(256, 4, 8), (16, 4, 3), (5, 2, 1), (1, 1, 4)])
def test_equals_brute_force(spark, entries, rounds, pivots):
    rows = table()
    got = result(spark.createDataFrame(rows, SCHEMA).repartition(3), entries=entries, rounds=rounds, pivots=pivots)
    assert got == brute(rows, entries=entries, rounds=rounds)


def test_huge_numbers_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([1e14, -1e14, 3e13]) * rng.random() for _ in range(4)], 1, "", 0, "") for i in range(60)]
    assert result(spark.createDataFrame(rows, SCHEMA), entries=8) == brute(rows, entries=8)


def test_empty_and_unusable_tables(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
    assert result(spark.createDataFrame([(1, None, 1, "", 0, "")], SCHEMA)) == []
    alone = [(None, [0.5], None, "", 0, "")]
    assert result(spark.createDataFrame(alone, SCHEMA)) == brute(alone)


def test_ties_go_to_the_lower_index():
    entries = np.array([[5, 0], [0, 5], [0, 5], [5, 0]], object)
    points = np.array([[0, 0], [5, 5], [0, 6]], np.int64)
    pivots = pivot_codes.choose_pivots(entries, 2)
    codes, errors, _ = pivot_codes.nearest(points, pivot_codes.to_pivots(points, pivots), entries, pivots)
    assert codes.tolist() == [0, 0, 1] and errors.tolist() == [25, 25, 1]


def test_bounds_spare_evaluations():
    rng = np.random.default_rng(0)
    centres = rng.integers(-4000, 4000, (64, 16))
    points = centres[rng.integers(0, 64, 3000)] + rng.integers(-50, 50, (3000, 16))
    entries = centres.astype(object)
    pivots = pivot_codes.choose_pivots(entries, 8)
    codes, errors, evaluated = pivot_codes.nearest(points, pivot_codes.to_pivots(points, pivots), entries, pivots)
    full = ((points[:, None, :] - centres) ** 2).sum(-1)
    assert (codes == full.argmin(1)).all() and (errors == full.min(1)).all()
    assert evaluated < full.size / 4


def test_query_equals_brute_force(spark, folder):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op13_pivot_codes(spark, folder).collect()), key=str)
    assert got == brute(rows)
