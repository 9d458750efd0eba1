import math
import random

import numpy as np
import pytest

from taxoweave.llm import graph_dedup, queries

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, rep string, shard int"


def brute(rows, cosine=0.93):
    linked = {}
    usable = []
    for k, (i, v, label, *_) in enumerate(rows):
        linked[k] = set()
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            usable.append((k, label, x / np.abs(x).max()))
    for p, (j, label, x) in enumerate(usable):
        for k, other, y in usable[p + 1:]:
            if label == other and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                linked[j].add(k)
                linked[k].add(j)
    out, component = [], {}
    for k in linked:
        if k not in component:
            todo, group = [k], {k}
            while todo:
                for x in linked[todo.pop()] - group:
                    group.add(x)
                    todo.append(x)
            ids = [rows[x][0] for x in group if rows[x][0] is not None]
            component |= dict.fromkeys(group, min(ids, default=None))
        out.append((rows[k][0], len(linked[k]), component[k], rows[k][0] == component[k]))
    return sorted(out, key=str)


def cluster(rng, n, dim, spread):
    centre = rng.normal(size=dim)
    return [(centre / np.linalg.norm(centre) + spread * rng.normal(size=dim) / math.sqrt(dim)).tolist() for _ in range(n)]


def table(seed=0, dim=16):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(300, dim)).tolist() + cluster(rng, 250, dim, 0.15) + cluster(rng, 120, dim, 0.3) + cluster(rng, 60, dim, 0.02)
    for n in range(2, 30):
        vectors += cluster(rng, n, dim, 0.25)
    vectors += [vectors[0]] * 40 + [vectors[310]] * 25
    order = random.Random(seed)
    order.shuffle(vectors)
    rows = [(i, v, order.choice([1, 1, 1, 2, 3])) for i, v in enumerate(vectors)]
    same = rows[1][1]
    rows += [(5, same, 1), (5, same, 1), (7, rows[9][1], 1), (None, same, 1), (None, None, 1), (2001, same, None), (2002, same, None), (2003, None, 1),
             (2004, [0.0] * dim, 1), (2005, [0.0] * dim, 1), (2006, same[:-1] + [None], 1), (2007, same[:-1] + [float("nan")], 1), (2008, [float("inf")] * dim, 1),
             (2009, [], 1), (2010, [], 1), (2011, [1.0, 2.0], 1), (2012, [2.0, 4.0], 1), (2013, [-x for x in same], 1), (2014, [3e38] * dim, 1), (2015, [2e-38] * dim, 1)]
    return [(*r, "x", "y", 2) for r in rows]


def result(df, **options):
    got = graph_dedup.near_vectors(df, **options)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("shard,slot,cosine", [(4096, 16384, 0.93), (150, 64, 0.93), (60, 1000, 0.8)])
def test_equals_brute_force(spark, monkeypatch, shard, slot, cosine):
    monkeypatch.setattr(graph_dedup, "SHARD_POINTS", shard)
    monkeypatch.setattr(graph_dedup, "SLOT_QUERIES", slot)
    rows = table()
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(3), cosine=cosine) == brute(rows, cosine)


def test_empty_and_unusable_tables(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
    rows = [(1, None, 1, "", "", 0), (None, [1.0], None, "", "", 0), (3, [1.0], 2, "", "", 0)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def shard_of(vectors, cosine=0.93, copies=None):
    n = len(vectors)
    return graph_dedup.Shard.build(np.arange(n), np.ones(n, np.int64) if copies is None else copies, vectors, math.acos(cosine))


def test_members_of_a_ball_are_linked_and_walks_are_short():
    rng = np.random.default_rng(1)
    vectors = np.array(rng.normal(size=(2500, 24)).tolist() + [v for _ in range(40) for v in cluster(rng, 25, 24, 0.1)])
    shard = shard_of(vectors)
    for start, size in zip(shard.starts, shard.sizes):
        part = shard.vectors[start:start + size]
        assert (part @ part.T).min() >= 0.93
    queries = graph_dedup.unit(vectors[-1000:])
    _, _, seen = shard.layers.walk(0, queries.astype(np.float32), shard.layers.descend(queries.astype(np.float32), 0, 12), graph_dedup.BEAM)
    assert (seen > graph_dedup.UNSEEN).mean() < 0.5
    true = queries.astype(np.float32) @ shard.layers.points.T >= shard.reach
    assert ((seen >= shard.reach) & true).sum() >= 0.99 * true.sum()


def test_audits_widen_beams_that_miss():
    """A graph without most of its links still answers, for its audits fail until the beam covers it."""
    rng = np.random.default_rng(2)
    vectors = np.array([v for _ in range(60) for v in cluster(rng, 10, 24, 0.35)])
    shard = shard_of(vectors)
    for links in shard.layers.links:
        links[:, 2:] = -1
    queries = graph_dedup.unit(vectors)
    counts, *_ = shard.ask(queries, np.arange(len(vectors)))
    cosines = queries @ queries.T >= 0.93
    assert shard.walked > 2 and counts.sum() >= 0.97 * (cosines.sum() - len(vectors))


def test_pairs_stay_inside_tasks(spark):
    """Rows between stages grow with the vectors, not with the pairs of a group."""
    rng = np.random.default_rng(3)
    rows = [(i, v, 1, "", "", 0) for i, v in enumerate(cluster(rng, 800, 16, 0.2))]
    nodes = spark.createDataFrame([(i, 1, 16, [float(x) for x in v], 1, 1, i) for i, v, *_ in rows], "node long, label int, dim int, v array<double>, copies long, shards long, rep long").withColumns(
        {"rows": graph_dedup.F.lit(800).cast("long")})
    graphs = graph_dedup.shard_graphs(nodes, math.acos(0.93)).select("label", "dim", "shard", "graph").withColumn("rows", graph_dedup.F.lit(800).cast("long"))
    found = graph_dedup.ask_all(nodes, graphs).collect()
    assert sum(r.n is not None for r in found) == 800 and sum(r.n or 0 for r in found) > 100_000
    assert len(found) < 800 * 12


def test_query_equals_brute_force(spark, folder):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op11_near_vectors(spark, folder).collect()), key=str) == brute(rows)
