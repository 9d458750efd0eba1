"""Exact top-k search by inner product over KD-trees, one tree per shard of the vectors.

A tree halves its points at the median of the widest coordinate and keeps a
tight bounding box at every node. A box bounds the product of a query with any
point in it, so the traversal takes the most promising node first and stops
when no box can reach the kth best score. Queries travel in blocks: first each
block searches one shard; the kth score found there then goes with it to all
other shards, where most boxes fall below it.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, ship_package

SHARD_POINTS = 8_192
BLOCK_QUERIES = 256
LEAF_POINTS = 64
SCALE = 1024


def scaled(vector: str, scale: int = SCALE) -> Column:
    """Each component as the floor of ``scale`` times it; null for vectors that are null or hold null or non-finite components.

    Components beyond a long's range take its nearest bound.
    """
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(finite, F.transform(v, lambda x: F.floor(x * scale).cast("long")))


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def build_tree(ids: np.ndarray, points: np.ndarray, leaf: int = LEAF_POINTS) -> dict[str, np.ndarray]:
    """Points in the order of the tree's leaves, and its nodes: range of points, children, box."""
    order = np.arange(len(ids))
    nodes: list[tuple[int, int, int, int]] = []
    low, high = [], []
    todo = [(0, len(ids), -1, 0)]
    while todo:
        start, end, parent, side = todo.pop()
        number = len(nodes)
        if parent >= 0:
            a, b, left, right = nodes[parent]
            nodes[parent] = (a, b, number, right) if side == 0 else (a, b, left, number)
        part = points[order[start:end]]
        lo, hi = part.min(axis=0), part.max(axis=0)
        nodes.append((start, end, -1, -1))
        low.append(lo)
        high.append(hi)
        width = hi.astype(float) - lo.astype(float)
        if end - start > leaf and width.size and width.max() > 0:
            axis = int(width.argmax())
            middle = (end - start) // 2
            split = np.argpartition(part[:, axis], middle)
            order[start:end] = order[start:end][split]
            todo += [(start, start + middle, number, 0), (start + middle, end, number, 1)]
    return {"ids": ids[order], "points": points[order], "nodes": np.array(nodes, np.int64), "low": np.array(low), "high": np.array(high)}


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays in a type that holds their products exactly: doubles if all stay below 2**53, else whole numbers."""
    largest = [float(np.abs(a.astype(float)).max(initial=0)) for a in arrays]
    dim = arrays[0].shape[1]
    safe = largest[0] * max(largest[1:], default=0) * max(dim, 1) < 2**52 and max(largest) < 2**52
    return [a.astype(float if safe else object) for a in arrays]


def search_tree(tree: dict[str, np.ndarray], query_ids: list[int], queries: np.ndarray, floors: list[int | None], k: int) -> list[tuple[int, int, int]]:
    """``(query, id, score)``: the ``k`` best of a tree for each query, of equal scores the smaller ids.

    Points below a query's floor are left out, and so is the query's own id.
    """
    q, points, low, high = _exact(queries, tree["points"], tree["low"], tree["high"])
    ids, nodes = tree["ids"], tree["nodes"].tolist()
    bounds = high @ np.where(q > 0, q, 0 * q).T + low @ np.where(q < 0, q, 0 * q).T
    out = []
    for column, (own, floor) in enumerate(zip(query_ids, floors)):
        bound, vector = bounds[:, column], q[column]
        best: list[tuple[int, int]] = []
        heap = [(-bound[0], 0)]
        while heap:
            value, number = heapq.heappop(heap)
            if floor is not None and -value < floor:
                break
            start, end, left, right = nodes[number]
            if left >= 0:
                heapq.heappush(heap, (-bound[left], left))
                heapq.heappush(heap, (-bound[right], right))
                continue
            scores = points[start:end] @ vector
            for at in range(len(scores)) if floor is None else np.flatnonzero(scores >= floor):
                entry = (int(scores[at]), -int(ids[start + at]))
                if entry[1] == -own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                floor = best[0][0] if floor is None else max(floor, best[0][0])
        out += [(own, -i, max(-(1 << 63), min((1 << 63) - 1, s))) for s, i in best]
    return out


def shard_trees(vectors: DataFrame, shards: int) -> DataFrame:
    """``dim``, ``shard``, ``tree``: a packed tree for each shard of vectors ``vec_id``, ``v`` of one length."""
    def build(part: pd.DataFrame) -> pd.DataFrame:
        dim = int(part["dim"].iloc[0])
        points = np.array(part["v"].tolist(), np.int64).reshape(len(part), dim)
        tree = build_tree(part["vec_id"].to_numpy(np.int64), points)
        return pd.DataFrame({"dim": [dim], "shard": [int(part["shard"].iloc[0])], "tree": [_pack(**tree)]})

    sharded = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("long"))
    return sharded.groupBy("dim", "shard").applyInPandas(build, "dim int, shard long, tree binary")


def _search(asked: DataFrame, trees: DataFrame, k: int) -> DataFrame:
    """Search ``asked`` (``dim``, ``block``, ``shard``, ``queries``) in the trees of their shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                with np.load(io.BytesIO(batch.column(0)[row].as_py())) as packed:
                    tree = dict(packed)
                queries = batch.column(1)[row].as_py()
                vectors = np.array([x["v"] for x in queries], np.int64).reshape(len(queries), -1)
                found = search_tree(tree, [x["vec_id"] for x in queries], vectors, [x["floor"] for x in queries], k)
                columns = list(zip(*found)) if found else [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    return asked.join(trees, ["dim", "shard"]).select("tree", "queries").mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each query the ``k`` vectors of the largest inner product.

    Both tables have ``id_col`` and ``vector_col``; scores are of whole numbers,
    see :func:`scaled`. A query's own id is no candidate; candidates of another
    length aren't either. Ties go to the smaller id. Fewer candidates than ``k``
    give fewer rows. Rows without an id or with an unusable vector take no part;
    repeated candidates are ranked each for itself, repeated query ids are asked
    once, with the smallest vector. Other columns are ignored.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    usable = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled(vector_col).alias("v")).where("vec_id is not null and v is not null").withColumn("dim", F.size("v"))
    asked = queries.select(F.col(id_col).cast("long").alias("vec_id"), scaled(vector_col).alias("v")).where("vec_id is not null and v is not null")
    asked = settle(asked.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v")), "queries")
    shards = max(1, -(-usable.count() // SHARD_POINTS))
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    trees = settle(shard_trees(usable, shards), "trees")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("long"))
    home = F.pmod(F.col("block"), F.lit(shards))

    def gathered(rows: DataFrame) -> DataFrame:
        return rows.groupBy("dim", "block").agg(F.collect_list(F.struct("vec_id", "v", "floor")).alias("queries"))

    first = settle(_search(gathered(asked.withColumn("floor", F.lit(None).cast("long"))).withColumn("shard", home), trees, k), "first")
    floors = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
    floored = asked.join(floors.select(F.col("query_id").alias("vec_id"), F.col("kth").alias("floor")), "vec_id", "left")
    others = gathered(floored).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))).where(F.col("shard") != home)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = first.unionByName(_search(others, trees, k)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


#: The rows of op1_topk in DuckDB.
TOPK_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
