"""Near-duplicate vectors by hierarchical navigable small-world graphs, one graph per shard.

Vectors of a label are dealt to shards of bounded size. A shard first gathers
vectors that are so close to a leader that all of them are linked with one
another into a ball; its graph holds the leaders. Every vector asks every shard
of its label. Its beam widens until an audit of sampled queries against all
leaders finds enough of them. A ball whose farthest member must be linked, by
the angles, counts as a whole; of other balls every member's cosine is taken in
double precision.

No pairs leave a task: a query returns how many vectors it is linked with, and
which of a shard's own components it joins.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_key_join
from .common import settle, ship_package
from .near_dedup import components

SHARD_POINTS = 4_096
#: Queries that share one copy of a graph, and queries that walk it together.
SLOT_QUERIES = 16_384
TOGETHER = 512
#: Links of a node in the upper layers and in the lowest; width of the beam while building, and at first while asking.
LINKS, LOWEST_LINKS = 12, 24
BUILD_BEAM, BEAM = 48, 32
#: Points inserted together, and candidates among which a node's links are chosen.
BATCH, CANDIDATES = 128, 48
#: Queries of each audit, and the share of the leaders in reach that a beam must have found.
AUDITED, RECALL = 32, 0.99
#: Radius of a ball as a share of the linking angle; below a half, all of a ball's members are linked.
BALL = 0.45
#: Cosines come in single precision from a walk, angles in double precision from arc cosines.
WALK_SLACK, ANGLE_SLACK = 1e-4, 1e-6
UNSEEN = np.float32(-2)
SEED = 11


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one; none may be zero."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


class Layers:
    """A navigable small-world graph of unit vectors in layers; each layer holds a sample of the one below it."""

    def __init__(self, points: np.ndarray, links: list[np.ndarray], entry: int) -> None:
        self.points, self.links, self.entry = points, links, entry

    def walk(self, layer: int, queries: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``ids`` and ``values`` of each query's beam after all its nodes were expanded, and the cosines of all nodes seen."""
        n, links = len(queries), self.links[layer]
        seen = np.full((n, len(self.points)), UNSEEN)
        ids = np.full((n, width), -1, np.int64)
        values = np.full((n, width), UNSEEN)
        closed = np.ones((n, width), bool)
        take = min(entries.shape[1], width)
        ids[:, :take] = entries[:, :take]
        at = ids[:, :take] >= 0
        rows, columns = np.nonzero(at)
        values[rows, columns] = np.einsum("ij,ij->i", queries[rows], self.points[ids[rows, columns]])
        seen[rows, ids[rows, columns]] = values[rows, columns]
        closed[rows, columns] = False
        active = np.arange(n)
        while True:
            waiting = np.where(closed[active], UNSEEN, values[active])
            pick = waiting.argmax(axis=1)
            live = waiting[np.arange(len(active)), pick] > UNSEEN
            active, pick = active[live], pick[live]
            if not len(active):
                return ids, values, seen
            closed[active, pick] = True
            near = links[ids[active, pick]]
            fresh = near >= 0
            fresh[fresh] = (seen[active[:, None], near] == UNSEEN)[fresh]
            r, c = np.nonzero(fresh)
            found = np.full(near.shape, UNSEEN)
            found[r, c] = np.einsum("ij,ij->i", queries[active[r]], self.points[near[r, c]])
            seen[active[r], near[r, c]] = found[r, c]
            # Only queries that saw something better than their beam's end change.
            better = found.max(axis=1) > values[active].min(axis=1)
            rows = active[better]
            all_values = np.concatenate([values[rows], found[better]], axis=1)
            best = np.argpartition(-all_values, width - 1, axis=1)[:, :width]
            values[rows] = np.take_along_axis(all_values, best, axis=1)
            ids[rows] = np.take_along_axis(np.concatenate([ids[rows], near[better]], axis=1), best, axis=1)
            closed[rows] = np.take_along_axis(np.concatenate([closed[rows], found[better] == UNSEEN], axis=1), best, axis=1)

    def descend(self, queries: np.ndarray, to_layer: int, width: int) -> np.ndarray:
        """The best nodes of the layer above ``to_layer``, to enter it by."""
        entries = np.full((len(queries), 1), self.entry, np.int64)
        for layer in range(len(self.links) - 1, to_layer, -1):
            ids, values, _ = self.walk(layer, queries, entries, width)
            entries = np.take_along_axis(ids, np.argsort(-values, axis=1), axis=1)
        return entries

    def choose(self, base: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
        """For each base vector ``count`` of its candidates (-1: none): the near ones, first those nearer to it than to one chosen before."""
        values = np.where(ids >= 0, np.einsum("ij,ikj->ik", base, self.points[ids]), UNSEEN)
        order = np.argsort(-values, axis=1, kind="stable")[:, :CANDIDATES]
        ids, values = np.take_along_axis(ids, order, axis=1), np.take_along_axis(values, order, axis=1)
        vectors = self.points[ids]
        among = vectors @ vectors.transpose(0, 2, 1)
        nearest = np.full(ids.shape, UNSEEN)
        kept = np.zeros(ids.shape, bool)
        for c in range(ids.shape[1]):
            good = (ids[:, c] >= 0) & (values[:, c] > nearest[:, c]) & (kept.sum(axis=1) < count)
            kept[good, c] = True
            nearest[good] = np.maximum(nearest[good], among[good, c])
        rank = np.where(kept, 0, np.where(ids >= 0, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
        first = np.argsort(rank, axis=1)[:, :count]
        out = np.full((len(ids), count), -1, np.int64)
        out[:, : first.shape[1]] = np.take_along_axis(ids, first, axis=1)
        return out

    def insert(self, new: np.ndarray, levels: np.ndarray, beams: np.ndarray) -> None:
        """Link the nodes ``new``, whose points are set, into all layers up to their levels; ``beams`` is what they see in the lowest."""
        base = self.points[new]
        top = len(self.links) - 1
        for layer in range(int(levels.max()), -1, -1):
            mine = levels >= layer
            rows = new[mine]
            if layer == 0:
                found = beams
            elif layer <= top:
                entries = self.descend(base[mine], layer, LINKS)
                found, _, _ = self.walk(layer, base[mine], entries, BUILD_BEAM)
            else:
                found = np.empty((len(rows), 0), np.int64)
            while len(self.links) <= layer:
                self.links.append(np.full((len(self.points), LINKS if self.links else LOWEST_LINKS), -1, np.int64))
            peers = np.tile(rows, (len(rows), 1))
            peers[np.arange(len(rows)), np.arange(len(rows))] = -1
            links = self.links[layer]
            links[rows] = self.choose(base[mine], np.concatenate([found, peers], axis=1), links.shape[1])
            # Back links: nodes that were named choose anew among their links and those who named them.
            r, c = np.nonzero(links[rows] >= 0)
            named, by = links[rows][r, c], rows[r]
            order = np.argsort(named, kind="stable")
            named, by = named[order], by[order]
            unique, start, count = np.unique(named, return_index=True, return_counts=True)
            fresh = np.full((len(unique), int(count.max(initial=0))), -1, np.int64)
            fresh[np.repeat(np.arange(len(unique)), count), np.arange(len(named)) - np.repeat(start, count)] = by
            fresh[(fresh[:, :, None] == links[unique][:, None, :]).any(axis=2)] = -1
            links[unique] = self.choose(self.points[unique], np.concatenate([links[unique], fresh], axis=1), links.shape[1])
        if levels.max() > top or self.entry < 0:
            self.entry = int(new[levels.argmax()])


class Shard:
    """Balls of near vectors and the graph of their leaders.

    Members of a ball lie together, ``starts`` has each ball's first, its
    leader. ``angle`` is the greatest one at which vectors are linked.
    """

    def __init__(self, angle: float, vectors: np.ndarray, nodes: np.ndarray, copies: np.ndarray, starts: np.ndarray, radius: np.ndarray, layers: Layers) -> None:
        self.angle, self.vectors, self.nodes, self.copies, self.starts, self.radius, self.layers = angle, vectors, nodes, copies, starts, radius, layers
        self.sizes = np.diff(np.append(starts, len(nodes)))
        self.weights = np.add.reduceat(copies, starts)
        self.ball_of = np.repeat(np.arange(len(starts)), self.sizes)
        self.sorted = np.argsort(nodes)
        self.reach = np.float32(math.cos(min(math.pi, (1 + BALL) * angle)) - WALK_SLACK)
        self.reps = np.empty(0, np.int64)
        self.walked = 0

    @staticmethod
    def build(nodes: np.ndarray, copies: np.ndarray, vectors: np.ndarray, angle: float) -> Shard:
        """Deal vectors to balls, batch by batch, and insert the leaders into the graph."""
        n = len(nodes)
        exact, single = unit(vectors), unit(vectors).astype(np.float32)
        layers = Layers(np.zeros(single.shape, np.float32), [], -1)
        level = np.floor(-np.log(1 - np.random.default_rng(SEED).random(n)) / math.log(LINKS)).astype(np.int64)
        within = math.cos(BALL * angle)
        owner = np.zeros(n, np.int64)  # the number of each vector's ball
        leaders: list[int] = []
        for start in range(0, n, BATCH):
            batch = np.arange(start, min(n, start + BATCH))
            open_ = np.ones(len(batch), bool)
            ids = np.empty((len(batch), 0), np.int64)
            if leaders:
                ids, values, _ = layers.walk(0, single[batch], layers.descend(single[batch], 0, LINKS), BUILD_BEAM)
                best = ids[np.arange(len(batch)), values.argmax(axis=1)]
                near = np.einsum("ij,ij->i", exact[batch], exact[np.array(leaders)[best]]) >= within
                owner[batch[near]] = best[near]
                open_ = ~near
            rest = batch[open_]
            among = exact[rest] @ exact[rest].T
            first = len(leaders)
            chosen: list[int] = []
            for k in range(len(rest)):
                close = [c for c in chosen if among[k, c] >= within]
                if close:
                    owner[rest[k]] = first + chosen.index(max(close, key=lambda c: among[k, c]))
                else:
                    owner[rest[k]] = first + len(chosen)
                    chosen.append(k)
            if chosen:
                added = rest[chosen]
                leaders += added.tolist()
                new = np.arange(first, len(leaders))
                layers.points[new] = single[added]
                layers.insert(new, level[added], ids[open_][chosen])
        order = np.lexsort([np.arange(n), owner])  # a ball's leader came before its other members
        starts = np.searchsorted(owner[order], np.arange(len(leaders)))
        cosines = np.clip(np.einsum("ij,ij->i", exact, exact[np.array(leaders)[owner]]), -1, 1)
        radius = np.maximum.reduceat(np.arccos(cosines)[order], starts)
        radius[np.diff(np.append(starts, n)) == 1] = 0
        layers.points = layers.points[: len(leaders)]
        layers.links = [x[: len(leaders)] for x in layers.links]
        shard = Shard(angle, exact[order], nodes[order], copies[order], starts, radius, layers)
        shard.reps = shard._local_components()
        return shard

    def _local_components(self) -> np.ndarray:
        """For each ball the smallest leader's node among balls that leaders' links connect within this shard."""
        heads = self.nodes[self.starts]
        pairs = []
        for start in range(0, len(heads), TOGETHER):
            rows = np.arange(start, min(len(heads), start + TOGETHER))
            _, row, ball = self.ask(self.vectors[self.starts[rows]], heads[rows])
            pairs.append((rows[row], ball))
        a, b = (np.concatenate(x) for x in zip(*pairs))
        labels = heads.copy()
        while True:
            before = labels.copy()
            np.minimum.at(labels, a, before[b])
            np.minimum.at(labels, b, before[a])
            if (labels == before).all():
                return labels

    def _beams(self, queries: np.ndarray) -> np.ndarray:
        """Cosines of the queries with the leaders seen, after beams wide enough for the audits."""
        single = queries.astype(np.float32)
        seen = np.full((len(queries), len(self.starts)), UNSEEN)
        todo, width = np.arange(len(queries)), BEAM
        while len(todo):
            if width >= len(self.starts):
                seen[todo] = single[todo] @ self.layers.points.T
                break
            _, values, seen[todo] = self.layers.walk(0, single[todo], self.layers.descend(single[todo], 0, LINKS), width)
            self.walked += 1
            hit = (seen[todo] >= self.reach).any(axis=1)
            audited = np.concatenate([np.flatnonzero(x)[:: max(1, x.sum() // (AUDITED // 2))][: AUDITED // 2] for x in (hit, ~hit)])
            true = single[todo[audited]] @ self.layers.points.T >= self.reach
            found = (seen[todo[audited]] >= self.reach) & true
            if found.sum() >= RECALL * true.sum():
                todo = todo[values.min(axis=1) >= self.reach]  # their beams are full of leaders in reach
            width *= 2
        return seen

    def ask(self, queries: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many vectors of the shard each query is linked with, but for its own node; and the pairs of queries and balls that are linked."""
        cosine = math.cos(self.angle)
        place = self.sorted[np.minimum(np.searchsorted(self.nodes, own, sorter=self.sorted), len(self.nodes) - 1)]
        own_place = np.where(self.nodes[place] == own, place, -1)
        row, ball = np.nonzero(self._beams(queries) >= self.reach)
        leader = np.einsum("ij,ij->i", queries[row], self.vectors[self.starts[ball]])
        at = np.arccos(np.clip(leader, -1, 1))
        single = self.sizes[ball] == 1
        whole = ~single & (at + self.radius[ball] <= self.angle - ANGLE_SLACK)
        linked = whole | (single & (leader >= cosine) & (self.starts[ball] != own_place[row]))
        counts = np.zeros(len(queries), np.int64)
        np.add.at(counts, row[linked], self.weights[ball[linked]])
        mine = whole & (own_place[row] >= 0)
        mine[mine] = self.ball_of[own_place[row[mine]]] == ball[mine]
        np.add.at(counts, row[mine], -self.copies[own_place[row[mine]]])
        unsure = np.flatnonzero(~single & ~whole & (at - self.radius[ball] <= self.angle + ANGLE_SLACK))
        edges = np.cumsum(self.sizes[ball[unsure]])
        for part in np.split(unsure, np.searchsorted(edges, np.arange(1 << 15, int(edges[-1]) if len(edges) else 0, 1 << 15))):
            size = self.sizes[ball[part]]
            of = np.repeat(part, size)
            member = np.repeat(self.starts[ball[part]] - (np.cumsum(size) - size), size) + np.arange(len(of))
            good = (np.einsum("ij,ij->i", queries[row[of]], self.vectors[member]) >= cosine) & (member != own_place[row[of]])
            np.add.at(counts, row[of[good]], self.copies[member[good]])
            linked[of[good]] = True
        return counts, row[linked], ball[linked]

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, angle=self.angle, vectors=self.vectors, nodes=self.nodes, copies=self.copies, starts=self.starts, radius=self.radius, reps=self.reps,
                 entry=self.layers.entry, points=self.layers.points, depth=len(self.layers.links), **{f"links{k}": x.astype(np.int32) for k, x in enumerate(self.layers.links)})
        return out.getvalue()

    @staticmethod
    def unpack(data: bytes) -> Shard:
        with np.load(io.BytesIO(data)) as x:
            layers = Layers(x["points"], [x[f"links{k}"].astype(np.int64) for k in range(int(x["depth"]))], int(x["entry"]))
            shard = Shard(float(x["angle"]), x["vectors"], x["nodes"], x["copies"], x["starts"], x["radius"], layers)
            shard.reps = x["reps"]
        return shard


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(flat), -1)


def _usable(vector: Column) -> Column:
    """Whether a vector has a direction."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``node``, ``label``, ``dim``, ``h1``, ``h2``, ``v``, ``copies``, ``least``: equal vectors of a label as one node, with the smallest id."""
    groups = rows.groupBy("label", "dim", "h1", "h2").agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
    return settle(groups.withColumn("node", F.monotonically_increasing_id()), "nodes")


def shard_graphs(nodes: DataFrame, angle: float) -> DataFrame:
    """``label``, ``dim``, ``shard``, ``graph``, ``nodes``, ``reps``: a graph for each shard, its nodes and the local component of each."""
    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        shard = Shard.build(table.column("node").to_numpy(), table.column("copies").to_numpy(), _matrix(table.column("v")), angle)
        head = table.slice(0, 1)
        return pa.table([head.column("label"), head.column("dim"), head.column("shard"), pa.array([shard.pack()], pa.binary()),
                         pa.array([shard.nodes.tolist()], pa.list_(pa.int64())), pa.array([shard.reps[shard.ball_of].tolist()], pa.list_(pa.int64()))],
                        names=["label", "dim", "shard", "graph", "nodes", "reps"])

    label = dict(nodes.dtypes)["label"]
    dealt = nodes.select("label", "dim", F.pmod(F.xxhash64("node"), F.col("shards")).alias("shard"), "node", "copies", "v")
    return dealt.groupBy("label", "dim", "shard").applyInArrow(build, f"label {label}, dim int, shard long, graph binary, nodes array<long>, reps array<long>")


def ask_all(nodes: DataFrame, graphs: DataFrame) -> DataFrame:
    """Ask every shard of its label for every node: rows ``node``, ``n`` with the links found, and rows ``a``, ``b`` of linked local components.

    At most ``SLOT_QUERIES`` queries, on average, come with a copy of a graph.
    """
    schema = "node long, n long, a long, b long"

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            shard = Shard.unpack(left.column("graph")[0].as_py())
            nodes, reps, vectors = right.column("node").to_numpy(), right.column("rep").to_numpy(), _matrix(right.column("v"))
            for start in range(0, len(nodes), TOGETHER):
                part = slice(start, start + TOGETHER)
                counts, row, ball = shard.ask(unit(vectors[part]), nodes[part])
                pairs = np.unique(np.stack([reps[part][row], shard.reps[ball]], axis=1), axis=0)
                pairs = pairs[pairs[:, 0] != pairs[:, 1]]
                some = counts > 0
                none = [None] * some.sum()
                out.append(pa.table([pa.array(nodes[part][some]), pa.array(counts[some]), pa.array(none, pa.int64()), pa.array(none, pa.int64())], names=["node", "n", "a", "b"]))
                none = [None] * len(pairs)
                out.append(pa.table([pa.array(none, pa.int64()), pa.array(none, pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["node", "n", "a", "b"]))
        empty = pa.table({c: pa.array([], pa.int64()) for c in ("node", "n", "a", "b")})
        return pa.concat_tables(out) if out else empty

    slots = F.ceil(F.col("rows") / SLOT_QUERIES).cast("long")
    asking = nodes.select("label", "dim", "node", "rep", "v", F.pmod(F.xxhash64("node", F.lit(1)), slots).alias("slot"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    copied = graphs.select("label", "dim", "shard", "graph", F.explode(F.sequence(F.lit(0).cast("long"), slots - 1)).alias("slot"))
    keys = ["label", "dim", "shard", "slot"]
    return copied.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(ask, schema)


def near_vectors(vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """The near-duplicate component of each vector, among vectors of the same label.

    Returns ``id_col``, ``n_links`` (other rows at a cosine of ``cosine`` or
    more, in double precision, that the graphs find), ``component_id`` (smallest
    id reachable over links, the own one included) and ``kept`` (whether that is
    the own one), one row for each input row.

    Rows without a label, and vectors that are null, zero, empty or hold null or
    non-finite components, are linked with nothing; vectors of different lengths
    neither. Rows that repeat an id are vectors of their own. Rows without an id
    are linked like others; a component without any id has none. Equal vectors of
    a label are known by 128 bits of hash. Other columns are ignored; an empty
    table gives an empty result.
    """
    ship_package(vectors.sparkSession)
    angle = math.acos(cosine)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    linkable = F.col("label").isNotNull() & _usable(F.col("v"))
    keyed = rows.where(linkable).withColumns({"dim": F.size("v"), "h1": F.xxhash64("label", "v"), "h2": F.xxhash64(F.lit(SEED), "label", "v")})
    nodes = distinct_vectors(keyed)
    labels = settle(nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("rows")).withColumn("shards", F.ceil(F.col("rows") / SHARD_POINTS).cast("long")), "labels")
    sized = hot_key_join(nodes, labels, ["label", "dim"], counts=labels, rows="rows", spread=["node"], how="inner")
    graphs = settle(shard_graphs(sized, angle), "graphs")
    reps = graphs.select(F.explode(F.arrays_zip("nodes", "reps")).alias("x")).select(F.col("x.nodes").alias("node"), F.col("x.reps").alias("rep"))
    placed = settle(sized.join(reps, "node"), "placed")
    found = settle(ask_all(placed, graphs.select("label", "dim", "shard", "graph").join(labels, ["label", "dim"])), "found")
    joined = components(found.where("a is not null").select("a", "b"))
    members = placed.select("node", "label", "dim", "h1", "h2", "copies", "least", "rep").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    members = settle(members.withColumn("component", F.coalesce("component", "rep")), "members")
    least = settle(members.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("rows")), "least")
    named = hot_key_join(members, least.drop("rows"), ["component"], counts=least, rows="rows", spread=["node"], how="inner")
    counted = found.where("node is not null").groupBy("node").agg(F.sum("n").alias("n"))
    by_node = settle(named.join(counted, "node", "left").select("label", "dim", "h1", "h2", "copies", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "by_node")
    keys = ["label", "dim", "h1", "h2"]
    linked = hot_key_join(keyed.select("id", *keys), by_node.drop("copies"), keys, counts=by_node.select(*keys, "copies"), rows="copies", spread=["id"], how="inner")
    alone = rows.where(~linkable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    both = linked.select("id", "n_links", "component_id").unionByName(alone)
    return both.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


#: The rows of op11_near_vectors in DuckDB.
NEAR_VECTORS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.93),
reached AS (
  SELECT a, b FROM links
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id, e.vec_id <= coalesce(l.b, e.vec_id) AS kept
FROM embeddings e LEFT JOIN least l ON l.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
