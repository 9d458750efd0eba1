"""Vector compression by one code per part, trained in whole numbers with LAESA pivots.

A vector is cut into parts, each replaced by the index of its codebook's
nearest entry. A few fixed pivots stand for each part position. The distances
from every part to its pivots are computed once and stored; each round only
adds the distances from the pivots to the entries. The largest difference of
the two bounds the distance of a part and an entry from below: entries are
tried in the order of that bound, and the exact whole-number distance is
evaluated only while the bound can still beat the best entry found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import ROWS_PER_SALT, hot_key_join
from .common import settle, ship_package
from .topk import scaled

PARTS = 4
ENTRIES = 256
ROUNDS = 4
PIVOTS = 8
#: Rows that a task holds against all entries at once, and entries tried in one step.
SLAB = 2_048
STEP = 8
#: Stored distances are single precision; a bound gives up this share of what it is made of.
SLACK = 1e-6
LONG_MAX = (1 << 63) - 1


def whole(numbers: np.ndarray) -> np.ndarray:
    """The numbers as longs if sums of squared differences fit into one, else as Python's numbers."""
    largest = max(int(numbers.max(initial=0)), -int(numbers.min(initial=0)))
    return numbers.astype(np.int64 if 4 * largest * largest * max(numbers.shape[-1], 1) < 2**62 else object)


def lengths(differences: np.ndarray) -> np.ndarray:
    """Euclidean length of each row of whole numbers, in double precision."""
    return np.sqrt((differences.astype(float) ** 2).sum(axis=-1))


def choose_pivots(entries: np.ndarray, pivots: int) -> np.ndarray:
    """Entries far from one another: the first, then always the one farthest from those chosen."""
    chosen = [0]
    near = lengths(entries - entries[0])
    while len(chosen) < min(pivots, len(entries)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, lengths(entries - entries[chosen[-1]]))
    return entries[chosen]


def to_pivots(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each point (row) to each pivot (column)."""
    out = np.empty((len(points), len(pivots)), np.float32)
    for k, pivot in enumerate(pivots):
        out[:, k] = lengths(points - pivot)
    return out


def nearest(points: np.ndarray, to_pivot: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of each point's nearest entry, ties to the lower index, and the number of exact evaluations."""
    both = whole(np.concatenate([points, entries]))
    points, entries = both[: len(points)], both[len(points):]
    of_entries = to_pivots(entries, pivots)
    codes = np.zeros(len(points), np.int64)
    errors = np.zeros(len(points), both.dtype)
    evaluated = 0
    for start in range(0, len(points), SLAB):
        x, d = points[start:start + SLAB], to_pivot[start:start + SLAB]
        bound = np.zeros((len(x), len(entries)), np.float32)
        for k in range(len(pivots)):
            a, b = d[:, k, None], of_entries[None, :, k]
            np.maximum(bound, np.abs(a - b) - np.float32(SLACK) * (a + b), out=bound)
        order = bound.argsort(axis=1, kind="stable")
        ordered = np.take_along_axis(bound, order, axis=1).astype(float) ** 2 * (1 - SLACK)
        code = np.full(len(x), len(entries), np.int64)
        best = np.full(len(x), LONG_MAX, both.dtype)
        unset = np.ones(len(x), bool)
        active = np.arange(len(x))
        for step in range(0, len(entries), STEP):
            tried = order[active, step:step + STEP]
            exact = ((x[active][:, None, :] - entries[tried]) ** 2).sum(axis=-1)
            evaluated += exact.size
            least = exact.min(axis=1)
            index = np.where(exact == least[:, None], tried, len(entries)).min(axis=1)
            better = unset[active] | (least < best[active]) | ((least == best[active]) & (index < code[active]))
            rows = active[better.astype(bool)]
            best[rows], code[rows], unset[rows] = least[better.astype(bool)], index[better.astype(bool)], False
            if step + STEP < len(entries):
                active = active[ordered[active, step + STEP] <= best[active].astype(float)]
            if not len(active):
                break
        codes[start:start + SLAB], errors[start:start + SLAB] = code, best
    return codes, errors, evaluated


class Codebooks:
    """Entries and pivots of all part positions; ``entries`` has the shape (parts, entries, numbers of a part)."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray) -> None:
        self.entries, self.pivots = entries, pivots

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """Distances of the parts of vectors to the pivots of their positions, part after part."""
        cut = vectors.reshape(len(vectors), len(self.entries), -1)
        return np.concatenate([to_pivots(whole(cut[:, p]), self.pivots[p]) for p in range(len(self.entries))], axis=1)

    def assign(self, vectors: np.ndarray, to_pivot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (a column for each part) and summed squared distances."""
        cut = vectors.reshape(len(vectors), len(self.entries), -1)
        stored = to_pivot.reshape(len(vectors), len(self.entries), -1)
        found = [nearest(cut[:, p], stored[:, p], self.entries[p], self.pivots[p]) for p in range(len(self.entries))]
        return np.stack([f[0] for f in found], axis=1), sum(f[1].astype(object) for f in found)

    def digest(self) -> str:
        """All entries' numbers, by part, entry and place, in SHA-256."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _matrix(column: pa.Array, rows: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(rows, -1)


def padded(vector: Column, width: int) -> Column:
    """Zeros behind a vector up to ``width``."""
    return F.concat(vector, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(vector)))


def _first_codebooks(vectors: DataFrame, width: int, parts: int, entries: int, pivots: int) -> Codebooks | None:
    """The parts of the vectors with the smallest ids; at most ``entries`` rows come to the driver."""
    rows = vectors.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not rows:
        return None
    first = np.array([r.v for r in rows], object).reshape(len(rows), parts, width // parts).transpose(1, 0, 2)
    return Codebooks(first, np.stack([choose_pivots(e, pivots) for e in first]))


def _sums(stored: DataFrame, books: Codebooks) -> DataFrame:
    """``part``, ``entry``, ``place``, ``total``, ``n``: sums of the parts assigned to each entry, one set of rows for each task."""
    parts, entries, size = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts * entries, size), object)
        counts = np.zeros(parts * entries, np.int64)
        for batch in batches:
            vectors = _matrix(batch.column(0), batch.num_rows, np.int64)
            codes, _ = books.assign(vectors, _matrix(batch.column(1), batch.num_rows, np.float32))
            cut = vectors.reshape(len(vectors), parts, size)
            fits = max(int(vectors.max(initial=0)), -int(vectors.min(initial=0))) * max(len(vectors), 1) < 2**62
            part_sums = np.zeros((parts * entries, size), np.int64 if fits else object)
            for p in range(parts):
                np.add.at(part_sums, codes[:, p] + p * entries, cut[:, p] if fits else cut[:, p].astype(object))
                counts += np.bincount(codes[:, p] + p * entries, minlength=parts * entries)
            totals += part_sums
        used = np.flatnonzero(counts)
        at = np.repeat(used, size)
        yield pa.RecordBatch.from_arrays([
            pa.array(at // entries, pa.int32()), pa.array(at % entries, pa.int32()), pa.array(np.tile(np.arange(size), len(used)), pa.int32()),
            pa.array([str(t) for t in totals[used].ravel().tolist()], pa.string()).cast(pa.decimal128(38, 0)), pa.array(counts[at], pa.int64()),
        ], ["part", "entry", "place", "total", "n"])

    return stored.select("v", "to_pivot").mapInArrow(run, "part int, entry int, place int, total decimal(38,0), n long")


def train(stored: DataFrame, books: Codebooks, rounds: int) -> Codebooks:
    """Rounds of assigning all parts and moving each entry to the floored mean of its parts.

    What comes to the driver has the codebooks' size.
    """
    for _ in range(rounds):
        sums = _sums(stored, books).groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        moved = books.entries.copy()
        for r in sums.collect():
            moved[r.part, r.entry, r.place] = int(r.total) // r.n
        books = Codebooks(moved, books.pivots)
    return books


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``id_col``, ``code``, ``error``, ``label_error``, ``codebooks_sha256`` of every usable vector.

    Each component becomes the floor of 1024 times it. A code has two hex digits
    for each part (``entries`` is at most 256). ``error`` is the squared distance
    of the vector and what its code stands for, ``label_error`` its sum over
    equal labels, nulls together; sums beyond a long take its bound.

    Rows whose vector is null or holds null or non-finite components are
    dropped. Shorter vectors get zeros behind them, up to the longest length,
    rounded up to a multiple of ``parts``. Rows that repeat an id are vectors of
    their own; among them the codebooks start with the smaller vector. Rows
    without an id are coded, and start a codebook only where fewer than
    ``entries`` others do. With fewer rows the codebooks are smaller. Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    kind = dict(vectors.select(id_col).dtypes)[id_col]
    usable = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), scaled(vector_col).alias("v")).where("v is not null")
    longest = usable.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, -(-longest // parts)) * parts
    usable = usable.withColumn("v", padded(F.col("v"), width))
    books = _first_codebooks(usable, width, parts, entries, pivots)
    if books is None:
        return spark.createDataFrame([], f"`{id_col}` {kind}, code string, error long, label_error long, codebooks_sha256 string")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = books.distances(_matrix(batch.column("v"), batch.num_rows, np.int64))
            listed = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], [*batch.schema.names, "to_pivot"])

    label = dict(usable.dtypes)["label"]
    stored = settle(usable.mapInArrow(measure, f"vec_id {kind}, label {label}, v array<long>, to_pivot array<float>"), "pivots")
    trained = train(stored, books, rounds)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = trained.assign(_matrix(batch.column("v"), batch.num_rows, np.int64), _matrix(batch.column("to_pivot"), batch.num_rows, np.float32))
            digits = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"), pa.array(digits, pa.string()),
                pa.array([min(int(e), LONG_MAX) for e in errors], pa.int64())], ["vec_id", "label", "code", "error"])

    coded = settle(stored.mapInArrow(code, f"vec_id {kind}, label {label}, code string, error long"), "codes")
    keyed = coded.withColumns({"unlabelled": F.col("label").isNull(), "of": F.coalesce(F.col("label").cast("string"), F.lit(""))})
    summed = settle(keyed.groupBy("unlabelled", "of").agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long").alias("label_error"), F.count(F.lit(1)).alias("rows")), "labels")
    joined = hot_key_join(keyed, summed.drop("rows"), ["unlabelled", "of"], counts=summed, rows="rows", spread=["code", "vec_id"], how="inner", rows_per_salt=ROWS_PER_SALT)
    return joined.select(F.col("vec_id").alias(id_col), "code", "error", "label_error", F.lit(trained.digest()).alias("codebooks_sha256"))


def _round_sql(n: int) -> str:
    """Assignment to codebooks ``c{n}`` and, from it, codebooks ``c{n + 1}``."""
    return f"""
a{n} AS (
  SELECT p.vec_id, p.label, p.part, CAST(min(p.xx - 2 * list_dot_product(p.x, c.x) + c.xx) AS BIGINT) AS d,
    arg_min(c.entry, (p.xx - 2 * list_dot_product(p.x, c.x) + c.xx) * 1024 + c.entry) AS entry
  FROM parts p JOIN c{n} c ON c.part = p.part GROUP BY p.vec_id, p.label, p.part),
m{n} AS (
  SELECT part, entry, list(m ORDER BY place) AS x FROM (
    SELECT a.part, a.entry, u.place, floor(sum(p.x[u.place]) / count(*)) AS m
    FROM a{n} a JOIN parts p ON p.vec_id = a.vec_id AND p.part = a.part, (SELECT unnest(range(1, 17)) AS place) u
    GROUP BY a.part, a.entry, u.place)
  GROUP BY part, entry),
c{n + 1} AS (
  SELECT part, entry, x, list_dot_product(x, x) AS xx FROM (
    SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN m{n} m ON m.part = c.part AND m.entry = c.entry)),"""


#: The rows of op13_pivot_codes in DuckDB, for vectors of 64 numbers and unique ids.
PIVOT_CODES_SQL = f"""
WITH v AS (
  SELECT vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, label, part, x, list_dot_product(x, x) AS xx FROM (
    SELECT vec_id, label, part, e[part * 16 + 1:part * 16 + 16] AS x FROM v, (SELECT unnest(range(0, 4)) AS part) q)),
c0 AS (
  SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS entry, x, xx FROM parts
  WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 256)),{"".join(map(_round_sql, range(ROUNDS)))}
a AS (
  SELECT p.vec_id, p.label, p.part, CAST(min(p.xx - 2 * list_dot_product(p.x, c.x) + c.xx) AS BIGINT) AS d,
    arg_min(c.entry, (p.xx - 2 * list_dot_product(p.x, c.x) + c.xx) * 1024 + c.entry) AS entry
  FROM parts p JOIN c{ROUNDS} c ON c.part = p.part GROUP BY p.vec_id, p.label, p.part),
r AS (
  SELECT vec_id, label, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a GROUP BY vec_id, label),
b AS (
  SELECT sha256(string_agg(array_to_string([CAST(CAST(k AS BIGINT) AS VARCHAR) FOR k IN x], ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM r, b
"""
