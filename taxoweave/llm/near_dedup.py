"""Near-duplicate detection by min-max hashing.

Each hash function gives two signature values, the smallest and the largest
hash of a document's shingles, so half the evaluations fill a signature. Bands
of the signature nominate pairs; every link is confirmed on the full shingle
sets. Documents with equal sets are one node from the start.

A band's bucket never emits all its pairs. It compares its nodes with one of
them, its hub; linked nodes become one component, and a bucket within one
component is done. What is left over is compared exactly, but for pairs that
cannot be linked: how many of a set's shingles no other set, or only few sets,
hold bounds what it has in common with any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import measured, or_empty, settle, ship_package, tidy, worker_cache

#: A pair at a similarity of 0.8 misses all 36 bands of 5 values with probability 6e-7, at 0.85 with 7e-10.
BANDS = 36
BAND_VALUES = 5
#: A shingle in at most so many of the sets left over is rare.
RARE = 16
#: Members of a bucket that the exact comparison takes as one block.
BLOCK = 64
#: Distinct words a worker remembers.
CACHED_WORDS = 200_000
CHUNK = 4096
BATCH_BYTES = 4 << 20
SEED = 9
# Odd multipliers of 64-bit mixing, written for the places of a shingle's words and for the hash functions.
MIX = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            if len(self) > CACHED_WORDS:
                self.clear()
            self[word] = value
        return value


def _hashes() -> _WordHashes:
    """The word hashes of this worker."""
    known = worker_cache("near_dedup")
    if "words" not in known:
        known["words"] = _WordHashes()
    return known["words"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str, words_per_shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    Words are runs without ASCII white space, A-Z in lower case. A text with
    fewer words than a shingle is one shingle of all its words; one without
    words has none.
    """
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes().__getitem__, words), np.uint64, len(words))
    k = min(words_per_shingle, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, np.uint64)  # a short sequence is no shingle of full length
    for place in range(k):
        out = _mixed(out * MIX + h[place:place + n])
    return np.unique(out)


def multipliers(count: int, seed: int = SEED) -> np.ndarray:
    """Odd 64-bit multipliers, each one a permutation of the hashes."""
    return np.random.default_rng(seed).integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1)


def min_max_signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Smallest and largest hash of a set under each permutation, side by side."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(factors), np.uint64)
    for start in range(0, len(shingles), CHUNK):
        hashed = factors[:, None] * shingles[None, start:start + CHUNK]
        low = np.minimum(low, hashed.min(axis=1))
        high = np.maximum(high, hashed.max(axis=1))
    return np.stack([low, high], axis=1).ravel()


def band_keys(signature: np.ndarray, bands: int, values: int) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    rows = signature[: bands * values].reshape(bands, values)
    key = np.arange(1, bands + 1, dtype=np.uint64) * MIX
    for place in range(values):
        key = _mixed(key + rows[:, place])
    return key.view(np.int64)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in parts of bounded size."""
    for batch in batches:
        step = max(1, min(batch.num_rows, batch.num_rows * BATCH_BYTES // max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def sketches(docs: DataFrame, words_per_shingle: int, bands: int = BANDS, values: int = BAND_VALUES,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_shingles``, ``digest`` (128 bits of the whole set) and ``keys`` (of the bands), a row for each input row."""
    ship_package(docs.sparkSession)
    factors = multipliers(-(-bands * values // 2))
    rows = docs.select(F.col(id_col).alias("id"), or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            sizes, digests, keys = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingle_set(text, words_per_shingle)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                keys.append(band_keys(min_max_signature(found, factors), bands, values) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "n_shingles", "digest", "keys"])

    return rows.mapInArrow(tidy(run), f"id {kind}, n_shingles long, digest binary, keys array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, words_per_shingle: int, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` of nodes with 100 * intersection >= percent * union of their full sets.

    ``texts`` has ``id`` and ``text``, each id once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in _batches(batches):
            keep = []
            for a, text_a, text_b in zip(*(batch.column(c).to_pylist() for c in ("a", "text_a", "text_b"))):
                if a != last:
                    last, last_set = a, shingle_set(text_a, words_per_shingle)
                other = shingle_set(text_b, words_per_shingle)
                both = len(np.intersect1d(last_set, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(last_set) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    kind = pairs.schema["a"].dataType.simpleString()
    joined = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(tidy(run), f"a {kind}, b {kind}")


def components(links: DataFrame) -> DataFrame:
    """``id``, ``component``: the smallest id reachable over links ``a``, ``b``, for each node that has a link.

    Every round each node takes the smallest label among its neighbours' and
    its own, then the label of its label; labels that no longer change end it.
    """
    both = settle(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = settle(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near")).select("id", F.least("near", "id").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("seen"))
        nearer = labels.join(near, "id").select("id", "component", F.least("component", "seen").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("component").alias("beyond"))
        stepped = settle(nearer.join(jump, "next").select("id", "component", F.least("next", "beyond").alias("next")), "labels")
        labels = stepped.select("id", F.col("next").alias("component"))
        if stepped.where("component <> next").isEmpty():
            return labels


def shingle_rows(texts: DataFrame, words_per_shingle: int) -> DataFrame:
    """``id``, ``shingle``: a row for each distinct shingle of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            sets = [shingle_set(t, words_per_shingle) for t in batch.column(1).to_pylist()]
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
            for start in range(0, len(flat), 1 << 16):
                part = slice(start, start + (1 << 16))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner[part])), pa.array(flat[part])], ["id", "shingle"])

    return texts.select("id", "text").mapInArrow(tidy(run), f"id {texts.schema['id'].dataType.simpleString()}, shingle long")


def _can_link(common: Column, n: Column, other: Column, percent: int) -> Column:
    """Whether sets of two sizes can be linked if they have at most ``common`` shingles in common."""
    return 100 * common >= percent * (n + other - common)


def leftovers(members: DataFrame, shingles: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a < b`` of different components that share a bucket or a rare shingle, and that can still be linked.

    ``members`` has ``bucket``, ``id``, ``n_shingles`` and ``component``,
    ``shingles`` the shingles of these ids. A shingle in at most ``RARE`` sets
    is rare. Pairs that share rare shingles are few and listed from them, with
    their number. All others have at most the smaller number of common shingles
    in common; so the number a set holds bounds the sizes of its partners, and
    sets that are near their hub but not linked to it rarely have any. In a
    bucket only members outside its largest component ask for partners.
    """
    rare = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")).where(F.col("holders") <= RARE).select("shingle")
    held = settle(shingles.join(rare, "shingle"), "rare")
    per_id = held.groupBy("id").agg(F.count(F.lit(1)).alias("rare"))
    own = members.groupBy("id").agg(F.collect_list("bucket").alias("own"))  # one for each band at most
    counted = settle(members.join(per_id, "id", "left").join(own, "id").select(
        "bucket", "own", "id", "component", F.col("n_shingles").alias("n"), (F.col("n_shingles") - F.coalesce("rare", F.lit(0))).alias("common")), "counted")

    nodes = counted.select("id", "component", "n", "common").distinct()
    shared = held.alias("x").join(held.alias("y"), "shingle").where("x.id < y.id").groupBy(F.col("x.id").alias("a"), F.col("y.id").alias("b")).agg(F.count(F.lit(1)).alias("both"))
    for side in ("a", "b"):
        shared = shared.join(nodes.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("component", "n", "common")]), side)
    by_rare = shared.where(F.col("component_a") != F.col("component_b")).where(
        _can_link(F.least("common_a", "common_b") + F.col("both"), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")

    def cell(size: Column) -> Column:
        return F.floor(F.log(size.cast("double")) / float(np.log(1.03)) + 1e-9)

    sizes = counted.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("bucket").agg(F.max_by("component", F.struct("k", "component")).alias("largest"))
    answering = counted.withColumn("cell", cell(F.col("n")))
    slots = answering.groupBy("bucket", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("slots"))
    right = answering.join(slots, ["bucket", "cell"]).select(
        "bucket", "cell", F.pmod(F.xxhash64("id"), "slots").alias("slot"), F.col("id").alias("y"), F.col("n").alias("ny"), F.col("common").alias("my"), F.col("component").alias("cy"), F.col("own").alias("by"))
    low, high = F.ceil(F.col("n") * percent / 100), F.floor(F.col("common") * 100 / percent - (F.col("n") - F.col("common")) + 1e-6)
    asking = counted.join(largest, "bucket").where("component <> largest").withColumns({"low": low.cast("long"), "high": high.cast("long")}).where("low <= high")
    asking = asking.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high"))))).join(slots, ["bucket", "cell"])
    left = asking.select("bucket", "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("slot"),
                         F.col("id").alias("x"), F.col("n").alias("nx"), F.col("common").alias("mx"), F.col("component").alias("cx"), F.col("own").alias("bx"), "low", "high")
    allowed = (F.col("cx") != F.col("cy")) & F.col("ny").between(F.col("low"), F.col("high")) & _can_link(F.least("mx", "my"), F.col("nx"), F.col("ny"), percent)
    allowed &= F.array_min(F.array_intersect("bx", "by")) == F.col("bucket")  # one of the buckets that a pair shares lists it
    in_buckets = left.join(right, ["bucket", "cell", "slot"]).where(allowed).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return by_rare.unionByName(in_buckets).distinct()


def near_groups(docs: DataFrame, words_per_shingle: int = 5, percent: int = 80, bands: int = BANDS, values: int = BAND_VALUES,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The near-duplicate component of each document.

    Returns ``id_col``, ``n_shingles``, ``component_id`` (smallest id reachable
    over links, its own included) and ``kept`` (whether that is its own), one
    row for each input row. Linked are documents with 100 * intersection >=
    ``percent`` * union of their shingle sets. Documents without words are
    linked with nothing. Rows that repeat an id are one document; should their
    texts differ, the smallest one decides its links. Rows without an id get no
    component and stay. Other columns are ignored; an empty table gives an empty
    result.
    """
    sketched = settle(sketches(docs, words_per_shingle, bands, values, id_col, text_col), "sketches")
    texts = docs.select(F.col(id_col).alias("id"), or_empty(text_col).alias("text")).where("id is not null")
    counted = sketched.agg(F.count("id").alias("rows"), F.countDistinct("id").alias("ids")).first()
    named = sketched
    if counted["rows"] != counted["ids"]:
        texts = settle(texts.groupBy("id").agg(F.min("text").alias("text")), "texts")
        named = settle(sketches(texts, words_per_shingle, bands, values, "id", "text"), "sketches")
    named = named.where("id is not null and n_shingles > 0")
    # Equal sets are one node, named by its smallest id.
    sets = settle(named.groupBy("digest").agg(F.min("id").alias("node")), "sets")
    nodes = named.join(sets.select(F.col("node").alias("id")), "id", "left_semi").select("id", "n_shingles", F.explode("keys").alias("bucket"))
    shared = nodes.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("bucket")
    buckets = settle(nodes.join(shared, "bucket"), "buckets")
    # Only the texts of nodes in shared buckets travel from here on.
    nominated = settle(buckets.select("id").distinct(), "nominated")
    texts = settle(texts.join(measured(nominated), "id", "left_semi"), "texts")
    # Every bucket compares its nodes with its hub; one whose nodes are then in one component is done.
    hubs = buckets.groupBy("bucket").agg(F.min("id").alias("a"))
    pairs = settle(buckets.join(hubs, "bucket").where("id <> a").select("a", F.col("id").alias("b")).distinct(), "pairs")
    links = settle(confirmed(pairs, texts, words_per_shingle, percent), "links")
    labels = components(links)
    labeled = buckets.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_ = labeled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("bucket")
    active = settle(labeled.join(open_, "bucket"), "active")
    asked = texts.join(measured(settle(active.select("id").distinct(), "asked")), "id", "left_semi")
    rest = settle(leftovers(active, settle(shingle_rows(asked, words_per_shingle), "shingles"), percent), "rest")
    more = settle(confirmed(rest, texts, words_per_shingle, percent), "links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    by_id = named.select("id", "digest").join(sets, "digest").select("id", "node")
    by_id = by_id.join(labels.withColumnRenamed("id", "node"), "node", "left").select("id", F.coalesce("component", "node").alias("component"))
    return sketched.select("id", "n_shingles").join(by_id, "id", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"),
        F.coalesce("component", "id").eqNullSafe(F.col("id")).alias("kept"))


def drop_near_copies(docs: DataFrame, words_per_shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, with all its columns; rows without an id stay."""
    groups = near_groups(docs, words_per_shingle, percent, id_col=id_col, text_col=text_col)
    dropped = settle(groups.where("not kept").select(F.col(id_col).alias("__dropped")).distinct(), "dropped")
    return docs.join(measured(dropped), F.col(id_col) == F.col("__dropped"), "left_anti")
