"""Alignment of the tokens that two tokenizers cut from the same text, by diagonal run skipping.

A token ends at a byte. Where both tokenizers' tokens end, the text falls into
groups. Along a diagonal - token ``i`` of the one against token ``i + shift`` of
the other - ends mostly agree one by one, so stretches of doubling length are
compared at the present shift and jumped as a whole. Where they part, the next
shared end is looked for in small windows on both sides, which gives one
irregular group and the new shift.

Tokens of the same group are linked. Corpus-wide counts of linked id pairs are
made of one small table for each block of documents, and come back to each
block as the counts of its own pairs only.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import or_empty, settle, ship_package, tidy, worker_cache

#: Tokens after which a new place to walk from is looked for, and the longest stretch compared at once.
LANE = 128
STRETCH = 64
#: Window up to which all ends of both sides are compared at once.
WINDOW = 16
#: Characters tokenized at once, and characters of the documents that share a table of pairs; a longer text is one of its own.
PART_CHARS = 1_000_000
BLOCK_CHARS = 8_000_000
#: Links of a group above which its ids are counted instead of listed.
LISTED = 1 << 16

# The pattern that a byte-level vocabulary cuts text by before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 as it is, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteBpe:
    """A byte-level BPE vocabulary whose ids are the ranks of its merges, as a tokenizer file holds it."""

    def __init__(self, spec: str) -> None:
        import tiktoken

        model = json.loads(spec)["model"]
        letters = byte_letters()
        self.tokens = {i: bytes(letters[c] for c in token) for token, i in model["vocab"].items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        if any(model["vocab"][a + b] != 256 + k for k, (a, b) in enumerate(pairs)):
            raise ValueError("the vocabulary's ids are not in the order of its merges")
        self.encoding = tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks={t: i for i, t in self.tokens.items()}, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(t) for t in texts]


class Pieces:
    """A sentence piece vocabulary; it puts a space before every text by itself."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [(i, self.processor.id_to_piece(i)) for i in range(self.processor.get_piece_size())]
        self.tokens = {i: bytes([int(p[3:5], 16)]) if self.processor.is_byte(i) else p.replace("▁", " ").encode() for i, p in names}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


class Vocabulary:
    """A tokenizer with its tokens' bytes, their lengths and their ids in decimal digits."""

    def __init__(self, tokenizer: ByteBpe | Pieces) -> None:
        size = max(tokenizer.tokens) + 1
        self.encode, self.tokens = tokenizer.encode, tokenizer.tokens
        self.lengths = np.zeros(size, np.int64)
        for i, token in self.tokens.items():
            self.lengths[i] = len(token)
        self.digits = np.array([str(i) for i in range(size)], "S8").view(np.uint8).reshape(size, 8)

    @staticmethod
    def of(kind: type, spec: str | bytes) -> Vocabulary:
        """The vocabulary of this worker, read once."""
        key = (kind.__name__, hashlib.md5(spec.encode() if isinstance(spec, str) else spec).hexdigest())
        known = worker_cache("alignment")
        if key not in known:
            known[key] = Vocabulary(kind(spec))
        return known[key]

    def spells(self, ids: list[int], text: bytes) -> bool:
        """Whether the tokens' bytes give the text."""
        return b"".join(map(self.tokens.__getitem__, ids)) == text


def _first_shared(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """The first places in two ascending arrays with an equal value, which there must be; compares prefixes of doubling length."""
    size = 2 * WINDOW
    while True:
        found, p, q = np.intersect1d(a[:size], b[:size], assume_unique=True, return_indices=True)
        if len(found):
            return int(p[0]), int(q[0])
        size *= 2


def shared_ends(a: np.ndarray, b: np.ndarray, start_a: np.ndarray, start_b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places ``i``, ``j`` with ``a[i] == b[j]``, both in ascending order.

    ``a`` and ``b`` ascend; lanes ``start`` to ``stop`` cover them, each ending
    with an equal value. All lanes walk at once, each along its own diagonal.
    """
    i, j = start_a.copy(), start_b.copy()
    width = np.ones(len(i), np.int64)
    found_a, found_b = [], []
    lanes = np.flatnonzero(i < stop_a)
    while len(lanes):
        parted = []
        for w in np.unique(width[lanes]):
            rows = lanes[width[lanes] == w]
            span = np.arange(w)
            at_a, at_b = i[rows, None] + span, j[rows, None] + span
            same = (at_a < stop_a[rows, None]) & (at_b < stop_b[rows, None])
            same[same] = a[at_a[same]] == b[at_b[same]]
            run = np.where(same.all(axis=1), w, same.argmin(axis=1))
            reached = span < run[:, None]
            found_a.append(at_a[reached])
            found_b.append(at_b[reached])
            i[rows] += run
            j[rows] += run
            whole = run == w
            width[rows[whole]] = min(2 * w, STRETCH)
            parted.append(rows[~whole])
        rows = np.concatenate(parted)
        rows = rows[i[rows] < stop_a[rows]]
        width[rows] = 1
        w = 4
        while len(rows) and w <= WINDOW:
            span = np.arange(w)
            at_a, at_b = i[rows, None] + span, j[rows, None] + span
            ends_a = np.where(at_a < stop_a[rows, None], a[np.minimum(at_a, len(a) - 1)], -1)
            ends_b = np.where(at_b < stop_b[rows, None], b[np.minimum(at_b, len(b) - 1)], -2)
            equal = ends_a[:, :, None] == ends_b[:, None, :]
            hit = equal.any(axis=2)
            met = hit.any(axis=1)
            p = hit[met].argmax(axis=1)
            q = equal[met, :, :][np.arange(len(p)), p].argmax(axis=1)
            _step(i, j, rows[met], p, q, found_a, found_b)
            rows = rows[~met]
            w *= 2
        if len(rows):
            places = np.array([_first_shared(a[i[r]:stop_a[r]], b[j[r]:stop_b[r]]) for r in rows])
            _step(i, j, rows, places[:, 0], places[:, 1], found_a, found_b)
        lanes = lanes[i[lanes] < stop_a[lanes]]
    if not found_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))


def _step(i: np.ndarray, j: np.ndarray, rows: np.ndarray, p: np.ndarray, q: np.ndarray, found_a: list, found_b: list) -> None:
    """Record shared ends ``p`` and ``q`` places ahead and go behind them, which sets the lanes' shifts."""
    found_a.append(i[rows] + p)
    found_b.append(j[rows] + q)
    i[rows] += p + 1
    j[rows] += q + 1


def lanes(a: np.ndarray, b: np.ndarray, doc_a: np.ndarray, doc_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and stops of lanes: documents, cut again at shared ends that a binary search finds about every ``LANE`` tokens.

    ``doc_a`` and ``doc_b`` are the places behind each document's last token.
    """
    probe = np.arange(LANE - 1, len(a), LANE)
    place = np.searchsorted(b, a[probe])
    shared = place < len(b)
    shared[shared] = b[place[shared]] == a[probe[shared]]
    stop_a = np.union1d(doc_a, probe[shared] + 1)
    stop_b = np.union1d(doc_b, place[shared] + 1)
    return np.concatenate([[0], stop_a[:-1]]), np.concatenate([[0], stop_b[:-1]]), stop_a, stop_b


class Aligned:
    """The groups of a list of documents whose tokens give the same bytes: ``ids_a``, ``ids_b`` and, for each document, their number.

    Every document has tokens.
    """

    def __init__(self, ids_a: np.ndarray, ids_b: np.ndarray, counts_a: np.ndarray, counts_b: np.ndarray, lengths_a: np.ndarray, lengths_b: np.ndarray) -> None:
        self.ids_a, self.ids_b = ids_a, ids_b
        ends_a, ends_b = np.cumsum(lengths_a[ids_a]), np.cumsum(lengths_b[ids_b])
        doc_a, doc_b = np.cumsum(counts_a), np.cumsum(counts_b)
        last_a, last_b = shared_ends(ends_a, ends_b, *lanes(ends_a, ends_b, doc_a, doc_b))
        self.start_a, self.start_b = np.concatenate([[0], last_a[:-1] + 1]), np.concatenate([[0], last_b[:-1] + 1])
        self.size_a, self.size_b = last_a + 1 - self.start_a, last_b + 1 - self.start_b
        self.doc = np.searchsorted(doc_a, last_a, side="right")
        self.docs = len(counts_a)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``doc``, ``pair``, ``n``: how often each id pair is linked in each document, in ascending order; a pair is the one id times 2**32 and the other."""
        product = self.size_a * self.size_b
        listed = np.flatnonzero(product <= LISTED)
        of = np.repeat(listed, product[listed])
        within = np.arange(len(of)) - np.repeat(np.cumsum(product[listed]) - product[listed], product[listed])
        at_a, at_b = self.start_a[of] + within // self.size_b[of], self.start_b[of] + within % self.size_b[of]
        parts = [(self.doc[of], self.ids_a[at_a], self.ids_b[at_b], np.ones(len(of), np.int64))]
        for g in np.flatnonzero(product > LISTED):
            a, n_a = np.unique(self.ids_a[self.start_a[g]:self.start_a[g] + self.size_a[g]], return_counts=True)
            b, n_b = np.unique(self.ids_b[self.start_b[g]:self.start_b[g] + self.size_b[g]], return_counts=True)
            parts.append((np.full(len(a) * len(b), self.doc[g]), np.repeat(a, len(b)), np.tile(b, len(a)), np.outer(n_a, n_b).ravel()))
        doc, a, b, n = (np.concatenate(c) for c in zip(*parts))
        # Documents of a part and ids of two vocabularies fit into one long.
        bits_a, bits_b = int(self.ids_a.max()).bit_length(), int(self.ids_b.max()).bit_length()
        key, where = np.unique((doc << bits_a | a) << bits_b | b, return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, where, n)
        rest = key & ((1 << bits_a + bits_b) - 1)
        return key >> bits_a + bits_b, (rest >> bits_b) << 32 | rest & ((1 << bits_b) - 1), total

    def digests(self, digits_a: np.ndarray, digits_b: np.ndarray) -> list[str]:
        """For each document SHA-256 of its groups, as ``a1,a2|b1;a3|b2,b3``."""
        total = len(self.ids_a) + len(self.ids_b)
        before = np.arange(len(self.doc))
        place_a = np.arange(len(self.ids_a)) + np.repeat(self.start_b[before], self.size_a)
        place_b = np.arange(len(self.ids_b)) + np.repeat(self.start_a[before] + self.size_a, self.size_b)
        out = np.zeros((total, 9), np.uint8)
        out[place_a, :8] = digits_a[self.ids_a]
        out[place_b, :8] = digits_b[self.ids_b]
        out[:, 8] = ord(",")
        out[place_a[self.start_a + self.size_a - 1], 8] = ord("|")
        out[place_b[self.start_b + self.size_b - 1], 8] = ord(";")
        filled = out != 0
        text = out[filled].tobytes()
        ends = np.cumsum(filled.sum(axis=1))
        last_group = np.searchsorted(self.doc, np.arange(self.docs), side="right") - 1
        stops = ends[place_b[self.start_b[last_group] + self.size_b[last_group] - 1]]
        starts = np.concatenate([[0], stops[:-1]])
        return [hashlib.sha256(text[s:e - 1]).hexdigest() for s, e in zip(starts, stops)]


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 as planes of bytes, lowest first; planes of zeros or runs shrink to little when they are written."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


DOC_COLUMNS = ("n_a", "n_b", "n_groups", "n_links")


class _Block:
    """Documents that share a table of id pairs."""

    def __init__(self, key: pa.DataType) -> None:
        self.key = key
        self.keys: list[pa.Array] = []
        self.rows: list[np.ndarray] = []
        self.digests: list[str] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.held: list[np.ndarray] = []
        self.chars = 0

    def add(self, keys: pa.Array, texts: list[str], a: Vocabulary, b: Vocabulary) -> None:
        """Tokenize, align and count some documents."""
        self.keys.append(keys)
        self.chars += sum(map(len, texts))
        kept = [k for k, t in enumerate(texts) if t]
        spaced = [" " + texts[k] for k in kept]
        cut_a, cut_b = a.encode(spaced), b.encode([texts[k] for k in kept])
        same = [x for x, text in enumerate(spaced) if a.spells(cut_a[x], raw := text.encode()) and b.spells(cut_b[x], raw)]
        numbers = np.zeros((len(texts), len(DOC_COLUMNS)), np.int64)
        digests = [""] * len(texts)
        held = np.zeros(len(texts), np.int64)
        if same:
            at = np.array([kept[x] for x in same])
            counts_a, counts_b = np.array([len(cut_a[x]) for x in same]), np.array([len(cut_b[x]) for x in same])
            flat_a = np.fromiter(chain.from_iterable(cut_a[x] for x in same), np.int64, counts_a.sum())
            flat_b = np.fromiter(chain.from_iterable(cut_b[x] for x in same), np.int64, counts_b.sum())
            del cut_a, cut_b
            aligned = Aligned(flat_a, flat_b, counts_a, counts_b, a.lengths, b.lengths)
            doc, pair, times = aligned.links()
            numbers[at, 0], numbers[at, 1] = counts_a, counts_b
            numbers[at, 2] = np.bincount(aligned.doc, minlength=len(at))
            np.add.at(numbers[:, 3], at[aligned.doc], aligned.size_a * aligned.size_b)
            held[at] = np.bincount(doc, minlength=len(at))
            for x, digest in zip(at, aligned.digests(a.digits, b.digits)):
                digests[x] = digest
            self.pairs.append(pair)
            self.times.append(times)
        self.rows.append(numbers)
        self.digests += digests
        self.held.append(held)

    def batch(self, number: int) -> pa.RecordBatch:
        """A row for each document, then one with the block's pairs and the number of documents that hold each."""
        pairs, places = np.unique(np.concatenate(self.pairs or [np.empty(0, np.int64)]), return_inverse=True)
        times = np.concatenate(self.times or [np.empty(0, np.int64)])
        stops = np.cumsum(np.concatenate(self.held))
        starts = stops - np.concatenate(self.held)
        rows = np.concatenate(self.rows)
        n = len(rows)
        keys = pa.concat_arrays([k.combine_chunks() if isinstance(k, pa.ChunkedArray) else k for k in self.keys])
        columns = [pa.concat_arrays([keys, pa.nulls(1, self.key)])]
        columns += [pa.array([*c, None], pa.int64()) for c in rows.T.tolist()]
        columns.append(pa.array([*self.digests, None], pa.string()))
        columns.append(pa.array([*(_planes(places[s:e]) for s, e in zip(starts, stops)), None], pa.binary()))
        # Times beyond the planes' range, of groups far longer than any word, are spelled out.
        columns.append(pa.array([*(_planes(np.minimum(times[s:e], 0xFFFFFFFF)) for s, e in zip(starts, stops)), None], pa.binary()))
        columns.append(pa.array([*(times[s:e][times[s:e] >= 0xFFFFFFFF].tolist() for s, e in zip(starts, stops)), None], pa.list_(pa.int64())))
        columns.append(pa.array([None] * n + [pairs.tolist()], pa.list_(pa.int64())))
        columns.append(pa.array([None] * n + [np.bincount(places, minlength=len(pairs)).tolist()], pa.list_(pa.int64())))
        columns.append(pa.array([number] * (n + 1), pa.int64()))
        return pa.RecordBatch.from_arrays(columns, ["key", *DOC_COLUMNS, "groups_sha256", "places", "times", "large", "pairs", "held", "block"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Rows in parts of bounded size; a longer text is a part of its own."""
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1)
        start, chars = 0, 0
        for i, text in enumerate(texts):
            size = len(text.as_py())
            if i > start and chars + size > PART_CHARS:
                yield keys.slice(start, i - start), texts.slice(start, i - start).to_pylist()
                start, chars = i, 0
            chars += size
        if start < batch.num_rows:
            yield keys.slice(start), texts.slice(start).to_pylist()


def blocks(docs: DataFrame, byte_spec: str, piece_model: bytes) -> DataFrame:
    """Rows of documents and, for each block of them, one row of its id pairs; ``docs`` has an id and a text."""
    kind = docs.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = Vocabulary.of(ByteBpe, byte_spec), Vocabulary.of(Pieces, piece_model)
        number = TaskContext.get().partitionId() << 32
        block = None
        for keys, texts in _parts(batches):
            block = block or _Block(keys.type)
            block.add(keys, texts, a, b)
            if block.chars >= BLOCK_CHARS or sum(map(len, block.rows)) >= 50_000:
                yield block.batch(number)
                number, block = number + 1, None
        if block:
            yield block.batch(number)

    numbers = ", ".join(f"{c} long" for c in DOC_COLUMNS)
    return docs.mapInArrow(tidy(run), f"key {kind}, {numbers}, groups_sha256 string, places binary, times binary, large array<long>, pairs array<long>, held array<long>, block long")


def align(docs: DataFrame, byte_vocabulary: str, piece_vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Align the tokens of every whole text under a byte-level and a sentence piece vocabulary.

    The vocabularies are paths that the driver can open. Returns, one row for
    each input row, ``id_col``, ``n_a`` and ``n_b`` (tokens), ``n_groups``,
    ``n_links`` (pairs of tokens of one group), ``n_best`` (links whose id pair
    is held by as many documents as any pair of the same first id),
    ``count_sum`` (documents that hold the pair, summed over links) and
    ``groups_sha256``. Rows are documents, also where they repeat an id or have
    none. Texts that are null or empty, or that a vocabulary does not spell byte
    by byte, have zeros and an empty digest. Other columns are ignored; an empty
    table gives an empty result.
    """
    with open(byte_vocabulary, encoding="utf-8") as file:
        byte_spec = file.read()
    with open(piece_vocabulary, "rb") as file:
        piece_model = file.read()
    ship_package(docs.sparkSession)
    aligned = settle(blocks(docs.select(F.col(id_col).alias("key"), or_empty(text_col).alias("text")), byte_spec, piece_model), "aligned")
    tables = aligned.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "x")).select(
        "block", "place", F.col("x.pairs").alias("pair"), F.col("x.held").alias("held"))
    counted = settle(tables.groupBy("pair").agg(F.sum("held").alias("documents")), "pairs").withColumn("a", F.shiftright("pair", 32))
    # A row for each id of the vocabulary at most.
    highest = counted.groupBy("a").agg(F.max("documents").alias("highest"))
    weighed = counted.join(F.broadcast(highest), "a").select("pair", "documents", (F.col("documents") == F.col("highest")).alias("best"))
    known = tables.select("block", "place", "pair").join(weighed, "pair").select(F.col("block").alias("of"), "place", "documents", "best")

    def weigh(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        documents, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
        documents[place] = right.column("documents").to_numpy()
        best[place] = right.column("best").to_numpy(zero_copy_only=False)
        n_best, count_sum = [], []
        for places, times, large in zip(*(left.column(c).to_pylist() for c in ("places", "times", "large"))):
            at, n = _from_planes(places), _from_planes(times)
            if large:
                n[n == 0xFFFFFFFF] = large
            n_best.append(int(n[best[at]].sum()))
            count_sum.append(int((n * documents[at]).sum()))
        return pa.table([*(left.column(c) for c in ("key", *DOC_COLUMNS)), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), left.column("groups_sha256")],
                        names=["key", *DOC_COLUMNS, "n_best", "count_sum", "groups_sha256"])

    kind = aligned.schema["key"].dataType.simpleString()
    numbers = ", ".join(f"{c} long" for c in (*DOC_COLUMNS, "n_best", "count_sum"))
    rows = aligned.where("pairs is null").drop("pairs", "held")
    weighed_rows = rows.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(weigh, f"key {kind}, {numbers}, groups_sha256 string")
    return weighed_rows.withColumnRenamed("key", id_col)
