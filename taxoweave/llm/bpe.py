"""Encoding and decoding with a word-end BPE vocabulary by speculation and verification.

A word is first cut greedily into the longest tokens. Such a cut is the exact
encoding if each token encodes to itself and no merge ever crosses a border of
two adjacent tokens, and that depends on the two tokens alone. All adjacent
pairs of a batch are tested at once over arrays; only words with a failing pair
are merged exactly. Words repeat, so a worker keeps what it found, up to a bound.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, or_empty, ship_package, tidy, worker_cache

#: Words a worker remembers before it starts anew; longer words are not remembered.
CACHED_WORDS = 60_000
CACHED_LENGTH = 64
#: Rows and characters after which a worker hands over a batch.
BATCH_ROWS = 2_000
BATCH_CHARS = 250_000
#: Letters up to which a word's lowest rank is searched for directly.
SHORT = 64
#: Words merged side by side.
SIDE_BY_SIDE = 2_000
NEVER = np.iinfo(np.int64).max
#: The same along the edges of tokens, whose arrays are kept for each level.
NO_END = np.iinfo(np.int32).max

# White space of the vocabulary's patterns, and the contractions that are words of their own.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def _char_class(kind: str, end: int) -> str:
    """The code points up to ``end`` whose general category starts with ``kind``, as ranges of a character class."""
    parts, start = [], None
    for code in range(end + 2):
        inside = code <= end and unicodedata.category(chr(code))[0] == kind
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            parts.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return "".join(parts)


def _byte_chars() -> dict[int, str]:
    """The visible character that stands for each byte: itself if printable, else the next free one from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of words one behind the other, and where each word starts and ends."""
    spelled = [w.encode() for w in words]
    ends = np.cumsum(np.fromiter(map(len, spelled), np.int64, len(words)))
    letters = np.frombuffer(b"".join(spelled), np.uint8).astype(np.int64)
    return letters, np.concatenate([[0], ends[:-1]]), ends


class WordBpe:
    """A vocabulary with its merges, read from the JSON of a tokenizer file."""

    def __init__(self, spec: str, forms: tuple[str, ...] = ("text", "decoded")) -> None:
        """``forms`` names what is remembered of a word: ``text`` (decimal ids), ``decoded`` or ``numbers`` (four bytes an id).

        What no form needs is not kept, and parts of the file are let go as soon as they are read.
        """
        self.makers = [{"text": self.text, "decoded": self.decode, "numbers": self.numbers}[f] for f in forms]
        data = json.loads(spec)
        model = data["model"]
        suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model.pop("vocab")
        merges = model.pop("merges")
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        del data, model
        size = max(*vocab.values(), *self.special.values()) + 1 if self.special else max(vocab.values()) + 1
        pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
        self.merged_ids, keys = np.empty(len(merges), np.int64), np.empty(len(merges), np.int64)
        for r, (a, b) in enumerate(pairs):
            self.merged_ids[r], keys[r] = vocab[a + b], vocab[a] << 32 | vocab[b]
        del merges, pairs
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()} if "decoded" in forms else {}
        self.decimals = [str(i) for i in range(size)] if "text" in forms else []
        inner = {t: i for t, i in vocab.items() if not t.endswith(suffix)}
        self.final = {t.removesuffix(suffix): i for t, i in vocab.items() if t.endswith(suffix)}
        del vocab
        self.byte_chars = _byte_chars()
        self._index_letters(inner)
        del inner
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._index_merges(keys, size)
        # Classes that end at U+FFFF are tables for the pattern matcher, others lists of ranges.
        self.words, self.plane_words = (
            re.compile(f"{CONTRACTIONS}|[{letters}]+|[{numbers}]|[^{WHITE}{letters}{numbers}]+")
            for letters, numbers in ((_char_class("L", end), _char_class("N", end)) for end in (sys.maxunicode, 0xFFFF)))
        self.ascii_words = re.compile(rf"{CONTRACTIONS}|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
        self.cache: dict[str | int, tuple] = {}
        self.older: dict[str | int, tuple] = {}

    def _index_merges(self, pairs: np.ndarray, size: int) -> None:
        """Arrays over tokens: whether a token encodes to itself, and the pieces along its left and right edge.

        ``pairs`` has the two ids of each merge in one number, by rank.
        ``spines[side][level]`` is ``(piece, end)``: a piece at that edge of the
        token, and the rank of the merge that takes it up.
        """
        order = np.argsort(pairs, kind="stable")
        last = np.append(np.diff(pairs[order]) != 0, True)  # of a repeated pair the last rank holds
        self.keys, self.key_ranks = pairs[order][last], order[last]
        first = np.full(size, -1, np.int64)  # the merge that makes a token
        first[self.merged_ids[::-1]] = np.arange(len(pairs))[::-1]
        joined = np.flatnonzero(first >= 0)
        joined = joined[np.argsort(first[joined])]
        limit = first[joined]
        parts = pairs[limit] >> 32, pairs[limit] & 0xFFFFFFFF
        spines = []
        for part in parts:
            piece, end = np.arange(size, dtype=np.int32), np.full(size, NO_END, np.int32)
            levels = [(piece, end)]
            parent, rank = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
            parent[joined], rank[joined] = part, limit
            while (piece >= 0).any():
                live = piece >= 0
                piece, end = np.where(live, parent[piece], np.int32(-1)), np.where(live, rank[piece], np.int32(NO_END))
                if (piece >= 0).any():
                    levels.append((piece, end))
            spines.append(levels)
        self.left_edge, self.right_edge = spines
        # The argument about borders needs merges that come after their parts.
        late = ((first[self.keys >> 32] < self.key_ranks) & (first[self.keys & 0xFFFFFFFF] < self.key_ranks)).all()
        self.sound = np.ones(size, bool)
        self.sound[joined] = late
        if late:
            good = self.compatible(*parts, limit)
            for t, a, b, whole in zip(joined.tolist(), *(x.tolist() for x in (*parts, good))):
                self.sound[t] = whole and self.sound[a] and self.sound[b]

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | int = NEVER) -> np.ndarray:
        """For each pair of tokens, whether no merge of a rank below ``before`` crosses their border.

        A piece ``x`` at the right edge of ``a`` and a piece ``y`` at the left
        edge of ``b`` merge if their pair has a rank, and neither has been
        taken up by then; of equal ranks the leftmost goes first.
        """
        good = np.ones(len(a), bool)
        before = np.broadcast_to(np.asarray(before, np.int64), a.shape)
        for piece_a, end_a in self.right_edge:
            x, x_end = piece_a[a].astype(np.int64), end_a[a]
            for piece_b, end_b in self.left_edge:
                y = piece_b[b]
                look = np.flatnonzero(good & (x >= 0) & (y >= 0))
                if not len(look):
                    continue
                key = x[look] << 32 | y[look]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                rank = np.where(self.keys[at] == key, self.key_ranks[at], NEVER)
                crossed = (rank < x_end[look]) & (rank <= end_b[b[look]]) & (rank < before[look])
                good[look[crossed]] = False
        return good

    def _index_letters(self, inner: dict[str, int]) -> None:
        """A trie over the bytes of all tokens: sorted edges, and the token that ends at each node inside and at the end of a word."""
        code = {c: b for b, c in self.byte_chars.items()}
        nodes: dict[str, int] = {"": 0}
        edges = []
        for token in chain(inner, self.final):
            for end in range(1, len(token) + 1):
                if token[:end] not in nodes:
                    nodes[token[:end]] = len(nodes)
                    edges.append((nodes[token[: end - 1]] << 8 | code[token[end - 1]]) << 32 | nodes[token[:end]])
        edges = np.sort(np.array(edges, np.int64))
        self.edge_keys, self.edge_nodes = edges >> 32, edges & 0xFFFFFFFF
        self.inner_at, self.final_at = (np.array([kind.get(prefix, -1) for prefix in nodes], np.int64) for kind in (inner, self.final))
        self.inner_of, self.final_of = (np.array([kind[self.byte_chars[b]] for b in range(256)], np.int64) for kind in (inner, self.final))

    def propose(self, letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The greedy cut into the longest tokens, of all words at once: ``tokens``, word after word, and each one's ``owner``.

        Every step reads one more letter of every word; a word without a longer
        token takes the longest it came by and goes on behind it.
        """
        owners, tokens = [], []
        word = np.flatnonzero(starts < ends)
        at, node = starts[word].copy(), np.zeros(len(word), np.int64)
        best, behind = np.full(len(word), -1, np.int64), starts[word].copy()
        while len(word):
            end = ends[word]
            key = node << 8 | letters[np.minimum(at, len(letters) - 1)]
            place = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
            on = (self.edge_keys[place] == key) & (at < end)
            node = np.where(on, self.edge_nodes[place], 0)
            at = at + on
            token = np.where(at == end, self.final_at[node], self.inner_at[node])
            longer = on & (token >= 0)
            best, behind = np.where(longer, token, best), np.where(longer, at, behind)
            stop = np.flatnonzero(~on | (at == end))
            if len(stop):
                owners.append(word[stop])
                tokens.append(best[stop])
                at[stop], node[stop], best[stop] = behind[stop], 0, -1
                live = at < end
                if not live.all():
                    word, at, node, best, behind = (x[live] for x in (word, at, node, best, behind))
        if not owners:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(tokens)[order], owner[order]

    def merge(self, words: str | list[str]) -> list:
        """The exact encoding of a word, or of each of several: the pair of the lowest rank is merged first, the leftmost of equals.

        Words of similar length are merged side by side, one merge each at a time.
        """
        if isinstance(words, str):
            return self.merge([words])[0]
        letters, starts, ends = _letters(words)
        out: list = [None] * len(starts)
        sizes = ends - starts
        for low, high in ((0, 8), (8, 16), (16, 32), (32, SHORT)):
            mine = np.flatnonzero((sizes > low) & (sizes <= high))
            for part in (mine[k:k + SIDE_BY_SIDE] for k in range(0, len(mine), SIDE_BY_SIDE)):
                for k, ids in zip(part.tolist(), self._merge_rows(letters, starts[part], sizes[part], high)):
                    out[k] = ids
        for k in np.flatnonzero(sizes > SHORT).tolist():
            inside = letters[starts[k]:ends[k]]
            out[k] = self._merge_long([*self.inner_of[inside[:-1]].tolist(), int(self.final_of[inside[-1]])])
        return out

    def _merge_rows(self, letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> list[list[int]]:
        rows, span = np.arange(len(starts)), np.arange(width)
        inside = span < sizes[:, None]
        ids = np.where(inside, self.inner_of[letters[np.where(inside, starts[:, None] + span, 0)]], -1)
        ids[rows, sizes - 1] = self.final_of[letters[starts + sizes - 1]]
        ranks = np.full(ids.shape, NEVER)  # of each id and the one behind it
        r, c = np.nonzero(inside[:, 1:])
        ranks[r, c] = self._ranks(ids[r, c], ids[r, c + 1])
        active = rows
        while len(active):
            at = ranks[active].argmin(axis=1)
            rank = ranks[active, at]
            some = rank != NEVER
            active, at, rank = active[some], at[some], rank[some]
            if not len(active):
                break
            for table, empty in ((ids, -1), (ranks, NEVER)):  # close the gap behind the merged id
                part = table[active]
                shifted = np.concatenate([part[:, 1:], np.full((len(active), 1), empty)], axis=1)
                table[active] = np.where(span > at[:, None], shifted, part)
            ids[active, at] = self.merged_ids[rank]
            last = np.minimum(at + 1, width - 1)
            right = np.where(at + 1 < width, ids[active, last], -1)
            ranks[active, at] = np.where(right >= 0, self._ranks(ids[active, at], right), NEVER)
            left = at > 0
            a, k = active[left], at[left]
            ranks[a, k - 1] = self._ranks(ids[a, k - 1], ids[a, k])
        left_over = ids >= 0
        return [x.tolist() for x in np.split(ids[left_over], np.cumsum(left_over.sum(axis=1))[:-1])]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ranks[at], NEVER)

    @cached_property
    def rank_of(self) -> dict[int, int]:
        """Ranks of pairs one by one; made when the first long word comes."""
        return dict(zip(self.keys.tolist(), self.key_ranks.tolist()))

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap of pairs, for words whose length makes a search for the lowest rank slow."""
        after = [*range(1, len(ids)), -1]
        prior = [-1, *range(len(ids) - 1)]
        numbers = np.array(ids, np.int64)
        ranks = self._ranks(numbers[:-1], numbers[1:])
        some = np.flatnonzero(ranks != NEVER)
        heap = [(r, i, (ids[i], ids[i + 1])) for r, i in zip(ranks[some].tolist(), some.tolist())]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            if j < 0 or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = int(self.merged_ids[rank]), -1
            after[i] = after[j]
            if after[j] >= 0:
                prior[after[j]] = i
            for left, right in ((prior[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (rank := self.rank_of.get(ids[left] << 32 | ids[right])) is not None:
                    heapq.heappush(heap, (rank, left, (ids[left], ids[right])))
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of words as the pre-tokenizer cuts them; none is empty."""
        letters, starts, ends = _letters(words)
        tokens, owner = self.propose(letters, starts, ends)
        failing = np.zeros(len(words), bool)
        failing[owner[~self.sound[tokens]]] = True
        inside = owner[:-1] == owner[1:]
        pairs, which = np.unique(tokens[:-1][inside] << 32 | tokens[1:][inside], return_inverse=True)
        good = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[which]
        failing[owner[:-1][inside][~good]] = True
        counts = np.bincount(owner, minlength=len(words))
        flat, stops = tokens.tolist(), np.cumsum(counts).tolist()
        cuts = [flat[a:b] for a, b in zip([0, *stops], stops)]
        wrong = np.flatnonzero(failing)
        if len(wrong):
            for k, ids in zip(wrong.tolist(), self.merge([words[k] for k in wrong])):
                cuts[k] = ids
        return cuts

    def cut(self, text: str) -> list[str | int]:
        """The words of a text in order, and the ids of special tokens that stand in it."""
        parts = self.split_special.split(text) if self.split_special else [text]
        out: list[str | int] = []
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
            elif part.isascii():
                out += self.ascii_words.findall(part.lower())
            else:
                # Lower case goes letter by letter, so a sigma has no final form.
                lower = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                first_plane = len(lower.encode("utf-16-le")) == 2 * len(lower)
                out += (self.plane_words if first_plane else self.words).findall(lower)
        return out

    def look_up(self, texts: list[list[str | int]]) -> dict[str | int, tuple]:
        """For each word of the texts: the number of its ids, then its forms."""
        if len(self.cache) > CACHED_WORDS:  # words still in use come back from the older half
            self.cache, self.older = {}, self.cache
        wanted = set().union(*texts) - self.cache.keys()
        again = wanted & self.older.keys()
        self.cache.update((w, self.older[w]) for w in again)
        new = wanted - again
        words = [w for w in new if isinstance(w, str)]
        long = {w: self._entry([w]) for w in new if isinstance(w, int)}
        for w, ids in zip(words, self.encode_words(words) if words else []):
            (self.cache if len(w) <= CACHED_LENGTH else long)[w] = self._entry(ids)
        return _Layered(long, self.cache) if long else self.cache

    def _entry(self, ids: list[int]) -> tuple:
        return len(ids), *(make(ids) for make in self.makers)

    def text(self, ids: list[int]) -> str:
        """The ids in decimal digits, joined by one space."""
        return " ".join(map(self.decimals.__getitem__, ids))

    def numbers(self, ids: list[int]) -> bytes:
        """The ids as 32-bit numbers."""
        return np.array(ids, np.int32).tobytes()

    def decode(self, ids: list[int]) -> str:
        """The tokens' texts joined by one space, for the vocabulary names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


class _Layered(dict):
    """Entries that are not remembered, then the cache."""

    def __init__(self, new: dict, rest: dict) -> None:
        super().__init__(new)
        self.rest = rest

    def __missing__(self, key):
        return self.rest[key]


def _model(spec: str, forms: tuple[str, ...]) -> WordBpe:
    """The vocabulary of this worker, read once; only the last one asked for is kept."""
    models = worker_cache("bpe")
    key = (hashlib.md5(spec.encode()).hexdigest(), forms)
    if key not in models:
        models.clear()
        give_back()  # what was remembered before, else the new vocabulary comes on top of it
        models[key] = WordBpe(spec, forms)
        give_back()
    return models[key]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Rows in parts of bounded size; a longer text is a part of its own.

    Only the texts of one part are Python strings at a time.
    """
    for batch in batches:
        keys, column = batch.column(0), batch.column(1)
        lengths = pc.utf8_length(column).to_pylist()
        start, chars = 0, 0
        for i, length in enumerate(lengths):
            chars += length
            if chars >= BATCH_CHARS or i + 1 - start >= BATCH_ROWS:
                yield keys.slice(start, i + 1 - start), column.slice(start, i + 1 - start).to_pylist()
                start, chars = i + 1, 0
        if start < len(lengths):
            yield keys.slice(start), column.slice(start).to_pylist()


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           columns: tuple[str, ...] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """Encode whole texts and decode them again.

    ``vocabulary`` is the path of a tokenizer file that the driver can open.
    ``columns`` chooses among ``n_tokens``, ``ids`` (array of int), ``decoded``
    (the text that the ids give back), ``ids_sha256`` (of the decimal ids joined
    by one space) and ``decoded_sha256``. One row for each input row, ids
    unchanged; null and empty texts have no tokens. Special tokens written in a
    text are encoded as such. Other columns are ignored, an empty table gives an
    empty result.
    """
    with open(vocabulary, encoding="utf-8") as file:
        spec = file.read()
    ship_package(docs.sparkSession)
    kinds = {"n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}
    rows = docs.select(F.col(id_col), or_empty(text_col).alias("text"))
    key = rows.schema[0].dataType.simpleString()

    form_of = {"ids": "numbers", "ids_sha256": "text", "decoded": "decoded", "decoded_sha256": "decoded"}
    forms = tuple(dict.fromkeys(form_of[c] for c in columns if c in form_of))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(spec, forms)
        for keys, texts in _slices(batches):
            cut = [model.cut(t) for t in texts]
            entry = model.look_up(cut)
            found = [[entry[w] for w in words] for words in cut]
            sizes = [sum(e[0] for e in row) for row in found]
            out = {}
            for name in columns:
                place = 1 + forms.index(form_of[name]) if name in form_of else 0
                if name == "n_tokens":
                    out[name] = pa.array(sizes, pa.int64())
                elif name == "ids":
                    flat = np.frombuffer(b"".join([e[place] for row in found for e in row]), np.int32)
                    out[name] = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(flat))
                else:
                    joined = (" ".join([e[place] for e in row]) for row in found)
                    out[name] = pa.array(joined if name == "decoded" else map(_sha256, joined), pa.string())
            yield pa.RecordBatch.from_arrays([keys, *out.values()], [id_col, *out])

    return rows.mapInArrow(tidy(run), ", ".join([f"`{id_col}` {key}", *(f"{c} {kinds[c]}" for c in columns)]))
