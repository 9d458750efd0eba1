import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import public_tokenizers
from taxoweave.llm import alignment, queries

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

TEXTS = [
    "", " ", "  \n\t ", "Hello, World! it's we'll DON'T", "<|endoftext|> <s> </s> <unk> <0x41>", "ΑΣ ΣΑΣ İstanbul ß", "日本語 テキスト 한국어 ไทย",
    "😀😀👩‍👩‍👧 ~~~~ ====", "a\x00b\x1c\x85\xa0　c​d\x7f", "x" * 3000, "=" * 2500, "ab" * 900, "▁literal▁mark", "\U0001D518 \U0010FFFF",
    "the cat sat on the mat", "the cat sat on the mat", " " * 700, "\n" * 301 + "end", "1234567890" * 40, "é́" * 50,
]


def cut(libraries, text):
    a_lib, a_bytes, b_lib, b_bytes = libraries
    a = a_lib.encode(" " + text, add_special_tokens=False).ids
    b = b_lib.encode(text)
    raw = (" " + text).encode()
    if not text or b"".join(a_bytes[i] for i in a) != raw or b"".join(b_bytes[i] for i in b) != raw:
        return None
    return a, [len(a_bytes[i]) for i in a], b, [len(b_bytes[i]) for i in b]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    letters = alignment.byte_letters()
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    b_bytes = {i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())}
    return a, a_bytes, b, b_bytes


def brute(libraries, rows):
    docs = []
    for key, text in rows:
        found = cut(libraries, text or "")
        groups = []
        if found:
            a, len_a, b, len_b = found
            ends_a, ends_b = np.cumsum(len_a).tolist(), np.cumsum(len_b).tolist()
            last_a = last_b = 0
            for end in sorted(set(ends_a) & set(ends_b)):
                i, j = ends_a.index(end) + 1, ends_b.index(end) + 1
                groups.append((a[last_a:i], b[last_b:j]))
                last_a, last_b = i, j
        docs.append((key, found, groups))
    held = collections.Counter()
    for _, _, groups in docs:
        held.update({(x, y) for g, h in groups for x in g for y in h})
    highest = {}
    for (x, _), n in held.items():
        highest[x] = max(highest.get(x, 0), n)
    out = []
    for key, found, groups in docs:
        links = [(x, y) for g, h in groups for x in g for y in h]
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((key, len(found[0]) if found else 0, len(found[2]) if found else 0, len(groups), len(links), sum(held[p] == highest[p[0]] for p in links),
                    sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if found else ""))
    return sorted(out, key=str)


def result(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("lane,part,block,listed", [(128, 1 << 20, 1 << 23, 1 << 16), (3, 50, 200, 4), (7, 4000, 5000, 1)])
def test_equals_brute_force(spark, monkeypatch, libraries, lane, part, block, listed):
    for name, value in (("LANE", lane), ("PART_CHARS", part), ("BLOCK_CHARS", block), ("LISTED", listed)):
        monkeypatch.setattr(alignment, name, value)
    rng = random.Random(lane)
    words = " ".join(TEXTS[:9]).split() + ["the", "über", "naïve", "tokenization", "zürich", "xq", "1.5", "\t", "\n\n", "  "]
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "the cat"), (None, None), (3, "repeated id"), (3, "repeated id"), (99, None)]
    rows += [(100 + k, "".join(rng.choice(words) + rng.choice([" ", "", "  "]) for _ in range(60))) for k in range(25)]
    df = spark.createDataFrame([(k, t, 1, "x", "y") for k, t in rows], "doc_id long, text string, n_a int, block string, pairs string").repartition(3)
    assert result(alignment.align(df, BYTES, PIECES)) == brute(libraries, rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert result(alignment.align(df, BYTES, PIECES)) == []
    alone = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert result(alignment.align(alone, BYTES, PIECES)) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_vocabularies_equal_the_libraries(libraries):
    a, b = alignment.Vocabulary.of(alignment.ByteBpe, open(BYTES, encoding="utf-8").read()), alignment.Vocabulary.of(alignment.Pieces, open(PIECES, "rb").read())
    assert a.tokens == libraries[1] and b.tokens == libraries[3]
    for text in TEXTS:
        assert a.encode([" " + text]) == [libraries[0].encode(" " + text, add_special_tokens=False).ids]


def test_stretches_are_jumped():
    """One-to-one stretches take few comparisons; ends that are rarely shared, and runs that part at equal shifts, come out right."""
    rng = np.random.default_rng(0)
    for share_a, share_b in ((0.9, 0.9), (0.3, 0.3), (0.02, 0.05), (1.0, 0.001)):
        ends = np.arange(1, 20_000)
        a = np.unique(np.append(ends[rng.random(len(ends)) < share_a], 20_000))
        b = np.unique(np.append(ends[rng.random(len(ends)) < share_b], 20_000))
        stops = np.array([len(a)]), np.array([len(b)])
        for starts in (alignment.lanes(a, b, *stops), (np.array([0]), np.array([0]), *stops)):
            p, q = alignment.shared_ends(a, b, *starts)
            want = np.intersect1d(a, b)
            assert (a[p] == want).all() and (b[q] == want).all() and len(p) == len(want)
    rounds = []
    exact = np.unique
    try:
        np.unique = lambda *x, **y: rounds.append(1) or exact(*x, **y)
        same = np.arange(1, 100_001)
        p, _ = alignment.shared_ends(same, same, np.array([0]), np.array([0]), np.array([100_000]), np.array([100_000]))
    finally:
        np.unique = exact
    assert len(p) == 100_000 and len(rounds) < 100_000 / alignment.STRETCH + 10


def test_query_equals_brute_force(spark, folder, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert result(queries.op12_alignment(spark, folder).select(*COLUMNS)) == brute(libraries, rows)
