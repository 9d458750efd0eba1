import hashlib
import random
import tracemalloc

import pytest
from tokenizers import Tokenizer

import public_tokenizers
from taxoweave.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def model():
    return bpe.WordBpe(open(PATH, encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(model, text):
    cut = model.cut(text)
    entry = model.look_up([cut])
    return [int(x) for w in cut for x in entry[w][1].split()]


TEXTS = [
    "", " ", "\n\t", "Hello, World! it's we'll DON'T ''s 'S 1234 ½ Ⅷ", "<|startoftext|>a<|endoftext|> <|END", "ΑΣ ΣΑΣ İstanbul ǅ ß ẞ",
    "é å Å ﬁ", "日本語 テキスト 한국어", "😀😀👩‍👩‍👧 ~~~~~~~~ ====", "a\x00b\x1c\x1d\x85\xa0　c​d\x7f", "x" * 5000, "=" * 3000, "ab" * 2000,
    "aaa aaaa aaaaa aaaaaaaaaaaaaa", "\U0001D518\U0001D518 กำ", "the</w> </w>", "'" * 50 + "s", "1" * 700,
]


def test_equals_the_library_on_odd_texts(model, library):
    for text in TEXTS:
        want = library.encode(text, add_special_tokens=False)
        got = ids_of(model, text)
        assert got == want.ids, text[:50]
        assert model.decode(got) == library.decode(want.ids, skip_special_tokens=False)


def test_equals_the_library_on_random_words(model, library):
    rng = random.Random(1)
    syllables = ["th", "er", "ing", "é", "ü", "tion", "a", "o", "ss", "%%%", "lowei", "qu", "x", "zz", "ñ", "1", "'", "ly"]
    for _ in range(300):
        text = " ".join("".join(rng.choices(syllables, k=rng.randint(1, 9))) for _ in range(30))
        assert ids_of(model, text) == library.encode(text, add_special_tokens=False).ids


def test_most_words_need_no_merging_but_some_do(model):
    merged = []
    exact = model.merge
    model.merge = lambda w: merged.append(w) or exact(w)
    words = [t for t in list(model.final)[600:4000] if t.isascii() and t.isalpha()]
    pairs = [a + b for a, b in zip(words, words[1:])]
    cuts = model.encode_words(pairs)
    model.merge = exact
    assert 0 < len(merged) < len(pairs)
    assert cuts == [exact(w) for w in pairs]


def test_rows(spark):
    df = spark.createDataFrame([(1, "Hello hello", 5), (2, None, 6), (2, "", 7), (None, "x", 8)], "doc_id long, text string, ids int")
    rows = {(r.doc_id, r.n_tokens): r for r in bpe.encode(df, PATH).collect()}
    assert set(rows) == {(1, 2), (2, 0), (None, 1)}
    assert rows[1, 2].decoded == "hello</w> hello</w>" and rows[2, 0].ids == []
    assert bpe.encode(df.limit(0), PATH).collect() == []


def test_query_equals_the_library(spark, folder, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.op10_bpe(spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_side_by_side_merging_equals_the_heap(model):
    rng = random.Random(5)
    letters = "etaoinsrhlé'%zqж😀"
    words = ["".join(rng.choices(letters, k=rng.randint(1, 50))) for _ in range(800)]
    for word, ids in zip(words, model.merge(words)):
        raw = word.encode()
        assert ids == model._merge_long([*model.inner_of[list(raw[:-1])].tolist(), int(model.final_of[raw[-1]])])


def test_only_failing_words_are_merged(model):
    merged = []
    exact = model.merge
    model.merge = lambda words: merged.extend(words) or exact(words)
    words = [t for t in list(model.final)[600:4000] if t.isascii() and t.isalpha()]
    try:
        pairs = [a + b for a, b in zip(words, words[1:])]
        model.encode_words(pairs)
    finally:
        model.merge = exact
    assert 0 < len(merged) < len(pairs) and set(merged) <= set(pairs)


def test_columns_and_long_texts(spark, library):
    text = "some words, and längere Wörter 12 " * 60_000
    df = spark.createDataFrame([(1, text), (1, text), (2, "x")], "doc_id long, text string")
    want = library.encode(text, add_special_tokens=False).ids
    rows = bpe.encode(df, PATH, columns=("ids", "n_tokens")).collect()
    assert sorted(r.n_tokens for r in rows) == [1, len(want), len(want)]
    assert all(r.ids == want for r in rows if r.doc_id == 1)


def test_a_worker_builds_the_vocabulary_in_little_memory():
    with open(PATH, encoding="utf-8") as file:
        spec = file.read()
    tracemalloc.start()
    try:
        built = bpe.WordBpe(spec, ("numbers",))
        kept, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert kept < 25 << 20 and most < 50 << 20  # 34 and 63 when whole parts of the file were kept
    assert built.encode_words(["hello"]) == [built.merge("hello")]
