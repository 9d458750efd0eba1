import random

import pytest
from pyspark.sql import functions as F

from tests.brute import candidates
from tests.conftest import TAXONOMY
from taxoweave.operators import retrieval as R
from taxoweave.operators.matching import ANY_NEEDLE, gram_sizes, substring_hits

SYNONYMS = {"salesforce": ("crm", "apps"), "digital twin": ("compute",), "temp": ("contractors", "staff")}
TEXTS = [
    "Salesforce licence renewal", "digital twin platform", "xdigital twinx", "nothing here at all", "",
    "gas", "biogasx works", "hr software", "contractor pay", "IT Contractors for cloud hosting", "temp staff",
    "uniforms and UNIFORMS & gas", "crm crm crm tools", "air", "staff", "a an the of", "é contractor",
]


def texts(spark):
    rng = random.Random(7)
    vocabulary = sorted({w for leaf in TAXONOMY for part in leaf[1:] for w in part.split()} | {"temp", "salesforce", "zz"})
    more = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 5))) for _ in range(60)]
    return [(i, t) for i, t in enumerate(TEXTS + more)]


@pytest.mark.parametrize("top_n", [3, 7, 15])
@pytest.mark.parametrize("limit", [R.BROADCAST_LEAVES, 0])
@pytest.mark.parametrize("pruned", [R.PRUNED_LEAVES, 0])
def test_same_as_scoring_every_leaf(spark, taxonomy, monkeypatch, top_n, limit, pruned):
    """Both join strategies and both rankings give the result of comparing every text with every leaf."""
    monkeypatch.setattr(R, "BROADCAST_LEAVES", limit)
    monkeypatch.setattr(R, "PRUNED_LEAVES", pruned)
    index = R.TaxonomyIndex(taxonomy, R.Lexicon(synonyms=SYNONYMS))
    assert index.bounded is (limit > 0)
    rows = texts(spark)
    found = {}
    for row in index.candidates(spark.createDataFrame(rows, "query_id bigint, text string"), top_n).collect():
        found.setdefault(row.query_id, (row.branch, []))[1].append((row.rank, row.ordinal, row.score))
    for key, text in rows:
        branch, ranked = candidates(text, TAXONOMY, set(index.lexicon.stopwords), SYNONYMS, top_n)
        assert found[key][0] == branch, text
        assert [r[1:] for r in sorted(found[key][1])] == [tuple(r) for r in ranked], text


def test_all_branches_occur(spark):
    kinds = {candidates(t, TAXONOMY, set(R.Lexicon().stopwords), SYNONYMS, 7)[0] for _, t in texts(spark)}
    assert kinds == {"strong", "moderate", "weak"}


def test_explanation_adds_up(spark, taxonomy):
    index = R.TaxonomyIndex(taxonomy, R.Lexicon(synonyms=SYNONYMS))
    queries = spark.createDataFrame(texts(spark), "query_id bigint, text string")
    why = index.explain(queries).groupBy("query_id", "ordinal").agg(F.sum("points").alias("points"))
    scored = index.candidates(queries).filter("score > 0")
    assert scored.join(why, ["query_id", "ordinal"], "left").filter("NOT score <=> points").isEmpty()


def test_empty_taxonomy_gives_no_candidates(spark, taxonomy):
    index = R.TaxonomyIndex(taxonomy.limit(0), R.Lexicon(synonyms={}))
    assert index.candidates(spark.createDataFrame([(1, "x")], "query_id bigint, text string")).isEmpty()


def test_substring_join_finds_needles_of_any_length(spark):
    needles = ["a", "ab", "abc", "abcd", "abcde", "%", "b c", "zz", ""]
    rows = [(1, "xabcdex ab"), (2, "100% b c"), (3, ""), (4, "zzz")]
    hits = substring_hits(
        spark.createDataFrame(rows, "id int, t string"), "t",
        spark.createDataFrame([(n,) for n in needles], "needle string"), bounded=True,
    )
    expected = sorted((i, n) for i, t in rows for n in needles if n and n in t)
    assert sorted(map(tuple, hits.collect())) == expected
    assert gram_sizes(None) == (4,) and gram_sizes(3) == (3,) and gram_sizes(1) == ANY_NEEDLE


def test_long_notes_repeated_ordinals_and_null_texts(spark):
    """Features of a leaf are not numbered by place, so neither long notes nor equal ordinals mix them up."""
    from taxoweave.schemas import TAXONOMY as SCHEMA

    note = " ".join(f"term{i}" for i in range(9_000))
    leaves = [(1, "A", "B", "C", "Dee", "A > B > C > Dee", note), (2, "E", "F", "G", "Hay", "E > F > G > Hay", "term1"), (3, "I", "J", "K", "Ell", "x", "")]
    rows = [(1, "term0 term8500 term8999"), (2, "term1 hay"), (3, None)]
    index = R.TaxonomyIndex(spark.createDataFrame(leaves, SCHEMA), R.Lexicon(synonyms={}))
    found = {}
    for row in index.candidates(spark.createDataFrame(rows, "query_id bigint, text string"), 7).collect():
        found.setdefault(row.query_id, []).append((row.rank, row.ordinal, row.score))
    for key, text in rows:
        _, ranked = candidates(text or "", leaves, set(index.lexicon.stopwords), {}, 7)
        assert [r[1:] for r in sorted(found[key])] == [tuple(r) for r in ranked]
    twice = R.TaxonomyIndex(spark.createDataFrame([leaves[1], (2, "P", "Q", "R", "Sea", "y", "")], SCHEMA), R.Lexicon(synonyms={}))
    scores = twice.signals.groupBy("feature").agg(F.count_distinct("term").alias("terms"))
    assert scores.where("terms > 1").isEmpty()


def wide_taxonomy(n, seed=3):
    rng = random.Random(seed)
    things, kinds, groups = [f"thing{i}" for i in range(n // 4)], [f"kind{i}" for i in range(40)], ["alpha", "beta", "gamma"]
    out = []
    for i in range(n):
        levels = (rng.choice(groups), rng.choice(kinds), f"class{rng.randrange(200)}", " ".join(rng.sample(things, 2)))
        out.append((i * 3, *levels, " > ".join(levels), rng.choice(["", "", "", "about " + rng.choice(things)])))
    return out


def test_ranking_by_bounds_opens_few_blocks(spark, monkeypatch):
    from taxoweave.schemas import TAXONOMY as SCHEMA

    leaves = wide_taxonomy(3_000)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices([w for leaf in rng.sample(leaves, 3) for w in leaf[5].split() if w != ">"], k=4))) for i in range(80)]
    rows += [(100, "alpha"), (101, "beta gamma"), (102, "nothing"), (103, "kind1 alpha beta gamma"), (104, None)]
    index = R.TaxonomyIndex(spark.createDataFrame(leaves, SCHEMA), R.Lexicon(synonyms={}))
    queries = spark.createDataFrame(rows, "query_id bigint, text string")
    found = {}
    for row in index.candidates(queries, 15).collect():
        found.setdefault(row.query_id, []).append((row.rank, row.ordinal, row.score))
    for key, text in rows:
        _, ranked = candidates(text or "", leaves, set(index.lexicon.stopwords), {}, 15)
        assert [r[1:] for r in sorted(found[key])] == [tuple(r) for r in ranked], text
    signatures = index.signatures(queries)
    pairs = index.contenders(index._distinct(signatures)).count()
    assert pairs < 0.1 * signatures.select("sig_a", "sig_b").distinct().count() * len(leaves)


def test_needles_found_by_places_alone(spark):
    """Tiles at their distances, in texts with repeats and letters beyond the first plane; no text is shuffled."""
    rng = random.Random(5)
    letters = ["a", "b", "\U0001F600", "\U0001F601", " ", "é"]
    rows = [(i, "".join(rng.choices(letters, k=rng.randint(0, 40)))) for i in range(60)] + [(99, "abababababab")]
    needles = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(60)] + ["abababab", "", "bab"]
    needles = list(dict.fromkeys(needles))
    df = spark.createDataFrame(rows, "id int, body string")
    hits = substring_hits(df, "body", spark.createDataFrame([(n,) for n in needles], "needle string"), bounded=False)
    assert sorted(map(tuple, hits.collect())) == sorted((i, n) for i, t in rows for n in needles if n and n in t)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "body" in line]
    assert "Exchange" in plan and all("Exchange" not in line for line in exchanged)


def test_large_lexicons_are_not_broadcast(spark, monkeypatch):
    rows = [(1, "digital twin temp"), (2, "salesforce"), (3, "nothing"), (4, None)]
    queries = spark.createDataFrame(rows, "query_id bigint, text string")
    lexicon = R.Lexicon(synonyms=SYNONYMS)
    small = {r.query_id: r.tokens for r in R.expand_tokens(queries, lexicon).collect()}
    monkeypatch.setattr(R, "BROADCAST_LEAVES", 0)
    assert not lexicon.bounded
    assert {r.query_id: r.tokens for r in R.expand_tokens(queries, lexicon).collect()} == small
    assert small[1] == ["compute", "contractors", "digital", "staff", "temp", "twin"]


def test_similar_leaves_open_few_blocks(spark, monkeypatch):
    """Names of few words on very many leaves: neither a rare number nor words that never stand together open whole lists."""
    from taxoweave.schemas import TAXONOMY as SCHEMA

    rng = random.Random(4)
    leaves = []
    for i in range(2_400):
        name = f"{rng.choice(['large', 'small', 'hot', 'old'])} {rng.choice(['ring', 'plate', 'bolt', 'rod'])}"
        levels = (rng.choice(["LARGE", "SMALL", "PROMO"]), f"Brand#{rng.randrange(25)}", name, f"{name} {i}")
        leaves.append((i + 1, *levels, " > ".join(levels), "seventh shelf" if i % 50 == 7 else ""))
    synonyms = {"urgent": ("hot", "plate"), "not specified": ("old", "rod")}
    rows = [(i, f"{leaf[4]}, {rng.choice(['1-URGENT', '3-MEDIUM', '4-NOT SPECIFIED'])}") for i, leaf in enumerate(rng.sample(leaves, 60))]
    index = R.TaxonomyIndex(spark.createDataFrame(leaves, SCHEMA), R.Lexicon(synonyms=synonyms))
    queries = spark.createDataFrame(rows, "query_id bigint, text string")
    found = {}
    for row in index.candidates(queries, 15).collect():
        found.setdefault(row.query_id, []).append((row.rank, row.ordinal, row.score))
    for key, text in rows:
        _, ranked = candidates(text, leaves, set(index.lexicon.stopwords), synonyms, 15)
        assert [r[1:] for r in sorted(found[key])] == [tuple(r) for r in ranked], text
    pairs = index.contenders(index._distinct(index.signatures(queries))).count()
    assert pairs < 0.08 * len(rows) * len(leaves)
    met = index._triggers.filter("kind = 'g'").groupBy("probe").count().agg(F.max("count")).first()[0]
    assert met < 0.02 * len(leaves)


def test_salted_copies_are_not_broadcast(spark):
    from taxoweave.operators.joins import dimension_join

    plan = dimension_join(spark.range(100), spark.range(10), ["id"], bounded=False)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_few_keys_need_no_row_for_each_word(spark):
    """A lexicon of few keys gives what the joins give, ids that repeat and null ones included, without a row for each word."""
    rows = [(1, "Digital Twin temp"), (1, "salesforce"), (None, "temp zz"), (2, ""), (3, None), (4, "xdigital twinx"), (5, "the of")]
    queries = spark.createDataFrame(rows, "query_id bigint, text string")
    found = R.expand_tokens(queries, R.Lexicon(synonyms=SYNONYMS))
    got = {r.query_id: r.tokens for r in found.collect()}
    assert got == {
        1: ["apps", "compute", "contractors", "crm", "digital", "salesforce", "staff", "temp", "twin"],
        None: ["contractors", "staff", "temp", "zz"], 4: ["compute", "twinx", "xdigital"],
    }
    assert "explode" not in found._jdf.queryExecution().executedPlan().toString().lower()  # one row for each text only
    plain = {r.query_id: r.tokens for r in R.expand_tokens(queries, R.Lexicon(synonyms={})).collect()}
    assert plain[4] == ["twinx", "xdigital"]


def test_many_needles_of_few_letters_meet_few_texts(spark, monkeypatch):
    """Numbered names share every short substring with many others; by places a text meets few of them still."""
    from taxoweave.operators import matching as M

    numbers = ["".join(str(i >> 2 * k & 3) for k in range(6)) for i in range(4096)]
    needles = [f"{'old ring' if i % 2 else 'hot bolt'} {n}" for i, n in enumerate(numbers)] + ["ring", "hot bolt"]
    rows = [(i, f"{needles[i * 7]}, urgent") for i in range(300)]
    met = []

    def join(*args, **kwargs):
        met.append(M_join(*args, **kwargs))
        return met[-1]

    M_join = M.dimension_join
    monkeypatch.setattr(M, "dimension_join", join)
    hits = M.placed_hits(spark.createDataFrame(rows, "id int, t string"), "t", spark.createDataFrame([(n,) for n in needles], "needle string"))
    assert sorted(map(tuple, hits.collect())) == sorted((i, n) for i, t in rows for n in needles if n in t)
    assert len(met) == 1 and met[0].count() < 6 * len(rows)
