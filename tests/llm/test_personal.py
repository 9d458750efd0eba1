import hashlib
import re

from taxoweave.llm import personal, queries

SCHEMA = "doc_id long, text string, base string, email string, token int"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.split("."))
    if kind == "card":
        total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) if len(digits) < 20 else 1
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def brute(text):
    found = [(m.start(), n, m.end(), k) for n, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if holds(k, m[0])]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(found)]


def check(rows, got):
    rows = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        want = brute(rows[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w.startswith(k + ":") for w in want) for k in PATTERNS), r.doc_id
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), r.doc_id
        assert set(want) - {""} <= set(r.spans.split(","))


ROWS = list(enumerate([
    None, "", "é𝔘 a.b@c.de, x@y.z_d@e.f @a.b a@b a@b. a@b..c a@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0255.00.1.007 1.2.3.4567890123456789012345 1..2.3.4",
    "4041 8949 7460 8795 4041-8949-7460-8795 4041894974608795 4041894974608796 40418949746087950000 4 0 4  1", "+1 (988) 555-2485 4041894974608795 x +1-2 +123456789 0 +1234567890123456",
    "+1 (988) 555-2485 or +1 (988) 555-2486.", "x" * 100_000 + "@y.zz", "1" * 100_000, "1." * 50_000, "a@" * 20_000, "+1" + " " * 100_000 + "2", "9 " * 30_000,
    "0" * 16, "1.1.1.1 " * 3000, "ａ@b.cc ١٢٣٤٥٦٧٨٩٠١٢٣٤٥",
]))


def test_base_spans_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in ROWS], SCHEMA)
    check(ROWS, personal.personal_digest(personal.scan(df)).collect())


def test_contexts_discover_unseen_identifiers(spark):
    texts = [f"word{i} your mail address: user{i}@site.org please" for i in range(5)] + [f"n{i} at host 10.0.0.{i} now" for i in range(5)]
    texts += ["é your mail address: root@localhost please", "plain text with other@thing in it", "no at host 10.0.0.999 now", "at 10.0.0.998 on", "your mail address: 55512345 please"]
    got = {r.doc_id: r.spans for r in personal.personal_digest(personal.scan(spark.createDataFrame([(i, t, "", "", 1) for i, t in enumerate(texts)], SCHEMA))).collect()}
    assert got[10] == "context_email:21:35" and got[12] == "context_ip:11:21"
    assert got[11] == got[13] == got[14] == ""


def test_pattern_needs_precision_and_support(spark):
    edges = [("0", "good", f"s{i}", True) for i in range(4)] + [("0", "good", "new", False)] + [("0", "vague", f"s{i}", True) for i in range(4)]
    edges += [("0", "vague", f"x{i}", False) for i in range(9)] + [("0", "rare", "s1", True), ("0", "rare", "y", False)]
    edges += [("0", "second", f"s{i}", True) for i in range(4)] + [("0", "second", "new", False), ("0", "second", "third", False)]
    known = personal._learnt(spark.createDataFrame(edges, "kind string, context string, value string, seed boolean"), 1)
    assert {r.value for r in known.collect()} == {"new"}
    known = personal._learnt(spark.createDataFrame(edges, "kind string, context string, value string, seed boolean"), 2)
    assert {r.value for r in known.collect()} == {"new", "third"}  # "new" now counts as known for the second pattern


def test_repeated_rows_and_empty(spark):
    rows = [(1, "a@b.cc", "", "", 1), (1, "a@b.cc", "", "", 1), (None, "+1 (988) 555-2485", "", "", 1)]
    got = [(r.doc_id, r.spans) for r in personal.personal_digest(personal.scan(spark.createDataFrame(rows, SCHEMA))).collect()]
    assert sorted(got, key=str) == [(1, "email:0:6"), (1, "email:0:6"), (None, "phone:0:17")]
    assert personal.personal_digest(personal.scan(spark.createDataFrame([], SCHEMA))).collect() == []


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check(rows, queries.op8_personal(spark, folder).collect())


def test_spaced_numbers_are_discovered(spark):
    """Phones without a plus and cards with a wrong check digit, in contexts that well-formed ones teach."""
    texts = [f"call me on phone +1 415 555 10{i:02d} today" for i in range(30)] + [f"paid by card no 4041 8949 7460 8795 today {i}" for i in range(1)]
    texts += [f"paid by card no {n} today" for n in ("4111 1111 1111 1111", "5500-0000-0000-0004", "4012888888881881")]
    odd = ["call me on phone (988) 555-2000 today", "call me on phone 988 555 3000 today", "call me on phone 9885552485 today", "the 12 13 14 15 16 17 18 numbers",
           "paid by card no 4041 8949 7460 8796 today", "mail a@b.cc or call me on phone 988 555 4000 today", "é call me on phone\n988 555 5000 today"]
    rows = [(i, t, "", "", 1) for i, t in enumerate(texts + odd)]
    got = {r.doc_id: r.spans for r in personal.personal_digest(personal.scan(spark.createDataFrame(rows, SCHEMA))).collect()}
    found = [got[len(texts) + k] for k in range(len(odd))]
    assert found == ["context_phone:17:31", "context_phone:17:29", "context_phone:17:27", "", "context_card:16:35", "email:5:11,context_phone:32:44", "context_phone:19:31"]
