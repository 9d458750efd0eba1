import random

from pyspark.sql import functions as F

from taxoweave.llm import queries, warc

SCHEMA = "record_id long, kind string, url string, time long, http string, key string, slice int, found string"


def test_canonical_urls(spark):
    cases = {
        "HTTP://Example.COM:80/a?b=2&a=1#x": "http://example.com/a?a=1&b=2", "https://e.com": "https://e.com/", "https://e.com:8443?z": "https://e.com:8443/?z",
        "https://u:p@e.com:443/A%20b?": "https://e.com/A%20b", "no scheme#f": "no scheme", "": "", " http://e.com/&&? ": "http://e.com/&&", None: None,
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r.u: r.c for r in df.select("u", warc.canonical_url(F.col("u")).alias("c")).collect()} == cases


def test_header_map(spark):
    block = "HTTP/1.1 200 OK\r\nA: 1\r\na:  2 \nB:x:y\r\nbroken line\r\n: none\r\n"
    got = spark.createDataFrame([(block,), (None,)], "b string").select(warc.header_map(F.col("b")).alias("m"), warc.status_of(F.col("b")).alias("s")).collect()
    assert [(r.m, r.s) for r in got] == [({"a": "1, 2", "b": "x:y"}, 200), ({}, 0)]


def block(status, **fields):
    return "\r\n".join([f"HTTP/1.1 {status} X", *[f"{k.replace('_', '-')}: {v}" for k, v in fields.items()]])


def brute(rows):
    """Resolution and response of each revisit, one by one."""
    out = []
    full = [r for r in rows if r[1] == "response" and r[2] is not None and r[3] is not None and (r[4] or "").startswith("HTTP/1.1 200")]
    for i, kind, url, time, http in rows:
        if kind != "revisit":
            continue
        earlier = [r for r in full if url is not None and time is not None and r[2] == url and r[3] < time]
        best = max(earlier, key=lambda r: (r[3], r[0]), default=None)
        fields = [dict(x.split(": ", 1) for x in (h or "").split("\r\n")[1:]) for h in (http, best[4] if best else "")]
        new, old = ({k.lower(): v for k, v in f.items()} for f in fields)
        result = "unverified"
        if best is None:
            result = "no_response"
        elif "etag" in new and "etag" in old:
            result = "resolved" if new["etag"].removeprefix("W/") == old["etag"].removeprefix("W/") else "mismatch"
        elif "last-modified" in new and "last-modified" in old:
            result = "resolved" if new["last-modified"] == old["last-modified"] else "mismatch"
        if result == "resolved":
            new = old | {k: v for k, v in new.items() if k not in warc.KEPT_FIELDS}
        out.append((i, best and best[0], result, sorted(new.items())))
    return sorted(out, key=str)


def test_resolution_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(warc, "SLICE_ROWS", 20)
    rng = random.Random(0)
    rows = []
    for i in range(500):
        url = rng.choice(["http://hot.com/"] * 6 + [f"http://e.com/{k}" for k in range(8)] + [None])
        time = rng.choice([rng.randrange(60), rng.randrange(60), 7, None])
        fields = {k: v for k, v in {"ETag": rng.choice(['"a"', 'W/"a"', '"b"']), "Last_Modified": rng.choice("xy"), "Content_Length": i, "Cache_Control": i, "Content_Type": f"t{i}"}.items() if rng.random() < 0.7}
        kind = rng.choice(["response", "response", "revisit", "revisit", "warcinfo"])
        rows.append((i, kind, url, time, rng.choice([block(304 if kind == "revisit" else rng.choice([200, 200, 404]), **fields)] * 9 + [None])))
    rows += rows[:20]
    df = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA)
    got = warc.resolve_revisits(df)
    assert got.columns == ["record_id", "url", "response_id", "resolution", "headers"]
    assert sorted(((r.record_id, r.response_id, r.resolution, sorted(r.headers.items())) for r in got.collect()), key=str) == brute(rows)


def test_empty(spark):
    assert warc.resolve_revisits(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_has_a_row_for_every_page(spark, folder):
    got = queries.op2_warc(spark, folder).collect()
    assert len(got) == spark.read.parquet(f"{folder}/pages.parquet").count()
    assert {r.resolution for r in got} >= {"resolved", "unverified"}
