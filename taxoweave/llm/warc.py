"""Resolution of not-modified revisits in web archives.

A revisit record of a 304 answer has headers but no payload. It is resolved by
an as-of join: the latest full response of the same canonical URL that is
strictly earlier. If its validators agree with the revisit's, the revisit takes
over the payload of that response, and its headers update the stored ones as
far as a 304 may.

The join cuts time into slices, so that a URL captured very often is the work
of many tasks: a revisit looks within its own slice first, and else takes the
last response of the slices before, from a table with a row for each URL and
slice. Payloads never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, settle

#: Records that a slice of time holds on average.
SLICE_ROWS = 20_000
# Header fields that a 304 answer doesn't change in a stored response (HTTP caching, RFC 9111, sections 3.1 and 3.2).
KEPT_FIELDS = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate",
               "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, without the scheme's own port, user or fragment; parameters sorted, an empty path as ``/``.

    What has no scheme or host stays as it is, without its fragment; null stays null.
    """
    bare = F.regexp_replace(F.trim(url), "(?s)#.*$", "")
    pattern = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?@]*@)?([^/?:]+)(?::([0-9]*))?([^?]*)(\?.*)?$"

    def built(text: Column) -> Column:
        part = [F.regexp_extract(text, pattern, i) for i in range(6)]
        scheme, host, port = F.lower(part[1]), F.lower(part[2]), part[3]
        own = (port == "") | (F.concat(scheme, F.lit(":"), port).isin("http:80", "https:443", "ftp:21"))
        query = F.array_join(F.array_sort(F.filter(F.split(F.substring(part[5], 2, 1 << 30), "&"), lambda p: p != "")), "&")
        path = F.when(part[4] == "", "/").otherwise(part[4])
        return F.when(part[1] == "", text).otherwise(F.concat(
            scheme, F.lit("://"), host, F.when(own, "").otherwise(F.concat(F.lit(":"), port)), path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))

    return let(bare, built)


def header_map(block: Column) -> Column:
    """The header fields of an HTTP message: names in lower case; repeated fields are joined by a comma. Null has none."""
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), r"\r?\n"), lambda x: x.rlike(r"^[^:\s]+:"))
    fields = F.transform(lines, lambda x: F.struct(
        F.lower(F.substring_index(x, ":", 1)).alias("name"), F.regexp_replace(x, r"^[^:]*:\s*|\s+$", "").alias("value")))
    return let(fields, lambda fs: let(F.array_distinct(F.transform(fs, lambda f: f["name"])), lambda names: F.map_from_arrays(
        names, F.transform(names, lambda n: F.array_join(F.transform(F.filter(fs, lambda f: f["name"] == n), lambda f: f["value"]), ", ")))))


def status_of(block: Column) -> Column:
    """The status of an HTTP response, 0 if there is none."""
    return F.coalesce(F.regexp_extract(block, r"^HTTP/\S+\s+([0-9]{3})\b", 1).try_cast("int"), F.lit(0))


def opaque_tag(tag: Column) -> Column:
    """An entity tag for weak comparison: without its weakness mark."""
    return F.regexp_replace(tag, "^W/", "")


def latest_earlier(records: DataFrame, slices: int) -> DataFrame:
    """Add ``found``: the payload struct of the latest response of the same ``key`` at a strictly earlier ``time``.

    ``records`` has ``key``, ``time``, ``id``, ``offered`` (struct of a response,
    null for others). Of responses at the same time the largest id is latest.
    """
    low, high = records.agg(F.min("time"), F.max("time")).first()
    slot = F.width_bucket(F.col("time").cast("double"), F.lit(float(low)), F.lit(float(high) + 1.0), F.lit(slices)) if low is not None else F.lit(0)
    sliced = records.withColumn("slice", slot)
    # At one time those that ask come before the responses, so that these aren't earlier.
    order = Window.partitionBy("key", "slice").orderBy("time", F.col("offered").isNotNull(), "id")
    within = sliced.withColumn("found", F.last("offered", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = sliced.groupBy("key", "slice").agg(F.max_by("offered", F.when(F.col("offered").isNotNull(), F.struct("time", "id"))).alias("end"))
    before = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("key", "slice", F.last("end", ignorenulls=True).over(before).alias("carried")).where("carried is not null")
    asking = within.where("offered is null")
    return asking.join(carried, ["key", "slice"], "left").withColumn("found", F.coalesce("found", "carried"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Resolve each revisit: ``record_id``, ``url`` (canonical), ``response_id``, ``resolution``, ``headers`` (map).

    ``records`` has ``record_id``, ``kind`` (``response``, ``revisit`` or
    another, left out), ``url``, ``time`` (long) and ``http`` (status line and
    header fields). One row for each revisit row. ``resolution`` is

    * ``resolved``: entity tags agree by weak comparison, or, where one side has none, the dates of last change do;
    * ``mismatch``: they do not, so the page had changed in between;
    * ``unverified``: there is a response, but no validator that both have;
    * ``no_response``: no earlier full response (status 200), or no url or time.

    Headers are the merged ones for ``resolved``, else the revisit's own; and
    ``response_id`` is null for ``no_response`` alone. Null header blocks have no
    fields. Repeated rows are resolved each for itself. Other columns are
    ignored; an empty table gives an empty result.
    """
    slim = records.where("kind in ('response', 'revisit')").select(
        F.col("record_id").alias("id"), "kind", canonical_url(F.col("url")).alias("key"), F.col("time").cast("long").alias("time"), "http")
    usable = F.col("key").isNotNull() & F.col("time").isNotNull()
    slim = slim.where((F.col("kind") == "revisit") | (usable & (status_of(F.col("http")) == 200)))
    offered = F.when(F.col("kind") == "response", F.struct(F.col("id").alias("response_id"), F.col("http").alias("stored")))
    slim = settle(slim.withColumn("offered", offered), "records")
    slices = -(-slim.count() // SLICE_ROWS) or 1
    joined = latest_earlier(slim.where(usable), slices).select("id", "key", "http", "found")
    lost = slim.where(~usable).select("id", "key", "http", F.lit(None).cast(joined.schema["found"].dataType).alias("found"))
    parsed = joined.unionByName(lost).select(
        "id", "key", F.col("found.response_id").alias("response_id"), F.col("found").isNull().alias("none"), header_map(F.col("http")).alias("new"), header_map(F.col("found.stored")).alias("old"))
    tags = [opaque_tag(F.col(side)["etag"]) for side in ("new", "old")]
    dates = [F.col(side)["last-modified"] for side in ("new", "old")]
    agree = F.when(tags[0].isNotNull() & tags[1].isNotNull(), tags[0] == tags[1]).when(dates[0].isNotNull() & dates[1].isNotNull(), dates[0] == dates[1])
    resolution = F.when(F.col("none"), "no_response").when(agree.isNull(), "unverified").when(agree, "resolved").otherwise("mismatch")
    update = F.map_filter("new", lambda k, v: ~k.isin(*KEPT_FIELDS))
    merged = F.map_concat(F.map_filter("old", lambda k, v: ~F.map_contains_key(F.col("update"), k)), F.col("update"))
    resolved = parsed.withColumn("resolution", resolution).withColumn("update", update)
    return resolved.select(F.col("id").alias("record_id"), F.col("key").alias("url"), "response_id", "resolution",
                           F.when(F.col("resolution") == "resolved", merged).otherwise(F.col("new")).alias("headers"))


def header_lines(headers: Column) -> Column:
    """``name: value`` of each field, sorted, one to a line."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")


def crawl_of(pages: DataFrame) -> DataFrame:
    """A crawl derived from pages: each page's response and a later revisit of its URL.

    The response of page ``p`` has id ``2 p`` and time ``p``; the revisit, id
    ``2 p + 1``, follows 1,000 later, and by then another page of the same
    canonical URL may have come. Revisits carry a weak entity tag, or the date
    alone (every fifth page), or no validator (every seventh).
    """
    day = F.concat(F.lit("Mon, 01 Jan 2024 00:00:00 GMT +"), F.col("page_id").cast("string"))
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit("")).cast("binary")), F.lit('"'))
    size = F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    response = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: "), size, F.lit("\r\nETag: "), tag,
                        F.lit("\r\nLast-Modified: "), day, F.lit("\r\nCache-Control: max-age=60\r\nServer: origin"))
    validator = F.when(F.col("page_id") % 7 == 0, "").when(F.col("page_id") % 5 == 0, F.concat(F.lit("\r\nLast-Modified: "), day)).otherwise(
        F.concat(F.lit("\r\nETag: W/"), tag))
    revisit = F.concat(F.lit("HTTP/1.1 304 Not Modified\r\nContent-Length: 0\r\nCache-Control: max-age=120\r\nDate: "), day, validator)
    parts = F.array(
        F.struct((F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("kind"), F.col("page_id").alias("time"), response.alias("http")),
        F.struct((F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), (F.col("page_id") + 1000).alias("time"), revisit.alias("http")))
    return pages.select("url", F.explode(parts).alias("r")).select("url", "r.*")


#: The rows of op2_warc in DuckDB: the same crawl, an as-of join, and the fields that a 304 may change.
WARC_SQL = r"""
WITH p AS (
  SELECT page_id, md5(coalesce(html, '')) AS tag, octet_length(encode(coalesce(html, ''))) AS size,
    regexp_replace(trim(url), '#.*$', '', 's') AS bare FROM pages),
q AS (
  SELECT *, regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]+)([^?]*)(\?.*)?$', 1) AS scheme,
    regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]+)([^?]*)(\?.*)?$', 2) AS host,
    regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]+)([^?]*)(\?.*)?$', 3) AS path,
    regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]+)([^?]*)(\?.*)?$', 4) AS args FROM p),
c AS (
  SELECT page_id, tag, size, lower(scheme) || '://' || lower(host) || CASE WHEN path = '' THEN '/' ELSE path END
    || CASE WHEN len(args) > 1 THEN '?' || array_to_string(list_sort([x FOR x IN string_split(args[2:], '&') IF x <> '']), '&') ELSE '' END AS key,
    'Mon, 01 Jan 2024 00:00:00 GMT +' || page_id AS day FROM q),
j AS (
  SELECT v.*, r.page_id AS rp, r.tag AS rtag, r.size AS rsize, r.day AS rday
  FROM (SELECT *, page_id + 1000 AS t FROM c) v ASOF LEFT JOIN c r ON v.key = r.key AND v.t > r.page_id),
k AS (
  SELECT *, CASE WHEN rp IS NULL THEN 'no_response' WHEN page_id % 7 = 0 THEN 'unverified'
    WHEN page_id % 5 = 0 THEN CASE WHEN day = rday THEN 'resolved' ELSE 'mismatch' END
    WHEN tag = rtag THEN 'resolved' ELSE 'mismatch' END AS resolution FROM j)
SELECT page_id * 2 + 1 AS record_id, key AS url, rp * 2 AS response_id, resolution,
  'cache-control: max-age=120' || chr(10) || CASE WHEN resolution = 'resolved' THEN
    'content-length: ' || rsize || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || day || chr(10)
    || 'etag: ' || CASE WHEN page_id % 5 = 0 THEN '"' || rtag || '"' ELSE 'W/"' || tag || '"' END || chr(10) || 'last-modified: ' || rday || chr(10) || 'server: origin'
  ELSE 'content-length: 0' || chr(10) || 'date: ' || day || CASE WHEN page_id % 7 = 0 THEN ''
    WHEN page_id % 5 = 0 THEN chr(10) || 'last-modified: ' || day ELSE chr(10) || 'etag: W/"' || tag || '"' END END AS headers
FROM k
"""
