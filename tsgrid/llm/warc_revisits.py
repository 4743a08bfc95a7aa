"""WARC not-modified revisits: each revisit is resolved to the latest earlier full response of its URL.

Captures are rows (record_id, url, captured_at long, kind 'response' or 'revisit', headers map<string,string>).
URLs are joined in canonical form. The join is as-of: the response of the same canonical URL with the largest
captured_at below the revisit's (of equals the largest record_id). A URL may hold a third of all captures, so
no window holds a whole URL: captures are first reduced to one row per URL and time (partial aggregation, so equal
times can't fill a window), time is cut at BUCKETS quantiles of these rows, the window runs per (URL, bucket), and the
latest response of the buckets before comes from a table of one row per URL and bucket. Revisits meet the result by URL
and time, in a join that Spark splits where it is skewed.
Only times and ids move through the windows; the response's headers are joined afterwards by record id,
where Spark splits a response that very many revisits meet.

Validators: if both sides have an ETag they must agree (weak comparison); else, if both have Last-Modified,
these must agree; else, if both have a payload digest, these; without a common validator the revisit stands.
Status: ``resolved``, ``no_response`` or ``mismatch``. A resolved revisit's headers are the response's, updated
by the revisit's permitted ones: not those that describe the stored payload or the connection (FORBIDDEN).

Defined results: null URL or time, or an empty URL: no_response. Null headers are empty; names are
lower-cased, the last by name order wins. Null kinds are neither. Repeated record ids of responses: the one
captured last (then by ETag) gives the headers; repeated revisits give one row each. Extra columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize

BUCKETS = 64
#: Header fields that a not-modified answer must not change (RFC 9111 and RFC 9110).
FORBIDDEN = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
             "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade")
TRACKING = r"(?i)(^|&)(utm_[a-z]+|ref|sessionid|phpsessid|jsessionid|sid|gclid|fbclid)=[^&]*"


def canonical_url(url: Column) -> Column:
    """Scheme, user, www, default port, fragment, tracking parameters and trailing slashes go; the host is
    lower-cased and the query's parameters are sorted. Null for null and for URLs without a host."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), "^[A-Za-z][A-Za-z0-9+.-]*:", ""), "#.*$", "")
    rest = F.regexp_replace(rest, "^//", "")
    host = F.lower(F.regexp_extract(rest, r"^(?:[^/?@]*@)?(?:[wW]{3}\.)?([^/?:]+)", 1))
    port = F.regexp_extract(rest, r"^[^/?]*:(\d+)(?:[/?]|$)", 1)
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_replace(F.regexp_extract(rest, r"\?(.*)$", 1), TRACKING, "")
    query = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda x: x != "")), "&")
    return F.when(host != "", F.concat(host, F.when(port.isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port)), path,
                                       F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


def lower_headers(headers: Column) -> Column:
    """Names lower-cased; of names that become equal the last one in name order stays."""
    entries = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    last = F.filter(entries, lambda x, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda y: F.lower(y["key"]) == F.lower(x["key"])))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(F.lower(x["key"]).alias("key"), x["value"].alias("value"))))


def latest_response(captures: DataFrame) -> DataFrame:
    """``captures`` (url_key, captured_at, kind, record_id, ...) of kind revisit with ``hit`` = (t, id) or null."""
    # without a URL or a time nothing is joined, and no group of such rows is formed
    known = F.col("url_key").isNotNull() & F.col("captured_at").isNotNull()
    own = F.when(F.col("kind") == "response", F.struct(F.col("captured_at").alias("t"), F.col("record_id").alias("id")))
    moments = materialize(captures.where(known).groupBy("url_key", "captured_at").agg(F.max(own).alias("own")), "moments")
    cuts = moments.agg(F.percentile_approx("captured_at", [i / BUCKETS for i in range(1, BUCKETS)], 10_000).alias("q")).first().q or []
    bucket = F.size(F.filter(F.lit(sorted(set(cuts))).cast("array<bigint>"), lambda q: q <= F.col("captured_at"))) if cuts else F.lit(0)
    x = moments.withColumn("bucket", bucket)
    steps = x.groupBy("url_key", "bucket").agg(F.max("own").alias("own"))
    steps = steps.withColumn("before", F.max("own").over(Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    inside = Window.partitionBy("url_key", "bucket").orderBy("captured_at").rowsBetween(Window.unboundedPreceding, -1)
    hits = (x.withColumn("near", F.max("own").over(inside)).join(steps.select("url_key", "bucket", "before"), ["url_key", "bucket"])
            .select("url_key", "captured_at", F.greatest("near", "before").alias("hit")))
    revisits = captures.where("kind = 'revisit'")
    met = revisits.where(known).join(hits, ["url_key", "captured_at"], "left").select(*captures.columns, "hit")
    unknown = revisits.where(~known).withColumn("hit", F.lit(None).cast(met.schema["hit"].dataType))
    return met.unionByName(unknown)


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """(record_id, url_key, captured_at, status, response_id, response_at, headers) of every revisit."""
    names = ("etag", "last-modified", "payload-digest")
    c = captures.select(F.col("record_id").cast("long").alias("record_id"), canonical_url(F.col("url").cast("string")).alias("url_key"),
                        F.col("captured_at").cast("long").alias("captured_at"), F.col("kind"), lower_headers(F.col("headers")).alias("headers"))
    c = materialize(c, "captures")
    met = latest_response(c)
    full = (c.where("kind = 'response'").groupBy(F.col("record_id").alias("response_id"))
            .agg(F.max_by("headers", F.struct("captured_at", F.element_at("headers", "etag"))).alias("stored")))
    # revisits without a response are dealt by their own id (spread), which no response has, so that nulls don't meet in one task
    spread = F.when(F.col("response_id").isNull(), F.concat(F.lit("none"), F.xxhash64("record_id", "captured_at", "url_key").cast("string")))
    out = met.withColumn("response_id", F.col("hit.id"))
    out = (out.withColumn("meets", F.coalesce(spread, F.col("response_id").cast("string")))
           .join(full.where("response_id is not null").select(F.col("response_id").cast("string").alias("meets"), "stored"), "meets", "left"))
    strong = lambda v: F.regexp_replace(v, "^[wW]/", "")
    verdict = F.lit(True)
    for name in reversed(names):
        ours, theirs = F.element_at("headers", name), F.element_at("stored", name)
        verdict = F.when(ours.isNotNull() & theirs.isNotNull(), strong(ours) == strong(theirs)).otherwise(verdict)
    status = F.when(F.col("hit").isNull(), "no_response").when(verdict, "resolved").otherwise("mismatch")
    update = F.map_filter("headers", lambda k, v: ~k.isin(*FORBIDDEN))
    merged = F.map_concat(F.map_filter("stored", lambda k, v: ~F.array_contains(F.map_keys("update"), k)), F.col("update"))
    out = out.withColumn("status", status).withColumn("update", update)
    return out.select("record_id", "url_key", "captured_at", "status", F.when(F.col("status") == "resolved", F.col("response_id")).alias("response_id"),
                      F.when(F.col("status") == "resolved", F.col("hit.t")).alias("response_at"), F.when(F.col("status") == "resolved", merged).alias("headers"))


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Two captures per page: the full response at time page_id, and a not-modified revisit that carries the page's own
    ETag. The revisit's time is page_id plus a delay drawn by hash from the width of the range of page_id to either
    side, so at every size responses lie before and after the revisits of their URL."""
    width = pages.agg((F.max("page_id") - F.min("page_id") + 1).cast("long").alias("n")).first().n or 1
    drawn = F.conv(F.substring(F.md5(F.col("record_id").cast("string")), 1, 8), 16, 10).cast("long")
    etag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    p = pages.select(F.col("page_id").cast("long").alias("record_id"), F.col("url"), etag.alias("etag"),
                     F.octet_length(F.coalesce("html", F.lit(""))).cast("string").alias("size"))
    pair = lambda *kv: F.map_from_arrays(F.array(*map(F.lit, kv[::2])), F.array(*kv[1::2]))
    at, later = F.col("record_id"), F.col("record_id") + drawn % (2 * width) - width
    first = p.select("record_id", "url", at.alias("captured_at"), F.lit("response").alias("kind"), pair(
        "Content-Type", F.lit("text/html"), "Content-Length", F.col("size"), "ETag", F.col("etag"), "Date", at.cast("string"), "Cache-Control", F.lit("max-age=60")).alias("headers"))
    again = p.select("record_id", "url", later.alias("captured_at"), F.lit("revisit").alias("kind"), pair(
        "Content-Length", F.lit("0"), "ETag", F.concat(F.lit("W/"), F.col("etag")), "Date", later.cast("string"), "X-Cache", F.lit("hit")).alias("headers"))
    return first.unionByName(again)


def headers_digest(headers: str) -> Column:
    lines = F.transform(F.array_sort(F.map_entries(headers)), lambda x: F.concat_ws(":", x["key"], x["value"]))
    return F.sha2(F.array_join(lines, "\n"), 256)


ORACLE_SQL = rf"""
WITH u AS (SELECT page_id, html, regexp_replace(regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*:', ''), '#.*$', ''), '^//', '') AS r FROM pages),
w AS (SELECT coalesce(max(page_id) - min(page_id) + 1, 1) AS n FROM pages),
q AS (SELECT page_id, page_id + ('0x' || substr(md5(page_id::VARCHAR), 1, 8))::BIGINT % (2 * n) - n AS later, '"' || md5(coalesce(html, '')) || '"' AS etag, strlen(coalesce(html, '')) AS size,
    lower(regexp_extract(r, '^(?:[^/?@]*@)?(?:[wW]{{3}}\.)?([^/?:]+)', 1)) AS host, regexp_extract(r, '^[^/?]*:(\d+)(?:[/?]|$)', 1) AS port,
    regexp_replace(regexp_extract(r, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_replace(regexp_extract(r, '\?(.*)$', 1), '{TRACKING}', '', 'g'), '&'), lambda x: x <> '')), '&') AS query FROM u, w),
k AS (SELECT page_id, later, etag, size, CASE WHEN host <> '' THEN host || CASE WHEN port IN ('', '80', '443') THEN '' ELSE ':' || port END || path
    || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS url_key FROM q),
j AS (SELECT a.page_id, a.later, a.url_key, a.etag, b.page_id AS rid, b.etag AS retag, b.size AS rsize
    FROM k a ASOF LEFT JOIN k b ON a.url_key = b.url_key AND a.later > b.page_id)
SELECT page_id, url_key, CASE WHEN rid IS NULL THEN 'no_response' WHEN etag = retag THEN 'resolved' ELSE 'mismatch' END AS status,
  CASE WHEN etag = retag THEN rid END AS response_id,
  CASE WHEN etag = retag THEN sha256('cache-control:max-age=60' || chr(10) || 'content-length:' || rsize || chr(10) || 'content-type:text/html' || chr(10)
    || 'date:' || later || chr(10) || 'etag:W/' || etag || chr(10) || 'x-cache:hit') END AS headers_sha256 FROM j
"""
