"""Not-modified revisits of a web archive resolved to the responses they stand for.

A revisit record (304, no body) is joined as of its time, by canonical URL, to the latest earlier full
response. Validators decide whether it may stand for that response: entity tags are compared weakly when
the revisit has one, else the modification dates; a revisit without either can't be checked. A resolved
revisit has the response's headers, with the headers a 304 may update taken from the revisit.

The as-of join is a two-level scan: records are dealt into ranges of URL and time, a URL of any number of
captures lying in as many as it fills; within a range a window looks back, and the last response of each
URL and range is carried to the ranges after it, over one row each. Windows and carry hold record ids
and times alone; headers and payloads of the responses found are joined after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venue_analytics.llm.common import cut, table

#: headers that a not-modified answer may update (fixed values: HTTP's list for status 304)
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical_url(url: Column) -> Column:
    """Host and path in one form: scheme, ``www.``, default ports, fragment, trailing slash and utm_ arguments
    dropped, host in lower case, arguments sorted. Null stays null; a text without ``://`` is taken whole."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^([^/?]*)", 1)), "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    args = F.filter(F.array_sort(F.split(F.regexp_extract(bare, "[?](.*)$", 1), "&")),
                    lambda a: (a != "") & ~a.startswith("utm_"))
    return F.concat(host, path, F.when(F.size(args) > 0, F.concat(F.lit("?"), F.array_join(args, "&"))).otherwise(""))


def _tag(c: Column) -> Column:
    """Entity tag for weak comparison."""
    return F.nullif(F.regexp_replace(F.trim(c), "^W/", ""), F.lit(""))


def merged_headers(response: Column, revisit: Column, permitted=PERMITTED) -> Column:
    """The response's headers with the permitted ones of the revisit in their place; maps of lower-case names."""
    allowed = F.map_filter(F.coalesce(revisit, F.create_map().cast("map<string,string>")), lambda k, v: k.isin(*permitted))
    rest = F.map_filter(F.coalesce(response, F.create_map().cast("map<string,string>")), lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_concat(rest, allowed)


def resolve_revisits(records: DataFrame, permitted=PERMITTED) -> DataFrame:
    """One row per revisit of ``records(record_id, url, captured, kind, status, headers, payload)``: ``record_id,
    url_key, captured, outcome, response_id, response_captured, headers, payload``.

    ``captured`` is in microseconds, ``kind`` is 'response' or 'revisit', ``headers`` maps lower-case names,
    ``payload`` names the body (a digest or a place). Full responses are those of status 200; of several at
    the latest earlier time the one with the largest record id counts. Outcomes: 'resolved',
    'mismatch' (a validator differs), 'no_validator' (none to compare), 'no_response' (nothing earlier, or a
    null URL or time). Headers and payload are null unless resolved. Repeated rows are rows of their own;
    other columns are left out; other kinds are ignored."""
    rows = records.select("record_id", canonical_url(F.col("url")).alias("url_key"), "captured", "kind", "status", "headers", "payload")
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    placed = F.col("url_key").isNotNull() & F.col("captured").isNotNull()
    revisits = rows.where(F.col("kind") == "revisit").select("record_id", "url_key", "captured", "headers")
    responses = rows.where(full & placed).select("record_id", "url_key", "captured", "headers", "payload")
    name = F.struct("captured", "record_id")
    # one row per moment of a URL: the response that counts from then on, if any, and whether a revisit looks back from there
    moments = rows.where((full | (F.col("kind") == "revisit")) & placed).groupBy("url_key", "captured").agg(F.max(F.when(full, name)).alias("own"))
    dealt = cut(moments.repartitionByRange("url_key", "captured").withColumn("part", F.spark_partition_id()))
    back = Window.partitionBy("url_key", "part").orderBy("captured").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("url_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lasts = dealt.groupBy("url_key", "part").agg(F.max("own").alias("last")).select("url_key", "part", F.max("last").over(before).alias("far"))
    seen = dealt.select("url_key", "captured", "part", F.max("own").over(back).alias("near")).join(lasts, ["url_key", "part"])
    seen = seen.select("url_key", "captured", F.coalesce("near", "far").alias("found")).where("found is not null")
    asked = revisits.join(seen, ["url_key", "captured"], "left")
    body = responses.groupBy("url_key", F.struct("captured", "record_id").alias("found")).agg(F.first(F.struct("headers", "payload")).alias("body"))
    found = asked.join(body, ["url_key", "found"], "left").select("record_id", "url_key", "captured", "headers", F.when(F.col("found").isNotNull(), F.struct(
        F.col("found.record_id").alias("response_id"), F.col("found.captured").alias("response_captured"), F.col("body.headers").alias("response_headers"),
        F.col("body.payload").alias("response_payload"))).alias("r"))
    mine, its = F.col("headers"), F.col("r.response_headers")
    tag, date = _tag(F.element_at(mine, "etag")), F.nullif(F.trim(F.element_at(mine, "last-modified")), F.lit(""))
    outcome = (F.when(F.col("r").isNull(), "no_response").when(tag.isNull() & date.isNull(), "no_validator")
               .when(tag.isNotNull(), F.when(F.coalesce(tag == _tag(F.element_at(its, "etag")), F.lit(False)), "resolved").otherwise("mismatch"))
               .when(F.coalesce(date == F.trim(F.element_at(its, "last-modified")), F.lit(False)), "resolved").otherwise("mismatch"))
    got = found.withColumn("outcome", outcome)
    good = F.col("outcome") == "resolved"
    return got.select("record_id", "url_key", "captured", "outcome", F.col("r.response_id").alias("response_id"),
                      F.col("r.response_captured").alias("response_captured"),
                      F.when(good, merged_headers(its, mine, permitted)).alias("headers"),
                      F.when(good, F.col("r.response_payload")).alias("payload"))


# ------------------------------------------------------------------------------ query
#: responses of a page: days after its first, (every so many pages, status instead of 200)
RESPONSES = ((0, 11, 404), (2, 3, 503), (8, 5, 302))
#: revisits of a page: days after its first response
REVISITS = (-1, 1, 5, 10, 30)
#: ids of a page's records
IDS = len(RESPONSES) + len(REVISITS)


def captures(pages: DataFrame) -> DataFrame:
    """Archive records that the pages table stands for. A page has three responses with other contents, some of
    another status, and five revisits that believe one of the versions; validators match, differ or are
    missing by page id. Every fourth page is captured at its host alone, so hosts have many captures."""
    p = pages.select("page_id", "url", F.sha2(F.coalesce("html", F.lit("")), 256).alias("content"))
    host = F.regexp_extract("url", "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    p = p.withColumn("url", F.when((F.col("page_id") % 4 == 0) & (host != ""), host).otherwise(F.col("url")))
    first = F.lit(1_600_000_000) + F.col("page_id") * 60

    def payload(version: Column) -> Column:
        return F.sha2(F.concat(version.cast("string"), F.lit(":"), F.col("content")), 256)

    def tag(version: Column) -> Column:
        return F.concat(F.lit('"'), F.substring(payload(version), 1, 16), F.lit('"'))

    def day(version: Column) -> Column:
        return F.concat(F.lit("day "), ((F.col("page_id") + version) % 28).cast("string"))
    found = []
    for k, (days, every, other) in enumerate(RESPONSES):
        at, v = (first + days * 86_400) * 1_000_000, F.lit(k)
        own = F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("etag"), tag(v), F.lit("last-modified"), day(v), F.lit("date"), at.cast("string"))
        found.append(F.struct((F.col("page_id") * IDS + k).alias("record_id"), at.alias("captured"), F.lit("response").alias("kind"),
                              F.when(F.col("page_id") % every == 0, other).otherwise(200).alias("status"), own.alias("headers"), payload(v).alias("payload")))
    for k, days in enumerate(REVISITS):
        at, v = (first + days * 86_400) * 1_000_000, (F.col("page_id") + k) % len(RESPONSES)
        headers = (F.when((F.col("page_id") + k) % 7 == 0, F.create_map(F.lit("content-type"), F.lit("none"), F.lit("date"), at.cast("string")))
                   .when((F.col("page_id") + k) % 7 == 1, F.create_map(F.lit("last-modified"), day(v), F.lit("date"), at.cast("string")))
                   .otherwise(F.create_map(F.lit("etag"), F.concat(F.lit("W/"), tag(v)), F.lit("expires"), F.lit("later"), F.lit("server"), F.lit("x"),
                                           F.lit("date"), at.cast("string"))))
        found.append(F.struct((F.col("page_id") * IDS + len(RESPONSES) + k).alias("record_id"), at.alias("captured"), F.lit("revisit").alias("kind"),
                              F.lit(304).alias("status"), headers.alias("headers"), F.lit(None).cast("string").alias("payload")))
    return p.select("url", F.explode(F.array(*found)).alias("c")).select("url", "c.*")


def op1_warc(spark, sf_dir):
    """All revisits that the pages table stands for, resolved."""
    got = resolve_revisits(captures(table(spark, sf_dir, "pages")))
    named = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return got.select("record_id", F.floor(F.col("record_id") / IDS).alias("page_id"), "url_key", "outcome", "response_id",
                      named.alias("headers"), "payload")


OP1_SQL = rf"""
WITH p AS (SELECT page_id, CASE WHEN page_id % 4 = 0 AND regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) <> ''
                                THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) ELSE url END AS url,
                  sha256(coalesce(html, '')) AS content, CAST(1600000000 AS BIGINT) + page_id * 60 AS t FROM pages),
b AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM p),
a AS (SELECT *, list_filter(list_sort(string_split(regexp_extract(bare, '[?](.*)$', 1), '&')),
                            lambda x: x <> '' AND NOT starts_with(x, 'utm_')) AS args FROM b),
u AS (SELECT page_id, content, t, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^www[.]', ''), ':(80|443)$', '')
             || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '')
             || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END AS url_key FROM a),
v AS (SELECT page_id, url_key, t, k, sha256(CAST(k AS VARCHAR) || ':' || content) AS payload, 'day ' || CAST((page_id + k) % 28 AS VARCHAR) AS day
      FROM u, range({len(RESPONSES)}) AS x(k)),
q AS (SELECT page_id * {IDS} + v.k AS id, url_key, (t + days * 86400) * 1000000 AS c, payload, '"' || substr(payload, 1, 16) || '"' AS tag, day
      FROM v, (VALUES {", ".join(f"({k}, {d}, {e})" for k, (d, e, _) in enumerate(RESPONSES))}) AS w(k, days, every)
      WHERE v.k = w.k AND page_id % every <> 0),
one AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY url_key, c ORDER BY id DESC) = 1),
r AS (SELECT v.page_id * {IDS} + {len(RESPONSES)} + n AS record_id, v.page_id, url_key, (t + days * 86400) * 1000000 AS c,
             CASE WHEN (v.page_id + n) % 7 < 2 THEN NULL ELSE '"' || substr(payload, 1, 16) || '"' END AS tag,
             CASE WHEN (v.page_id + n) % 7 = 1 THEN day END AS day
      FROM v, (VALUES {", ".join(f"({k}, {d})" for k, d in enumerate(REVISITS))}) AS w(n, days) WHERE v.k = (v.page_id + n) % {len(RESPONSES)}),
j AS (SELECT r.*, one.id AS q, one.payload, one.tag AS q_tag, one.day AS q_day FROM r ASOF LEFT JOIN one ON r.url_key = one.url_key AND r.c > one.c),
o AS (SELECT *, CASE WHEN q IS NULL THEN 'no_response' WHEN tag IS NULL AND day IS NULL THEN 'no_validator'
                     WHEN coalesce(tag = q_tag, day = q_day) THEN 'resolved' ELSE 'mismatch' END AS outcome FROM j)
SELECT record_id, page_id, url_key, outcome, q AS response_id,
       CASE WHEN outcome = 'resolved' THEN 'content-type=text/html;date=' || CAST(c AS VARCHAR) || ';etag=' || CASE WHEN tag IS NOT NULL THEN 'W/' ELSE '' END || q_tag
            || CASE WHEN tag IS NOT NULL THEN ';expires=later' ELSE '' END || ';last-modified=' || q_day END AS headers,
       CASE WHEN outcome = 'resolved' THEN payload END AS payload
FROM o"""
