"""Registered queries over the driver tables (Spark) and their DuckDB oracles.

Every query runs on the whole tables (``month=None``: all months at once), through the stand-in
collections of ``plans.standins``. Each oracle re-derives the same stand-ins in plain SQL and
computes the result in SQL; from this package it takes only the fixed values (stop words, punctuation,
sources, kinds, hours, ratings), which the tests pin by themselves.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venue_analytics.functions.accounts import is_own_post, linked_account_ids, linked_accounts_by_source, merchant_accounts
from venue_analytics.functions.columns import (
    day_str, full_match, hour_key, hour_str, month_bounds_col, month_str, parse_legacy_time, source_of, venue_id_strip,
)
from venue_analytics.functions.text import stop_words, text_strip, text_strip_joined, tokenize
from venue_analytics.operators import bitmaps, core
from venue_analytics.operators import checks as C
from venue_analytics.operators import reports as R
from venue_analytics.operators.counts import map_entries_long, nested_map_entries, pivot_counts
from venue_analytics.plans import standins as SD
from venue_analytics.session import checkpoint_dir
from venue_analytics.sources.readers import read_table, write_bucketed
from venue_analytics.sources.sinks import append_run, publish_month, read_report, write_report
from venue_analytics.sources.schemas import (
    HOURS, INTERACTION_TYPES, KINDS, PUNCTUATION, RATINGS, REVIEW_SOURCES, SOURCES,
)

AS_OF = SD.AS_OF
TAGS = ["R", "A"]

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------------------ Spark queries
def _t(spark, d, **kw):
    return SD.tables(spark, d, **kw)


def q_active_places(spark, d):
    t = _t(spark, d)
    return core.active_places(t.places, t.merchants, AS_OF).select("place_id", "place_name", "merchant_id")


def q_place_posts(spark, d):
    return core.place_posts(_t(spark, d), None, ["merchant_id", "place_name", "post_id", "post_month", "source", "kind"],
                            as_of=AS_OF)


def q_own_post_filter(spark, d):
    return core.own_place_posts(_t(spark, d), None, AS_OF)


def q_content_types_long(spark, d):
    return R.content_types(_t(spark, d), None, AS_OF)


def q_content_types_legacy_forms(spark, d):
    """The content report on sources in the original loader's string forms: post times as
    'Sat Oct 03 00:00:00 UTC 1998', venue lists as '[V1, V2]', expiry as epoch milliseconds,
    each normalised by the readers; same rows as content_types_long."""
    from venue_analytics.sources.readers import normalise
    t = _t(spark, d)
    posts = t.posts.select(
        "id", F.date_format("post_time", "EEE MMM dd HH:mm:ss 'UTC' yyyy").alias("post_time"),
        F.concat(F.lit("["), F.array_join("secondary_venue_ids", ", "), F.lit("]")).alias("secondary_venue_ids"),
        "kind", "text", "poster_id", "rating")
    merchants = t.merchants.select("id", "name", F.struct(
        F.unix_millis(F.col("subscription.expires_at")).alias("expires_at")).alias("subscription"))
    legacy = core.Tables(posts=normalise("posts", posts), places=t.places,
                         merchants=normalise("merchants", merchants), accounts=t.accounts)
    return R.content_types(legacy, None, AS_OF)


def q_content_types_pivot(spark, d):
    return pivot_counts(R.content_types(_t(spark, d), None, AS_OF), R.PLACE_MONTH, "source", "n", SOURCES)


def q_reviews_long(spark, d):
    return R.reviews(_t(spark, d), None, AS_OF)


def q_reviews_pivot(spark, d):
    return pivot_counts(R.reviews(_t(spark, d), None, AS_OF), ["merchant_id", "place_name", "month"], "value", "n",
                        RATINGS, prefix="r_")


def q_interactions_pivot(spark, d):
    return pivot_counts(R.interactions(_t(spark, d), None, AS_OF, same_month=False),
                        ["merchant_id", "place_name", "month", "user", "source"], "type", "n", INTERACTION_TYPES)


def q_posters_long(spark, d):
    return R.posters(_t(spark, d), None, AS_OF)


def q_posters_pivot(spark, d):
    return pivot_counts(R.posters(_t(spark, d), None, AS_OF), R.PLACE_MONTH, "source", "n", SOURCES)


def q_posters_total(spark, d):
    return R.posters_map(_t(spark, d), None, AS_OF).select(*R.PLACE_MONTH, "total")


def q_keywords_total(spark, d):
    return R.keywords_map(_t(spark, d, with_text=True), None, AS_OF).select(*R.PLACE_MONTH, "word", "total")


def q_segments_total(spark, d):
    return (R.segments(_t(spark, d, event_based=True), None, AS_OF).filter(F.col("hour") == "total")
            .select("merchant_id", "place_id", "month", "day", "source", F.col("n").alias("total")))


def q_segments_pivot(spark, d):
    hourly = R.segments(_t(spark, d, event_based=True), None, AS_OF).filter(F.col("hour") != "total")
    return pivot_counts(hourly, ["merchant_id", "place_id", "month", "day", "source"], "hour", "n", HOURS, prefix="h_")


def q_segments_long(spark, d):
    return R.segments(_t(spark, d, event_based=True), None, AS_OF)


def q_segment_check(spark, d):
    return C.check_segment_totals(R.segments_map(_t(spark, d, event_based=True), None, AS_OF))


def q_keywords_long(spark, d):
    return R.keywords(_t(spark, d, with_text=True), None, AS_OF)


def q_text_strip_words(spark, d):
    docs = SD.load(spark, d, "documents")
    return docs.select("doc_id", F.coalesce(text_strip_joined("text"), F.lit("")).alias("normalised"),
                       F.coalesce(F.array_size(text_strip("text")), F.lit(0)).cast("long").alias("n_words"))


def q_interactions_long(spark, d):
    return R.interactions(_t(spark, d), None, AS_OF, same_month=False)


def q_unique_interactions(spark, d):
    return R.int_rows(_t(spark, d), None)


def q_follow_attribution(spark, d):
    _, follows = R.interaction_parts(_t(spark, d), None, AS_OF, same_month=False)
    return follows


def q_interactions_same_month(spark, d):
    return R.interactions(_t(spark, d, event_based=True), None, AS_OF)


def q_response_times_events(spark, d):
    return R.response_times(_t(spark, d, event_based=True), None)


def q_response_times(spark, d):
    return R.response_times(_t(spark, d), None)


def q_response_times_wrapped(spark, d):
    return R.response_times(_t(spark, d), None, wrap_days=True)


def q_merchant_post_count(spark, d):
    return C.merchant_post_count(_t(spark, d), None)


def q_tagged_post_count(spark, d):
    return C.tagged_post_count(_t(spark, d), TAGS, None)


def q_user_likes(spark, d):
    return C.user_likes(_t(spark, d), None, None)


def q_keyword_mentions(spark, d):
    bench = SD.load(spark, d, "benchmark")
    mentions = C.text_mentions(bench, "item_id", "text", (F.col("item_id") % SD.N_MERCHANTS).cast("string"))
    # the mention terms restrict the tokens before counting (same rows as filtering the report)
    return R.keywords(_t(spark, d, with_text=True), None, AS_OF, words=mentions.withColumnRenamed("term", "word"))


def q_month_parts(spark, d):
    o = SD.load(spark, d, "orders")
    legacy = F.date_format("o_orderdate", "EEE MMM dd HH:mm:ss 'UTC' yyyy")
    ts = parse_legacy_time(legacy)
    m = month_str(ts)
    start, end = month_bounds_col(m)
    return o.select("o_orderkey", m.alias("month"), day_str(ts).alias("day"), hour_str(ts).alias("hour"),
                    F.date_format(start, "yyyy-MM-dd").alias("month_start"),
                    F.date_format(end, "yyyy-MM-dd").alias("next_month"))


def q_source_prefix(spark, d):
    return SD.posts(spark, d).select(F.col("id").alias("post_id"), source_of("id").alias("source"))


def q_venue_list_parse(spark, d):
    p = SD.posts(spark, d).filter(F.col("secondary_venue_ids").isNotNull())
    rendered = F.concat(F.lit("["), F.array_join("secondary_venue_ids", ", "), F.lit("]"))
    parsed = tokenize(venue_id_strip(rendered))
    return p.select(F.col("id").alias("post_id"), F.array_size(parsed).cast("long").alias("n_venues"),
                    F.array_join(F.array_sort(parsed), ",").alias("venues"))


def q_content_types_map_entries(spark, d):
    return nested_map_entries(R.content_types_map(_t(spark, d), None, AS_OF), R.PLACE_MONTH, "counts",
                              "source", "kind", keep=["total"])


def q_reviews_map_entries(spark, d):
    return nested_map_entries(R.reviews_map(_t(spark, d), None, AS_OF), ["merchant_id", "place_name", "month"],
                              "counts", "source", "value")


def q_posters_map_entries(spark, d):
    return map_entries_long(R.posters_map(_t(spark, d), None, AS_OF), R.PLACE_MONTH + ["total"], "counts",
                            "source", "n")


def q_keywords_map_entries(spark, d):
    return map_entries_long(R.keywords_map(_t(spark, d, with_text=True), None, AS_OF),
                            R.PLACE_MONTH + ["word", "total"], "counts", "source", "n")


def q_interactions_map_entries(spark, d):
    return nested_map_entries(R.interactions_map(_t(spark, d), None, AS_OF, same_month=False),
                              ["merchant_id", "place_name", "month", "user"], "counts", "source", "type")


def q_segments_map_entries(spark, d):
    return nested_map_entries(R.segments_map(_t(spark, d, event_based=True), None, AS_OF),
                              ["merchant_id", "place_id", "month", "day", "metric"], "counts", "hour", "source")


def q_follow_nulls(spark, d):
    """The interactions report where every seventh user and every fifth place has no name: a follow without a
    user goes nowhere, a place without a name keeps its follows."""
    t = _t(spark, d)
    actor = F.col("actor")
    user = F.when(F.regexp_extract("actor.object_id", "([0-9]+)", 1).cast("long") % 7 != 0, actor["label"])
    name = F.when(F.col("id").cast("long") % 5 != 0, F.col("name"))
    t = dataclasses.replace(t, audits=t.audits.withColumn("actor", actor.withField("label", user)),
                            places=t.places.withColumn("name", name))
    return R.interactions(t, None, AS_OF, same_month=False)


def q_venue_mentions(spark, d):
    t = dataclasses.replace(_t(spark, d), venues=SD.venues(spark, d))
    return C.venue_mentions(t)


def q_handle_mentions(spark, d):
    return C.handle_mentions(SD.linked_merchants(spark, d))


def q_linked_own_posts(spark, d):
    """Own posts by linked accounts: the services' account ids as poster ids."""
    t = dataclasses.replace(_t(spark, d), accounts=merchant_accounts(SD.linked_merchants(spark, d)))
    return core.own_place_posts(t, None, AS_OF)


def q_place_posts_own_array(spark, d):
    """Own posts told by the account list of a row: the linked accounts of each post's customer."""
    c = SD.linked_merchants(spark, d).select(F.col("id").alias("merchant_id"), linked_accounts_by_source("linked_accounts").alias("own"))
    return c.select("merchant_id", F.explode("own").alias("source", "ids")).select("merchant_id", "source", F.explode("ids").alias("poster_id"))


def _folder(spark, what: str) -> str:
    """A new folder of a registered query that writes and reads back, where the cluster shares it."""
    base = checkpoint_dir(spark)
    if base is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/va-{what}-{uuid.uuid4().hex}"


def _name(what: str) -> str:
    """A table name that no other run has."""
    return f"va_{what}_{uuid.uuid4().hex}"


def q_content_types_salted(spark, d):
    """The content report with the venue join salted for the venues that the sketch finds hot."""
    return R.content_types(dataclasses.replace(_t(spark, d), venue_salt="sketch"), None, AS_OF)


def q_count_reports(spark, d):
    """Content, reviews, posters and segments counted in one pass over the match."""
    return R.count_reports(_t(spark, d), None, AS_OF)


def q_response_times_bucketed(spark, d):
    """Response times with the posts laid out in buckets by id."""
    t = _t(spark, d)
    posts = write_bucketed(t.posts.select("id", "post_time"), _folder(spark, "posts"), _name("posts"))
    return R.response_times(dataclasses.replace(t, posts=posts), None)


def _documents(df: DataFrame, rename: dict) -> DataFrame:
    """Documents as a store's export writes them: one JSON text per row, with an unknown field."""
    fields = [rename.get(c, F.col(c)).alias("_id" if c == "id" else c) for c in df.columns]
    return df.select(F.to_json(F.struct(*fields, F.lit(1).alias("__v"))).alias("value"))


def _date(c: str):
    """``{"$date": {"$numberLong": "…"}}`` of a time; null without one."""
    millis = F.unix_millis(F.col(c).cast("timestamp")).cast("string")
    wrapped = F.struct(F.struct(millis.alias("$numberLong")).alias("$date"))
    return F.when(F.col(c).isNotNull(), wrapped)


def _exported(spark, name: str, df: DataFrame, rename: dict) -> DataFrame:
    path = _folder(spark, f"export-{name}")
    _documents(df, rename).write.text(path)
    return read_table(spark, name, path, "documents")


def _oid(c: str):
    return F.struct(F.col(c).alias("$oid"))


def q_content_types_exported(spark, d):
    """The content report on posts, places and merchants exported in a document store's own types."""
    t = _t(spark, d)
    expiry = F.struct(_date("subscription.expires_at").alias("expires_at"))
    return R.content_types(core.Tables(
        posts=_exported(spark, "posts", t.posts, {"post_time": _date("post_time")}),
        places=_exported(spark, "places", t.places, {"id": _oid("id"), "merchant_id": _oid("merchant_id")}),
        merchants=_exported(spark, "merchants", t.merchants, {"id": _oid("id"), "subscription": expiry}), accounts=t.accounts), None, AS_OF)


def q_response_times_exported(spark, d):
    """Response times on audits exported in a document store's own types."""
    t = _t(spark, d)
    audits = _exported(spark, "audits", t.audits, {"id": _oid("id"), "merchant_id": _oid("merchant_id"), "created_at": _date("created_at")})
    return R.response_times(dataclasses.replace(t, audits=audits), None)


def q_place_scan(spark, d):
    """Places written to a folder and scanned by ``read_table``."""
    path = _folder(spark, "places")
    SD.places(spark, d).withColumnRenamed("id", "_id").write.parquet(path)
    return read_table(spark, "places", path).select("id", "name", "merchant_id", F.array_join("venue_ids", ",").alias("venues"))


def q_published_month(spark, d):
    """A month of the content report published as a table, first from photos alone, then whole; read back."""
    t, table, path = _t(spark, d), _name("content"), _folder(spark, "content")
    publish_month(R.content_types(dataclasses.replace(t, posts=t.posts.where("kind = 'photo'")), ORDER_MONTH, AS_OF), table, path, "content", ORDER_MONTH)
    publish_month(R.content_types(t, ORDER_MONTH, AS_OF), table, path, "content", ORDER_MONTH)
    return spark.table(table)


def q_merchant_lookup(spark, d):
    """All months of the content report written clustered by merchant; the rows of one merchant read back."""
    path = _folder(spark, "clustered")
    write_report(R.content_types(_t(spark, d), None, AS_OF), path, "content", cluster_by="merchant_id")
    return read_report(spark, path, merchant_id=LOOKED_UP)


def q_appended_runs(spark, d):
    """Documents of two runs appended to a sink, one run repeated; read back."""
    t, table, path = _t(spark, d), _name("posters"), _folder(spark, "posters")
    for run, source in (("one", "FB"), ("two", "IG"), ("one", "FB")):
        append_run(R.poster_counts(t, None, AS_OF).where(F.col("source") == source), table, path, run)
    return spark.table(table)


def q_monthly_run(spark, d):
    """The runner for one month, stopped before its last report and resumed; the report tables read back."""
    from venue_analytics.plans.jobs import run_reports
    t, sink = _t(spark, d), _folder(spark, "sink")
    run_reports(spark, t, sink, ORDER_MONTH, ["content"], as_of=AS_OF)
    run_reports(spark, t, sink, ORDER_MONTH, ["content", "posters"], as_of=AS_OF, resume=True)
    parts = [read_report(spark, f"{sink}/{r}", post_month=ORDER_MONTH).select(F.lit(r).alias("report"), *R.PLACE_MONTH, "total")
             for r in ("content", "posters")]
    return parts[0].unionByName(parts[1])


def q_posters_merged(spark, d):
    """The posters report from bitmaps of two arrivals of posts, the later one folded in."""
    t, path = _t(spark, d), _folder(spark, "posters-dictionary")
    late = F.pmod(F.xxhash64("id"), F.lit(3)) == 0
    early, later = (dataclasses.replace(t, posts=t.posts.where(c)) for c in (~late, late))
    state = bitmaps.poster_bitmaps(early, bitmaps.extend_dictionary(early.posts, path, first=True), None, AS_OF)
    added = bitmaps.poster_bitmaps(later, bitmaps.extend_dictionary(later.posts, path), None, AS_OF)
    return R.with_group_total(bitmaps.poster_counts(bitmaps.merged(state, added)), R.PLACE_MONTH)


def q_keyword_mentions_written(spark, d):
    """Mention terms looked up in the whole keywords report."""
    bench = SD.load(spark, d, "benchmark")
    mentions = C.text_mentions(bench, "item_id", "text", (F.col("item_id") % SD.N_MERCHANTS).cast("string"))
    return C.keyword_mentions(R.keywords(_t(spark, d, with_text=True), None, AS_OF), mentions)


def q_audit_types(spark, d):
    """Audits whose whole type matches a pattern ('like' isn't 'unlike')."""
    a = SD.audits(spark, d).withColumn("type", F.when(F.col("type") == "error", "unlike").otherwise(F.col("type")))
    return a.where(full_match("type", "like|re.*")).select(F.col("id").alias("audit_id"), "type")


def q_own_post_flags(spark, d):
    """Every customer's linked accounts against the poster id of each source with the customer's key."""
    c = SD.linked_merchants(spark, d).select(F.col("id").alias("merchant_id"), "linked_accounts")
    ids = c.select("merchant_id", linked_account_ids("linked_accounts").alias("own"), F.element_at(F.map_values("linked_accounts"), 1)[0]["account_id"].alias("key"))
    posted = ids.select("merchant_id", "own", F.explode(F.array(*[F.concat(F.lit(f"{s}-"), F.col("key")) for s in SOURCES])).alias("poster_id"))
    return posted.select("merchant_id", "poster_id", is_own_post("own", "poster_id").alias("own"))


def q_hour_keys(spark, d):
    """Hour keys of the events from the hour as a number."""
    return SD.load(spark, d, "events").select("event_id", hour_key(F.hour("ts")).alias("hour"))


#: merchant of the lookup
LOOKED_UP = "7"
#: months of the month-scoped entries: of the orders, of the events
ORDER_MONTH, EVENT_MONTH = "1998Mar", "2024Jan"


def _monthly(report, month, month_col, **how):
    def run(spark, d):
        t = _t(spark, d, **how)
        return report(t, month) if report is R.response_times else report(t, month, AS_OF)
    run.__name__, run.__doc__ = f"{report.__name__}_month", f"The report of one month ({month_col} {month})."
    return run


#: name: (whole query, report, month, month column, stand-ins)
MONTHLY = {
    "content_types_month": ("content_types_long", R.content_types, ORDER_MONTH, "post_month", {}),
    "reviews_month": ("reviews_long", R.reviews, ORDER_MONTH, "month", {}),
    "keywords_month": ("keywords_long", R.keywords, ORDER_MONTH, "post_month", {"with_text": True}),
    "posters_month": ("posters_long", R.posters, ORDER_MONTH, "post_month", {}),
    "interactions_month": ("interactions_same_month", R.interactions, EVENT_MONTH, "month", {"event_based": True}),
    "response_times_month": ("response_times_events", R.response_times, EVENT_MONTH, "month", {"event_based": True}),
    "segments_month": ("segments_long", R.segments, EVENT_MONTH, "month", {"event_based": True}),
}

QUERIES: dict[str, Query] = {
    **{name: _monthly(report, month, col, **how) for name, (_, report, month, col, how) in MONTHLY.items()},
    "content_types_salted": q_content_types_salted,
    "count_reports": q_count_reports,
    "response_times_bucketed": q_response_times_bucketed,
    "content_types_exported": q_content_types_exported,
    "response_times_exported": q_response_times_exported,
    "place_scan": q_place_scan,
    "published_month": q_published_month,
    "merchant_lookup": q_merchant_lookup,
    "appended_runs": q_appended_runs,
    "monthly_run": q_monthly_run,
    "hour_keys": q_hour_keys,
    "posters_merged": q_posters_merged,
    "keyword_mentions_written": q_keyword_mentions_written,
    "audit_types": q_audit_types,
    "own_post_flags": q_own_post_flags,
    "follow_nulls": q_follow_nulls,
    "venue_mentions": q_venue_mentions,
    "handle_mentions": q_handle_mentions,
    "linked_own_posts": q_linked_own_posts,
    "linked_accounts": q_place_posts_own_array,
    "active_places": q_active_places,
    "place_posts": q_place_posts,
    "own_post_filter": q_own_post_filter,
    "content_types_long": q_content_types_long,
    "content_types_pivot": q_content_types_pivot,
    "content_types_legacy_forms": q_content_types_legacy_forms,
    "reviews_long": q_reviews_long,
    "reviews_pivot": q_reviews_pivot,
    "posters_long": q_posters_long,
    "posters_pivot": q_posters_pivot,
    "posters_total": q_posters_total,
    "segments_long": q_segments_long,
    "segments_total": q_segments_total,
    "segments_pivot": q_segments_pivot,
    "segment_check": q_segment_check,
    "keywords_long": q_keywords_long,
    "keywords_total": q_keywords_total,
    "text_strip_words": q_text_strip_words,
    "interactions_long": q_interactions_long,
    "interactions_pivot": q_interactions_pivot,
    "unique_interactions": q_unique_interactions,
    "follow_attribution": q_follow_attribution,
    "interactions_same_month": q_interactions_same_month,
    "response_times": q_response_times,
    "response_times_events": q_response_times_events,
    "response_times_wrapped": q_response_times_wrapped,
    "merchant_post_count": q_merchant_post_count,
    "tagged_post_count": q_tagged_post_count,
    "user_likes": q_user_likes,
    "keyword_mentions": q_keyword_mentions,
    "month_parts": q_month_parts,
    "source_prefix": q_source_prefix,
    "venue_list_parse": q_venue_list_parse,
    "content_types_map_entries": q_content_types_map_entries,
    "reviews_map_entries": q_reviews_map_entries,
    "posters_map_entries": q_posters_map_entries,
    "keywords_map_entries": q_keywords_map_entries,
    "interactions_map_entries": q_interactions_map_entries,
    "segments_map_entries": q_segments_map_entries,
}


# ------------------------------------------------------------------------------ DuckDB oracles
def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _stops_sql() -> str:
    return "[" + ", ".join(_sql_str(w) for w in stop_words()) + "]"


_PUNC = "[" + PUNCTUATION.replace("-", "") + "-]"  # '-' last: literal in a character class


def _keyword_cte(src: str, key_cols: str, text_col: str = "text") -> str:
    """SQL pipeline: distinct normalised words of each text (order is irrelevant for counts),
    each split on the tokenizer delimiters, one row per token. Produces CTEs kw1..kw3."""
    return f"""
kw1 AS (SELECT {key_cols}, list_filter(list_transform(string_split({text_col}, ' '), lambda x: lower(x)),
                 lambda x: length(x) >= 3 AND length(x) <= 16) AS l1 FROM {src}),
kw2 AS (SELECT {key_cols}, list_distinct(list_filter(list_transform(l1,
                 lambda x: regexp_replace(regexp_replace(x, {_sql_str('^' + _PUNC)}, ''), {_sql_str(_PUNC + '$')}, '')),
                 lambda x: length(x) >= 3 AND NOT contains(x, 'http') AND NOT list_contains({_stops_sql()}, x))) AS l2
        FROM kw1),
kw3 AS (SELECT {key_cols}, unnest(flatten(list_transform(l2,
                 lambda w: list_filter(regexp_split_to_array(w, '[ ",()*]+'), lambda x: x <> '')))) AS word
        FROM kw2)"""


_STANDINS = """
src_orders AS (
  SELECT o.*, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'FB' WHEN '2' THEN 'IG' WHEN '3' THEN 'TW'
                                                   WHEN '4' THEN '4S' ELSE 'WB' END AS src
  FROM orders o),
sd_merchants AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS merchant_id, n_name AS name,
         CASE WHEN n_regionkey <> 0 THEN TIMESTAMP '2030-01-01 00:00:00' ELSE TIMESTAMP '1999-01-01 00:00:00' END AS expires_at
  FROM nation),
sd_active AS (SELECT merchant_id FROM sd_merchants WHERE NOT (TIMESTAMP '2002-01-01 00:00:00' > expires_at)),
sd_accounts AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS merchant_id, s.src || '-' || CAST(c_custkey AS VARCHAR) AS poster_id
  FROM customer CROSS JOIN (VALUES ('FB'), ('IG'), ('TW'), ('4S'), ('WB')) AS s(src)),
sd_places AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS place_id, s_name AS place_name, CAST(s_nationkey AS VARCHAR) AS merchant_id,
         'V' || CAST(s_suppkey AS VARCHAR) AS venue_id
  FROM supplier),
sd_active_places AS (SELECT p.* FROM sd_places p JOIN sd_active a ON a.merchant_id = p.merchant_id),
sd_posts AS (
  SELECT o.o_orderkey, o.src || '-' || CAST(o.o_orderkey AS VARCHAR) AS post_id, o.src AS source,
         o.o_orderdate AS post_time, strftime(o.o_orderdate, '%Y%b') AS post_month,
         CASE o.o_orderstatus WHEN 'F' THEN 'photo' WHEN 'O' THEN 'video' ELSE 'review' END AS kind,
         o.src || '-' || CAST(o.o_custkey AS VARCHAR) AS poster_id,
         CAST(o.o_orderkey % 5 + 1 AS VARCHAR) AS rating_value, d.text AS text
  FROM src_orders o LEFT JOIN documents d ON d.doc_id = o.o_orderkey),
sd_post_venues AS (
  SELECT p.*, 'V' || CAST(l.l_suppkey AS VARCHAR) AS venue_id, l.l_returnflag AS tag
  FROM sd_posts p JOIN lineitem l ON l.l_orderkey = p.o_orderkey),
sd_all_matches AS (
  SELECT pv.merchant_id, pv.place_id, pv.place_name, p.post_id, p.source, p.post_month, p.kind, p.poster_id,
         p.rating_value, p.text
  FROM sd_post_venues p JOIN sd_active_places pv ON pv.venue_id = p.venue_id),
sd_matches AS (
  SELECT m.* FROM sd_all_matches m
  WHERE NOT EXISTS (SELECT 1 FROM sd_accounts a WHERE a.merchant_id = m.merchant_id AND a.poster_id = m.poster_id)),
sd_audits AS (
  SELECT CAST(e.event_id AS VARCHAR) AS audit_id,
         CASE e.event_type WHEN 'view' THEN 'like' WHEN 'click' THEN 'reply' WHEN 'purchase' THEN 'tag'
                           WHEN 'signup' THEN 'follow' ELSE 'error' END AS type,
         CAST(e.k % 25 AS VARCHAR) AS merchant_id, e.ts AS created_at, strftime(e.ts, '%Y%b') AS month,
         'U' || CAST(e.user_id AS VARCHAR) AS user_name,
         o.src || '-' || CAST(o.o_orderkey AS VARCHAR) AS post_id
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) e
  LEFT JOIN src_orders o ON o.o_orderkey = e.event_id // 2),
sd_event_posts AS (
  SELECT src || '-E' || CAST(event_id AS VARCHAR) AS post_id, src AS source, ts AS post_time,
         src || '-' || CAST(user_id AS VARCHAR) AS poster_id,
         strftime(ts, '%Y%b') AS month, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour,
         'V' || CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) AS venue_id
  FROM (SELECT *, CASE event_type WHEN 'view' THEN 'FB' WHEN 'click' THEN 'IG' WHEN 'purchase' THEN 'TW'
                                  WHEN 'signup' THEN '4S' ELSE 'WB' END AS src FROM events)),
sd_event_src AS (
  SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         CASE event_type WHEN 'view' THEN 'FB' WHEN 'click' THEN 'IG' WHEN 'purchase' THEN 'TW'
                         WHEN 'signup' THEN '4S' ELSE 'WB' END AS src
  FROM events),
sd_audits_ev AS (
  SELECT CAST(e.event_id AS VARCHAR) AS audit_id,
         CASE e.event_type WHEN 'view' THEN 'like' WHEN 'click' THEN 'reply' WHEN 'purchase' THEN 'tag'
                           WHEN 'signup' THEN 'follow' ELSE 'error' END AS type,
         CAST(e.k % 25 AS VARCHAR) AS merchant_id, e.ts AS created_at, strftime(e.ts, '%Y%b') AS month,
         'U' || CAST(e.user_id AS VARCHAR) AS user_name,
         e2.src || '-E' || CAST(e2.event_id AS VARCHAR) AS post_id
  FROM sd_event_src e LEFT JOIN sd_event_src e2 ON e2.event_id = e.event_id // 2),
sd_ev_pp AS (
  SELECT DISTINCT pv.place_name, p.post_id, pv.merchant_id, p.month AS post_month
  FROM sd_event_posts p JOIN sd_active_places pv ON pv.venue_id = p.venue_id
  WHERE NOT EXISTS (SELECT 1 FROM sd_accounts a WHERE a.merchant_id = pv.merchant_id AND a.poster_id = p.poster_id)),
sd_ev_aud4 AS (
  SELECT DISTINCT type, merchant_id, month, user_name, post_id, substr(post_id, 1, 2) AS source
  FROM sd_audits_ev WHERE type IN ('like', 'reply', 'tag', 'follow')),
sd_ev_int_all AS (
  SELECT * FROM sd_ev_aud4 WHERE type IN ('like', 'reply', 'tag')
  UNION ALL
  SELECT DISTINCT 'int' AS type, merchant_id, month, user_name, post_id, source FROM sd_ev_aud4 WHERE type IN ('like', 'reply')),
sd_ev_matched AS (
  SELECT i.type, i.user_name, i.source, i.month, pp.place_name, pp.merchant_id
  FROM sd_ev_int_all i JOIN sd_ev_pp pp ON pp.post_id = i.post_id AND pp.merchant_id = i.merchant_id
                                        AND pp.post_month = i.month),
sd_ev_pu AS (SELECT DISTINCT user_name, place_name, merchant_id, month FROM sd_ev_matched),
sd_ev_follows AS (
  SELECT f.type, f.user_name, f.source, f.month, pu.place_name, pu.merchant_id
  FROM sd_ev_aud4 f JOIN sd_ev_pu pu ON pu.user_name = f.user_name AND pu.merchant_id = f.merchant_id AND pu.month = f.month
  WHERE f.type = 'follow'),
sd_aud4 AS (
  SELECT DISTINCT type, merchant_id, month, user_name, post_id, substr(post_id, 1, 2) AS source
  FROM sd_audits WHERE type IN ('like', 'reply', 'tag', 'follow')),
sd_int_all AS (
  SELECT * FROM sd_aud4 WHERE type IN ('like', 'reply', 'tag')
  UNION ALL
  SELECT DISTINCT 'int' AS type, merchant_id, month, user_name, post_id, source FROM sd_aud4 WHERE type IN ('like', 'reply')),
sd_int_pp AS (SELECT DISTINCT place_name, post_id, merchant_id FROM sd_matches),
sd_int_matched AS (
  SELECT i.type, i.user_name, i.source, i.month, pp.place_name, pp.merchant_id
  FROM sd_int_all i JOIN sd_int_pp pp ON pp.post_id = i.post_id AND pp.merchant_id = i.merchant_id),
sd_int_pu AS (SELECT DISTINCT user_name, place_name, merchant_id, month FROM sd_int_matched),
sd_follows AS (
  SELECT f.type, f.user_name, f.source, f.month, pu.place_name, pu.merchant_id
  FROM sd_aud4 f JOIN sd_int_pu pu ON pu.user_name = f.user_name AND pu.merchant_id = f.merchant_id AND pu.month = f.month
  WHERE f.type = 'follow'),
sd_content AS (
  SELECT merchant_id, place_name, post_month, source, kind, count(*) AS n
  FROM (SELECT DISTINCT merchant_id, place_name, post_id, post_month, source, kind FROM sd_matches)
  GROUP BY ALL),
sd_content_t AS (
  SELECT *, CAST(sum(n) OVER (PARTITION BY merchant_id, place_name, post_month) AS BIGINT) AS total FROM sd_content),
sd_posters AS (
  SELECT merchant_id, place_name, post_month, source, count(*) AS n
  FROM (SELECT DISTINCT merchant_id, place_name, post_month, source, poster_id FROM sd_matches)
  GROUP BY ALL),
sd_posters_t AS (
  SELECT *, CAST(sum(n) OVER (PARTITION BY merchant_id, place_name, post_month) AS BIGINT) AS total FROM sd_posters),
sd_seg_hours AS (
  SELECT merchant_id, place_id, month, day, hour, source, count(*) AS n
  FROM (SELECT DISTINCT pv.merchant_id, pv.place_id, p.post_id, p.month, p.day, p.hour, p.source
        FROM sd_event_posts p JOIN sd_active_places pv ON pv.venue_id = p.venue_id)
  GROUP BY ALL),
sd_reviews AS (
  SELECT merchant_id, place_name, post_month AS month, source, rating_value AS value, count(*) AS n
  FROM (SELECT DISTINCT merchant_id, place_name, post_month, source, post_id, rating_value FROM sd_matches
        WHERE kind = 'review' AND source = 'FB')
  GROUP BY ALL),
sd_interactions AS (
  SELECT merchant_id, place_name, month, user_name AS "user", source, type, count(*) AS n
  FROM (SELECT * FROM sd_int_matched UNION ALL SELECT * FROM sd_follows) GROUP BY ALL),
sd_segments AS (
  SELECT merchant_id, place_id, month, day, 'PC' AS metric, hour, source, n FROM sd_seg_hours
  UNION ALL
  SELECT merchant_id, place_id, month, day, 'PC' AS metric, 'total' AS hour, source, CAST(sum(n) AS BIGINT) AS n
  FROM sd_seg_hours GROUP BY merchant_id, place_id, month, day, source),
sd_kw_texts AS (
  SELECT DISTINCT merchant_id, place_name, post_month, text, source FROM sd_matches
  WHERE text IS NOT NULL AND text <> ''),""" + _keyword_cte("sd_kw_texts", "merchant_id, place_name, post_month, source") + """,
sd_keywords AS (
  SELECT merchant_id, place_name, post_month, word, source, n,
         CAST(sum(n) OVER (PARTITION BY merchant_id, place_name, post_month, word) AS BIGINT) AS total
  FROM (SELECT merchant_id, place_name, post_month, source, word, count(*) AS n FROM kw3 WHERE word <> '' GROUP BY ALL))
"""


def _pivot_by(src: str, group: list[str], key: str, keys, prefix: str) -> str:
    cols = ",\n  ".join(f"CAST(sum(CASE WHEN {key} = {_sql_str(k)} THEN n ELSE 0 END) AS BIGINT) AS {prefix}{k.lower()}"
                         for k in keys)
    g = ", ".join(group)
    return f"""SELECT {g},
  {cols},
  CAST(sum(n) AS BIGINT) AS total
FROM {src} GROUP BY {g}"""


def _pivot_sql(src: str) -> str:
    cols = ",\n  ".join(f"CAST(sum(CASE WHEN source = '{s}' THEN n ELSE 0 END) AS BIGINT) AS n_{s.lower()}" for s in SOURCES)
    return f"""SELECT merchant_id, place_name, post_month,
  {cols},
  CAST(sum(n) AS BIGINT) AS total
FROM {src} GROUP BY merchant_id, place_name, post_month"""


def _values(keys) -> str:
    return "(VALUES " + ", ".join(f"({_sql_str(k)})" for k in keys) + ")"


def _flat_entries_sql(base: str, group: list[str], key: str, outer_keys, keep=()) -> str:
    """Zero-filled flat map entries: every fixed key and every key present, per group."""
    g = ", ".join(group)
    kept = "".join(f", g.{c}" for c in keep)
    return f"""SELECT {", ".join("g." + c for c in group)}{kept}, k.{key}, CAST(coalesce(b.n, 0) AS BIGINT) AS n
FROM (SELECT DISTINCT {g}{"".join(", " + c for c in keep)} FROM {base}) g
JOIN (SELECT DISTINCT {g}, x.{key} FROM (SELECT DISTINCT {g} FROM {base}) CROSS JOIN {_values(outer_keys)} AS x({key})
      UNION SELECT DISTINCT {g}, coalesce({key}, 'None') FROM {base}) k USING ({g})
LEFT JOIN (SELECT {g}, coalesce({key}, 'None') AS {key}, sum(n) AS n FROM {base} GROUP BY ALL) b USING ({g}, {key})"""


def _nested_entries_sql(base: str, group: list[str], outer: str, inner: str, outer_keys, inner_keys,
                        value: str = "n", keep=()) -> str:
    """Zero-filled nested map entries: fixed and present outer keys; under each, fixed and present
    inner keys; value 0 when absent."""
    g = ", ".join(group)
    go = g + ", " + outer
    kept = "".join(f", g.{c}" for c in keep)
    return f"""SELECT {", ".join("g." + c for c in group)}{kept}, i.{outer}, i.{inner}, CAST(coalesce(b.n, 0) AS BIGINT) AS {value}
FROM (SELECT DISTINCT {g}{"".join(", " + c for c in keep)} FROM {base}) g
JOIN (SELECT {go}, y.{inner} FROM (
        SELECT DISTINCT {g}, x.{outer} FROM (SELECT DISTINCT {g} FROM {base}) CROSS JOIN {_values(outer_keys)} AS x({outer})
        UNION SELECT DISTINCT {g}, coalesce({outer}, 'None') FROM {base}) o
      CROSS JOIN {_values(inner_keys)} AS y({inner})
      UNION SELECT DISTINCT {g}, coalesce({outer}, 'None'), coalesce({inner}, 'None') FROM {base}) i USING ({g})
LEFT JOIN (SELECT {g}, coalesce({outer}, 'None') AS {outer}, coalesce({inner}, 'None') AS {inner}, sum(n) AS n
           FROM {base} GROUP BY ALL) b USING ({go}, {inner})"""


_NULLED = (_STANDINS.replace("'U' || CAST(e.user_id AS VARCHAR) AS user_name",
                             "CASE WHEN e.user_id % 7 <> 0 THEN 'U' || CAST(e.user_id AS VARCHAR) END AS user_name")
           .replace("s_name AS place_name", "CASE WHEN s_suppkey % 5 <> 0 THEN s_name END AS place_name"))

#: linked accounts by customer: service, source code (null for the unknown one)
_LINKED = """
ln AS (SELECT CAST(c_nationkey AS VARCHAR) AS merchant_id, c_custkey, c_name,
              ['facebook', 'facebookpages', 'instagram', 'twitter', 'foursquare', 'myspace'][c_custkey % 6 + 1] AS service,
              ['FB', 'FB', 'IG', 'TW', '4S', NULL][c_custkey % 6 + 1] AS src FROM customer)"""


def _wrap(body: str, extra_ctes: str = "") -> str:
    extra = ("," + extra_ctes) if extra_ctes else ""
    return "WITH " + _STANDINS + extra + "\n" + body


def _rt_sql(wrapped: bool, audits: str = "sd_audits", posts: str = "sd_posts") -> str:
    diff = "epoch_us(a.created_at) // 1000000 - epoch_us(p.post_time) // 1000000"
    if wrapped:
        diff = f"(({diff}) % 86400 + 86400) % 86400"
    return _wrap(f"""SELECT merchant_id, month, user_name AS "user", avg(m) AS average
FROM (SELECT a.merchant_id, a.user_name, a.month, a.post_id, min({diff}) AS m
      FROM (SELECT DISTINCT type, created_at, month, user_name, post_id, merchant_id FROM {audits}
            WHERE type IN ('like', 'reply', 'tag', 'follow')) a
      JOIN {posts} p ON p.post_id = a.post_id
      GROUP BY ALL)
GROUP BY ALL""")


def oracle_sql() -> dict[str, str]:
    sources = ", ".join(f"('{s}')" for s in SOURCES)
    bench_mentions = """
bm AS (SELECT CAST(item_id % 25 AS VARCHAR) AS merchant_id, text FROM benchmark),""" + \
        _keyword_cte("bm", "merchant_id").replace("kw1", "bk1").replace("kw2", "bk2").replace("kw3", "bk3") + """,
bmentions AS (SELECT DISTINCT merchant_id, word AS term FROM bk3 WHERE word <> '')"""
    strip_words = f"""
w0 AS (SELECT d.doc_id, u.w, u.pos FROM documents d, unnest(string_split(d.text, ' ')) WITH ORDINALITY AS u(w, pos)),
w1 AS (SELECT doc_id, pos, regexp_replace(regexp_replace(lower(w), {_sql_str('^' + _PUNC)}, ''), {_sql_str(_PUNC + '$')}, '') AS w
       FROM w0 WHERE length(lower(w)) >= 3 AND length(lower(w)) <= 16),
w2 AS (SELECT doc_id, w, min(pos) AS pos FROM w1
       WHERE length(w) >= 3 AND NOT contains(w, 'http') AND NOT list_contains({_stops_sql()}, w) GROUP BY ALL)"""
    found = {
        "follow_nulls": "WITH " + _NULLED + """SELECT merchant_id, place_name, month, user_name AS "user", source, type, count(*) AS n
FROM (SELECT * FROM sd_int_matched UNION ALL SELECT * FROM sd_follows) GROUP BY ALL""",
        "venue_mentions": """SELECT CAST(s_nationkey AS VARCHAR) AS merchant_id, CAST(s_suppkey AS VARCHAR) AS place_id,
  'V' || CAST(s_suppkey AS VARCHAR) AS venue_id, split_part(s_name, '#', -1) AS term FROM supplier WHERE s_suppkey % 2 = 0""",
        "handle_mentions": "WITH " + _LINKED + " SELECT merchant_id, service, c_name AS name FROM ln WHERE service IN ('instagram', 'twitter')",
        "linked_own_posts": _wrap("""SELECT DISTINCT m.merchant_id, m.place_name, m.post_id, m.poster_id FROM sd_all_matches m
WHERE EXISTS (SELECT 1 FROM ln a WHERE a.merchant_id = m.merchant_id AND a.src || '-' || CAST(a.c_custkey AS VARCHAR) = m.poster_id)""", _LINKED),
        "linked_accounts": "WITH " + _LINKED + """ SELECT merchant_id, src AS source, src || '-' || CAST(c_custkey AS VARCHAR) AS poster_id
FROM ln WHERE src IS NOT NULL""",
        "active_places": _wrap("SELECT place_id, place_name, merchant_id FROM sd_active_places"),
        "place_posts": _wrap("SELECT DISTINCT merchant_id, place_name, post_id, post_month, source, kind FROM sd_matches"),
        "own_post_filter": _wrap("""SELECT DISTINCT m.merchant_id, m.place_name, m.post_id, m.poster_id FROM sd_all_matches m
WHERE EXISTS (SELECT 1 FROM sd_accounts a WHERE a.merchant_id = m.merchant_id AND a.poster_id = m.poster_id)"""),
        "content_types_long": _wrap("SELECT * FROM sd_content_t WHERE total > 0"),
        "content_types_pivot": _wrap(_pivot_sql("sd_content")),
        "content_types_legacy_forms": _wrap("SELECT * FROM sd_content_t WHERE total > 0"),
        "reviews_long": _wrap("""SELECT merchant_id, place_name, post_month AS month, source, rating_value AS value, count(*) AS n
FROM (SELECT DISTINCT merchant_id, place_name, post_month, source, post_id, rating_value FROM sd_matches
      WHERE kind = 'review' AND source = 'FB')
GROUP BY ALL"""),
        "posters_long": _wrap("SELECT * FROM sd_posters_t WHERE total > 0"),
        "posters_pivot": _wrap(_pivot_sql("sd_posters")),
        "reviews_pivot": _wrap(_pivot_by("sd_reviews", ["merchant_id", "place_name", "month"], "value", RATINGS, "r_")),
        "interactions_pivot": _wrap(_pivot_by("sd_interactions", ["merchant_id", "place_name", "month", '"user"', "source"],
                                              "type", INTERACTION_TYPES, "n_")),
        "posters_total": _wrap("""SELECT merchant_id, place_name, post_month, CAST(sum(n) AS BIGINT) AS total
FROM sd_posters GROUP BY ALL"""),
        "segments_pivot": _wrap(_pivot_by("sd_seg_hours", ["merchant_id", "place_id", "month", "day", "source"], "hour",
                                          HOURS, "h_")),
        "segments_total": _wrap("""SELECT merchant_id, place_id, month, day, source, CAST(sum(n) AS BIGINT) AS total
FROM sd_seg_hours GROUP BY ALL"""),
        "keywords_total": _wrap("""SELECT DISTINCT merchant_id, place_name, post_month, word, total FROM sd_keywords
WHERE total >= 2"""),
        "segments_long": _wrap("""SELECT merchant_id, place_id, month, day, 'PC' AS metric, hour, source, n FROM sd_seg_hours
UNION ALL
SELECT merchant_id, place_id, month, day, 'PC' AS metric, 'total' AS hour, source, CAST(sum(n) AS BIGINT) AS n
FROM sd_seg_hours GROUP BY merchant_id, place_id, month, day, source"""),
        "segment_check": _wrap(f"""SELECT merchant_id, place_id, month, day, source, hours_sum, total, hours_sum = total AS ok
FROM (SELECT d.merchant_id, d.place_id, d.month, d.day, s.source,
  CAST(coalesce((SELECT sum(h.n) FROM sd_seg_hours h WHERE h.merchant_id = d.merchant_id AND h.place_id = d.place_id
                 AND h.month = d.month AND h.day = d.day AND h.source = s.source), 0) AS BIGINT) AS hours_sum,
  CAST(coalesce((SELECT count(DISTINCT p.post_id) FROM sd_event_posts p JOIN sd_active_places pv ON pv.venue_id = p.venue_id
                 WHERE pv.merchant_id = d.merchant_id AND pv.place_id = d.place_id AND p.month = d.month
                 AND p.day = d.day AND p.source = s.source), 0) AS BIGINT) AS total
  FROM (SELECT DISTINCT merchant_id, place_id, month, day FROM sd_seg_hours) d
  CROSS JOIN (VALUES {sources}) AS s(source))"""),
        "keywords_long": _wrap("SELECT * FROM sd_keywords WHERE total >= 2"),
        "text_strip_words": _wrap("""SELECT d.doc_id, coalesce(string_agg(w2.w, ' ' ORDER BY w2.pos), '') AS normalised,
  count(w2.w) AS n_words
FROM documents d LEFT JOIN w2 ON w2.doc_id = d.doc_id GROUP BY d.doc_id""", strip_words),
        "interactions_long": _wrap("""SELECT merchant_id, place_name, month, user_name AS "user", source, type, count(*) AS n
FROM (SELECT * FROM sd_int_matched UNION ALL SELECT * FROM sd_follows) GROUP BY ALL"""),
        "unique_interactions": _wrap("""SELECT DISTINCT 'int' AS type, merchant_id, month, user_name AS "user", post_id, source
FROM sd_aud4 WHERE type IN ('like', 'reply')"""),
        "follow_attribution": _wrap("""SELECT type, user_name AS "user", source, month, place_name, merchant_id FROM sd_follows"""),
        "interactions_same_month": _wrap("""SELECT merchant_id, place_name, month, user_name AS "user", source, type,
  count(*) AS n
FROM (SELECT * FROM sd_ev_matched UNION ALL SELECT * FROM sd_ev_follows) GROUP BY ALL"""),
        "response_times_events": _rt_sql(False, "sd_audits_ev", "sd_event_posts"),
        "response_times": _rt_sql(False),
        "response_times_wrapped": _rt_sql(True),
        "merchant_post_count": _wrap("""SELECT pv.merchant_id, p.post_month AS month, count(DISTINCT p.post_id) AS n_posts
FROM sd_post_venues p JOIN sd_places pv ON pv.venue_id = p.venue_id GROUP BY ALL"""),
        "tagged_post_count": _wrap(f"""SELECT pv.merchant_id, pv.place_id, pv.place_name, p.post_month AS month,
  count(DISTINCT p.post_id) AS n_posts
FROM sd_post_venues p JOIN sd_places pv ON pv.venue_id = p.venue_id
WHERE p.o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ({", ".join(_sql_str(x) for x in TAGS)}))
GROUP BY ALL"""),
        "user_likes": _wrap("""SELECT user_name AS "user", month, post_id, place_id, place_name, merchant_id, count(*) AS likes
FROM (SELECT DISTINCT l.audit_id, l.user_name, l.month, l.post_id, pv.place_id, pv.place_name, pv.merchant_id
      FROM sd_audits l JOIN sd_post_venues p ON p.post_id = l.post_id JOIN sd_places pv ON pv.venue_id = p.venue_id
      WHERE l.type = 'like')
GROUP BY ALL"""),
        "keyword_mentions": _wrap("""SELECT k.* FROM sd_keywords k WHERE k.total >= 2
AND EXISTS (SELECT 1 FROM bmentions m WHERE m.merchant_id = k.merchant_id AND m.term = k.word)""", bench_mentions),
        "month_parts": _wrap("""SELECT o_orderkey, strftime(o_orderdate, '%Y%b') AS month, strftime(o_orderdate, '%d') AS day,
  strftime(o_orderdate, '%H') AS hour, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
  strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_month
FROM orders"""),
        "source_prefix": _wrap("SELECT post_id, source FROM sd_posts"),
        "venue_list_parse": _wrap("""SELECT post_id, count(*) AS n_venues, string_agg(venue_id, ',' ORDER BY venue_id) AS venues
FROM sd_post_venues GROUP BY post_id"""),
        "content_types_map_entries": _wrap(_nested_entries_sql(
            "sd_content_t", ["merchant_id", "place_name", "post_month"], "source", "kind", SOURCES, KINDS,
            keep=["total"])),
        "reviews_map_entries": _wrap(_nested_entries_sql(
            "sd_reviews", ["merchant_id", "place_name", "month"], "source", "value", REVIEW_SOURCES, RATINGS)),
        "posters_map_entries": _wrap(_flat_entries_sql(
            "sd_posters_t", ["merchant_id", "place_name", "post_month"], "source", SOURCES, keep=["total"])),
        "keywords_map_entries": _wrap(_flat_entries_sql(
            "(SELECT * FROM sd_keywords WHERE total >= 2)", ["merchant_id", "place_name", "post_month", "word"],
            "source", SOURCES, keep=["total"])),
        "interactions_map_entries": _wrap(_nested_entries_sql(
            "sd_interactions", ["merchant_id", "place_name", "month", '"user"'], "source", "type", SOURCES,
            INTERACTION_TYPES)),
        "segments_map_entries": _wrap(_nested_entries_sql(
            "sd_segments", ["merchant_id", "place_id", "month", "day", "metric"], "hour", "source",
            HOURS + ["total"], SOURCES)),
    }
    found["content_types_salted"] = found["content_types_exported"] = found["content_types_long"]
    found["response_times_bucketed"] = found["response_times_exported"] = found["response_times"]
    found["place_scan"] = """SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS merchant_id,
  'V' || CAST(s_suppkey AS VARCHAR) AS venues FROM supplier"""
    found["published_month"] = f"SELECT * FROM ({found['content_types_long']}) WHERE post_month = {_sql_str(ORDER_MONTH)}"
    found["merchant_lookup"] = f"SELECT * FROM ({found['content_types_long']}) WHERE merchant_id = {_sql_str(LOOKED_UP)}"
    found["appended_runs"] = _wrap("""SELECT merchant_id, place_name, post_month, source, n, CASE source WHEN 'FB' THEN 'one' ELSE 'two' END AS run
FROM sd_posters WHERE source IN ('FB', 'IG')""")
    found["monthly_run"] = _wrap(f"""SELECT 'content' AS report, merchant_id, place_name, post_month, CAST(sum(n) AS BIGINT) AS total
FROM sd_content WHERE post_month = {_sql_str(ORDER_MONTH)} GROUP BY ALL
UNION ALL SELECT 'posters', merchant_id, place_name, post_month, CAST(sum(n) AS BIGINT)
FROM sd_posters WHERE post_month = {_sql_str(ORDER_MONTH)} GROUP BY ALL""")
    found["posters_merged"] = found["posters_long"]
    found["keyword_mentions_written"] = found["keyword_mentions"]
    found["audit_types"] = _wrap("""SELECT audit_id, CASE type WHEN 'error' THEN 'unlike' ELSE type END AS type
FROM sd_audits WHERE type = 'like' OR type LIKE 're%'""")
    found["own_post_flags"] = "WITH " + _LINKED + f""" SELECT merchant_id, s.src || '-' || CAST(c_custkey AS VARCHAR) AS poster_id,
  coalesce(ln.src = s.src, false) AS own FROM ln CROSS JOIN (VALUES {sources}) AS s(src)"""
    found["hour_keys"] = "SELECT event_id, strftime(ts, '%H') AS hour FROM events"
    found["count_reports"] = _wrap("""
SELECT 'content' AS report, merchant_id, NULL AS place_id, place_name, post_month, NULL AS day, NULL AS hour, source, kind, NULL AS value, n FROM sd_content
UNION ALL SELECT 'reviews', merchant_id, NULL, place_name, month, NULL, NULL, source, NULL, value, n FROM sd_reviews
UNION ALL SELECT 'posters', merchant_id, NULL, place_name, post_month, NULL, NULL, source, NULL, NULL, n FROM sd_posters
UNION ALL SELECT 'segments', merchant_id, place_id, NULL, post_month, day, h.hour, source, NULL, NULL, count(*)
FROM (SELECT DISTINCT m.merchant_id, m.place_id, m.post_month, strftime(p.post_time, '%d') AS day, strftime(p.post_time, '%H') AS hour, m.source, m.post_id
      FROM sd_all_matches m JOIN sd_posts p USING (post_id)) x
JOIN (SELECT DISTINCT strftime(post_time, '%H') AS at, strftime(post_time, '%H') AS hour FROM sd_posts
      UNION ALL SELECT DISTINCT strftime(post_time, '%H'), 'total' FROM sd_posts) h ON h.at = x.hour
GROUP BY ALL""")
    for name, (whole, _, month, col, _) in MONTHLY.items():
        found[name] = f"SELECT * FROM ({found[whole]}) WHERE {col} = {_sql_str(month)}"
    return found


def queries() -> dict[str, Query]:
    return dict(QUERIES)
