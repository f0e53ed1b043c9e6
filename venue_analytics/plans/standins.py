"""Model collections derived from the driver's tables, so every report runs on them at any scale.

All derivations are Spark projections and joins of the given tables (nothing is made up or
sampled), so the work grows with the tables.

=============  ================================================================================
merchants      nation: id = n_nationkey, name = n_name, expires 2030-01-01 (1999-01-01 for region
               0, i.e. expired at AS_OF)
accounts       customer: merchant = c_nationkey, own poster ids '<source>-<c_custkey>' for each of the
               five sources
linked         customer: one row per customer with its merchant and a one-service linked_accounts
               map (service by c_custkey % 6, the sixth unknown), account id = c_custkey
venues         supplier: id 'V<s_suppkey>', type 'mention' for even keys, else 'place', term = last
               word of s_name
places         supplier: id = s_suppkey, name = s_name, merchant = s_nationkey, venues ['V<s_suppkey>']
posts          orders: source by o_orderpriority (1 FB, 2 IG, 3 TW, 4 4S, 5 WB), id '<source>-<o_orderkey>',
               post_time o_orderdate, kind by o_orderstatus (F photo, O video, P review), poster
               '<source>-<o_custkey>', rating 1 + o_orderkey % 5, venues 'V<l_suppkey>' and tags
               l_returnflag of the order's line items, text = documents.text of doc_id = o_orderkey
event posts    events: source by event_type (view FB, click IG, purchase TW, signup 4S, error WB),
               id '<source>-E<event_id>', post_time ts, venues ['V<k>'] with k = props.k
audits         events: type by event_type (view like, click reply, purchase tag, signup follow,
               error 'error' = noise), user 'U<user_id>', merchant k % 25, created_at ts, post =
               the order post with o_orderkey = event_id div 2 (with event posts: the event post
               of that event_id), so subjects run over the whole key range
=============  ================================================================================

Order posts are dated 1995-2001 and audits 2024, so the interaction stand-in on order posts runs
with ``same_month=False`` (audits of any month meet posts of any month); on event posts it runs
with the default ``same_month=True``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venue_analytics.operators.core import Tables, dealt_by
from venue_analytics.sources.schemas import SOURCES

AS_OF = dt.datetime(2002, 1, 1)
N_MERCHANTS = 25
#: tasks that collect the lists of orders, in shuffle partitions of the session
LIST_TASKS = 4


# Declared schemas of the driver tables read here (as Spark reads them): no schema-inference job
# per read, and a changed file fails loudly instead of silently changing types.
DRIVER_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _order_source() -> Column:
    p = F.substring("o_orderpriority", 1, 1)
    return (F.when(p == "1", "FB").when(p == "2", "IG").when(p == "3", "TW")
            .when(p == "4", "4S").otherwise("WB"))


def _event_source() -> Column:
    e = F.col("event_type")
    return (F.when(e == "view", "FB").when(e == "click", "IG").when(e == "purchase", "TW")
            .when(e == "signup", "4S").otherwise("WB"))


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def merchants(spark, sf_dir) -> DataFrame:
    n = load(spark, sf_dir, "nation")
    exp = F.when(F.col("n_regionkey") != 0, F.lit(dt.datetime(2030, 1, 1))).otherwise(F.lit(dt.datetime(1999, 1, 1)))
    return n.select(_s("n_nationkey").alias("id"), F.col("n_name").alias("name"),
                    F.struct(exp.alias("expires_at")).alias("subscription"))


def accounts(spark, sf_dir) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    src = F.explode(F.array(*[F.lit(s) for s in SOURCES]))
    return (c.select(_s("c_nationkey").alias("merchant_id"), "c_custkey", src.alias("src"))
            .select("merchant_id", F.concat("src", F.lit("-"), _s("c_custkey")).alias("poster_id")))


SERVICES = ["facebook", "facebookpages", "instagram", "twitter", "foursquare", "myspace"]


def linked_merchants(spark, sf_dir) -> DataFrame:
    """Merchant rows with linked accounts, one row per customer: the map has one entry and doesn't grow."""
    c = load(spark, sf_dir, "customer")
    service = F.element_at(F.array(*[F.lit(s) for s in SERVICES]), (F.col("c_custkey") % 6 + 1).cast("int"))
    account = F.struct(_s("c_custkey").alias("account_id"), F.col("c_name").alias("name"))
    return c.select(_s("c_nationkey").alias("id"), F.create_map(service, F.array(account)).alias("linked_accounts"))


def venues(spark, sf_dir) -> DataFrame:
    s = load(spark, sf_dir, "supplier")
    return s.select(F.concat(F.lit("V"), _s("s_suppkey")).alias("id"),
                    F.when(F.col("s_suppkey") % 2 == 0, "mention").otherwise("place").alias("type"),
                    F.substring_index("s_name", "#", -1).alias("term"))


def places(spark, sf_dir) -> DataFrame:
    s = load(spark, sf_dir, "supplier")
    return s.select(_s("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                    _s("s_nationkey").alias("merchant_id"),
                    F.array(F.concat(F.lit("V"), _s("s_suppkey"))).alias("venue_ids"))


def posts(spark, sf_dir, with_text: bool = False) -> DataFrame:
    """Order posts. Venue and tag lists are collected per order: bounded by the order's line
    items (a handful), never an unbounded group."""
    o = load(spark, sf_dir, "orders")
    li = (dealt_by(load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag"), "l_orderkey", tasks=LIST_TASKS)
          .groupBy("l_orderkey")
          .agg(F.collect_list(F.concat(F.lit("V"), _s("l_suppkey"))).alias("secondary_venue_ids"),
               F.collect_list("l_returnflag").alias("tag_ids")))
    src = _order_source()
    # orders and their line items are both fact tables; AQE picks the join from measured sizes
    p = (o.join(li, o["o_orderkey"] == li["l_orderkey"], "left")
         .select(F.concat(src, F.lit("-"), _s("o_orderkey")).alias("id"),
                 F.col("o_orderdate").alias("post_time"),
                 "secondary_venue_ids",
                 F.when(F.col("o_orderstatus") == "F", "photo").when(F.col("o_orderstatus") == "O", "video")
                 .otherwise("review").alias("kind"),
                 F.concat(src, F.lit("-"), _s("o_custkey")).alias("poster_id"),
                 F.struct(_s(F.col("o_orderkey") % 5 + 1).alias("value"), F.lit(5).alias("scale")).alias("rating"),
                 "tag_ids", "o_orderkey"))
    if with_text:
        d = load(spark, sf_dir, "documents").select(F.col("doc_id"), "text")
        p = p.join(d, p["o_orderkey"] == d["doc_id"], "left").drop("doc_id")
    else:
        p = p.withColumn("text", F.lit(None).cast("string"))
    return p.drop("o_orderkey")


def event_posts(spark, sf_dir) -> DataFrame:
    e = load(spark, sf_dir, "events")
    src = _event_source()
    return e.select(F.concat(src, F.lit("-E"), _s("event_id")).alias("id"),
                    F.col("ts").alias("post_time"),
                    F.array(F.concat(F.lit("V"), _s(_k()))).alias("secondary_venue_ids"),
                    F.lit("feed").alias("kind"),
                    F.concat(src, F.lit("-"), _s("user_id")).alias("poster_id"),
                    F.lit(None).cast("string").alias("text"))


def audits(spark, sf_dir, on_event_posts: bool = False) -> DataFrame:
    """Audits from events. The subject is the order post with o_orderkey = event_id div 2, or with
    ``on_event_posts`` the event post of that event_id (same month as the audits)."""
    e = load(spark, sf_dir, "events").withColumn("k", _k())
    typ = (F.when(F.col("event_type") == "view", "like").when(F.col("event_type") == "click", "reply")
           .when(F.col("event_type") == "purchase", "tag").when(F.col("event_type") == "signup", "follow")
           .otherwise("error"))
    if on_event_posts:
        target = load(spark, sf_dir, "events").select(
            F.col("event_id").alias("t_id"),
            F.concat(_event_source(), F.lit("-E"), _s("event_id")).alias("t_post"))
        joined = e.join(target, F.floor(e["event_id"] / 2) == target["t_id"], "left")
        post_id = F.col("t_post")
    else:
        o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
        joined = e.join(o, F.floor(e["event_id"] / 2) == o["o_orderkey"], "left")
        post_id = F.concat(_order_source(), F.lit("-"), _s("o_orderkey"))
    return (joined
            .select(_s("event_id").alias("id"), F.lit("interaction").alias("category"), typ.alias("type"),
                    _s(F.col("k") % N_MERCHANTS).alias("merchant_id"), F.col("ts").alias("created_at"),
                    F.struct(F.lit("user").alias("type"), _s("user_id").alias("object_id"),
                             F.concat(F.lit("U"), _s("user_id")).alias("label")).alias("actor"),
                    F.struct(F.lit("post").alias("type"), post_id.alias("origin_id"),
                             F.lit("post").alias("label")).alias("subject")))


def tables(spark: SparkSession, sf_dir: str, with_text: bool = False, event_based: bool = False) -> Tables:
    """Stand-in Tables; ``event_based`` swaps order posts for event posts (hour-level times,
    same month as the audits) and points the audits at them."""
    p = event_posts(spark, sf_dir) if event_based else posts(spark, sf_dir, with_text)
    return Tables(posts=p, places=places(spark, sf_dir), merchants=merchants(spark, sf_dir),
                  audits=audits(spark, sf_dir, on_event_posts=event_based), accounts=accounts(spark, sf_dir))
