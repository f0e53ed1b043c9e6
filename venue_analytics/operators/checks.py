"""Data-quality and drill-down checks over the sources and the report outputs.

The original validators looped on the client (a find per place, a find_one per venue or like);
here each is one distributed plan: explode + equi-join replaces the per-document lookups, and the
array-overlap filters become joins on the exploded venue id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venue_analytics.functions.columns import month_pred, month_str
from venue_analytics.functions.text import keyword_words
from venue_analytics.operators.core import Tables, place_venues, salt_mode, salted_venue_join
from venue_analytics.sources.schemas import HOURS


def _all_place_venues(places: DataFrame) -> DataFrame:
    return place_venues(places.select(F.col("id").alias("place_id"), F.col("name").alias("place_name"),
                                      "merchant_id", "venue_ids"))


def _month_posts(posts: DataFrame, month: str | None, extra_filter=None) -> DataFrame:
    p = posts.filter(month_pred(posts, "post_time", month))
    if extra_filter is not None:
        p = p.filter(extra_filter)
    return p.select(F.col("id").alias("post_id"), month_str("post_time").alias("month"),
                    F.explode(F.array_distinct("secondary_venue_ids")).alias("venue_id"))


def _at_venues(posts: DataFrame, venues: DataFrame, salt: str | int | None = None, key: str = "post_id") -> DataFrame:
    return salted_venue_join(posts, venues, salt_mode(posts.sparkSession, salt), key)


# ----------------------------------------------------------------------------------------- Q8
def check_segment_totals(segments_map: DataFrame, group_cols=("merchant_id", "place_id", "month", "day")) -> DataFrame:
    """Per segment document and source: the sum over the 24 hour entries, the 'total' entry and
    ``ok`` = equal. Works on the map form; every source present in the map is checked."""
    g = list(group_cols)
    cells = (segments_map
             .select(*g, F.explode("counts").alias("hour", "by_source"))
             .select(*g, "hour", F.explode("by_source").alias("source", "n")))
    return (cells.groupBy(*g, "source")
            .agg(F.sum(F.when(F.col("hour").isin(HOURS), F.col("n")).otherwise(F.lit(0))).cast("long").alias("hours_sum"),
                 F.sum(F.when(F.col("hour") == "total", F.col("n")).otherwise(F.lit(0))).cast("long").alias("total"))
            .withColumn("ok", F.col("hours_sum") == F.col("total")))


def segment_violations(segments_map: DataFrame) -> DataFrame:
    """Rows of ``check_segment_totals`` that fail."""
    return check_segment_totals(segments_map).filter(~F.col("ok"))


# ----------------------------------------------------------------------------------------- Q9
def merchant_post_count(t: Tables, month: str | None = None) -> DataFrame:
    """(merchant_id, month, n_posts): posts of the month whose venue list shares a venue with any
    place of the merchant (every place, active or not), each post counted once per merchant."""
    mv = _all_place_venues(t.places).select("merchant_id", "venue_id").distinct()
    j = _at_venues(_month_posts(t.posts, month), mv, t.venue_salt)
    return (j.select("merchant_id", "month", "post_id").distinct()
            .groupBy("merchant_id", "month").agg(F.count(F.lit(1)).alias("n_posts")))


# ---------------------------------------------------------------------------------------- Q10
def venue_mentions(t: Tables) -> DataFrame:
    """(merchant_id, place_id, venue_id, term): terms of the 'mention' venues listed by a place."""
    v = t.venues.filter(F.col("type") == "mention").select(F.col("id").alias("venue_id"), "term")
    return _all_place_venues(t.places).join(v, "venue_id", "inner").select("merchant_id", "place_id", "venue_id", "term")


# ---------------------------------------------------------------------------------------- Q11
def handle_mentions(merchants: DataFrame, services=("instagram", "twitter")) -> DataFrame:
    """(merchant_id, service, name): account names of the merchant's instagram and twitter accounts."""
    entries = merchants.select(F.col("id").alias("merchant_id"),
                               F.explode("linked_accounts").alias("service", "accounts"))
    return (entries.filter(F.col("service").isin(list(services)))
            .select("merchant_id", "service", F.explode("accounts").alias("a"))
            .select("merchant_id", "service", F.col("a.name").alias("name")))


def mention_terms(t: Tables) -> DataFrame:
    """(merchant_id, term) from venue mentions and handle names."""
    parts = [handle_mentions(t.merchants).select("merchant_id", F.col("name").alias("term"))]
    if t.venues is not None:
        parts.append(venue_mentions(t).select("merchant_id", "term"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


# ---------------------------------------------------------------------------------------- Q12
def keyword_mentions(keywords_df: DataFrame, mentions: DataFrame) -> DataFrame:
    """Keyword report rows whose word is one of the merchant's mention terms (semi-join; the
    mention relation is small per merchant, AQE broadcasts it when its measured size allows)."""
    m = mentions.select("merchant_id", F.col("term").alias("word"))
    return keywords_df.join(m, ["merchant_id", "word"], "left_semi")


def text_mentions(texts: DataFrame, key_col: str, text_col: str, merchant_col=None, stops=None) -> DataFrame:
    """(merchant_id, term): keyword tokens of whole texts used as mention terms."""
    mc = F.col(merchant_col) if isinstance(merchant_col, str) else merchant_col
    return (texts.select(mc.alias("merchant_id"), F.explode(keyword_words(text_col, stops)).alias("term"))
            .filter(F.col("term") != "").distinct())


# ---------------------------------------------------------------------------------------- Q13
def tagged_post_count(t: Tables, tags, month: str | None = None) -> DataFrame:
    """(merchant_id, place_id, place_name, month, n_posts): per place, posts of the month at one of
    its venues carrying one of ``tags`` (a small literal list)."""
    has_tag = F.arrays_overlap(F.col("tag_ids"), F.array(*[F.lit(x) for x in tags]))
    j = _at_venues(_month_posts(t.posts, month, F.coalesce(has_tag, F.lit(False))), _all_place_venues(t.places), t.venue_salt)
    return (j.select("merchant_id", "place_id", "place_name", "month", "post_id").distinct()
            .groupBy("merchant_id", "place_id", "place_name", "month").agg(F.count(F.lit(1)).alias("n_posts")))


# ---------------------------------------------------------------------------------------- Q14
def user_likes(t: Tables, user: str | None = None, month: str | None = None) -> DataFrame:
    """(user, month, post_id, place_id, place_name, merchant_id, likes): each liked post of the
    month with every place (of any merchant) sharing one of its venues; ``likes`` = like audits."""
    cond = (F.col("type") == "like") & month_pred(t.audits, "created_at", month)
    if user is not None:
        cond = cond & (F.col("actor.label") == user)
    likes = t.audits.filter(cond).select(F.col("id").alias("audit_id"), F.col("actor.label").alias("user"),
                                         month_str("created_at").alias("month"),
                                         F.col("subject.origin_id").alias("post_id"))
    # liked posts only are exploded to their venues
    posts = t.posts.select(F.col("id").alias("post_id"), F.array_distinct("secondary_venue_ids").alias("venues"))
    liked = likes.join(posts, "post_id").select("audit_id", "user", "month", "post_id", F.explode("venues").alias("venue_id"))
    j = _at_venues(liked, _all_place_venues(t.places), t.venue_salt, "audit_id")
    return (j.select("audit_id", "user", "month", "post_id", "place_id", "place_name", "merchant_id").distinct()
            .groupBy("user", "month", "post_id", "place_id", "place_name", "merchant_id")
            .agg(F.count(F.lit(1)).alias("likes")))
