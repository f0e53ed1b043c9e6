"""Shared building blocks of every report: active places and the place <-> post venue match.

Plan shape (per report):

    posts --filter(month range: PushedFilters)--> explode(venue ids) --+
                                                                      +-- join on venue_id
    places --join(active merchants)--> explode(venue ids) ------------+        |
                                                                   left_anti (merchant_id, poster_id)
                                                                               |
                                                          distinct(report keys) -> groupBy -> count

* The place side is a dimension: AQE turns the venue join into a broadcast hash join only when the
  measured place side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise it is a
  sort-merge join whose skewed partitions (one venue holding a large share of posts) are split by
  AQE's skew-join handling (sessions of this package switch the static, estimate-based broadcast off).
* Own posts are removed with an anti-join on the flat (merchant_id, poster_id) relation instead of
  scanning an account array per row, so the cost does not grow with a merchant's account count.
* DISTINCT then COUNT is two aggregations with partial (map-side) aggregation, so a hot group is
  collapsed on the map side before any shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venue_analytics.functions.accounts import merchant_accounts
from venue_analytics.functions.columns import (
    day_str, hour_str, is_expired, month_pred, month_str, source_of,
)


@dataclass
class Tables:
    """The source collections of one run. ``accounts`` (merchant_id, poster_id) is optional:
    when absent it is derived from ``merchants.linked_accounts``."""
    posts: DataFrame
    places: DataFrame
    merchants: DataFrame
    audits: DataFrame | None = None
    accounts: DataFrame | None = None
    venues: DataFrame | None = None
    # Optional precomputed place/post match of one month (see ``match_table``), shared by the
    # reports of a run instead of each re-joining posts and places.
    matches: DataFrame | None = None
    matches_month: str | None = None
    matches_path: str | None = None
    # Optional precomputed counts of the same month (see ``reports.count_reports``)
    counts: DataFrame | None = None
    counts_path: str | None = None
    # how the venue join meets hot venues (see ``salt_mode``); None: as the session says
    venue_salt: str | int | None = None

    def own_accounts(self) -> DataFrame:
        if self.accounts is not None:
            return self.accounts.select("merchant_id", "poster_id")
        return merchant_accounts(self.merchants)


def active_merchants(merchants: DataFrame, as_of=None) -> DataFrame:
    """(merchant_id) of merchants whose subscription has not expired at ``as_of``."""
    exp_type = merchants.schema["subscription"].dataType["expires_at"].dataType
    return (merchants
            .filter(~is_expired(F.col("subscription.expires_at"), as_of, exp_type))
            .select(F.col("id").alias("merchant_id")))


def active_places(places: DataFrame, merchants: DataFrame, as_of=None) -> DataFrame:
    """Places of active merchants: (place_id, place_name, merchant_id, venue_ids)."""
    act = active_merchants(merchants, as_of)
    return (places
            .select(F.col("id").alias("place_id"), F.col("name").alias("place_name"),
                    "merchant_id", "venue_ids")
            .join(act, "merchant_id", "inner"))


def place_venues(places: DataFrame) -> DataFrame:
    """One row per (place, venue id); a place without venues has no row."""
    # a venue listed twice would only duplicate join rows that the dedupe removes later
    return places.select("merchant_id", "place_id", "place_name",
                         F.explode(F.array_distinct("venue_ids")).alias("venue_id"))


def text_digest(text: str = "text") -> Column:
    """The SHA-256 of a text as 32 bytes, null for a null or empty one."""
    return F.when(F.col(text) != "", F.unhex(F.sha2(text, 256)))


_DERIVED = {
    "post_id": lambda: F.col("id"),
    "source": lambda: source_of("id"),
    "post_month": lambda: month_str("post_time"),
    "day": lambda: day_str("post_time"),
    "hour": lambda: hour_str("post_time"),
    "kind": lambda: F.col("kind"),
    "poster_id": lambda: F.col("poster_id"),
    "text": lambda: F.col("text"),
    # equal texts have equal digests; a clash of two different texts is no practical risk with SHA-256
    "text_digest": lambda: text_digest(),
    "text_chars": lambda: F.length("text"),
    "value": lambda: F.col("rating.value").cast("string"),
}


def post_venues(posts: DataFrame, month: str | None, cols, extra_filter=None) -> DataFrame:
    """Posts of the month (range predicate on post_time, pushed to the scan) with their venue ids
    exploded: one row per (post, venue id), carrying the derived ``cols``."""
    p = posts.filter(month_pred(posts, "post_time", month))
    if extra_filter is not None:
        p = p.filter(extra_filter)
    # derived columns are computed once per post, below the explode
    once = p.select(*[(c if isinstance(c, Column) else _DERIVED[c]().alias(c)) for c in cols],
                    F.array_distinct("secondary_venue_ids").alias("_venues"))
    # outer: below an inner explode Spark filters by the list's size, which makes the list (from a document, its parse)
    # over again; the row without a venue goes before the shuffle
    return once.select("*", F.explode_outer("_venues").alias("venue_id")).drop("_venues").where(F.col("venue_id").isNotNull())


SALT_CONF = "venue_analytics.venueJoinSalt"
#: heaviest venues the sketch reports, and items it tracks on the way (a sketch of a task is no larger)
SKETCH_TOP, SKETCH_TRACKED = 64, 8192
#: a venue is hot from so many times the average partition's rows on
HOT_FACTOR = 2


def salt_mode(spark: SparkSession, given: str | int | None = None) -> str | int:
    """How the venue join meets hot venues: 'sketch', or a salt for every venue (1: none).

    ``given``, else the session conf ``venue_analytics.venueJoinSalt``: a positive whole number, 'sketch', or
    'auto' (default). 'auto' leaves hot venues to AQE's skew-join split, and takes the sketch where the
    session has that switched off."""
    mode = str(given if given is not None else spark.conf.get(SALT_CONF, "auto"))
    if mode == "auto":
        aqe = all(spark.conf.get(f"spark.sql.adaptive.{k}", "true").lower() == "true" for k in ("enabled", "skewJoin.enabled"))
        return 1 if aqe else "sketch"
    if mode != "sketch" and (not mode.isdigit() or int(mode) < 1):
        raise ValueError(f"{SALT_CONF} must be 'auto', 'sketch' or at least 1")
    return mode if mode == "sketch" else int(mode)


def hot_venues(post_side: DataFrame, factor: float = HOT_FACTOR) -> dict[str, int]:
    """Venues that hold more than ``factor`` times the average shuffle partition's rows of ``post_side``, each with
    the number of such partitions that its rows fill.

    A heavy-hitter sketch per task, merged: one pass over the venue ids, of which the driver gets at most
    SKETCH_TOP. The sketch estimates; it only decides which venues are spread, never what is counted."""
    seen = post_side.where(F.col("venue_id").isNotNull()).agg(
        F.call_function("approx_top_k", F.col("venue_id"), F.lit(SKETCH_TOP), F.lit(SKETCH_TRACKED)).alias("top"), F.count(F.lit(1)).alias("n")).first()
    share = max(seen["n"] / int(post_side.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1.0)
    return {r["item"]: math.ceil(r["count"] / share) for r in seen["top"] or [] if r["count"] > factor * share}


def salted_venue_join(post_side: DataFrame, place_side: DataFrame, salt: str | int, salt_key: str) -> DataFrame:
    """Inner join on venue_id. With a salt of one it is plain. With a larger one every post row gets a salt
    from a hash of its ``salt_key`` (deterministic, so a retried task produces the same rows), each
    place-venue row is repeated once per salt value, and the join runs on (venue_id, salt). With 'sketch'
    only the venues of ``hot_venues`` are spread so, each over as many partitions as its rows fill, and only
    their place rows are repeated. Every (post, place) pair meets exactly once."""
    if salt == "sketch":
        hot = hot_venues(post_side)
        if not hot:
            return post_side.join(place_side, "venue_id", "inner")
        of = F.create_map(*[F.lit(x) for pair in sorted(hot.items()) for x in pair])
        spread = F.when(F.col("venue_id").isin(*sorted(hot)), F.element_at(of, F.col("venue_id"))).otherwise(F.lit(1))
    elif salt <= 1:
        return post_side.join(place_side, "venue_id", "inner")
    else:
        spread = F.lit(salt)
    p = post_side.withColumn("_salt", F.pmod(F.xxhash64(F.col(salt_key)), spread.cast("long")))
    v = place_side.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), spread.cast("long") - 1)))
    return p.join(v, ["venue_id", "_salt"], "inner").drop("_salt")


def match_place_posts(places: DataFrame, posts: DataFrame, month: str | None, post_cols,
                      extra_filter=None, salt: str | int | None = None) -> DataFrame:
    """Venue equi-join of (active) places and month posts; one row per matching venue pair,
    so a post listing several venues of one place appears several times (dedupe follows)."""
    pv = place_venues(places)
    salt = salt_mode(posts.sparkSession, salt)
    added = salt != 1 and "post_id" not in [c for c in post_cols if isinstance(c, str)]
    cols = list(post_cols) + (["post_id"] if added else [])
    joined = salted_venue_join(post_venues(posts, month, cols, extra_filter), pv, salt, "post_id")
    return joined.drop("post_id") if added else joined


#: tasks in which rows are dealt by poster, in shuffle partitions of the session: each keeps its distinct posters in memory
POSTER_TASKS = 16


def dealt_by(df: DataFrame, *cols: str, tasks: int = POSTER_TASKS) -> DataFrame:
    """``df`` dealt by ``cols`` to ``tasks`` times the session's shuffle partitions."""
    return df.repartition(tasks * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def place_posts(t: Tables, month: str | None, keys, post_cols=None, as_of=None,
                drop_own: bool = True, extra_filter=None, places: DataFrame | None = None) -> DataFrame:
    """Distinct ``keys`` rows of the place/post match for the month, own posts removed.

    ``keys`` may name place columns (merchant_id, place_id, place_name) and post columns
    (post_id, source, post_month, day, hour, kind, poster_id, text, text_digest, text_chars, value)."""
    if t.matches is not None:
        if month != t.matches_month:
            raise ValueError(f"shared matches are for {t.matches_month!r}, not {month!r}")
        m = t.matches
        if extra_filter is not None:
            m = m.filter(extra_filter)
        if drop_own:
            m = m.filter(~F.col("_own"))
        if places is not None:
            m = m.join(places.select("place_id").distinct(), "place_id", "left_semi")
        return m.select(*[F.col(k) if k in m.columns or k not in _DERIVED else _DERIVED[k]().alias(k) for k in keys]).distinct()
    post_side = [k for k in keys if k in _DERIVED]
    if post_cols:
        post_side += [c for c in post_cols if c not in post_side]
    if drop_own and "poster_id" not in post_side:
        post_side.append("poster_id")
    act = places if places is not None else active_places(t.places, t.merchants, as_of)
    m = match_place_posts(act, t.posts, month, post_side, extra_filter, t.venue_salt)
    if drop_own:
        own = ["merchant_id", "poster_id"]
        if set(own) <= set(keys):
            # the distinct rows are kept where the accounts are met, without a further shuffle; Spark would move an anti
            # join below the dealing, to fewer tasks
            accounts = t.own_accounts().withColumn("_own", F.lit(True))
            m = dealt_by(m, *own).join(accounts, own, "left").where(F.col("_own").isNull())
        else:
            m = m.join(t.own_accounts(), own, "left_anti")
    return m.select(*keys).distinct()


RAW_POST_COLUMNS = ["id", "post_time", "kind", "poster_id", "rating"]


def match_table(t: Tables, month: str | None, as_of=None, with_text: bool = False) -> DataFrame:
    """The place/post venue match of a month, once for all reports of a run: raw post columns
    (``id, post_time, kind, poster_id, rating`` and, with ``with_text``, ``text_digest`` and ``text_chars``), the place columns
    (``merchant_id, place_id, place_name``) and ``_own`` (the poster is one of the merchant's own
    accounts). One row per matching (post, place); the reports derive and dedupe their keys."""
    act = active_places(t.places, t.merchants, as_of)
    cols = [c for c in RAW_POST_COLUMNS if c in t.posts.columns] + ([text_digest().alias("text_digest"), F.length("text").alias("text_chars")] if with_text else [])
    pv = (t.posts.filter(month_pred(t.posts, "post_time", month))
          .select(*cols, F.explode(F.array_distinct("secondary_venue_ids")).alias("venue_id")))
    # no distinct here: the rare repeat of a (post, place) pair is removed by each report's dedupe,
    # and a distinct would shuffle every post once more
    m = salted_venue_join(pv, place_venues(act), salt_mode(t.posts.sparkSession, t.venue_salt), "id").drop("venue_id")
    own = t.own_accounts().distinct().withColumn("_own", F.lit(True))
    return (m.join(own, ["merchant_id", "poster_id"], "left")
            .withColumn("_own", F.coalesce(F.col("_own"), F.lit(False))))


def own_place_posts(t: Tables, month: str | None, as_of=None) -> DataFrame:
    """The place-post rows the own-post rule removes: (merchant_id, place_name, post_id, poster_id)."""
    act = active_places(t.places, t.merchants, as_of)
    m = match_place_posts(act, t.posts, month, ["post_id", "poster_id"], salt=t.venue_salt)
    return (m.join(t.own_accounts(), ["merchant_id", "poster_id"], "left_semi")
            .select("merchant_id", "place_name", "post_id", "poster_id").distinct())


def distinct_count(df: DataFrame, group_cols, out: str = "n") -> DataFrame:
    """COUNT of (already distinct) rows per group. Nulls in non-group columns count like values."""
    return df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias(out))
