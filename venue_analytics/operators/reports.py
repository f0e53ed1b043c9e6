"""The seven monthly reports. Each has a long form (one row per count, the core result) and a map
form (``*_map``) that folds the long rows into the zero-filled nested maps of the original output.

``month`` is a label such as '2015Jan'; ``None`` runs every month at once, grouped by month (a
back-fill: the same rows as running each month separately).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venue_analytics.functions.columns import day_str, hour_str, month_pred, month_str, source_of, time_diff
from venue_analytics.functions.text import keyword_words
from venue_analytics.operators.core import Tables, dealt_by, distinct_count, match_table, place_posts, text_digest
from venue_analytics.operators.counts import fold_map, fold_nested_map
from venue_analytics.sources.schemas import (
    AUDIT_TYPES, INTERACTION_TYPES, KINDS, RATINGS, REVIEW_SOURCES, SEGMENT_KEYS, SOURCES,
)

PLACE_MONTH = ["merchant_id", "place_name", "post_month"]


def with_group_total(long_df: DataFrame, group_cols, n_col: str = "n", out: str = "total") -> DataFrame:
    """Attach the per-group sum of ``n`` to every long row. The input is already aggregated (at
    most sources x kinds rows per group), so the window's shuffle is small and cannot be skewed
    by a hot group; the long rows are not recomputed as a self-join would do."""
    w = Window.partitionBy(*group_cols)
    return long_df.withColumn(out, F.sum(n_col).over(w).cast("long"))


# ------------------------------------------------------------------------ R1, R2, R6, R7 at once
#: reports that count distinct posts or posters of the match
COUNT_REPORTS = ("content", "reviews", "posters", "segments")
#: the keys that the counts of every report are grouped by; ``place`` is an id or a name, ``time`` a month or a day, ``what`` a kind or a value
_COUNTED = ["report", "merchant_id", "place", "time", "hour", "source", "what"]
#: tasks that the distinct posts (or posters) of one count are dealt to
KEY_BUCKETS = 8
#: a row of one type, with nulls, for every report: unpivoted columns take the type of the first
_ROW = "struct<merchant_id: string, place: string, time: string, hour: string, source: string, what: string, key: string>"


def count_reports(t: Tables, month: str | None = None, as_of=None) -> DataFrame:
    """(report, merchant_id, place_id, place_name, post_month, day, hour, source, kind, value, n): the counts of
    COUNT_REPORTS from one pass over the place/post match; columns that a report doesn't count by are null.

    A row of the match becomes one row for each report that it counts in, and the distinct posts (or posters) of all
    reports are kept in one aggregation, where a report by itself takes a distinct and a count over a shuffle of
    the match; then one count serves all. The rows of all reports are of one struct, which is hashed and moved as a
    whole; a row that doesn't count in a report (own posts, no review) is left out before the shuffle. They are
    dealt to many tasks, so that each keeps its distinct rows in memory."""
    m = t.matches if t.matches is not None else match_table(t, month, as_of)
    if t.matches is not None and month != t.matches_month:
        raise ValueError(f"shared matches are for {t.matches_month!r}, not {month!r}")
    review = (F.col("kind") == "review") & F.col("id").startswith("FB")
    value = F.col("rating.value").cast("string") if "rating" in m.columns else F.lit(None).cast("string")
    hits = m.withColumns({"_month": month_str("post_time"), "_day": day_str("post_time"), "_source": source_of("id")})
    none = F.lit(None).cast("string")

    def row(place, time, hour, what, key):
        return F.struct("merchant_id", place, time, hour, "_source", what, key).cast(_ROW)
    rows = {"content": F.when(~F.col("_own"), row("place_name", F.col("_month"), none, F.col("kind"), "id")),
            "reviews": F.when(~F.col("_own") & review, row("place_name", F.col("_month"), none, value, "id")),
            "posters": F.when(~F.col("_own"), row("place_name", F.col("_month"), none, none, "poster_id")),
            "segments": row("place_id", F.concat("_month", "_day"), hour_str("post_time"), none, "id")}
    seen = hits.select(*[r.alias(name) for name, r in rows.items()]).unpivot([], list(rows), "report", "row").where(F.col("row").isNotNull())
    # rows that are counted together meet in a few tasks before the count's shuffle, those of a hot group in KEY_BUCKETS
    counted = F.xxhash64("report", *[f"row.{c}" for c in ("merchant_id", "place", "time", "source", "what")], F.pmod(F.xxhash64("row.key"), F.lit(KEY_BUCKETS)))
    seen = dealt_by(seen.withColumn("cell", counted), "cell").distinct().select("report", "row.*")
    # a place-post counts in its hour and in 'total'
    hours = F.when(F.col("report") == "segments", F.array(F.col("hour"), F.lit("total"))).otherwise(F.array(F.col("hour")))
    counts = distinct_count(seen.withColumn("hour", F.explode(hours)), _COUNTED)
    segment, kinds = F.col("report") == "segments", F.col("report") == "content"
    return counts.select("report", "merchant_id", F.when(segment, F.col("place")).alias("place_id"), F.when(~segment, F.col("place")).alias("place_name"),
                         F.when(segment, F.substring("time", F.lit(1), F.length("time") - 2)).otherwise(F.col("time")).alias("post_month"),
                         F.when(segment, F.substring("time", -2, 2)).alias("day"), "hour", "source",
                         F.when(kinds, F.col("what")).alias("kind"), F.when(F.col("report") == "reviews", F.col("what")).alias("value"), "n")


def _shared_counts(t: Tables, report: str, month: str | None, columns: list[str]) -> DataFrame:
    """A report's rows of the counts shared by a run."""
    if month != t.matches_month:
        raise ValueError(f"shared counts are for {t.matches_month!r}, not {month!r}")
    return t.counts.where(F.col("report") == report).select(*columns, "n")


# --------------------------------------------------------------------------------------- R1
def content_counts(t: Tables, month: str | None = None, as_of=None) -> DataFrame:
    """(merchant_id, place_name, post_month, source, kind, n): distinct place-posts per kind."""
    if t.counts is not None:
        return _shared_counts(t, "content", month, PLACE_MONTH + ["source", "kind"])
    pp = place_posts(t, month, ["merchant_id", "place_name", "post_id", "post_month", "source", "kind"],
                     as_of=as_of)
    return distinct_count(pp, PLACE_MONTH + ["source", "kind"])


def content_types(t: Tables, month: str | None = None, as_of=None) -> DataFrame:
    """(merchant_id, place_name, post_month, source, kind, n, total): distinct place-posts per
    kind and source; ``total`` covers every kind of the place-month (kept when > 0)."""
    return with_group_total(content_counts(t, month, as_of), PLACE_MONTH).filter(F.col("total") > 0)


def content_types_map(t: Tables, month: str | None = None, as_of=None) -> DataFrame:
    """(merchant_id, place_name, post_month, counts{source->{kind->n}}, total)."""
    return (fold_nested_map(content_counts(t, month, as_of), PLACE_MONTH, "source", "kind", "n", SOURCES, KINDS,
                            total="total")
            .filter(F.col("total") > 0))


# --------------------------------------------------------------------------------------- R2
def reviews(t: Tables, month: str | None = None, as_of=None) -> DataFrame:
    """(merchant_id, place_name, month, source, value, n): FB reviews per raw rating value."""
    if t.counts is not None:
        return _shared_counts(t, "reviews", month, PLACE_MONTH + ["source", "value"]).withColumnRenamed("post_month", "month")
    is_review = (F.col("kind") == "review") & F.col("id").startswith("FB")
    pp = place_posts(t, month, ["merchant_id", "place_name", "post_month", "source", "post_id", "value"],
                     as_of=as_of, extra_filter=is_review)
    return (distinct_count(pp, ["merchant_id", "place_name", "post_month", "source", "value"])
            .withColumnRenamed("post_month", "month"))


def reviews_map(t: Tables, month: str | None = None, as_of=None) -> DataFrame:
    """(merchant_id, place_name, month, counts{'FB'->{rating->n}})."""
    return fold_nested_map(reviews(t, month, as_of), ["merchant_id", "place_name", "month"],
                           "source", "value", "n", REVIEW_SOURCES, RATINGS)


# --------------------------------------------------------------------------------------- R3
def _has_text():
    return F.col("text").isNotNull() & (F.col("text") != "")


def text_words(t: Tables, month: str | None = None, stops=None) -> DataFrame:
    """(text_digest, words): the keyword tokens, joined by blanks, of every distinct text of the month's posts
    that has any.

    The words follow from the text, so grouping by both keeps one row per text without an aggregate over
    the words: copies of a text collapse in their task, and its words are shuffled once."""
    posts = t.posts.filter(month_pred(t.posts, "post_time", month)).filter(_has_text())
    words = F.array_join(keyword_words("text", stops), " ")  # tokens hold no blank: it is a delimiter
    return posts.select(text_digest().alias("text_digest"), words.alias("words")).filter(F.col("words") != "").distinct()


#: characters of text of a place-month from which its words are dealt to several tasks
GROUP_CHARS = 16_000_000
#: tasks that count tokens, in shuffle partitions of the session: a text holds many tokens
TOKEN_TASKS = 4


def dealt_tokens(said: DataFrame, text: DataFrame, group_chars: int = GROUP_CHARS) -> DataFrame:
    """(PLACE_MONTH, _group, source, word): the tokens of the texts ``said`` at places, those of one word of a
    place-month in one task. ``said`` has text_digest and text_chars, ``text`` is of ``text_words``.

    Whole texts are shuffled to their place-months and split there, so no token is shuffled with its keys, and what
    follows by (PLACE_MONTH, _group) needs no further shuffle. A place-month with much text is dealt, by the hash of
    the word, to groups of about ``group_chars`` characters."""
    said = said.where(F.col("text_digest").isNotNull())  # as the join infers it, so both uses read one exchange
    sizes = said.groupBy(*PLACE_MONTH).agg(F.sum("text_chars").alias("_chars")).where(F.col("_chars") > group_chars)
    large = sizes.select(*[F.col(c).alias(f"_{c}") for c in PLACE_MONTH], F.ceil(F.col("_chars") / group_chars).cast("long").alias("_groups"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PLACE_MONTH]
    groups = said.join(large, same[0] & same[1] & same[2], "left").withColumn("_groups", F.coalesce("_groups", F.lit(1).cast("long")))
    mine = F.filter(F.split("words", " "), lambda w: F.pmod(F.xxhash64(w), F.col("_groups")) == F.col("_group"))
    spread = (groups.join(text, "text_digest").withColumn("_group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_groups") - 1)))
              .withColumn("words", F.when(F.col("_groups") == 1, F.col("words")).otherwise(F.array_join(mine, " "))).where("words != ''"))
    tasks = TOKEN_TASKS * int(said.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (spread.select(*PLACE_MONTH, "_group", "source", "words").repartition(tasks, *PLACE_MONTH, "_group")
            .select(*PLACE_MONTH, "_group", "source", F.explode(F.split("words", " ")).alias("word")))


def _grouped_counts(t: Tables, month: str | None = None, as_of=None, stops=None, words: DataFrame | None = None) -> DataFrame:
    """``keyword_counts`` with the group of each word (see ``dealt_tokens``)."""
    has_text = _has_text() if t.matches is None else F.col("text_digest").isNotNull()
    said = place_posts(t, month, ["merchant_id", "place_name", "post_month", "source", "text_digest", "text_chars"],
                       as_of=as_of, extra_filter=has_text)
    tokens = dealt_tokens(said, text_words(t, month, stops))
    if words is not None:
        tokens = tokens.join(words.select("merchant_id", "word"), ["merchant_id", "word"], "left_semi")
    return distinct_count(tokens, PLACE_MONTH + ["_group", "source", "word"])


def keyword_counts(t: Tables, month: str | None = None, as_of=None, stops=None,
                   words: DataFrame | None = None) -> DataFrame:
    """(merchant_id, place_name, post_month, source, word, n) before the total filter.

    Distinct texts per place-month-source (two posts with one text count once, told by SHA-256), then the
    keyword tokens of each distinct text, counted where the place-month's texts meet. The deduplication is
    factorised: the match carries digests alone, the words of a text are made apart from it
    (``text_words``) and meet its places after both are distinct.
    ``words`` (merchant_id, word) keeps only those words, before counting: a word's counts and
    total depend only on its own tokens, so the result is the restriction of the full report."""
    return _grouped_counts(t, month, as_of, stops, words).drop("_group")


def keywords(t: Tables, month: str | None = None, as_of=None, stops=None, min_total: int = 2,
             words: DataFrame | None = None) -> DataFrame:
    """(merchant_id, place_name, post_month, word, source, n, total) for words whose total over
    sources is > 1 (optionally only the merchant's ``words``, see ``keyword_counts``)."""
    long_df = _grouped_counts(t, month, as_of, stops, words)
    return (with_group_total(long_df, PLACE_MONTH + ["_group", "word"])
            .filter(F.col("total") >= min_total)
            .select(*PLACE_MONTH, "word", "source", "n", "total"))


def keywords_map(t: Tables, month: str | None = None, as_of=None, stops=None, min_total: int = 2) -> DataFrame:
    """(merchant_id, place_name, post_month, word, counts{source->n}, total), total > 1. Few words reach the
    total, so it is filtered before the fold."""
    return fold_map(keywords(t, month, as_of, stops, min_total), PLACE_MONTH + ["word"], "source", "n", SOURCES, total="total")


# --------------------------------------------------------------------------------------- R4
def _audits(audits: DataFrame, month: str | None, types) -> DataFrame:
    return (audits
            .filter(F.col("type").isin(list(types)) & month_pred(audits, "created_at", month))
            .select("type", "merchant_id", month_str("created_at").alias("month"),
                    F.col("actor.label").alias("user"), F.col("subject.origin_id").alias("post_id")))


def int_rows(t: Tables, month: str | None = None) -> DataFrame:
    """The synthetic 'int' audits: one row per (merchant, month, user, post) liked or replied to."""
    a = _audits(t.audits, month, AUDIT_TYPES).withColumn("source", source_of("post_id")).distinct()
    return (a.filter(F.col("type").isin("like", "reply")).withColumn("type", F.lit("int")).distinct()
            .select("type", "merchant_id", "month", "user", "post_id", "source"))


def interaction_parts(t: Tables, month: str | None = None, as_of=None, same_month: bool = True):
    """The pieces of the interactions report: (interactions + 'int' rows matched to places,
    follows attributed to places). Both are (type, user, source, month, place_name, merchant_id).

    ``same_month``: a post counts only for audits of its own month (what running one month does).
    With ``month=None`` and ``same_month=False`` audits of any month meet posts of any month.

    This is the literal union/join form, kept for drill-downs that need the unaggregated rows; it
    references the matched rows twice. The report itself is ``interactions`` (one linear plan)."""
    pp = place_posts(t, month, ["place_name", "post_id", "merchant_id", "post_month"], as_of=as_of)
    a = (_audits(t.audits, month, AUDIT_TYPES)
         .withColumn("source", source_of("post_id"))
         .distinct())
    follows = a.filter(F.col("type") == "follow")
    inter = a.filter(F.col("type").isin("like", "reply", "tag"))
    uniq = (inter.filter(F.col("type").isin("like", "reply"))
            .withColumn("type", F.lit("int")).distinct())
    int_all = inter.unionByName(uniq)
    keys = ["post_id", "merchant_id"]
    if same_month:
        pp = pp.withColumnRenamed("post_month", "month")
        keys.append("month")
    matched = (int_all.join(pp.drop("post_month") if not same_month else pp, keys, "inner")
               .select("type", "user", "source", "month", "place_name", "merchant_id"))
    places_users = matched.select("user", "place_name", "merchant_id", "month").distinct()
    follows_placed = (follows.drop("post_id")
                      .join(places_users, ["user", "merchant_id", "month"], "inner")
                      .select("type", "user", "source", "month", "place_name", "merchant_id"))
    return matched, follows_placed


def interactions(t: Tables, month: str | None = None, as_of=None, same_month: bool = True) -> DataFrame:
    """(merchant_id, place_name, month, user, source, type, n).

    Steps:

    1. audits of the month (like/reply/tag) -> one row per (merchant, month, user, post, source)
       with a 0/1 flag per type (partial aggregation with plain max aggregates);
    2. join with the distinct place-posts on (post_id, merchant_id) -> explode the types plus
       'int' when the post was liked or replied to -> count per place;
    3. follows (own scan, type pushed to the source) -> distinct posts counted per
       (merchant, month, user, source);
    4. the follow counts are joined with the distinct places at which the user interacted (equality on
       merchant, month and user, so a follow without a user has no place; a place without a name
       keeps its follows). No list of places is built; the join's skewed partitions can be split.
    """
    pp = place_posts(t, month, ["place_name", "post_id", "merchant_id", "post_month"], as_of=as_of)
    # one row per (merchant, month, user, post, source) with a flag per audit type: plain max
    # aggregates (codegen hash aggregation) instead of collecting a set of types
    flags = {ty: F.max((F.col("type") == ty).cast("int")).alias("_" + ty) for ty in ("like", "reply", "tag")}
    per_post = (_audits(t.audits, month, ["like", "reply", "tag"])
                .withColumn("source", source_of("post_id"))
                .groupBy("merchant_id", "month", "user", "post_id", "source")
                .agg(*flags.values()))
    keys = ["post_id", "merchant_id"]
    if same_month:
        pp = pp.withColumnRenamed("post_month", "month")
        keys.append("month")
    else:
        pp = pp.drop("post_month")
    liked_or_replied = (F.col("_like") == 1) | (F.col("_reply") == 1)
    with_int = F.array_compact(F.array(*[F.when(F.col("_" + ty) == 1, F.lit(ty)) for ty in ("like", "reply", "tag")],
                                       F.when(liked_or_replied, F.lit("int"))))
    group = ["merchant_id", "place_name", "month", "user", "source", "type"]
    counted = distinct_count(per_post.join(pp, keys, "inner")
                             .select("merchant_id", "place_name", "month", "user", "source",
                                     F.explode(with_int).alias("type")), group)
    follows = (_audits(t.audits, month, ["follow"])
               .select("merchant_id", "month", "user", "post_id", source_of("post_id").alias("source"))
               .distinct()
               .groupBy("merchant_id", "month", "user", "source").agg(F.count(F.lit(1)).alias("n")))
    # the places a user interacted at; n stays in the plan so that both uses of ``counted`` read one exchange
    at = (counted.groupBy("merchant_id", "month", "user", "place_name").agg(F.max("n").alias("_most"))
          .where("_most > 0").drop("_most"))
    placed = follows.join(at, ["merchant_id", "month", "user"]).withColumn("type", F.lit("follow"))
    return counted.select(*group, "n").unionByName(placed.select(*group, "n"))


def interactions_map(t: Tables, month: str | None = None, as_of=None, same_month: bool = True) -> DataFrame:
    """(merchant_id, place_name, month, user, counts{source->{type->n}})."""
    return fold_nested_map(interactions(t, month, as_of, same_month),
                           ["merchant_id", "place_name", "month", "user"], "source", "type", "n",
                           SOURCES, INTERACTION_TYPES)


# --------------------------------------------------------------------------------------- R5
def response_times(t: Tables, month: str | None = None, wrap_days: bool = False) -> DataFrame:
    """(merchant_id, month, user, average): per user, the mean over posts of the first response
    time (seconds from post to audit). Only the audit month is filtered; no venue/merchant check.
    ``wrap_days=True`` reproduces the original helper's day-wrapped seconds.

    The original de-duplicates the audits first; an exact duplicate cannot change a per-post
    minimum, so that step is left out. This saves a shuffle, and the join's audit side stays a
    filtered scan, from which Spark can build a runtime bloom filter for the large posts scan."""
    a = (t.audits
         .filter(F.col("type").isin(AUDIT_TYPES) & month_pred(t.audits, "created_at", month))
         .select("created_at", month_str("created_at").alias("month"),
                 F.col("actor.label").alias("user"), F.col("subject.origin_id").alias("post_id"),
                 "merchant_id"))
    p = t.posts.select(F.col("id").alias("post_id"), "post_time")
    j = a.join(p, "post_id", "inner")
    per_post = (j.groupBy("merchant_id", "user", "month", "post_id")
                .agg(F.min(time_diff("post_time", "created_at", wrap_days)).alias("min_response_time")))
    return (per_post.groupBy("merchant_id", "month", "user")
            .agg(F.avg("min_response_time").alias("average")))


# --------------------------------------------------------------------------------------- R6
def poster_counts(t: Tables, month: str | None = None, as_of=None) -> DataFrame:
    """(merchant_id, place_name, post_month, source, n): distinct posters per source; a missing
    poster id counts as one poster (DISTINCT then COUNT, not count(distinct))."""
    if t.counts is not None:
        return _shared_counts(t, "posters", month, PLACE_MONTH + ["source"])
    pp = place_posts(t, month, ["merchant_id", "place_name", "post_month", "source", "poster_id"], as_of=as_of)
    return distinct_count(pp, PLACE_MONTH + ["source"])


def posters(t: Tables, month: str | None = None, as_of=None) -> DataFrame:
    """(merchant_id, place_name, post_month, source, n, total); ``total`` over sources, > 0."""
    return with_group_total(poster_counts(t, month, as_of), PLACE_MONTH).filter(F.col("total") > 0)


def posters_map(t: Tables, month: str | None = None, as_of=None) -> DataFrame:
    """(merchant_id, place_name, post_month, counts{source->n}, total)."""
    return (fold_map(poster_counts(t, month, as_of), PLACE_MONTH, "source", "n", SOURCES, total="total")
            .filter(F.col("total") > 0))


# --------------------------------------------------------------------------------------- R7
SEGMENT_GROUP = ["merchant_id", "place_id", "month", "day"]


def segments(t: Tables, month: str | None = None, as_of=None) -> DataFrame:
    """(merchant_id, place_id, month, day, metric='PC', hour, source, n) with hour '00'..'23' and
    'total' rows (sum over the hours). Own posts are kept; grouped by place id."""
    if t.counts is not None:
        shared = _shared_counts(t, "segments", month, ["merchant_id", "place_id", "post_month", "day", "hour", "source"])
        return shared.select("merchant_id", "place_id", F.col("post_month").alias("month"), "day", F.lit("PC").alias("metric"), "hour", "source", "n")
    pp = (place_posts(t, month, ["merchant_id", "place_id", "post_id", "post_month", "day", "hour", "source"],
                      as_of=as_of, drop_own=False)
          .withColumnRenamed("post_month", "month"))
    # each distinct place-post counts in its hour and in 'total': one aggregation, no second branch
    both = pp.select(*SEGMENT_GROUP, "source", F.explode(F.array(F.col("hour"), F.lit("total"))).alias("hour"))
    return (distinct_count(both, SEGMENT_GROUP + ["hour", "source"])
            .select(*SEGMENT_GROUP, F.lit("PC").alias("metric"), "hour", "source", "n"))


def segments_map(t: Tables, month: str | None = None, as_of=None) -> DataFrame:
    """(merchant_id, place_id, month, day, metric, counts{hour|'total'->{source->n}})."""
    return fold_nested_map(segments(t, month, as_of), SEGMENT_GROUP + ["metric"], "hour", "source", "n",
                           SEGMENT_KEYS, SOURCES)


REPORTS = {
    "content": content_types_map,
    "reviews": reviews_map,
    "keywords": keywords_map,
    "interactions": interactions_map,
    "response_times": response_times,
    "posters": posters_map,
    "segments": segments_map,
}
LONG_REPORTS = {
    "content": content_types, "reviews": reviews, "keywords": keywords,
    "interactions": interactions, "response_times": response_times,
    "posters": posters, "segments": segments,
}
