"""Keyword tokens are counted where the texts of a place-month meet, large place-months in groups of words."""

import datetime as dt
import re

from pyspark.sql import functions as F

from conftest import make_tables
from venue_analytics.operators import reports as R

D = dt.datetime
AS = D(2015, 6, 1)


def tables(spark):
    places = [("P1", "Mill", "M1", ["V1"]), ("P2", None, "M1", ["V2"])]
    said = ["cat dog foo,bar foo", "cat zebra", "dog dog,zebra cat", None, "", "lone", "foo,bar foo"]
    posts = [(f"{'FB' if i % 2 else 'TW'}-{i}", D(2015, 1, 1 + i), ["V1", "V2"], "photo", text, None, None, None) for i, text in enumerate(said)]
    return make_tables(spark, posts, places, [("M1", "m", (D(2030, 1, 1),), None)], [])


def test_tokens_are_not_shuffled_and_rare_words_not_folded(spark):
    t = tables(spark)
    plan = R.keywords(t, "2015Jan", AS)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\([^)]*word#", plan)
    folded = R.keywords_map(t, "2015Jan", AS)._jdf.queryExecution().optimizedPlan().toString()
    assert folded.index("collect_list") < folded.index("total#")  # the filter stands below the fold
    assert {r.total for r in R.keywords_map(t, "2015Jan", AS).collect()} >= {2} and not R.keywords_map(t, "2015Jan", AS).where("total < 2").count()


def test_groups_of_words_keep_every_token(spark):
    t = tables(spark)
    said = R.place_posts(t, "2015Jan", ["merchant_id", "place_name", "post_month", "source", "text_digest", "text_chars"], as_of=AS)
    text = R.text_words(t, "2015Jan")
    whole, dealt = R.dealt_tokens(said, text), R.dealt_tokens(said, text, group_chars=5)
    assert dealt.select("_group").distinct().count() > 1 and whole.select("_group").distinct().count() == 1
    rows = [sorted(map(str, x.drop("_group").collect())) for x in (whole, dealt)]
    assert rows[0] == rows[1] and any("place_name=None" in r for r in rows[0])
    # the tokens of a word of a place-month have one group
    assert not dealt.groupBy(*R.PLACE_MONTH, "word").agg(F.count_distinct("_group").alias("n")).where("n > 1").count()
