"""Factorised keyword dedupe, sketch-salted venue join, bucketed posts, published months, shared counts, document
exports and the run journal."""

import dataclasses
import datetime as dt
import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, base_rows, make_tables
from test_brute_force import AS_OF as AS, MONTHS, random_tables
from test_skew import skewed_session  # noqa: F401  (fixture)
from venue_analytics.operators import bitmaps, core, reports as R
from venue_analytics.plans import jobs
from venue_analytics.sources import sinks
from venue_analytics.sources.exports import from_documents
from venue_analytics.sources.readers import open_bucketed, read_table, read_tables, write_bucketed

D = dt.datetime


def rows_of(df):
    return sorted(map(str, df.collect()))


def new_name():
    return f"t_{uuid.uuid4().hex}"


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


# ------------------------------------------------------------------------------ keywords
def test_keywords_shuffle_no_arrays_and_each_text_once(skewed_session):  # noqa: F811
    spark = skewed_session
    hot = "cat dog cat-dog zebra zebra,zebra"
    places = [(f"P{i}", f"Place {i}", "M1", [f"V{i}"]) for i in range(12)]
    posts = [(f"FB-{i}", D(2015, 1, 1 + i % 28), [f"V{i % 12}"], "photo", hot if i % 3 == 0 else f"word{i % 500} here and there{i % 7}", None, None, None)
             for i in range(3000)]  # a third of the posts say one text
    t = make_tables(spark, posts, places, [("M1", "m", (D(2030, 1, 1),), None)], [])
    df = R.keywords(t, "2015Jan", D(2015, 6, 1))
    plan = final_plan(df)
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    got = {(r.place_name, r.word): r.n for r in df.collect()}
    assert got[("Place 0", "zebra")] == 3 and ("Place 0", "cat") not in got  # one text, however often it is said
    words = R.text_words(t, "2015Jan")
    assert words.count() == words.select("text_digest").distinct().count() == len({p[4] for p in posts})


@pytest.mark.parametrize("seed", [11, 12])
def test_keywords_of_shared_matches_read_digests_alone(spark, seed):
    t = make_tables(spark, *random_tables(seed))
    for month in MONTHS:
        shared = jobs.share_matches(spark, t, month, AS, with_text=True)
        assert "text" not in shared.matches.columns
        assert rows_of(R.keywords(shared, month, AS)) == rows_of(R.keywords(t, month, AS))


# ------------------------------------------------------------------------------ hot venues
OFF = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16",
       "spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture()
def no_skew_handling(spark):
    old = {k: spark.conf.get(k, None) for k in OFF}
    for k, v in OFF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_table(spark):
    places = [(f"P{i}", f"Place {i}", "M1", [f"V{i}", f"W{i}"]) for i in range(200)]
    posts = [(f"FB-{i}", D(2015, 1, 1 + i % 28), ["V0" if i % 3 == 0 else f"V{1 + i % 199}"], "photo", None, f"FB-u{i % 9}", None, None) for i in range(9000)]
    return make_tables(spark, posts, places, [("M1", "m", (D(2030, 1, 1),), None)], [])


def test_sketch_splits_a_hot_venue_without_aqe_or_settings(no_skew_handling):
    spark = no_skew_handling
    t = hot_table(spark)
    assert core.salt_mode(spark) == "sketch"
    posts, places = core.post_venues(t.posts, "2015Jan", ["post_id"]), core.place_venues(core.active_places(t.places, t.merchants, AS_OF))
    hot = core.hot_venues(posts)
    assert set(hot) == {"V0"} and 4 <= hot["V0"] <= 7  # 3,000 rows of 9,000 over 16 partitions
    joined = core.salted_venue_join(posts, places, "sketch", "post_id")
    parts = joined.withColumn("part", F.spark_partition_id()).groupBy("venue_id").agg(F.countDistinct("part").alias("p"), F.count("*").alias("n")).collect()
    by = {r.venue_id: (r.p, r.n) for r in parts}
    assert by["V0"][0] >= 3 and by["V0"][1] == 3000
    assert all(p == 1 for v, (p, _) in by.items() if v != "V0")
    assert rows_of(joined) == rows_of(core.salted_venue_join(posts, places, 1, "post_id"))
    # the place side is repeated for the hot venue alone
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    assert rows_of(R.content_types(t, "2015Jan", AS_OF)) == rows_of(R.content_types(dataclasses.replace(t, venue_salt=1), "2015Jan", AS_OF))


def test_salt_modes(spark):
    assert core.salt_mode(spark) == 1 and core.salt_mode(spark, "sketch") == "sketch" and core.salt_mode(spark, 4) == 4
    for wrong in ("0", "-1", "much", "1.5"):
        with pytest.raises(ValueError):
            core.salt_mode(spark, wrong)
    assert core.hot_venues(spark.createDataFrame([(None,)], "venue_id string")) == {}
    t = make_tables(spark, *random_tables(3))
    for name, fn in R.LONG_REPORTS.items():
        if name != "response_times":
            salted = fn(dataclasses.replace(t, venue_salt="sketch"), None, AS)
            assert rows_of(salted) == rows_of(fn(t, None, AS)), name


# ------------------------------------------------------------------------------ buckets
def test_response_times_do_not_shuffle_bucketed_posts(no_skew_handling):
    spark = no_skew_handling
    t = make_tables(spark, *random_tables(5))
    d, name = tempfile.mkdtemp(prefix="va-buckets-"), new_name()
    laid = dataclasses.replace(t, posts=write_bucketed(t.posts, f"{d}/posts", name))
    df = R.response_times(laid, None)
    plan = df._jdf.queryExecution().executedPlan().toString()
    posts_side = plan[plan.index("SortMergeJoin"):]
    assert "Bucketed: true" in posts_side and posts_side.count("Exchange") == 1  # the audits
    assert rows_of(df) == rows_of(R.response_times(t, None))
    spark.sql(f"DROP TABLE {name}")  # as a session that doesn't know it
    again = open_bucketed(spark, f"{d}/posts", new_name())
    assert again.schema.simpleString() == t.posts.schema.simpleString() and rows_of(again) == rows_of(t.posts)
    assert "Bucketed: true" in R.response_times(dataclasses.replace(t, posts=again), None)._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------------------ published months
def test_a_reader_sees_the_old_or_the_new_month(spark, monkeypatch):
    path, table = tempfile.mkdtemp(prefix="va-pub-") + "/content", new_name()
    t = make_tables(spark, *base_rows())
    whole = R.content_types(t, None, AS_OF)
    want = {m: rows_of(whole.where(F.col("post_month") == m).select(*sorted(whole.columns))) for m in ("2015Feb", "2015May")}
    read = lambda m: rows_of(spark.table(table).where(F.col("post_month") == m).select(*sorted(whole.columns)))
    first = sinks.publish_month(whole.where("kind = 'photo'"), table, path, "content", "2015Feb")
    sinks.publish_month(whole, table, path, "content", "2015May")
    old = read("2015Feb")
    assert old != want["2015Feb"] and read("2015May") == want["2015May"]

    def stop(*_):
        raise RuntimeError("the driver stops here")
    monkeypatch.setattr(sinks, "_switch", stop)
    with pytest.raises(RuntimeError):
        sinks.publish_month(whole, table, path, "content", "2015Feb")
    assert read("2015Feb") == old and read("2015May") == want["2015May"]
    monkeypatch.undo()
    sinks.publish_month(whole, table, path, "content", "2015Feb")
    assert read("2015Feb") == want["2015Feb"] and read("2015May") == want["2015May"]
    assert not os.path.exists(first)  # the folder that the month left
    assert sinks.tidy(spark, table, path) == [] and len(sinks.tidy(spark, table, path, older_than_s=-5)) == 1  # the one of the run that stopped
    assert read("2015Feb") == want["2015Feb"]
    sinks.publish_month(whole.where("n < 0"), table, path, "content", "2015Feb", keep_old=True)  # an empty month
    assert read("2015Feb") == [] and read("2015May") == want["2015May"]
    assert len(sinks.tidy(spark, table, path, older_than_s=-5)) == 1


def test_a_run_appended_twice_counts_once(spark):
    path, table = tempfile.mkdtemp(prefix="va-runs-") + "/t", new_name()
    df = spark.range(5).withColumn("x", F.lit("it's"))
    for run in ("a'b", "two", "a'b"):
        sinks.append_run(df, table, path, run)
    got = spark.table(table).groupBy("run").count().collect()
    assert {r.run: r["count"] for r in got} == {"a'b": 5, "two": 5}


def test_a_merchants_rows_lie_in_few_row_groups(spark):
    """A lookup of one merchant reads the row groups that can hold it, by range and bloom filter."""
    df = spark.range(60_000).select(F.concat(F.lit("M"), F.pmod(F.xxhash64("id"), F.lit(500)).cast("string")).alias("merchant_id"),
                                    F.concat(F.lit("P"), "id").alias("place_name"), F.lit("2015Feb").alias("post_month"), F.col("id").alias("n"))
    read = {}
    for how in (None, "merchant_id"):
        path = tempfile.mkdtemp(prefix="va-cluster-")
        writer = df.repartition(4) if how is None else df
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        conf.set("parquet.block.size", "65536")
        conf.set("parquet.page.row.count.limit", "2000")
        try:
            sinks.write_report(writer, path, "content", cluster_by=how)
        finally:
            conf.unset("parquet.block.size")
            conf.unset("parquet.page.row.count.limit")
        found = sinks.read_report(spark, path, merchant_id="M7", post_month="2015Feb")
        assert found.count() == df.where("merchant_id = 'M7'").count()
        got = sinks.read_report(spark, path, merchant_id="M7")
        got.collect()
        plan = got._jdf.queryExecution().executedPlan()
        leaves = plan.collectLeaves()
        scan = leaves.apply(0)
        read[how] = scan.metrics().get("numOutputRows").get().value()
    assert read[None] == 60_000 and read["merchant_id"] <= 60_000 / 4, read


def test_write_report_writes_the_month_named_alone(spark):
    path = tempfile.mkdtemp(prefix="va-month-")
    whole = R.content_types(make_tables(spark, *base_rows()), None, AS_OF)
    sinks.write_report(whole, path, "content")
    sinks.write_report(whole.where("kind = 'photo'"), path, "content", month="2015Feb")
    got = sinks.read_report(spark, path)
    assert got.where("post_month = '2015May'").count() == whole.where("post_month = '2015May'").count()
    assert got.where("post_month = '2015Feb' and kind <> 'photo'").count() == 0


# ------------------------------------------------------------------------------ shared counts
@pytest.mark.parametrize("seed", [21, 22])
def test_shared_counts_equal_the_reports(spark, seed):
    t = make_tables(spark, *random_tables(seed))
    for month in (*MONTHS, None):
        shared = jobs.share_counts(spark, jobs.share_matches(spark, t, month, AS), month, AS)
        for name in R.COUNT_REPORTS:
            assert rows_of(R.LONG_REPORTS[name](shared, month, AS)) == rows_of(R.LONG_REPORTS[name](t, month, AS)), (name, month)
            assert rows_of(R.REPORTS[name](shared, month, AS)) == rows_of(R.REPORTS[name](t, month, AS)), (name, month)
    with pytest.raises(ValueError):
        R.content_types(dataclasses.replace(shared, matches_month=MONTHS[0]), MONTHS[1], AS)
    # one shuffle of the match, one of the distinct rows
    plan = R.count_reports(jobs.share_matches(spark, t, None, AS), None, AS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and plan.count("Expand") == 1


# ------------------------------------------------------------------------------ bitmaps
@pytest.mark.parametrize("seed", [31, 32])
def test_merged_bitmaps_equal_the_report(spark, seed):
    t = make_tables(spark, *random_tables(seed))
    path = tempfile.mkdtemp(prefix="va-bits-") + "/dictionary"
    states = []
    for k in range(3):  # three arrivals of posts, split at random
        some = dataclasses.replace(t, posts=t.posts.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(3)) == k))
        known = bitmaps.extend_dictionary(some.posts, path, first=k == 0)
        states.append(bitmaps.poster_bitmaps(some, known, None, AS))
    numbers = sorted(r.number for r in bitmaps.poster_dictionary(spark, path).collect())
    assert numbers == list(range(1, t.posts.where("poster_id is not null").select("poster_id").distinct().count() + 1))
    for order in (states, states[::-1], [bitmaps.merged(*states[:2]), states[2], states[0]]):  # a repeated arrival changes nothing
        assert rows_of(bitmaps.poster_counts(bitmaps.merged(*order))) == rows_of(R.poster_counts(t, None, AS))
    with pytest.raises(Exception, match="not in the dictionary"):
        bitmaps.poster_bitmaps(t, known.where("number < 3"), None, AS).collect()


# ------------------------------------------------------------------------------ exports
LINES = [
    '{"_id":{"$oid":"5f"},"post_time":{"$date":{"$numberLong":"1433116800999"}},"secondary_venue_ids":["FB-1",{"$oid":"aa"}],"kind":"photo",'
    '"text":"hi","rating":{"value":{"$numberInt":"5"},"scale":{"$numberLong":"5"}},"weird":{"a":[1,2]},"n":3}',
    '{"_id":"b","post_time":{"$date":"2015-02-03T07:15:00Z"},"secondary_venue_ids":"[FB-1, FB-11]","rating":null,"poster_id":7}',
    '{"id":"c","post_time":{"$date":1433116800999},"text":"2015","tag_ids":[]}',
    '{"_id":"d","post_time":"Tue Feb 03 07:15:00 AEST 2015","kind":{"a":1}}', '{"_id":"e","post_time":1433116800999,"rating":5}', "", "{}",
]


def test_documents_in_the_stores_types(spark):
    at, later = D(2015, 6, 1, 0, 0, 0, 999000), D(2015, 2, 3, 7, 15)
    got = from_documents(spark.createDataFrame([(x,) for x in LINES], "value string"), "posts").collect()
    by = {r.id: r for r in got}
    assert len(got) == 6 and by[None].extra == {}
    assert by["5f"].post_time == at and by["5f"].secondary_venue_ids == ["FB-1", "aa"] and tuple(by["5f"].rating) == ("5", 5)
    assert by["5f"].extra == {"weird": '{"a":[1,2]}', "n": "3"}
    assert by["b"].post_time == later and by["b"].secondary_venue_ids == ["FB-1", "FB-11"] and by["b"].poster_id == "7" and by["b"].rating is None
    assert by["c"].post_time == at and by["c"].text == "2015" and by["c"].tag_ids == []
    assert by["d"].post_time == later and by["e"].post_time == at and by["e"].rating is None
    line = '{"_id":"M1","subscription":{"expires_at":{"$date":1433116800999}},"linked_accounts":{"facebook":[{"account_id":{"$numberLong":"12"},"name":"a"}]}}'
    (m,) = from_documents(spark.createDataFrame([(line,)], "value string"), "merchants").collect()
    assert m.subscription.expires_at == D(2015, 6, 1) and m.linked_accounts["facebook"][0].account_id == "12"
    for wrong in ('{"_id":"x","post_time":"soon"}', "not json"):
        with pytest.raises(Exception):
            from_documents(spark.createDataFrame([(wrong,)], "value string"), "posts").collect()


def test_reports_on_exports(spark):
    base = tempfile.mkdtemp(prefix="va-exports-")
    t = make_tables(spark, *base_rows())
    for name in ("posts", "places", "merchants", "audits"):
        df = getattr(t, name)
        df.select(F.to_json(F.struct(*[F.col(c).alias("_id" if c == "id" else c) for c in df.columns])).alias("value")).write.text(f"{base}/{name}")
    read = core.Tables(**read_tables(spark, base, "documents"))
    for name, fn in R.LONG_REPORTS.items():
        args = (None,) if name == "response_times" else (None, AS_OF)
        assert rows_of(fn(read, *args)) == rows_of(fn(t, *args)), name


# ------------------------------------------------------------------------------ journal
def test_a_failed_run_goes_on_where_it_stopped(spark, monkeypatch):
    src, sink = tempfile.mkdtemp(prefix="va-jsrc-"), tempfile.mkdtemp(prefix="va-jsink-")
    t = make_tables(spark, *base_rows())
    for name in ("posts", "places", "merchants", "audits"):
        getattr(t, name).write.mode("overwrite").parquet(f"{src}/{name}")
    tables = lambda: core.Tables(**read_tables(spark, src))
    names, build, made = ["content", "posters", "segments", "keywords"], jobs.build_report, []

    def fails_at_third(t, report, *args):
        if report == "segments" and "segments" not in made:
            made.append(report)
            raise RuntimeError("stopped")
        made.append(report)
        return build(t, report, *args)
    monkeypatch.setattr(jobs, "build_report", fails_at_third)
    with pytest.raises(RuntimeError):
        jobs.run_reports(spark, tables(), sink, "2015Feb", names, as_of=AS_OF, resume=True)
    made.clear()
    made.append("segments")
    assert sorted(jobs.run_reports(spark, tables(), sink, "2015Feb", names, as_of=AS_OF, resume=True)) == ["keywords", "segments"]
    assert jobs.run_reports(spark, tables(), sink, "2015Feb", names, as_of=AS_OF, resume=True) == {}
    for name in names:
        alone = R.REPORTS[name](t, "2015Feb", AS_OF)
        got = sinks.read_report(spark, f"{sink}/{name}", **{sinks.MONTH_COLUMN[name]: "2015Feb"})
        assert rows_of(got.select(*alone.columns)) == rows_of(alone), name
    assert len(jobs.run_reports(spark, tables(), sink, "2015Feb", names, as_of=D(2015, 6, 2), resume=True)) == 4  # other parameters
    t.posts.where("kind = 'photo'").write.mode("append").parquet(f"{src}/posts")
    assert len(jobs.run_reports(spark, tables(), sink, "2015Feb", names, as_of=D(2015, 6, 2), resume=True)) == 4  # changed input
    memory = jobs.run_reports(spark, t, sink, "2015Feb", ["content"], as_of=AS_OF, resume=True)
    assert memory == jobs.run_reports(spark, t, sink, "2015Feb", ["content"], as_of=AS_OF, resume=True) != {}  # nothing tells whether it changed


def test_runner_publishes_tables(spark):
    db, sink = f"db_{uuid.uuid4().hex}", tempfile.mkdtemp(prefix="va-db-")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tempfile.mkdtemp(prefix='va-dbdir-')}'")
    t = make_tables(spark, *base_rows())
    for _ in range(2):
        jobs.run_reports(spark, t, sink, "2015Feb", ["content", "segments"], as_of=AS_OF, database=db)
    jobs.run_reports(spark, t, sink, "2015May", ["content"], as_of=AS_OF, database=db)
    content = spark.table(f"{db}.content")
    assert sorted(r[0] for r in content.select("post_month").distinct().collect()) == ["2015Feb", "2015May"]
    want = R.content_types_map(t, None, AS_OF)
    assert rows_of(content.select(*want.columns)) == rows_of(want)
    assert spark.table(f"{db}.segments").count() == R.segments_map(t, "2015Feb", AS_OF).count()
