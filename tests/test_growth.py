"""Steps whose memory or time grew with the tables: own posts told in more tasks, bitmaps in words, documents parsed once."""

import dataclasses
import datetime as dt
import re
import tempfile

from pyspark.sql import functions as F

from conftest import make_tables
from venue_analytics.operators import bitmaps, core
from venue_analytics.operators import reports as R
from venue_analytics.plans import standins as SD
from venue_analytics.sources.exports import from_documents

D = dt.datetime
AS = D(2015, 6, 1)


def tables(spark):
    places = [("P1", "Mill", "M1", ["V1", "V2"]), ("P2", None, "M1", ["V2"])]
    posts = [(f"FB-{i}", D(2015, 1, 1 + i % 28), [["V1"], ["V2", "V1"], [None, "V1"], [], None][i % 5], "photo", None, [f"u{i % 90}", None, "me"][i % 3], None, None) for i in range(300)]
    t = make_tables(spark, posts, places, [("M1", "m", (D(2030, 1, 1),), None)], [])
    accounts = spark.createDataFrame([("M1", "me"), ("M1", "me"), ("M1", None), (None, "u1")], "merchant_id string, poster_id string")
    return dataclasses.replace(t, accounts=accounts)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tasks(plan, *cols):
    return [int(n) for n in re.findall(r"hashpartitioning\(" + ", ".join(rf"{c}#\d+L?" for c in cols) + r", (\d+)\)", plan)]


# ------------------------------------------------------------------------------ F5
def test_a_document_is_parsed_once_and_plain_texts_are_taken_first(spark):
    lines = [
        '{"_id": {"$oid": "FB-1"}, "kind": "{photo", "secondary_venue_ids": ["V1", {"$oid": "V2"}, null, "{x", 5], "poster_id": {"$symbol": "p"}}',
        '{"id": "FB-2", "kind": {"a": 1}, "secondary_venue_ids": ["V1", "V2"], "poster_id": 7}',
        '{"id": null, "_id": "FB-3", "secondary_venue_ids": "[V1, V2]", "poster_id": [1]}',
        '{"_id": "FB-4", "secondary_venue_ids": []}',
    ]
    posts = from_documents(spark.createDataFrame([(x,) for x in lines], "value string"), "posts")
    got = {r.id: (r.kind, r.secondary_venue_ids, r.poster_id) for r in posts.collect()}
    assert got == {"FB-1": ("{photo", ["V1", "V2", None, "{x", "5"], "p"), "FB-2": ('{"a":1}', ["V1", "V2"], "7"),
                   "FB-3": (None, ["V1", "V2"], "[1]"), "FB-4": (None, [], None)}
    path = tempfile.mkdtemp(prefix="va-lines-") + "/lines"
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    venues = core.post_venues(from_documents(spark.read.text(path), "posts"), None, ["post_id", "kind"])
    assert plan_of(venues).split("FileScan")[0].count("VariantExpressionEvalUtils.parseJson(") == 1
    assert sorted((r.post_id, r.venue_id) for r in venues.collect()) == sorted(
        [("FB-1", v) for v in ("V1", "V2", "{x", "5")] + [(p, v) for p in ("FB-2", "FB-3") for v in ("V1", "V2")])


# ------------------------------------------------------------------------------ F6 to F9
def test_posters_are_made_distinct_where_their_accounts_are_met(spark):
    t = tables(spark)
    pp = core.place_posts(t, None, ["merchant_id", "place_name", "post_month", "source", "poster_id"], as_of=AS)
    n = core.POSTER_TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = plan_of(pp)
    assert set(tasks(plan, "merchant_id", "poster_id")) == {n}
    assert "poster_id" not in "".join(re.findall(r"hashpartitioning\(merchant_id#\d+, place_name[^)]*", plan))
    got = {(r.place_name, r.poster_id) for r in pp.collect()}
    assert {p for _, p in got} == {None, *(f"u{i}" for i in range(90) if i % 3 == 0 and any(j % 90 == i and j % 5 < 3 for j in range(300)))}
    assert {x for x, _ in got} == {"Mill", None}


# ------------------------------------------------------------------------------ F10
def test_bitmaps_hold_no_more_than_their_posters(spark):
    t = tables(spark)
    known = bitmaps.extend_dictionary(t.posts, tempfile.mkdtemp(prefix="va-bits-") + "/dictionary", first=True)
    known = known.withColumn("number", F.when(F.col("poster_id") == "u0", F.lit(2**40 + 63)).otherwise(F.col("number")))
    bits = bitmaps.poster_bitmaps(t, known, None, AS)
    assert dict(bits.dtypes)["bits"] == "bigint" and bits.where("bits = 0").count() == 0
    assert bits.where(F.col("bits") < 0).select("bucket").distinct().collect() == [(2**34,)]  # bit 63 alone
    rows = [sorted(map(str, x.select(*bitmaps.KEYS, "n").collect())) for x in (bitmaps.poster_counts(bitmaps.merged(bits, bits)), R.poster_counts(t, None, AS))]
    assert rows[0] == rows[1]


# ------------------------------------------------------------------------------ F11
def test_lists_of_orders_are_collected_in_more_tasks(spark):
    d = tempfile.mkdtemp(prefix="va-orders-")
    lines = [(k, v, "R") for k, v in [(1, 5), (2, 5), (1, 6), (None, 7), (1, 5)]]
    spark.createDataFrame(lines, "l_orderkey bigint, l_suppkey bigint, l_returnflag string").write.parquet(f"{d}/lineitem.parquet")
    orders = spark.createDataFrame([(1, 9, "F", "1-U"), (1, 8, "F", "1-U"), (3, 9, "O", "2-H"), (None, 9, "P", "3-M")],
                                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string")
    orders.withColumn("o_orderdate", F.lit(D(1998, 3, 1)).cast("timestamp_ntz")).write.parquet(f"{d}/orders.parquet")
    posts = SD.posts(spark, d)
    assert [sorted(r.secondary_venue_ids or []) for r in posts.orderBy("id", "poster_id").collect()] == [[], ["V5", "V5", "V6"], ["V5", "V5", "V6"], []]
    plan = plan_of(posts)
    assert tasks(plan, "l_orderkey") == [SD.LIST_TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))]


# ------------------------------------------------------------------------------ F12
def test_counted_rows_are_narrow_and_dealt_to_more_tasks(spark):
    t = tables(spark)
    places = [("P1", "Mill", "M1", ["V1", "V2"]), ("P2", None, "M1", ["V2"]), ("P3", "Mill", "M1", ["V3"]), ("P3", "Other", "M1", ["V3"]), (None, "Mill", "M1", ["V3"])]
    at = D(2015, 2, 3, 7)
    odd = [("FB-1", at, ["V1", "V3"], "review", None, "u7", ("4", 5), None), ("FB-1", at, ["V3"], "review", None, "u8", ("5", 5), None), (None, at, ["V3"], None, None, None, None, None),
           ("FB-2", None, ["V3", "V2"], "photo", None, "me", None, None), ("FB-2", D(2015, 2, 3, 8), ["V3"], "photo", None, "u7", None, None), ("IG-3", at, ["V3"], "review", None, "u7", ("1", 5), None)]
    more = make_tables(spark, odd * 2, places, [("M1", "m", (D(2030, 1, 1),), None)], [])
    t = dataclasses.replace(t, posts=t.posts.unionByName(more.posts), places=more.places)
    counts = R.count_reports(t, None, AS)
    n = core.POSTER_TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tasks(plan_of(counts), "cell") == [n]
    shared = dataclasses.replace(t, counts=counts)
    for name in R.COUNT_REPORTS:
        assert sorted(map(str, R.LONG_REPORTS[name](shared, None, AS).collect())) == sorted(map(str, R.LONG_REPORTS[name](t, None, AS).collect())), name
    got = {(r.place_id, r.post_month, r.day, r.hour, r.source): r.n for r in counts.where("report = 'segments' and place_id = 'P3'").collect()}
    assert got == {("P3", None, None, None, "FB"): 1, ("P3", None, None, "total", "FB"): 1, ("P3", "2015Feb", "03", "08", "FB"): 1, ("P3", "2015Feb", "03", "07", "FB"): 1,
                   ("P3", "2015Feb", "03", "total", "FB"): 2, ("P3", "2015Feb", "03", "07", "IG"): 1, ("P3", "2015Feb", "03", "total", "IG"): 1,
                   ("P3", "2015Feb", "03", "07", None): 1, ("P3", "2015Feb", "03", "total", None): 1}
