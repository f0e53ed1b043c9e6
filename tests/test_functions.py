"""Column-function tables (X1-X16) with the edge cases of each."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from venue_analytics.functions import accounts as A
from venue_analytics.functions import columns as X
from venue_analytics.functions import text as T


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col.alias("v")).collect()]


def test_source_of(spark):
    assert one(spark, X.source_of("s"), [("FB-aa",), ("4S-1",), ("ZZ",), (None,)], "s string") == ["FB", "4S", "ZZ", None]


def test_parse_legacy_time(spark):
    data = [("Tue Dec 22 12:05:21 EST 2015",), ("Wed Jan 7 01:02:03 AEST 2015",), ("Thu Jan 01 00:00:00 UTC 2015",),
            ("garbage",), (None,)]
    got = one(spark, X.parse_legacy_time("s"), data, "s string")
    assert got == [dt.datetime(2015, 12, 22, 12, 5, 21), dt.datetime(2015, 1, 7, 1, 2, 3),
                   dt.datetime(2015, 1, 1), None, None]


def test_month_day_hour(spark):
    data = [(dt.datetime(2015, 1, 21, 16, 30),), (dt.datetime(2015, 12, 31, 23, 59),), (dt.datetime(2016, 1, 1, 0, 0),)]
    df = spark.createDataFrame(data, "t timestamp")
    rows = df.select(X.month_str("t"), X.day_str("t"), X.hour_str("t")).collect()
    assert [tuple(r) for r in rows] == [("2015Jan", "21", "16"), ("2015Dec", "31", "23"), ("2016Jan", "01", "00")]


def test_hour_key(spark):
    assert one(spark, X.hour_key("h"), [(0,), (9,), (23,)], "h int") == ["00", "09", "23"]


@pytest.mark.parametrize("month,start,end", [
    ("2015Jan", dt.datetime(2015, 1, 1), dt.datetime(2015, 2, 1)),
    ("2015Dec", dt.datetime(2015, 12, 1), dt.datetime(2016, 1, 1)),
    ("2016Feb", dt.datetime(2016, 2, 1), dt.datetime(2016, 3, 1)),
])
def test_month_bounds(spark, month, start, end):
    assert X.month_bounds(month) == (start, end)
    s, e = X.month_bounds_col(F.lit(month))
    r = spark.range(1).select(s.alias("s"), e.alias("e")).collect()[0]
    assert (r.s, r.e) == (start, end)


def test_in_month_is_half_open(spark):
    data = [(dt.datetime(2015, 12, 31, 23, 59, 59),), (dt.datetime(2016, 1, 1),), (dt.datetime(2016, 1, 31, 23, 59),),
            (dt.datetime(2016, 2, 1),)]
    df = spark.createDataFrame(data, "t timestamp")
    got = [r.t for r in df.filter(X.in_month("t", "2016Jan")).collect()]
    assert got == [dt.datetime(2016, 1, 1), dt.datetime(2016, 1, 31, 23, 59)]
    assert df.filter(X.in_month("t", None)).count() == 4


def test_ms_to_seconds(spark):
    assert one(spark, X.ms_to_seconds("m"), [(1999,), (2000,), (0,)], "m long") == [1, 2, 0]


def test_is_expired(spark):
    as_of = dt.datetime(2015, 6, 1)
    data = [(dt.datetime(2015, 5, 31),), (dt.datetime(2015, 6, 1),), (dt.datetime(2015, 7, 1),), (None,)]
    # strictly after the expiry; equal instant is not expired; missing expiry counts as expired
    assert one(spark, X.is_expired("e", as_of), data, "e timestamp") == [True, False, False, True]


def test_is_expired_epoch_ms(spark):
    as_of = dt.datetime(2015, 6, 1)
    ms = int(dt.datetime(2015, 6, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    data = [(ms - 1000,), (ms + 999,), (ms + 1000,)]
    # epoch ms truncated to seconds: ms+999 -> same second as as_of -> not expired
    got = one(spark, X.is_expired(F.col("e"), as_of, dtype=__import__("pyspark.sql.types", fromlist=["LongType"]).LongType()),
              data, "e long")
    assert got == [True, False, False]


@pytest.mark.parametrize("s,expected", [
    ("[FB-1, FB-11]", "FB-1, FB-11"),
    ("[]", ""),
    ("FB-1, FB-2", "FB-1, FB-2"),     # no bracket: kept whole (documented deviation)
    ("[FB-1", "FB-1"),
    ("FB-1]", "FB-1"),
    ("x[FB-1]y", "FB-1"),
])
def test_venue_id_strip(spark, s, expected):
    assert one(spark, X.venue_id_strip("s"), [(s,)], "s string") == [expected]


def test_time_diff(spark):
    data = [(dt.datetime(2015, 1, 23, 17, 30), dt.datetime(2015, 1, 22, 17, 40)),
            (dt.datetime(2015, 1, 21, 16, 30), dt.datetime(2015, 1, 21, 16, 40)),
            (dt.datetime(2015, 1, 1), dt.datetime(2015, 1, 3, 0, 0, 5))]
    df = spark.createDataFrame(data, "a timestamp, b timestamp")
    true = [r[0] for r in df.select(X.time_diff("a", "b")).collect()]
    wrapped = [r[0] for r in df.select(X.time_diff("a", "b", wrap_days=True)).collect()]
    assert true == [-85800, 600, 172805]
    assert wrapped == [600, 600, 5]


@pytest.mark.parametrize("s,expected", [
    ("foo,bar", ["foo", "bar"]),
    ('a "b" (c)*d', ["a", "b", "c", "d"]),
    ("  x  ", ["x"]),
    ("", []),
    ("wow\nfun", ["wow\nfun"]),
])
def test_tokenize(spark, s, expected):
    assert one(spark, T.tokenize("s"), [(s,)], "s string") == [expected]


@pytest.mark.parametrize("text,words", [
    ("the quick brown Cat jumped over the lazy cat", ["quick", "brown", "cat", "jumped", "lazy"]),
    ("can you please watch my Apples?", ["watch", "apples"]),
    ("#Sunset @Bob!", ["#sunset", "@bob"]),
    ("foo,bar", ["foo,bar"]),
    ("((hello))", ["(hello)"]),
    ("don't!", []),
    ("...", []),
    ("http://x.co", []),
    ("abcdefghijklmnopq", []),
    ("abcdefghijklmnop", ["abcdefghijklmnop"]),
    ("wow\nfun", ["wow\nfun"]),
    ("The cat sat on the mat", ["cat", "sat", "mat"]),
    ("Cat cat CAT", ["cat"]),
])
def test_text_strip(spark, text, words):
    assert one(spark, T.text_strip("t"), [(text,)], "t string") == [words]


@pytest.mark.parametrize("text,tokens", [
    ("foo,bar foo", ["foo", "bar", "foo"]),
    ("((hello))", ["hello"]),
    ("Lydias cat is overweight", ["lydias", "cat", "overweight"]),
])
def test_keyword_words(spark, text, tokens):
    assert one(spark, T.keyword_words("t"), [(text,)], "t string") == [tokens]


def test_stop_words_fixed_list():
    sw = T.stop_words()
    assert len(sw) == 541 and len(set(sw)) == 541
    assert sw[0] == "a's" and sw[-1] == "zero" and list(sw) == sorted(sw)


def test_linked_accounts_and_own_post(spark):
    schema = "la map<string, array<struct<account_id:string, name:string>>>, p string"
    data = [({"facebook": [("9", "n9")], "facebookpages": [("8", "n8")], "myspace": [("7", "x")]}, "FB-8"),
            ({"twitter": [("5", "t")]}, "FB-5"),
            (None, "FB-9"),
            ({"instagram": [("3", "i")]}, None)]
    df = spark.createDataFrame(data, schema)
    rows = df.select(F.array_sort(A.linked_account_ids("la")).alias("ids"),
                     A.is_own_post(A.linked_account_ids("la"), F.col("p")).alias("own")).collect()
    assert [r.ids for r in rows] == [["FB-8", "FB-9"], ["TW-5"], [], ["IG-3"]]
    assert [r.own for r in rows] == [True, False, False, False]
    by_src = df.select(A.linked_accounts_by_source("la").alias("m")).collect()[0].m
    assert {k: sorted(v) for k, v in by_src.items()} == {"FB": ["FB-8", "FB-9"], "IG": [], "TW": [], "4S": [], "WB": []}


def test_full_match(spark):
    got = one(spark, X.full_match("s", "like|reply"), [("like",), ("unlike",), ("reply",), ("likes",), ("like\n",)],
              "s string")
    assert got == [True, False, True, False, False]
