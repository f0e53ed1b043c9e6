"""Cases the base fixture lacks (FIXTURES.md), and the checks Q8-Q14 on them."""

import datetime as dt

import pytest

from conftest import AS_OF, make_tables
from venue_analytics.operators import checks as C
from venue_analytics.operators import reports as R

D = dt.datetime


def post(pid, venues, when, kind="photo", poster=None, text=None, rating=None, tags=None):
    return (pid, when, venues, kind, text, poster, rating, tags)


def audit(i, typ, when, user, post_id, merchant="M3"):
    return (f"X{i}", "interaction", typ, merchant, when, ("user", "o", user), ("post", post_id, "p"))


MERCHANTS = [
    ("M3", "owncorp", (D(2015, 12, 31),),
     {"facebook": [("9", "fb9")], "facebookpages": [("8", "fb8")], "instagram": [("5", "iggy")],
      "twitter": [("6", "tweety")], "myspace": [("7", "x")]}),
    ("M2", "oldcorp", (D(2015, 1, 1),), None),          # expired at AS_OF
    ("M4", "othercorp", (D(2016, 1, 1),), {}),
]
PLACES = [
    ("Q1", "Cafe", "M3", ["V1", "V2"]),
    ("Q2", "Cafe", "M3", ["V3"]),                        # same name as Q1
    ("Q3", "Bar", "M3", ["V4"]),
    ("Q9", "Old", "M2", ["V9"]),
    ("Q4", "Shop", "M4", ["V1"]),                        # shares V1 with Q1 (other merchant)
    ("Q5", "Empty", "M3", []),
    ("Q6", "Null", "M3", None),
]
POSTS = [
    post("FB-own9", ["V1"], D(2015, 1, 10, 8, 0), poster="FB-9"),
    post("FB-own8", ["V3"], D(2015, 1, 10, 8, 30), poster="FB-8"),
    post("FB-p1", ["V1", "V3"], D(2015, 1, 10, 8, 45), poster="FB-100", text="Great cafe coffee", tags=["T9"]),
    post("FB-p2", ["V2"], D(2015, 1, 10, 9, 0), text="cafe coffee again", tags=["T1"]),
    post("FB-p3", ["V2"], D(2015, 1, 10, 9, 30), kind="video"),
    post("FB-p4", ["V2"], D(2015, 1, 10, 10, 0), kind="feed", poster="FB-101", text="cafe time", tags=["T2", "T3"]),
    post("ZZ-1", ["V4"], D(2015, 1, 10, 11, 0), kind="text", poster="ZZ-7"),
    post("FB-r1", ["V4"], D(2015, 1, 10, 12, 0), kind="review", rating=("4.5", 5)),
    post("FB-r2", ["V4"], D(2015, 1, 10, 12, 30), kind="review"),
    post("FB-dec", ["V4"], D(2015, 12, 31, 23, 59)),
    post("FB-jan1", ["V4"], D(2016, 1, 1, 0, 0)),
    post("FB-old", ["V9"], D(2015, 1, 5, 12, 0)),
    post("FB-e1", [], D(2015, 1, 10)),
    post("FB-e2", None, D(2015, 1, 10)),
]
AUDITS = [
    audit(1, "like", D(2015, 1, 11, 9, 0), "Ann", "FB-p2"),
    audit(2, "reply", D(2015, 1, 12, 9, 0), "Ann", "FB-p2"),
    audit(3, "tag", D(2015, 1, 10, 10, 30), "Ann", "FB-p4"),
    audit(4, "like", D(2015, 1, 10, 11, 10), "Bob", "ZZ-1"),
    audit(5, "like", D(2015, 1, 10, 10, 20), "Bob", "FB-p4"),
    audit(6, "follow", D(2015, 1, 15), "Bob", "TW-x"),
    audit(7, "follow", D(2015, 1, 15), "Cid", "TW-y"),
    audit(8, "like", D(2015, 2, 2, 9, 0), "Dee", "FB-p2"),
    audit(9, "like", D(2015, 1, 10, 9, 5), "Eve", "FB-p2", merchant="M4"),
    audit(10, "like", D(2015, 1, 5, 12, 1), "Old", "FB-old", merchant="M2"),
    audit(11, "view", D(2015, 1, 10, 9, 5), "Ann", "FB-p2"),          # not an interaction type
]
VENUES = [("V1", "mention", "cafe"), ("V4", "mention", "bar"), ("V2", "place", "x")]


@pytest.fixture(scope="module")
def edge(spark):
    return make_tables(spark, POSTS, PLACES, MERCHANTS, AUDITS, VENUES)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_content_edge(edge):
    got = rows(R.content_types(edge, "2015Jan", AS_OF), "merchant_id", "place_name", "source", "kind", "n", "total")
    assert got == rows_sorted([
        ("M3", "Cafe", "FB", "photo", 2, 4), ("M3", "Cafe", "FB", "video", 1, 4), ("M3", "Cafe", "FB", "feed", 1, 4),
        ("M3", "Bar", "ZZ", "text", 1, 3), ("M3", "Bar", "FB", "review", 2, 3),
        ("M4", "Shop", "FB", "photo", 2, 2)])
    bar = [r.counts for r in R.content_types_map(edge, "2015Jan", AS_OF).collect() if r.place_name == "Bar"][0]
    assert bar["ZZ"] == {"photo": 0, "video": 0, "feed": 0, "tip": 0, "text": 1}      # unknown source added
    assert bar["FB"]["review"] == 2 and bar["FB"]["photo"] == 0


def rows_sorted(xs):
    return sorted(xs, key=repr)


def test_december_rollover(edge):
    dec = rows(R.content_types(edge, "2015Dec", AS_OF), "place_name", "post_month", "n")
    jan = rows(R.content_types(edge, "2016Jan", AS_OF), "place_name", "post_month", "n")
    assert dec == [("Bar", "2015Dec", 1)] and jan == [("Bar", "2016Jan", 1)]


def test_posters_null_counts_once(edge):
    got = rows(R.posters(edge, "2015Jan", AS_OF), "merchant_id", "place_name", "source", "n")
    assert got == rows_sorted([("M3", "Cafe", "FB", 3), ("M3", "Bar", "ZZ", 1), ("M3", "Bar", "FB", 1),
                               ("M4", "Shop", "FB", 2)])


def test_reviews_odd_ratings(edge):
    got = rows(R.reviews(edge, "2015Jan", AS_OF), "place_name", "value", "n")
    assert got == rows_sorted([("Bar", "4.5", 1), ("Bar", None, 1)])
    m = R.reviews_map(edge, "2015Jan", AS_OF).collect()[0].counts
    assert m == {"FB": {"1": 0, "2": 0, "3": 0, "4": 0, "5": 0, "4.5": 1, "None": 1}}


def test_interactions_edge(edge):
    got = rows(R.interactions(edge, "2015Jan", AS_OF), "merchant_id", "place_name", "user", "source", "type", "n")
    assert got == rows_sorted([
        ("M3", "Cafe", "Ann", "FB", "like", 1), ("M3", "Cafe", "Ann", "FB", "reply", 1),
        ("M3", "Cafe", "Ann", "FB", "int", 1), ("M3", "Cafe", "Ann", "FB", "tag", 1),
        ("M3", "Bar", "Bob", "ZZ", "like", 1), ("M3", "Bar", "Bob", "ZZ", "int", 1),
        ("M3", "Cafe", "Bob", "FB", "like", 1), ("M3", "Cafe", "Bob", "FB", "int", 1),
        ("M3", "Cafe", "Bob", "TW", "follow", 1), ("M3", "Bar", "Bob", "TW", "follow", 1),
    ])
    # the February like meets no February post of that place
    assert R.interactions(edge, "2015Feb", AS_OF).count() == 0


def test_response_times_edge(edge):
    got = rows(R.response_times(edge, "2015Jan"), "merchant_id", "user", "average")
    assert got == rows_sorted([("M3", "Ann", 44100.0), ("M3", "Bob", 900.0), ("M4", "Eve", 300.0),
                               ("M2", "Old", 60.0)])
    wrapped = dict(rows(R.response_times(edge, "2015Jan", wrap_days=True), "user", "average"))
    assert wrapped["Ann"] == 900.0
    feb = rows(R.response_times(edge, "2015Feb"), "user", "average")
    assert feb == [("Dee", 23 * 86400.0)]


def test_segments_keep_own_posts(edge):
    got = rows(R.segments(edge, "2015Jan", AS_OF).filter("hour <> 'total'"), "place_id", "hour", "source", "n")
    assert got == rows_sorted([("Q1", "08", "FB", 2), ("Q1", "09", "FB", 2), ("Q1", "10", "FB", 1),
                               ("Q2", "08", "FB", 2), ("Q3", "11", "ZZ", 1), ("Q3", "12", "FB", 2),
                               ("Q4", "08", "FB", 2)])
    q3 = [r.counts for r in R.segments_map(edge, "2015Jan", AS_OF).collect() if r.place_id == "Q3"][0]
    assert q3["11"]["ZZ"] == 1 and q3["total"]["ZZ"] == 1 and q3["total"]["FB"] == 2


def test_keywords_edge(edge):
    got = rows(R.keywords(edge, "2015Jan", AS_OF), "place_name", "word", "source", "n", "total")
    assert got == rows_sorted([("Cafe", "cafe", "FB", 3, 3), ("Cafe", "coffee", "FB", 2, 2)])


# --------------------------------------------------------------------------------- checks
def test_segment_check_ok(edge):
    chk = C.check_segment_totals(R.segments_map(edge, None, AS_OF))
    assert chk.count() > 0 and chk.filter("NOT ok").count() == 0
    assert C.segment_violations(R.segments_map(edge, None, AS_OF)).count() == 0


def test_merchant_post_count(edge):
    got = rows(C.merchant_post_count(edge, "2015Jan"), "merchant_id", "n_posts")
    assert got == [("M2", 1), ("M3", 9), ("M4", 2)]


def test_venue_and_handle_mentions(edge):
    assert rows(C.venue_mentions(edge), "merchant_id", "place_id", "term") == \
        [("M3", "Q1", "cafe"), ("M3", "Q3", "bar"), ("M4", "Q4", "cafe")]
    assert rows(C.handle_mentions(edge.merchants), "merchant_id", "service", "name") == \
        [("M3", "instagram", "iggy"), ("M3", "twitter", "tweety")]
    assert rows(C.mention_terms(edge), "merchant_id", "term") == \
        [("M3", "bar"), ("M3", "cafe"), ("M3", "iggy"), ("M3", "tweety"), ("M4", "cafe")]


def test_keyword_mentions(edge):
    got = C.keyword_mentions(R.keywords(edge, "2015Jan", AS_OF), C.mention_terms(edge))
    assert rows(got, "place_name", "word", "total") == [("Cafe", "cafe", 3)]


def test_tagged_post_count(edge):
    got = rows(C.tagged_post_count(edge, ["T1", "T2"], "2015Jan"), "place_id", "place_name", "n_posts")
    assert got == [("Q1", "Cafe", 2)]


def test_user_likes(edge):
    got = rows(C.user_likes(edge, None, "2015Jan"), "user", "post_id", "place_id", "merchant_id", "likes")
    assert got == rows_sorted([("Ann", "FB-p2", "Q1", "M3", 1), ("Bob", "ZZ-1", "Q3", "M3", 1),
                               ("Bob", "FB-p4", "Q1", "M3", 1), ("Eve", "FB-p2", "Q1", "M3", 1),
                               ("Old", "FB-old", "Q9", "M2", 1)])
    assert rows(C.user_likes(edge, "Ann", "2015Jan"), "user", "post_id") == [("Ann", "FB-p2")]


def test_own_accounts_relation(edge):
    assert sorted(set(rows(edge.own_accounts(), "merchant_id", "poster_id"))) == [("M3", "FB-8"), ("M3", "FB-9"), ("M3", "IG-5"),
                                                                      ("M3", "TW-6")]


def test_shared_matches_equal_recomputed(spark, edge):
    from venue_analytics.plans.jobs import share_matches
    shared = share_matches(spark, edge, "2015Jan", AS_OF, with_text=True)
    for name, fn in R.LONG_REPORTS.items():
        if name == "response_times":
            continue
        assert rows_sorted(map(tuple, fn(edge, "2015Jan", AS_OF).collect())) == \
            rows_sorted(map(tuple, fn(shared, "2015Jan", AS_OF).collect())), name


def test_keywords_restricted_to_words_equals_filtered_report(edge):
    terms = C.mention_terms(edge)
    full = C.keyword_mentions(R.keywords(edge, "2015Jan", AS_OF), terms)
    early = R.keywords(edge, "2015Jan", AS_OF, words=terms.withColumnRenamed("term", "word"))
    assert rows(full, "place_name", "word", "source", "n", "total") == \
        rows(early, "place_name", "word", "source", "n", "total") == [("Cafe", "cafe", "FB", 3, 3)]
