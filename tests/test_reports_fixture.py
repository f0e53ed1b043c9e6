"""Each report on the base fixture against the expected outputs (FIXTURES.md)."""

import pytest

from conftest import AS_OF
from venue_analytics.operators import reports as R

ML, QK, ST = "Mill Lane Bakery", "Quay Kiosk", "Station Stall"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def nonzero_nested(counts):
    return {(a, b): n for a, inner in counts.items() for b, n in inner.items() if n}


def test_content_feb(base):
    got = rows(R.content_types(base, "2015Feb", AS_OF), "place_name", "source", "kind", "n", "total")
    assert got == sorted([
        (ML, "FB", "photo", 1, 4), (ML, "FB", "video", 1, 4), (ML, "IG", "photo", 1, 4), (ML, "WB", "feed", 1, 4),
        (QK, "4S", "tip", 1, 2), (QK, "FB", "photo", 1, 2), (ST, "TW", "text", 1, 2), (ST, "4S", "tip", 1, 2)])


def test_content_may_map(base):
    m = {r.place_name: (nonzero_nested(r.counts), r.total) for r in R.content_types_map(base, "2015May", AS_OF).collect()}
    assert m == {
        ML: ({("FB", "photo"): 1, ("FB", "review"): 1}, 2),
        QK: ({("4S", "photo"): 1, ("FB", "review"): 2}, 3),
        ST: ({("TW", "text"): 1}, 1),
    }
    # zero fill: five sources, each with the four fixed kinds
    one = R.content_types_map(base, "2015May", AS_OF).collect()[0].counts
    assert set(one) == {"FB", "IG", "TW", "4S", "WB"}
    assert all({"photo", "video", "feed", "tip"} <= set(v) for v in one.values())


def test_reviews(base):
    assert R.reviews(base, "2015Feb", AS_OF).count() == 0
    m = {r.place_name: r.counts for r in R.reviews_map(base, "2015May", AS_OF).collect()}
    assert m == {ML: {"FB": {"1": 0, "2": 0, "3": 0, "4": 0, "5": 1}}, QK: {"FB": {"1": 2, "2": 0, "3": 0, "4": 0, "5": 0}}}


def test_keywords(base):
    got = rows(R.keywords(base, "2015Feb", AS_OF), "place_name", "word", "source", "n", "total")
    expected = [(ML, "rye", "FB"), (ML, "rye", "IG"), (ML, "bread", "FB"), (ML, "bread", "WB"),
                (QK, "coffee", "4S"), (QK, "coffee", "FB"), (QK, "quay", "4S"), (QK, "quay", "FB"),
                (ST, "pretzel", "TW"), (ST, "pretzel", "4S")]
    assert got == sorted((p, w, s, 1, 2) for p, w, s in expected)   # the text said twice counts once
    assert R.keywords(base, "2015May", AS_OF).count() == 0
    km = {(r.place_name, r.word): (r.counts, r.total) for r in R.keywords_map(base, "2015Feb", AS_OF).collect()}
    assert km[(ML, "bread")] == ({"FB": 1, "IG": 0, "TW": 0, "4S": 0, "WB": 1}, 2)


def test_posters(base):
    got = rows(R.posters(base, "2015Feb", AS_OF), "place_name", "source", "n", "total")
    assert got == sorted([(ML, "FB", 1, 3), (ML, "IG", 1, 3), (ML, "WB", 1, 3), (QK, "4S", 1, 2), (QK, "FB", 1, 2),
                          (ST, "TW", 1, 2), (ST, "4S", 1, 2)])
    may = {r.place_name: (r.counts, r.total) for r in R.posters_map(base, "2015May", AS_OF).collect()}
    assert may[ML] == ({"FB": 1, "IG": 0, "TW": 0, "4S": 0, "WB": 0}, 1)
    assert may[QK][1] == 2 and may[ST][1] == 1


def test_interactions(base):
    got = rows(R.interactions(base, "2015Feb", AS_OF), "place_name", "user", "source", "type", "n")
    assert got == sorted([
        (ML, "Noor", "FB", "like", 1), (ML, "Noor", "FB", "int", 1), (ML, "Iris", "IG", "reply", 1), (ML, "Iris", "IG", "int", 1),
        (QK, "Noor", "4S", "like", 1), (QK, "Noor", "4S", "int", 1), (ST, "Iris", "TW", "tag", 1),
        (ML, "Noor", "FB", "follow", 1), (QK, "Noor", "FB", "follow", 1)])
    assert R.interactions(base, "2015May", AS_OF).count() == 2
    maps = R.interactions_map(base, "2015Feb", AS_OF).collect()
    assert len(maps) == 4
    c = [r.counts for r in maps if r.place_name == ST][0]
    assert c["TW"] == {"like": 0, "reply": 0, "int": 0, "tag": 1, "follow": 0}


@pytest.mark.parametrize("wrap,iris", [(True, 2100.0), (False, 45300.0)])
def test_response_times(base, wrap, iris):
    got = rows(R.response_times(base, "2015Feb", wrap_days=wrap), "user", "average")
    assert got == [("Iris", iris), ("Noor", 2100.0)]


def test_segments(base):
    feb = rows(R.segments(base, "2015Feb", AS_OF).filter("hour <> 'total'"), "place_id", "day", "hour", "source", "n")
    assert feb == sorted([("P1", "03", "07", "FB", 1), ("P1", "03", "08", "IG", 1), ("P1", "04", "12", "WB", 1),
                          ("P1", "05", "07", "FB", 1), ("P2", "10", "09", "4S", 1), ("P2", "11", "09", "FB", 1),
                          ("P3", "12", "18", "TW", 1), ("P3", "28", "23", "4S", 1)])
    may = rows(R.segments(base, "2015May", AS_OF).filter("hour <> 'total'"), "place_id", "day", "hour", "source", "n")
    assert may == sorted([("P1", "02", "10", "FB", 1), ("P1", "03", "12", "FB", 1), ("P2", "03", "13", "FB", 2),
                          ("P2", "09", "15", "4S", 1), ("P3", "02", "11", "TW", 1)])
    m = R.segments_map(base, "2015May", AS_OF).collect()
    assert all(r.metric == "PC" and len(r.counts) == 25 for r in m)
    p2 = [r.counts for r in m if r.place_id == "P2" and r.day == "03"][0]
    assert p2["13"]["FB"] == 2 and p2["total"] == {"FB": 2, "IG": 0, "TW": 0, "4S": 0, "WB": 0}


def test_all_months_equals_union_of_months(base):
    """month=None (back-fill) gives exactly the rows of the single-month runs."""
    every = rows(R.content_types(base, None, AS_OF), "post_month", "place_name", "source", "kind", "n", "total")
    single = rows(R.content_types(base, "2015Feb", AS_OF), "post_month", "place_name", "source", "kind", "n", "total")
    single += rows(R.content_types(base, "2015May", AS_OF), "post_month", "place_name", "source", "kind", "n", "total")
    assert every == sorted(single)
    seg_all = R.segments(base, None, AS_OF).count()
    assert seg_all == R.segments(base, "2015Feb", AS_OF).count() + R.segments(base, "2015May", AS_OF).count()
