import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from venue_analytics.session import get_spark  # noqa: E402

AS_OF = dt.datetime(2015, 6, 1)


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", shuffle_partitions=4, app_name="venue_analytics_tests")
    yield s


def _t(s):
    """'03/02/15 07:15' -> datetime (day/month/2-digit year)."""
    return dt.datetime.strptime(s, "%d/%m/%y %H:%M")


# Base rows (FIXTURES.md): one merchant with three places, posts in two months with a text said twice, posts
# that list several venues (of one place, or unknown ones), reviews, and audits of every type.
PLACES = [
    ("P1", "Mill Lane Bakery", "M1", ["FB-m", "IG-m", "WB-m"]),
    ("P2", "Quay Kiosk", "M1", ["FB-q", "4S-q"]),
    ("P3", "Station Stall", "M1", ["TW-s", "4S-s"]),
]

POSTS = [
    ("FB-100", ["FB-m", "IG-m"], "03/02/15 07:15", "Fresh rye bread, warm rolls", "photo"),
    ("IG-101", ["IG-m"], "03/02/15 08:05", "rye loaf!", "photo"),
    ("WB-102", ["WB-m", "XX-1"], "04/02/15 12:45", "bread with butter", "feed"),
    ("FB-103", ["FB-m"], "05/02/15 07:15", "Fresh rye bread, warm rolls", "video"),
    ("4S-104", ["4S-q"], "10/02/15 09:00", "Coffee at the quay", "tip"),
    ("FB-105", ["FB-q", "XX-2"], "11/02/15 09:30", "quay coffee", "photo"),
    ("TW-106", ["TW-s"], "12/02/15 18:20", "late train (salted pretzel)", "text"),
    ("4S-107", ["4S-s", "TW-s"], "28/02/15 23:59", "pretzel", "tip"),
    ("FB-200", ["FB-m"], "02/05/15 10:10", "plum pies", "photo"),
    ("TW-201", ["TW-s"], "02/05/15 11:00", "sold out", "text"),
    ("4S-202", ["4S-q"], "09/05/15 15:00", None, "photo"),
]
REVIEWS = [
    ("FB-300", ["FB-m"], "03/05/15 12:00", "5"),
    ("FB-301", ["4S-q"], "03/05/15 13:00", "1"),
    ("FB-302", ["4S-q", "FB-q"], "03/05/15 13:30", "1"),
]
AUDITS = [
    ("like", "03/02/15 07:25", "Noor", "FB-100"),
    ("like", "03/02/15 07:40", "Noor", "FB-100"),
    ("reply", "03/02/15 09:05", "Iris", "IG-101"),
    ("like", "10/02/15 10:00", "Noor", "4S-104"),
    ("tag", "13/02/15 18:30", "Iris", "TW-106"),
    ("follow", "20/02/15 00:00", "Noor", "FB-999"),
    ("like", "02/05/15 10:40", "Iris", "FB-200"),
]


def post_row(pid, venues, when, text=None, kind=None, poster=None, rating=None, tags=None):
    return (pid, _t(when), venues, kind, text, poster, rating, tags)


def audit_row(i, typ, when, user, post, merchant="M1"):
    return (f"A{i}", "interaction", typ, merchant, _t(when), ("user", "u", user), ("post", post, "p"))


def base_rows():
    posts = [post_row(p, v, w, text=x, kind=k) for p, v, w, x, k in POSTS]
    posts += [post_row(p, v, w, kind="review", rating=(val, 5)) for p, v, w, val in REVIEWS]
    merchants = [("M1", "bakers", (dt.datetime(2015, 12, 31),), None)]
    audits = [audit_row(i, *a) for i, a in enumerate(AUDITS)]
    return posts, list(PLACES), merchants, audits


def make_tables(spark, posts, places, merchants, audits, venues=None):
    from venue_analytics.operators.core import Tables
    from venue_analytics.sources import schemas as S
    return Tables(
        posts=spark.createDataFrame(posts, S.POSTS),
        places=spark.createDataFrame(places, S.PLACES),
        merchants=spark.createDataFrame(merchants, S.MERCHANTS),
        audits=spark.createDataFrame(audits, S.AUDITS),
        venues=spark.createDataFrame(venues or [], S.VENUES),
    )


@pytest.fixture(scope="session")
def base(spark):
    return make_tables(spark, *base_rows())
