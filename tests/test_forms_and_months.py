"""Text forms of schema-less formats, months that come out empty, unnamed users and places, key clashes,
time zones, full drill-downs, and the fixed values."""

import datetime as dt
import glob
import hashlib
import json
import os
import subprocess
import sys
import tempfile

import pytest

from conftest import AS_OF, audit_row, base_rows, make_tables, post_row
from venue_analytics.functions.text import stop_words
from venue_analytics.operators import checks as C
from venue_analytics.operators import reports as R
from venue_analytics.operators.core import Tables
from venue_analytics.operators.counts import fold_map, fold_nested_map
from venue_analytics.plans.jobs import run_reports
from venue_analytics.sources import schemas as S
from venue_analytics.sources.readers import normalise, read_table, read_tables, write_month_partitioned
from venue_analytics.sources.sinks import read_report


def _json(base, name, rows):
    os.makedirs(os.path.join(base, name))
    with open(os.path.join(base, name, "part-0.json"), "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)


LEGACY = (lambda t: t.strftime("%a %b %d %H:%M:%S EST %Y"), lambda v: "[" + ", ".join(v) + "]",
          lambda t: int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000))
ISO = (lambda t: t.isoformat(), list, lambda t: t.isoformat())
ISO_TEXT = (lambda t: t.isoformat(" "), lambda v: json.dumps(v), lambda t: str(int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)))


@pytest.mark.parametrize("time,items,expiry", [LEGACY, ISO, ISO_TEXT])
def test_json_forms_give_the_typed_result(spark, time, items, expiry):
    posts, places, merchants, audits = base_rows()
    base = tempfile.mkdtemp(prefix="va-forms-")
    _json(base, "posts", [{"_id": p[0], "post_time": time(p[1]), "secondary_venue_ids": items(p[2]), "kind": p[3], "text": p[4],
                           "rating": p[6] and {"value": p[6][0], "scale": p[6][1]}} for p in posts])
    _json(base, "places", [{"_id": p[0], "name": p[1], "merchant_id": p[2], "venue_ids": items(p[3])} for p in places])
    _json(base, "merchants", [{"_id": m[0], "name": m[1], "subscription": {"expires_at": expiry(m[2][0])}} for m in merchants])
    _json(base, "audits", [{"_id": a[0], "category": a[1], "type": a[2], "merchant_id": a[3], "created_at": time(a[4]),
                            "actor": {"label": a[5][2]}, "subject": {"origin_id": a[6][1]}} for a in audits])
    _json(base, "venues", [{"_id": "FB-m", "type": "mention", "term": "mill"}])
    t = Tables(**read_tables(spark, base, fmt="json"))
    typed = make_tables(spark, *base_rows())
    for fn in (R.content_types, R.reviews, R.interactions):
        assert sorted(map(tuple, fn(t, None, AS_OF).collect()), key=repr) == sorted(map(tuple, fn(typed, None, AS_OF).collect()), key=repr)
    assert R.content_types(t, "2015Feb", dt.datetime(2016, 1, 1)).count() == 0       # expired by then
    assert [tuple(r) for r in C.venue_mentions(t).collect()] == [("M1", "P1", "FB-m", "mill")]


def test_unreadable_text_fails(spark):
    df = spark.createDataFrame([("a", "yesterday", "[x]")], "_id string, post_time string, secondary_venue_ids string")
    with pytest.raises(Exception, match="unreadable post_time"):
        normalise("posts", df).collect()


def test_a_month_that_comes_out_empty_is_replaced(spark):
    sink = tempfile.mkdtemp(prefix="va-empty-")
    posts, places, merchants, audits = base_rows()
    t = make_tables(spark, posts, places, merchants, audits)
    for month in ("2015Feb", "2015May"):
        out = run_reports(spark, t, sink, month, reports=["content"], as_of=AS_OF)
    assert read_report(spark, out["content"], post_month="2015Feb").count() == 3
    run_reports(spark, t, sink, "2015Feb", reports=["content"], as_of=dt.datetime(2017, 1, 1))     # expired: no rows
    assert read_report(spark, out["content"], post_month="2015Feb").count() == 0
    assert read_report(spark, out["content"], post_month="2015May").count() == 3


def test_follows_without_user_or_place_name(spark):
    posts = [post_row("FB-1", ["V"], "01/02/15 10:00"), post_row("FB-2", ["W"], "01/02/15 10:00")]
    places = [("P1", "Named", "M1", ["V"]), ("P2", None, "M1", ["W"])]
    audits = [audit_row(1, "like", "02/02/15 10:00", None, "FB-1"), audit_row(2, "follow", "02/02/15 10:00", None, "FB-9"),
              audit_row(3, "like", "02/02/15 10:00", "Noor", "FB-2"), audit_row(4, "follow", "02/02/15 10:00", "Noor", "FB-9")]
    t = make_tables(spark, posts, places, [("M1", "m", (dt.datetime(2016, 1, 1),), None)], audits)
    got = [(r["place_name"], r["user"]) for r in R.interactions(t, "2015Feb", AS_OF).where("type = 'follow'").collect()]
    assert got == [(None, "Noor")]
    literal = R.interaction_parts(t, "2015Feb", AS_OF)[1].collect()
    assert [(r["place_name"], r["user"]) for r in literal] == got


def test_map_folds_with_a_missing_key_beside_its_text(spark):
    df = spark.createDataFrame([("g", "a", None, 1), ("g", "a", "None", 2), ("g", None, "x", 3), ("g", "None", "x", 4)],
                               "g string, o string, k string, n long")
    assert fold_map(df.where("o = 'a'"), ["g"], "k", "n", ["z"]).first()["counts"] == {"None": 3, "z": 0}
    got = fold_nested_map(df, ["g"], "o", "k", "n", ["q"], ["z"], total="t").first()
    assert got["counts"] == {"a": {"None": 3, "z": 0}, "None": {"x": 7, "z": 0}, "q": {"z": 0}} and got["t"] == 10


def test_as_of_is_utc_on_any_machine():
    code = """
import datetime as dt, sys
sys.path.insert(0, %r)
from venue_analytics.session import get_spark
from venue_analytics.functions.columns import is_expired
s = get_spark("local[1]", 1)
df = s.sql("select timestamp'2015-06-01 02:00:00' e")
print("EXPIRED", df.select(is_expired("e", dt.datetime(2015, 6, 1)).alias("x")).first().x, df.select(is_expired("e", dt.datetime(2015, 6, 1, 3)).alias("x")).first().x)
""" % os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], env=os.environ | {"TZ": "America/New_York"}, capture_output=True, text=True, timeout=200).stdout
    assert "EXPIRED False True" in out


def test_a_month_of_one_timestamp_is_spread(spark):
    when = dt.datetime(2015, 2, 3)
    posts = spark.createDataFrame([(f"FB-{i}", when, ["V"], "photo", None, None, None, None) for i in range(400)], S.POSTS)
    path = tempfile.mkdtemp(prefix="va-spread-") + "/posts"
    write_month_partitioned(posts, path, "posts", spread=16)
    assert len(glob.glob(path + "/month_key=2015-02/*.parquet")) > 1
    assert read_table(spark, "posts", path).count() == 400


def test_drill_downs_show_every_row(spark, capsys):
    from venue_analytics.plans.validate import main
    src, sink = tempfile.mkdtemp(prefix="va-dsrc-"), tempfile.mkdtemp(prefix="va-dout-")
    posts = [post_row(f"FB-{i}", [f"V{i}"], "01/02/15 10:00", kind="photo") for i in range(70)]
    places = [(f"P{i}", f"Place {i}", f"M{i}", [f"V{i}"]) for i in range(70)]
    merchants = [(f"M{i}", "m", (dt.datetime(2016, 1, 1),), {"twitter": [("1", f"handle{i}")]}) for i in range(70)]
    t = make_tables(spark, posts, places, merchants, [audit_row(1, "like", "02/02/15 10:00", "Noor", "FB-1")])
    for name in ("posts", "places", "merchants", "audits"):
        getattr(t, name).write.parquet(os.path.join(src, name))
    R.segments_map(t, "2015Feb", AS_OF).write.partitionBy("month").parquet(sink + "/segments")
    assert main([sink, "--source", src, "--month", "2015Feb"]) == 0
    out = capsys.readouterr().out
    assert "merchant_posts: 70 row(s)" in out and out.count("'n_posts': 1") == 70 and "'term': 'handle69'" in out
    assert main([sink, "--source", src, "--month", "2015Feb", "--out", sink + "/drill"]) == 0
    assert spark.read.parquet(sink + "/drill/merchant_posts").count() == 70


def test_fixed_values():
    assert S.SOURCES == ["FB", "IG", "TW", "4S", "WB"] and S.KINDS == ["photo", "video", "feed", "tip"]
    assert S.RATINGS == list("12345") and S.INTERACTION_TYPES == ["like", "reply", "int", "tag", "follow"]
    assert len(S.HOURS) == 24 and len(S.PUNCTUATION) == 16 and (S.MIN_WORD, S.MAX_WORD) == (3, 16)
    words = stop_words()
    assert len(words) == 541
    assert hashlib.sha256("\n".join(words).encode()).hexdigest() == STOP_WORDS


STOP_WORDS = "c00746eb87fdb02a9c0cb7689d6d630a79bbda33593d078689a70563e192916d"  # of the 541 words, one per line
