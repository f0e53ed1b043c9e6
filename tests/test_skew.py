"""A venue (and a post) holding a large share of the rows: the sort-merge joins are split by AQE's
skew handling, and the counts stay exact (no row dropped, capped or sampled)."""

import datetime as dt

import pytest

from conftest import make_tables
from venue_analytics.operators import reports as R

D = dt.datetime
FORCE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",           # what a cluster-size run plans
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",   # scaled to the test data
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skewed_session(spark):
    old = {k: spark.conf.get(k, None) for k in FORCE}
    for k, v in FORCE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df):
    df.collect()  # run on the DataFrame's own execution so its adaptive plan is final
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_venue_join_is_split_and_exact(skewed_session):
    spark = skewed_session
    places = [(f"P{i}", f"Place {i}", "M1", [f"V{i}"]) for i in range(50)]
    posts = []
    for i in range(20000):
        v = "V0" if i % 2 == 0 else f"V{1 + i % 49}"          # V0 holds half of all posts
        posts.append((f"FB-{i}", D(2015, 1, 1 + i % 28, i % 24), [v], "photo", None, f"FB-u{i % 97}", None, None))
    audits = [(f"A{i}", "interaction", "like", "M1", D(2015, 1, 28, 12), ("user", "o", f"U{i % 7}"),
               ("post", "FB-0", "p")) for i in range(3000)]    # one post holds every like
    t = make_tables(spark, posts, places, [("M1", "m", (D(2030, 1, 1),), None)], audits)

    content = R.content_types(t, "2015Jan", D(2015, 6, 1))
    plan = _final_plan(content)
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    got = {r.place_name: r.n for r in content.collect()}
    assert got["Place 0"] == 10000 and sum(got.values()) == 20000

    inter = R.interactions(t, "2015Jan", D(2015, 6, 1))
    rows = {(r.user, r.type): r.n for r in inter.collect()}
    assert rows == {(f"U{u}", ty): 1 for u in range(7) for ty in ("like", "int")}


def test_salted_venue_join_is_exact(spark):
    """With the venue join salted, every report equals the unsalted result (random tables)."""
    from test_brute_force import AS_OF as AS, MONTHS, random_tables
    from venue_analytics.operators.core import SALT_CONF
    posts, places, merchants, audits = random_tables(7)
    t = make_tables(spark, posts, places, merchants, audits)

    def run():
        out = {}
        for name, fn in R.LONG_REPORTS.items():
            if name != "response_times":
                for m in MONTHS:
                    out[(name, m)] = sorted(map(tuple, fn(t, m, AS).collect()), key=repr)
        return out
    plain = run()
    spark.conf.set(SALT_CONF, "4")
    try:
        salted = run()
        plan = R.content_types(t, MONTHS[0], AS)._jdf.queryExecution().optimizedPlan().toString()
        assert "_salt" in plan
    finally:
        spark.conf.unset(SALT_CONF)
    assert salted == plain


def test_runtime_bloom_filter_prunes_posts_for_response_times(spark, tmp_path):
    """Joining a month of audits to all posts: with the scan thresholds scaled to the fixture,
    Spark injects a runtime bloom filter on the posts side (no false negatives: same rows)."""
    from conftest import AS_OF, base_rows
    from venue_analytics.sources.readers import read_table
    t = make_tables(spark, *base_rows())
    for name in ("posts", "audits"):
        getattr(t, name).write.mode("overwrite").parquet(str(tmp_path / name))
    t.posts = read_table(spark, "posts", str(tmp_path / "posts"))
    t.audits = read_table(spark, "audits", str(tmp_path / "audits"))
    expected = sorted(map(tuple, R.response_times(t, "2015Jan").collect()))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1KB"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = R.response_times(t, "2015Jan")
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        got = sorted(map(tuple, df.collect()))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "might_contain" in plan
    assert got == expected
