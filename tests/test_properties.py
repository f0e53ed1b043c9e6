"""Properties: the keyword normaliser against a direct Python statement of its rules (brute
force on random texts), report totals against their parts, and segment totals."""

import string

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import AS_OF
from venue_analytics.functions.text import keyword_words, stop_words, text_strip
from venue_analytics.operators import checks as C
from venue_analytics.operators import reports as R
from venue_analytics.sources.schemas import PUNCTUATION

STOPS = set(stop_words())


def py_text_strip(text):
    """The normaliser's rules restated as a comprehension pipeline (test oracle)."""
    def unwrap(w):
        w = w[1:] if w[:1] in PUNCTUATION else w
        return w[:-1] if w[-1:] in PUNCTUATION else w
    raw = [w.lower() for w in text.split(" ")]
    trimmed = [unwrap(w) for w in raw if 3 <= len(w) <= 16]
    kept = [w for w in trimmed if len(w) >= 3 and "http" not in w and w not in STOPS]
    return list(dict.fromkeys(kept))          # first occurrence of each word, in order


def py_tokens(words):
    import re
    return [t for t in re.split(r'[ ",()*]+', " ".join(words)) if t]


ALPHABET = string.ascii_letters[:10] + "Thé" + PUNCTUATION + " #@\n" + "ab"
WORDS = st.one_of(st.text(alphabet=ALPHABET, min_size=0, max_size=20), st.sampled_from(sorted(STOPS)[:50]),
                  st.sampled_from(["http://x", "The", "cat", "Cat!", "(dog)", "foo,bar"]))
TEXTS = st.lists(WORDS, min_size=0, max_size=12).map(" ".join)


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXTS, min_size=1, max_size=60))
def test_text_strip_matches_rules(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: (r.w, r.k) for r in df.select("i", text_strip("t").alias("w"), keyword_words("t").alias("k")).collect()}
    for i, t in enumerate(texts):
        words = py_text_strip(t)
        assert got[i][0] == words, t
        assert got[i][1] == py_tokens(words), t


def test_totals_are_sums(base):
    c = R.content_types(base, None, AS_OF)
    bad = (c.groupBy("merchant_id", "place_name", "post_month")
           .agg(F.sum("n").alias("s"), F.first("total").alias("t")).filter("s <> t"))
    assert bad.count() == 0
    for r in R.content_types_map(base, None, AS_OF).collect():
        assert r.total == sum(n for inner in r.counts.values() for n in inner.values())


def test_segment_hours_sum_to_total(base):
    assert C.segment_violations(R.segments_map(base, None, AS_OF)).count() == 0
