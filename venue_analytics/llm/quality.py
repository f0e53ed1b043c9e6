"""Quality rules as a short-circuit cascade, ordered by rejections per cost.

Each rule's cost (seconds per row) and selectivity (share of rows it rejects) are measured on a bounded
sample; rules then stand in one CASE in descending order of rejections per second, so a document that a
cheap, effective rule rejects never reaches the dear ones. The order changes what is evaluated, never
the verdict: a document is kept when no rule rejects it. All rules are built-in column expressions.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venue_analytics.llm.common import bounded_sample, cut, let, table, text_of, words_of

SYMBOLS = "[#*$%&|<>]+"


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long")


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def lines_with_word(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    return let(lines_with_word(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _covered(hashes: Column) -> Column:
    """Words covered by three-word windows whose hash occurs twice or more: hashes are sorted with their
    places, equal neighbours mark places, and the marked places (sorted) each add up to three words."""
    dealt = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    marked = let(dealt, lambda s: F.sort_array(F.transform(
        F.filter(s, lambda e, j: F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False))
                 | F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False))), lambda e: e["p"])))
    return let(marked, lambda p: F.aggregate(
        F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x))


def n_repeat_words(words: Column) -> Column:
    """Words in three-word windows found at least twice in the text, the first occurrence included.

    Windows are compared by a 64-bit hash of their words."""
    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                             lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                   .otherwise(_covered(h)))
        return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(some)
    return let(words, of)


@dataclass(frozen=True)
class Rule:
    """``rejects(text, words)`` is true for documents the rule rejects; ``words`` is the word array."""
    name: str
    rejects: Callable[[Column, Column], Column]


def _letters(text: Column, kept: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{kept}]+", ""))


#: base rules first; any order gives the same verdict
RULES = (
    Rule("few_words", lambda t, w: F.size(w) < 50),
    Rule("repeated_words", lambda t, w: 100 * n_repeat_words(w) > 50 * F.size(w)),
    Rule("symbols", lambda t, w: 10 * n_symbols(t) > F.size(w)),
    Rule("repeated_lines", lambda t, w: let(lines_with_word(t), lambda x:
                                            2 * (F.size(x) - F.size(F.array_distinct(x))) > F.size(x))),
    Rule("upper_case", lambda t, w: 2 * _letters(t, "A-Z") > _letters(t, "A-Za-z")),
    Rule("word_length", lambda t, w: (word_chars(w) > 15 * F.size(w)) | (word_chars(w) < 2 * F.size(w))),
)


def order_rules(df: DataFrame, text_col: str = "text", rules=RULES, sample_rows: int = 1000,
                key: Column | None = None) -> list[Rule]:
    """``rules`` by rejections per second on a sample of about ``sample_rows`` rows (at most twice that).

    ``key`` picks the sample by hash; the text by default. An empty table leaves the order as it is."""
    text = text_of(text_col)
    sample = cut(bounded_sample(df, F.col(text_col) if key is None else key, sample_rows)
                 .select(text.alias("t"), words_of(text).alias("w")))
    rows = sample.count()
    if rows == 0:
        return list(rules)

    def timed(col: Column) -> tuple[float, int]:
        began = time.perf_counter()
        n = sample.agg(F.count_if(col).alias("n")).first()["n"]
        return time.perf_counter() - began, n
    timed(F.lit(True))
    scan = timed(F.lit(True))[0]
    rank = {}
    for r in rules:
        seconds, hit = timed(F.coalesce(r.rejects(F.col("t"), F.col("w")), F.lit(False)))
        rank[r.name] = hit / max(seconds - scan, 0.001)
    return sorted(rules, key=lambda r: -rank[r.name])


def rejected_by(rules, text: Column, words: Column) -> Column:
    """Name of the first rule, in the order given, that rejects; null for a kept document."""
    col = F
    for r in rules:
        col = col.when(r.rejects(text, words), F.lit(r.name))
    return col


def quality_filter(df: DataFrame, text_col: str = "text", rules=RULES, sample_rows: int = 1000,
                   flag: str | None = None, key: Column | None = None) -> DataFrame:
    """The rows of ``df`` that no rule rejects; with ``flag``, all rows and a boolean column of that name
    (replacing a column that has it) that tells the kept ones.

    Null and empty texts have no words, so ``few_words`` rejects them. Repeated rows are judged alike;
    other columns, whatever their names, pass through."""
    ordered = order_rules(df, text_col, rules, sample_rows, key)
    # the words are bound once for the whole cascade: a filter is pushed into the scan's stage with its
    # expressions written out
    keep = let(words_of(text_of(text_col)), lambda w: rejected_by(ordered, text_of(text_col), w).isNull())
    if flag is None:
        return df.where(keep)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != flag], keep.alias(flag))


# ------------------------------------------------------------------------------ query
def op10_quality(spark, sf_dir):
    """Counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = text_of("text")
    got = (quality_filter(docs, flag="kept", key=F.col("doc_id"))
           .select("doc_id", "kept", text.alias("t"), words_of(text).alias("w"))
           .select("doc_id", "kept", F.size("w").cast("long").alias("n_words"), word_chars(F.col("w")).alias("word_chars"),
                   n_symbols(F.col("t")).alias("n_symbols"), n_dup_lines(F.col("t")).alias("n_dup_lines"),
                   n_repeat_words(F.col("w")).alias("n_repeat_words")))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
                      .alias("base_failed"), "kept")


OP10_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT rid, unnest(list_transform(range(1, len(w) - 1), lambda i: {'p': i, 'g': [w[i], w[i + 1], w[i + 2]]})) AS e FROM w),
m AS (SELECT rid, e.p AS p, count(*) OVER (PARTITION BY rid, e.g) AS c FROM g),
c AS (SELECT rid, least(3, coalesce(lead(p) OVER (PARTITION BY rid ORDER BY p) - p, 3)) AS k FROM m WHERE c > 1),
r AS (SELECT rid, sum(k) AS n FROM c GROUP BY rid),
s AS (SELECT doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines,
             CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
             length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS up, length(regexp_replace(t, '[^A-Za-z]+', '', 'g')) AS az
      FROM w LEFT JOIN r USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 2 * up > az
            OR word_chars > 15 * n_words OR word_chars < 2 * n_words) AS kept
FROM b"""
