"""Source divergence audit: how the sources of a language differ in their terms.

CountVectorizer per language, with minDF and the largest integer as vocabSize: its fit (terms in at least
minDF documents of the language) and its exact sparse vectors, for all languages in one pass. The class
itself gathers each vocabulary on the driver and broadcasts it, which nothing bounds, so the same is
written over rows: a vector is held as its coordinates, one row per document and term, and the
vocabulary is a table. Group sums of the vectors are sums of coordinates, added up where the documents
lie before they are shuffled. Pairs of sources are compared sparsely: only terms that both sources have
meet in a join; a term of one source alone depends on its count only and comes from the source's
histogram of counts; terms of neither are one product.

Shares are kept as integers of a billionth, p = 1 + floor(10^9 (count + 2) / (N + 2 V)), and two shares
differ by f = floor((p - q)^2 / (p + q)). All arithmetic is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venue_analytics.llm.common import cut, lower_az, numbered, stored, table

#: what separates terms: ASCII other than letters
GAP = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DF = 10
#: terms that a language may keep; more is an error, never a cut
VOCAB_SIZE = 2 ** 31 - 1
#: ranks of the distinguishing terms of a group
TOP = 10


def _texts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in
                         ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])


def group_sums(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(lang, source, term, n, df)``: the summed document vectors of every group and the number of its
    documents with the term, over all terms."""
    words = F.split(lower_az(F.col("text")), GAP)
    held = _texts(docs, lang_col, source_col, text_col).select("lang", "source", words.alias("w"))
    # each document's terms as they stand (for the counts) and once each (for the document frequencies)
    both = F.array(F.struct(F.col("w"), F.lit(0).alias("once")), F.struct(F.array_distinct("w").alias("w"), F.lit(1).alias("once")))
    rows = held.select("lang", "source", F.explode(both).alias("c")).select("lang", "source", F.col("c.once").alias("once"), F.explode("c.w").alias("term"))
    return (rows.where("term <> ''").groupBy("lang", "source", "term")
            .agg(F.sum(F.lit(1) - F.col("once")).alias("n"), F.sum("once").cast("long").alias("df")))


def fit(sums: DataFrame, min_df: int = MIN_DF) -> DataFrame:
    """``(lang, term, n)``: the vocabulary of every language, terms in at least ``min_df`` of its documents."""
    return sums.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")).where(F.col("df") >= min_df).select("lang", "term", "n")


def document_vectors(docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``(id, lang, size, indices, values)``: the sparse vector of every document with a kept term.

    Indices number a language's terms from 0 by falling count, then term, as ``fit`` counts them;
    ``indices`` rise. Rows alike in id, language and text share a vector."""
    order = [F.col("n").desc(), F.col("term").asc()]
    index = numbered(vocabulary, ["lang"], order, "at").select("lang", "term", (F.col("at") - 1).cast("int").alias("index"))
    sizes = vocabulary.groupBy("lang").agg(_checked(F.count("*")).cast("int").alias("size"))
    held = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    held = held.select("id", "lang", F.sha2("text", 256).alias("sha"), F.explode(F.split(lower_az(F.col("text")), GAP)).alias("term")).where("term <> ''")
    cells = held.groupBy("id", "lang", "sha", "term").agg(F.count("*").alias("n")).join(index, ["lang", "term"])
    rows = cells.groupBy("id", "lang", "sha").agg(F.array_sort(F.collect_list(F.struct("index", "n"))).alias("c"))
    return rows.join(sizes, "lang").select("id", "lang", "size", F.col("c.index").alias("indices"), F.col("c.n").alias("values"))


def _checked(v: Column) -> Column:
    return F.when(v > VOCAB_SIZE, F.raise_error(F.lit("more kept terms than an integer vocabSize holds"))).otherwise(v)


def _share(n: Column, total: Column, v: Column) -> Column:
    """p of a count, exact: the quotient is taken in decimals of 38 digits."""
    top = F.lit(10 ** 9).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return F.call_function("div", top, (total + 2 * v).cast("decimal(20,0)")) + 1


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_df: int = MIN_DF,
               top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of every group of language and source.

    Part ``pair``: the other sources of the language by falling difference summed over all kept terms (0
    without any). Part ``term``: the ``top`` kept terms of the group by falling f against the language's
    own share, of those whose share in the group is greater. Ties go by item. Null language, source and
    text are empty; an empty text counts as a document without terms, and its group is compared too; an
    empty table gives no rows. Other columns are not read, whatever their names."""
    sums = stored(group_sums(docs, lang_col, source_col, text_col))
    vocabulary = stored(fit(sums, min_df))
    sizes = vocabulary.groupBy("lang").agg(_checked(F.count("*")).alias("v"), F.sum("n").alias("lang_total"))
    kept = sums.select("lang", "source", "term", "n").join(vocabulary.select("lang", "term", F.col("n").alias("lang_n")), ["lang", "term"])
    kept = stored(kept)
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = (_texts(docs, lang_col, source_col, text_col).select("lang", "source").distinct()
              .join(totals, ["lang", "source"], "left").join(sizes, "lang", "left"))
    groups = cut(groups.select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("v", zero).alias("v"),
                               F.coalesce("lang_total", zero).alias("lang_total"))
                 .withColumn("p0", F.when(F.col("v") > 0, _share(zero, F.col("total"), F.col("v")))))
    shares = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", _share(F.col("n"), F.col("total"), F.col("v")).alias("p"), "p0",
        _share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"))
    shares = stored(shares)

    # terms that both sources have, each beside what the histograms count for it
    c = F.col
    left, right = (shares.select("lang", "term", c("source").alias(f"s{k}"), c("p").alias(f"p{k}"), c("p0").alias(f"z{k}")) for k in "ab")
    common = (left.join(right, ["lang", "term"]).where("sa < sb").select("lang", "sa", "sb", (
        _f(c("pa"), c("pb")) - _f(c("pa"), c("zb")) - _f(c("za"), c("pb")) + _f(c("za"), c("zb"))).alias("value"))
        .groupBy("lang", "sa", "sb").agg(F.sum("value").alias("value")))
    # terms of one source, by count; then the terms of neither
    others = groups.select("lang", c("source").alias("sb"), c("p0").alias("zb"), "v")
    counts = shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("k"))
    single = (counts.join(others, "lang").where("source <> sb")
              .select("lang", c("source").alias("sa"), "sb", (c("k") * (_f(c("p"), c("zb")) - _f(c("p0"), c("zb")))).alias("value"))
              .groupBy("lang", "sa", "sb").agg(F.sum("value").alias("value")))
    base = (groups.select("lang", c("source").alias("sa"), "p0").join(others, "lang").where("sa <> sb")
            .select("lang", "sa", "sb", F.when(c("v") > 0, c("v") * _f(c("p0"), c("zb"))).otherwise(0).alias("value")))
    turned = [x.select("lang", c("sb").alias("sa"), c("sa").alias("sb"), "value") for x in (common, single)]
    pairs = base
    for x in (common, single, *turned):
        pairs = pairs.unionAll(x.select("lang", "sa", "sb", "value"))
    pairs = pairs.groupBy("lang", "sa", "sb").agg(F.sum("value").alias("value")).select("lang", c("sa").alias("source"), c("sb").alias("item"), "value")
    terms = shares.where("p > q").select("lang", "source", c("term").alias("item"), _f(c("p"), c("q")).alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(c("value").desc(), c("item"))

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(by).alias("rank"))
    return ranked(pairs, "pair").unionAll(ranked(terms, "term").where(c("rank") <= top))


# ------------------------------------------------------------------------------ query
def op11_divergence(spark, sf_dir):
    """Pairs of sources and distinguishing terms of all documents, by language."""
    return divergence(table(spark, sf_dir, "documents"))


OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(DISTINCT k) >= {MIN_DF}),
s AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t JOIN (SELECT lang, term FROM kept) USING (lang, term) GROUP BY lang, source, term),
vs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
tot AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM grp LEFT JOIN s USING (lang, source) GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(s.n, 0) AS n, 1 + (1000000000 * (coalesce(s.n, 0) + 2)) // (tot.total + 2 * v) AS p,
             1 + (1000000000 * (kept.n + 2)) // (vs.total + 2 * v) AS q
      FROM tot JOIN vs USING (lang) JOIN kept USING (lang) LEFT JOIN s USING (lang, source, term)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
          FROM grp g JOIN grp h ON g.lang = h.lang AND g.source <> h.source
          LEFT JOIN pair ON pair.lang = g.lang AND pair.source = g.source AND pair.item = h.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM p WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
               FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= {TOP}"""
