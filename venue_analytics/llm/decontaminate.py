"""Benchmark decontamination over a positional inverted index of the training words.

A benchmark item is cut into windows of consecutive words. Word counts over all documents tell each
window's rarest distinct words, its anchors; a window with a word that no document has can't occur and
goes at once. The index holds a posting ``(term, key, pos)`` for every place of an anchor term in the
documents, dealt as the documents are, so a hot term's list lies in as many pieces as there are scan
tasks. Phrases: the list of a window's rarest anchor, moved back by its offset, gives the places where
the window may start; it is intersected with the next anchor's list, moved likewise. Proximity: the
lists are intersected by overlapping cells of the document instead. Only documents with candidates are
read again, and each candidate is verified on the document's words.

A document is known by its id and 128 bits of hash of its text; rows alike in both share their postings
and each get the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venue_analytics.llm.common import cut, let, lower_az, small, stored, table, text_of

#: what separates words: ASCII other than digits and letters
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: words of a window
WINDOW = 10
#: rarest distinct words of a window that its lists are intersected of
ANCHORS = 2
#: consecutive document words within which a proximity match has all words of a window
SPAN = 20
#: rows up to which test terms, anchors and keys of candidate documents are broadcast (counted first); beyond, the
#: join is shuffled
BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    """Words in the order they stand, case kept."""
    return F.array_remove(F.split(text, GAP), "")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b")).alias("key"),
                       text.alias("text"))


def windows_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``(win, text, words)``, the distinct windows of all items, numbered, and ``(item, win)``, whose they are.

    ``text`` is the words joined by blanks. An item of fewer words is one window, one of none has no window."""
    held = items.select(F.col(id_col).alias("item"), lower_az(text_of(text_col)).alias("text")).select("item", words_of(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    held = held.where(F.size("w") > 0).select("item", "w", F.explode(starts).alias("at"))
    held = cut(held.select("item", F.array_join(F.slice("w", F.col("at") + 1, window), " ").alias("text")).distinct())
    windows = cut(held.select("text").distinct().select(F.monotonically_increasing_id().alias("win"), "text"))
    return windows.withColumn("words", F.split("text", " ")), held.join(windows, "text").select("item", "win")


def tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(key, pos, term)``: every word of every document, lazily."""
    held = _keyed(docs, id_col, text_col).select("key", F.posexplode(words_of(F.col("text"))).alias("pos", "word"))
    return held.select("key", "pos", lower_az(F.col("word")).alias("term"))


def document_counts(docs: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """``(term, n)``: places of each of ``terms(term)`` in all documents; a term without any is left out."""
    held = docs.select(F.explode(words_of(text_of(text_col))).alias("word")).select(lower_az(F.col("word")).alias("term"))
    return held.join(small(terms, BROADCAST_ROWS), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def build_index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index: ``(term, key, pos)`` postings of ``terms(term)``, stored in the shared folder, every piece sorted
    by term."""
    posted = tokens(docs, id_col, text_col).join(small(terms, BROADCAST_ROWS), "term", "left_semi")
    return stored(posted.select("term", "key", "pos").sortWithinPartitions("term", "key", "pos"))


def anchors(windows: DataFrame, counts: DataFrame, most: int = ANCHORS) -> DataFrame:
    """``(win, j, offset, term)``: the rarest distinct words of each window, by count, then offset, numbered from 0.

    Windows with a word that isn't counted are left out: they can't occur."""
    each = windows.select("win", F.size("words").alias("size"), F.posexplode("words").alias("offset", "term"))
    known = each.join(counts, "term").groupBy("win", "term").agg(F.max("n").alias("n"), F.min("offset").alias("offset"), F.count("*").alias("k"),
                                                                 F.max("size").alias("size"))
    rare = (known.groupBy("win").agg(F.sum("k").alias("k"), F.max("size").alias("size"), F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("t"))
            .where("k = size").select("win", F.posexplode(F.slice("t", 1, most)).alias("j", "t")))
    return rare.select("win", "j", F.col("t.offset").alias("offset"), F.col("t.term").alias("term"))


def _intersected(index: DataFrame, anchored: DataFrame, places, wanted, most: int) -> DataFrame:
    """``(key, win, at)`` that every anchor of a window supports, from the rarest anchor's list on.

    ``places(pos, offset)`` is the array of places that a posting speaks for; ``wanted(at, offset)`` the place
    of a next anchor's posting, among ``places(pos, 0)`` of that anchor."""
    first = small(anchored.where("j = 0").select("win", "offset", "term"), BROADCAST_ROWS)
    held = index.join(first, "term").select("key", "win", F.explode(places(F.col("pos"), F.col("offset"))).alias("at")).where("at >= 0")
    for j in range(1, most):
        more = small(anchored.where(F.col("j") == j).select("win", "offset", "term"), BROADCAST_ROWS)
        lists = (index.join(small(anchored.where(F.col("j") == j).select("term").distinct(), BROADCAST_ROWS), "term", "left_semi")
                 .select("key", "term", F.explode(places(F.col("pos"), F.lit(0))).alias("place")))
        kept = (held.join(more, "win").select("key", "win", "at", "term", wanted(F.col("at"), F.col("offset")).alias("place"))
                .join(lists, ["key", "term", "place"], "left_semi").select("key", "win", "at"))
        held = kept.unionByName(held.join(more, "win", "left_anti"))  # windows of fewer distinct words have no such anchor
    return held


def phrase_candidates(index: DataFrame, anchored: DataFrame, most: int = ANCHORS) -> DataFrame:
    """``(key, win, at)``: word places where all anchors of a window stand at their offsets."""
    return _intersected(index, anchored, lambda pos, offset: F.array(pos - offset), lambda at, offset: at + offset, most)


def proximity_candidates(index: DataFrame, anchored: DataFrame, span: int = SPAN, most: int = ANCHORS) -> DataFrame:
    """``(key, win, at)``: cells that hold all anchors of a window. Cell ``at`` is the words from ``at * span``
    on, twice ``span`` of them, so any ``span`` consecutive words lie in one."""
    def cells(pos, _):
        cell = F.floor(pos / span).cast("int")
        return F.array(cell, F.greatest(cell - 1, F.lit(0)))
    return _intersected(index, anchored, cells, lambda at, offset: at, most)


def _near(words: Column, at: Column, win: Column, span: int) -> Column:
    """True if ``span`` consecutive words of cell ``at`` hold all words of the window."""
    def within(cell: Column) -> Column:
        return F.when(F.size(F.array_except(win, cell)) > 0, False).otherwise(F.exists(
            F.sequence(F.lit(0), F.greatest(F.size(cell) - span, F.lit(0))),
            lambda p: F.size(F.array_except(win, F.slice(cell, p + 1, F.lit(span)))) == 0))
    return let(F.slice(words, at * span + 1, F.lit(2 * span)), within)


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", window: int = WINDOW, span: int = SPAN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(phrases, near, owners)``; the first two have the documents with matches, by ``key(id, a, b)``, the last
    ``(item, win)``.

    ``phrases(key, n_hit, wins)``: document words inside an occurrence of a window, and the windows that
    occur. ``near(key, wins)``: windows whose words all stand, in any order, within ``span`` consecutive
    words. Both are verified on the whole text. Case: only A-Z are lowered. Null texts have no words;
    other columns of ``docs`` and ``items`` are not read, whatever their names."""
    windows, owners = windows_of(items, item_col, item_text_col, window)
    terms = windows.select(F.explode("words").alias("term")).distinct()
    counts = cut(document_counts(docs, terms, text_col))
    anchored = cut(anchors(windows, counts))
    index = build_index(docs, anchored.select("term").distinct(), id_col, text_col)
    found = (phrase_candidates(index, anchored).select("key", "win", "at", F.lit(0).alias("kind"))
             .unionAll(proximity_candidates(index, anchored, span).distinct().select("key", "win", "at", F.lit(1).alias("kind"))))
    found = found.join(small(windows.select("win", "text"), BROADCAST_ROWS), "win")
    # a place has one window of each length, so a document's list is no longer than a few times its text
    listed = cut(found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("at", "kind", "win", "text"))).alias("found")))
    # documents without candidates go before any text is shuffled
    some = _keyed(docs, id_col, text_col).join(small(listed.select("key"), BROADCAST_ROWS), "key", "left_semi")
    held = some.join(listed, "key").select("key", "found", words_of(lower_az(F.col("text"))).alias("words"))

    def of(words: Column) -> Column:
        exact = F.filter("found", lambda c: (c["kind"] == 0) & (
            F.array_join(F.slice(words, c["at"] + 1, F.size(F.split(c["text"], " "))), " ") == c["text"]))
        near = F.filter("found", lambda c: (c["kind"] == 1) & _near(words, c["at"], F.split(c["text"], " "), span))
        return F.struct(exact.alias("exact"), near.alias("near"))
    held = cut(held.select("key", let(F.col("words"), of).alias("m")).select("key", "m.exact", "m.near")
               .where("size(exact) > 0 OR size(near) > 0").dropDuplicates(["key"]))

    def covered(acc: Column, c: Column) -> Column:
        end = c["at"] + F.size(F.split(c["text"], " "))
        return F.struct((acc["n"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], c["at"]))).alias("n"), F.greatest(acc["end"], end).alias("end"))
    n_hit = F.aggregate("exact", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), covered, lambda acc: acc["n"].cast("long"))
    wins = lambda c: F.array_distinct(F.transform(c, lambda x: x["win"])).alias("wins")
    return (held.where("size(exact) > 0").select("key", n_hit.alias("n_hit"), wins("exact")),
            held.where("size(near) > 0").select("key", wins("near")), owners)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, span: int = SPAN) -> DataFrame:
    """``(id, n_words, n_hit, items, near)``, one row per row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of a window; ``items`` and ``near`` are the sorted
    ids, as strings, of the items with occurring windows and with windows whose words stand within
    ``span`` consecutive words. An item id given twice is one item with the windows of both; windows of
    items without an id mark words but name no item. Null and empty texts have no words and no match;
    repeated rows each get their row; empty tables give no rows or no matches."""
    phrases, near, owners = matches(docs, items, id_col, text_col, item_col, item_text_col, window, span)
    named = owners.where("item is not null").select(F.col("item").cast("string").alias("item"), "win")

    def ids(rows: DataFrame, out: str) -> DataFrame:
        return (rows.select("key", F.explode("wins").alias("win")).join(named, "win").select("key", "item").distinct()
                .groupBy("key").agg(F.array_sort(F.collect_list("item")).alias(out)))
    none = F.array().cast("array<string>")
    found = (phrases.select("key", "n_hit").join(ids(phrases, "items"), "key", "left").join(ids(near, "near"), "key", "full"))
    words = _keyed(docs, id_col, text_col).select("key", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    got = words.join(cut(found), "key", "left")
    return got.select(F.col("key.id").alias("id"), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                      F.coalesce("items", none).alias("items"), F.coalesce("near", none).alias("near"))


# ------------------------------------------------------------------------------ query
def op12_decontamination(spark, sf_dir):
    """Benchmark passages in all documents: windows of ten words, and near matches within twenty."""
    got = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
                      F.size("near").cast("long").alias("n_near"))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP12_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k,
                  regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wi AS (SELECT DISTINCT item_id, w[a + 1:a + {WINDOW}] AS words FROM (
         SELECT item_id, w, unnest(range(0, greatest(len(w) - {WINDOW}, 0) + 1)) AS a FROM b WHERE len(w) > 0)),
win AS (SELECT *, row_number() OVER () AS v, len(words) AS n FROM (SELECT DISTINCT words FROM wi)),
g AS (SELECT k, s, w[s + 1:s + n] AS words, n FROM (
        SELECT k, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT k, s, g.n, v FROM g JOIN win ON g.words = win.words),
hits AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(s, s + n)) AS p FROM hit) GROUP BY k),
items AS (SELECT k, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (
            SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS i FROM hit JOIN win USING (v) JOIN wi ON wi.words = win.words
            WHERE item_id IS NOT NULL) GROUP BY k),
vw AS (SELECT DISTINCT v, unnest(words) AS word FROM win),
m AS (SELECT v, count(*) AS m FROM vw GROUP BY v),
p AS (SELECT k, word, s FROM (SELECT k, unnest(w) AS word, unnest(range(0, len(w))) AS s FROM d) WHERE word IN (SELECT word FROM vw)),
full_sets AS (SELECT k, v FROM (SELECT DISTINCT k, word FROM p) JOIN vw USING (word) JOIN m USING (v) GROUP BY k, v, m HAVING count(*) = m),
near AS (SELECT DISTINCT k, v FROM (
           SELECT k, v, count(DISTINCT word) OVER (PARTITION BY k, v ORDER BY s RANGE BETWEEN CURRENT ROW AND {SPAN - 1} FOLLOWING) AS c
           FROM full_sets JOIN vw USING (v) JOIN p USING (k, word)) JOIN m USING (v) WHERE c = m),
nears AS (SELECT k, count(DISTINCT item_id) AS n_near FROM near JOIN win USING (v) JOIN wi ON wi.words = win.words GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN hits USING (k) LEFT JOIN items USING (k) LEFT JOIN nears USING (k)"""
