"""Mixing sources to target weights by hash-threshold histograms.

Every row has a 64-bit hash. A source whose target is ``k`` times its size plus a rest takes all rows
``k`` times and, once more, those whose hash lies under a threshold: thresholds of the first, second and
third copy are nested, so a smaller mix is a part of a larger one. The threshold comes from sums of
sizes by source and hash bucket: the bucket in which the running sum passes the rest is the boundary,
and only its rows are summed again by their next hash bits. Rows are never sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venue_analytics.llm.common import WHITE, cut, small, table, text_of

#: hash bits per histogram
BITS = 12
#: thresholds of up to so many sources are broadcast (counted before); more are joined by a shuffle
SOURCES_TO_BROADCAST = 10_000


def size_of(text: Column) -> Column:
    """Number of words."""
    return F.size(F.array_remove(F.split(text, WHITE), "")).cast("long")


def targets(sizes: DataFrame, weights=(5, 2, 1), cap: int = 3, share: float = 1.0) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes(source, source_size)``, one row per source.

    Sources in code-point order, null last, have ``weights``, repeating, and share ``share`` of all sizes.
    No target exceeds ``cap`` times its source's size; the excess is reshared by weight. The result of
    resharing until none is above is the level ``x`` at which the sums of min(cap * size, x * weight)
    fill the budget: with sources by the level they are full at, it is the first that is not passed.
    The windows run over one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    ahead = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    rows = (sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(cap))
            .withColumn("full_at", F.col("most") / F.col("weight"))
            .withColumn("all", F.sum("source_size").over(Window.partitionBy()) * share))
    level = (F.col("all") - F.coalesce(F.sum("most").over(ahead), F.lit(0.0))) / F.sum("weight").over(rest)
    rows = rows.withColumn("level", level)
    best = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(Window.partitionBy())["level"]
    return rows.select("source", "source_size", F.least(F.col("most"), F.coalesce(
        best * F.col("weight"), F.col("most"))).alias("target"))


def _prefix(bits: int) -> Column:
    return F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")


def thresholds(rows: DataFrame, weights=(5, 2, 1), cap: int = 3, share: float = 1.0) -> DataFrame:
    """Per source of ``rows(source, size, h)``: size, target, whole copies, and the threshold of the rest.

    ``prefix`` are the leading ``bits`` of the boundary hash; rows with smaller leading bits are taken,
    rows with equal ones when ``edge`` is true. ``rows`` is read once per histogram; pass it checkpointed."""
    sums = cut(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(cap).cast("long")))
    state = cut(targets(sums, weights, cap, share).withColumn("copies", F.coalesce(whole, F.lit(0).cast("long")))
                .withColumn("need", F.greatest(F.lit(0.0), F.col("target") - F.col("copies") * F.col("source_size")))
                .withColumn("prefix", F.lit(0).cast("long")).withColumn("edge", F.lit(False)))
    keep = ["source_size", "target", "copies"]
    bits = 0
    while bits < 64:
        step = min(BITS, 64 - bits)
        now = small(state, SOURCES_TO_BROADCAST).alias("s")
        inside = (rows.alias("r").join(now, F.col("r.source").eqNullSafe(F.col("s.source")) & (_prefix(bits) == F.col("s.prefix")))
                  .groupBy("r.source", _prefix(bits + step).alias("p"))
                  .agg(F.sum("r.size").alias("n"), F.min("h").alias("first"), F.max("h").alias("last")))
        by = Window.partitionBy("b.source").orderBy("b.p")
        summed = (inside.alias("b").join(now, F.col("b.source").eqNullSafe(F.col("s.source")))
                  .withColumn("upto", F.sum("b.n").over(by)))
        # the first bucket whose running sum passes the need; if none does, the last one
        boundary = F.min(F.struct((F.col("upto") <= F.col("need")).alias("late"),
                                  F.when(F.col("upto") > F.col("need"), F.col("b.p")).otherwise(-F.col("b.p")).alias("o"),
                                  F.col("b.p").alias("p"), F.col("n"), (F.col("upto") - F.col("n")).alias("under"),
                                  (F.col("first") == F.col("last")).alias("one")))
        state = cut(summed.groupBy(F.col("b.source").alias("source"), *keep, "need").agg(boundary.alias("e"))
                    .select("source", *keep, (F.col("need") - F.col("e.under")).alias("need"), F.col("e.p").alias("prefix"),
                            (2 * (F.col("need") - F.col("e.under")) >= F.col("e.n")).alias("edge"), F.col("e.one").alias("one")))
        bits += step
        if state.where(~F.col("one")).isEmpty():
            break
    return state.select("source", *keep, "prefix", "edge", F.lit(bits).alias("bits"))


def row_hash(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col), F.lit(11))


def _taken(limits: DataFrame) -> Column:
    bits = limits.select(F.max("bits")).first()[0] or 0
    mine = _prefix(bits)
    return F.col("copies") + ((mine < F.col("prefix")) | ((mine == F.col("prefix")) & F.col("edge"))).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=(5, 2, 1), cap: int = 3, share: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """The mix as ``(rows, limits)``: rows ``(id, source, size, source_size, target, copies)``, one per row of
    ``docs``, and the thresholds (one row per source).

    The size of a row is its number of words (null text: none). Null sources are a source of their own,
    the last. Rows alike in id and text have the same hash and are taken together (a large group of them
    can miss the target by half its size at most). An empty table gives empty results."""
    rows = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                           size_of(text_of(text_col)).alias("size"), row_hash(id_col, text_col).alias("h")))
    limits = thresholds(rows, weights, cap, share)
    got = (rows.alias("r").join(small(limits, SOURCES_TO_BROADCAST).alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
           .select("r.id", "r.source", "r.size", "s.source_size", "s.target", _taken(limits).alias("copies")))
    return got, limits


def repeat(docs: DataFrame, limits: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source") -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its copies say, in its own columns."""
    names = [F.col(f"d.`{c}`") for c in docs.columns]
    lim = small(limits.select(F.col("source").alias("__s"), "prefix", "edge", "copies"), SOURCES_TO_BROADCAST).alias("s")
    n = _taken(limits)
    mine = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), F.col(source_col).alias("__source"),
                       row_hash(id_col, text_col).alias("h"))
    return (mine.join(lim, F.col("__source").eqNullSafe(F.col("__s"))).withColumn("__n", n).where("__n > 0")
            .select("d", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n")))).select(*names))


# ------------------------------------------------------------------------------ query
def op3_mixing(spark, sf_dir):
    """All documents mixed to weights 5, 2, 1 by source, at most three times each source."""
    rows, _ = mix(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"))
