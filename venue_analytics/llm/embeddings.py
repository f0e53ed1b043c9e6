"""Embedding near-duplicates by spherical-cap filters from structured random product codes.

Vectors are rotated at random and cut into blocks; each block has a small code of random unit vectors. A
filter direction is a choice of one code word per block, so few code words span many filters. Each vector
is list-decoded to all filters whose direction it exceeds the cap's threshold with: partial sums over
blocks are dropped as soon as the best possible rest can't reach it. Vectors of a label that share a
filter are candidates and are verified by their cosine in double precision.

The caps are as fine as the rows of a label ask for: with ``words`` code words in each of three blocks,
doubled until a vector shares a filter with about ``PARTNERS`` unrelated ones at most, and with more filters
per vector the finer they are, so that links are found alike. Over random pairs of 64 entries at cosine
0.931, at least 0.98 of the pairs share a filter at every size (measured; see tests): with 64, 128, 256, 512
and 1,024 words a vector has about 29, 37, 57, 87 and 134 filters, and two unrelated vectors share one
with a probability of 0.0033, 0.0006, 0.0002, 0.00007 and 0.00002.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venue_analytics.llm.common import cut, ship, table
from venue_analytics.llm.components import connected_components

BLOCKS, SEED = 3, 42
#: coarsest code: its words per block, filters per vector, and the share of unrelated vectors that meet
WORDS, FILTERS, MEET = 64, 24, 0.0033
#: with twice the words a vector has so many times the filters, and unrelated vectors meet so many times as often
MORE_FILTERS, MEET_LESS = 2 ** 0.62, 2 ** -1.8
#: unrelated vectors of its label that a vector may meet, about
PARTNERS = 4


def words_for(rows: int) -> int:
    """Code words per block for a label of so many distinct vectors."""
    words, meet = WORDS, MEET
    while rows * meet > PARTNERS:
        words, meet = 2 * words, meet * MEET_LESS
    return words


class ProductCode:
    """Random rotation and block codes for vectors of ``dim`` entries; the same for the same arguments.

    ``least`` (filters per vector) follows from ``words``, and ``threshold`` from both: a random direction is
    about normal, and so many of all directions exceed it."""

    def __init__(self, dim: int, blocks: int = BLOCKS, words: int = 2 * WORDS, threshold: float | None = None,
                 least: int | None = None, seed: int = SEED):
        blocks = min(blocks, dim)
        if least is None:
            least = round(FILTERS * MORE_FILTERS ** np.log2(words / WORDS))
        if threshold is None:
            threshold = NormalDist().inv_cdf(max(1 - least / words ** blocks, 0.5)) / np.sqrt(dim)
        rng = np.random.default_rng([seed, dim])
        self.turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.cuts = [part for part in np.array_split(np.arange(dim), blocks)]
        self.code = []
        for part in self.cuts:
            c = rng.standard_normal((words, len(part)))
            self.code.append(c / np.linalg.norm(c, axis=1, keepdims=True) / np.sqrt(len(self.cuts)))
        self.words, self.threshold, self.least = words, threshold, least

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Filters of each row of ``unit``, best first: every direction whose product with the row is at least
        the threshold, lowered for a row that exceeds fewer than ``least`` directions to its ``least``-th best."""
        turned = unit @ self.turn
        sums = [turned[:, part] @ c.T for part, c in zip(self.cuts, self.code)]
        tops = np.array([s.max(axis=1) for s in sums])
        rest = np.vstack([np.cumsum(tops[::-1], axis=0)[::-1][1:], np.zeros((1, len(unit)))])
        return [self._row([s[k] for s in sums], rest[:, k]) for k in range(len(unit))]

    def _row(self, sums: list[np.ndarray], rest: np.ndarray) -> np.ndarray:
        best = sums[0].max() + rest[0]
        need = min(self.threshold, best)
        while True:
            total, name = np.zeros(1), np.zeros(1, dtype=np.int64)
            for s, r in zip(sums, rest):
                total = (total[:, None] + s[None, :]).ravel()
                stay = np.flatnonzero(total >= need - r - 1e-12)
                name = name[stay // self.words] * self.words + stay % self.words
                total = total[stay]
            if len(name) >= min(self.least, self.words ** len(sums)):
                break
            need -= 0.02
        order = np.argsort(-total, kind="stable")
        return name[order[:max(self.least, int((total >= self.threshold).sum()))]]


def vector_classes(rows: DataFrame) -> DataFrame:
    """``(label, key, n, low, unit)`` of the distinct usable vectors of ``rows(id, label, vec)``: number of rows,
    smallest id, and the vector of length one. Unusable: a null label or vector, a null or non-finite entry, zero."""
    usable = rows.where(F.col("label").isNotNull() & F.col("vec").isNotNull()
                        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                        & F.exists("vec", lambda x: x != 0))
    grouped = (usable.withColumn("key", _key()).groupBy("label", "key")
               .agg(F.count("*").alias("n"), F.min("id").alias("low"), F.first("vec").alias("vec")))
    peak = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    scaled = grouped.select("label", "key", "n", "low", F.transform("vec", lambda x: x / peak).alias("vec"))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    return scaled.select("label", "key", "n", "low", "vec", norm.alias("norm")).select(
        "label", "key", "n", "low", F.transform("vec", lambda x: x / F.col("norm")).alias("unit"))


def _key():
    """Name of a vector with its label, the same for equal ones."""
    return F.md5(F.concat_ws("|", F.col("label").cast("string"), F.col("vec").cast("string")))


#: best filters of a vector that go along with each of its filters
TOPS = ("t0", "t1", "t2")


def filters(classes: DataFrame, **code) -> DataFrame:
    """``(label, dim, filter, key, t0, t1, t2)``: one row per filter of each class, with its best ones."""
    ship(classes.sparkSession)
    kind = classes.schema["label"].dataType.simpleString()

    def run(batches):
        codes: dict[int, ProductCode] = {}
        for b in batches:
            ends, flat = b.column(2).offsets.to_numpy(), b.column(2).values.to_numpy(zero_copy_only=False)
            dims = np.diff(ends)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                own = codes.setdefault(int(dim), ProductCode(int(dim), **code))
                got = own.decode(np.stack([flat[ends[i]:ends[i + 1]] for i in at]))
                sizes = [len(g) for g in got]
                rows = pa.array(np.repeat(at, sizes))
                tops = [pa.array([int(g[i]) if i < len(g) else None for g in got], pa.int64()).take(pa.array(np.repeat(np.arange(len(got)), sizes)))
                        for i in range(len(TOPS))]
                yield pa.RecordBatch.from_arrays([b.column(0).take(rows), pa.array(np.full(len(rows), dim), pa.int32()),
                                                  pa.array(np.concatenate(got), pa.int64()), b.column(1).take(rows), *tops],
                                                 names=["label", "dim", "filter", "key", *TOPS])
    return classes.select("label", "key", "unit").mapInArrow(
        run, f"label {kind}, dim int, filter bigint, key string, " + ", ".join(f"{t} bigint" for t in TOPS))


def class_links(classes: DataFrame, cosine: float = 0.93, **code) -> DataFrame:
    """``(u, v)``, u < v, of the classes of one label that share a filter and have at least this cosine.

    Unless ``code`` names ``words``, the largest label's number of classes sets them. A pair whose best filters
    meet, as near copies' do, is made at the smallest of those they share alone; any other at each filter it
    shares, and once after."""
    if "words" not in code:
        most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
        code = {**code, "words": words_for(most)}
    cells = cut(filters(classes, **code))
    a, b = (cells.select("label", "dim", "filter", F.col("key").alias(k), *[F.col(t).alias(k + t) for t in TOPS]) for k in "uv")
    shared = F.least(*[F.when(F.col("u" + s) == F.col("v" + t), F.col("u" + s)) for s in TOPS for t in TOPS])
    pairs = (a.join(b, ["label", "dim", "filter"]).where((F.col("u") < F.col("v")) & (F.coalesce(shared, F.col("filter")) == F.col("filter")))
             .select("u", "v").distinct())
    units = classes.select("key", "unit")
    both = (pairs.join(units.select(F.col("key").alias("u"), F.col("unit").alias("x")), "u")
            .join(units.select(F.col("key").alias("v"), F.col("unit").alias("y")), "v"))
    dot = F.aggregate(F.zip_with("x", "y", lambda x, y: x * y), F.lit(0.0), lambda s, p: s + p)
    return both.where(dot >= cosine).select("u", "v")


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    cosine: float = 0.93, **code) -> DataFrame:
    """``(id, n_links, component_id)``, one row per row.

    ``n_links`` counts the other rows linked directly, equal vectors among them; ``component_id`` is the smallest
    id reachable. Equal vectors of a label are one class and never meet pairwise. Vectors that can't be
    used (see :func:`vector_classes`) have no links; vectors of different lengths don't link. Repeated ids
    are rows of their own; a null id is ignored in the smallest id."""
    given = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    classes = cut(vector_classes(given))
    links = cut(class_links(classes, cosine, **code))
    roots = connected_components(links)
    ends = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    sizes = classes.select(F.col("key").alias("v"), "n")
    others = ends.join(sizes, "v").groupBy(F.col("u").alias("key")).agg(F.sum("n").alias("others"))
    known = cut(classes.join(roots, classes["key"] == roots["node"], "left").join(others, "key", "left")
                .select("key", "low", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                        F.coalesce("root", "key").alias("root")))
    # apart from the join, which can then split a large component's partition
    lows = cut(known.groupBy("root").agg(F.min("low").alias("component_id")))
    found = known.join(lows, "root").select("key", "n_links", "component_id")
    named = given.select("id", _key().alias("key"))
    return named.join(found, "key", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("n_links").isNull(), F.col("id"))
        .otherwise(F.col("component_id")).alias("component_id"))


# ------------------------------------------------------------------------------ query
def op9_embeddings(spark, sf_dir):
    """Near-duplicate groups of all vectors of equal label, cosine 0.93 or more."""
    got = near_duplicates(table(spark, sf_dir, "embeddings"))
    return got.select(F.col("id").alias("vec_id"), "n_links", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
