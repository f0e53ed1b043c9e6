"""Subtree totals of a tree by parallel contraction: rake and compress in join rounds, then expansion.

Every round rakes all leaves (their totals are final and go to the parent, added up before the shuffle)
and compresses unary chains (a node with one child left is taken out, its child moves up to its parent
and remembers what it passed). A chain loses about half its nodes a round, a bushy tree its leaves, so the
rounds grow with the logarithm of the nodes, however deep or wide the tree. The nodes taken out are
re-expanded in reverse: each refers to a node that left in a later round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venue_analytics.llm.common import cut, small


def _coin(node: Column, depth: Column, r: int, bits: int) -> Column:
    """Whether a node may be taken out in round ``r``: by a bit of its depth first, which alternates along a
    chain from which earlier rounds took the lower bits; then by a hash."""
    if r < bits:
        return F.shiftright(depth, r).bitwiseAND(F.lit(1)) == 1
    return F.xxhash64(F.lit(r), node).bitwiseAND(F.lit(1).cast("long")) == 1


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``(node, *values)``: of every node the sums of the long columns ``values`` over its subtree, itself
    included.

    ``nodes(node, parent, depth, *values)`` is a forest: ids are unique and of any type that can be joined,
    roots have a null parent, ``depth`` is an int that rises from parent to child. Null values count as
    zero. A parent that isn't in the table makes its children roots of their own; an empty table gives no
    rows."""
    given = nodes.select("node", "parent", F.col("depth").cast("int").alias("depth"), *[F.coalesce(v, F.lit(0)).cast("long").alias(v) for v in values])
    lost = cut(given.where("parent is not null").select("parent").distinct().join(given.select(F.col("node").alias("parent")), "parent", "left_anti"))
    given = given.join(small(lost.withColumn("lost", F.lit(True)), 100_000), "parent", "left").withColumn(
        "parent", F.when(F.col("lost").isNull(), F.col("parent"))).drop("lost")
    kids = given.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("kids"))
    passed = [f"passed_{v}" for v in values]
    # kids: children left; passed_*: values of the nodes taken out between the node and its parent
    state = cut(given.join(kids, "node", "left").select(
        "node", "parent", "depth", F.coalesce("kids", F.lit(0).cast("long")).alias("kids"), *values, *[F.lit(0).cast("long").alias(p) for p in passed]))
    bits = int(state.agg(F.max("depth")).first()[0] or 0).bit_length()
    whole, taken, r = [], [], 0  # frames of final totals; frames of nodes taken out, by round
    while True:
        leaf = (F.col("kids") == 0) | F.col("parent").isNull() & (F.col("kids") == 0)
        whole.append(state.where(leaf).select("node", *values))
        rest = state.where(~leaf)
        if rest.isEmpty():
            break
        up = state.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
            F.count(F.when(~leaf, 1)).alias("left"), F.max(F.when(~leaf, F.struct("node", "depth"))).alias("heir"),
            *[F.sum(F.when(leaf, F.col(v) + F.col(p)).otherwise(0)).alias(f"up_{v}") for v, p in zip(values, passed)])
        now = rest.join(up, "node", "left").select(
            "node", "parent", "depth", F.col("left").alias("kids"), "heir", *[(F.col(v) + F.col(f"up_{v}")).alias(v) for v in values], *passed)
        out = (F.col("parent").isNotNull() & (F.col("kids") == 1) & _coin(F.col("node"), F.col("depth"), r, bits)
               & ~_coin(F.col("heir.node"), F.col("heir.depth"), r, bits))
        # a node taken out is met by its one child, so that no parent of many children gathers them
        gone = now.where(out).select(F.col("node").alias("gone"), F.col("heir.node").alias("gone_heir"), F.col("parent").alias("gone_parent"),
                                     *[F.col(v).alias(f"gone_{v}") for v in values], *[F.col(p).alias(f"gone_{p}") for p in passed])
        moved = cut(now.where(~out).drop("heir").join(gone, F.col("node") == F.col("gone_heir"), "left"))
        hop = F.col("gone").isNotNull()
        taken.append(moved.where(hop).select(F.col("gone").alias("node"), F.col("node").alias("heir"),
                                             *[(F.col(p) + F.col(f"gone_{v}")).alias(v) for v, p in zip(values, passed)]))
        state = moved.select("node", F.when(hop, F.col("gone_parent")).otherwise(F.col("parent")).alias("parent"), "depth", "kids", *values,
                             *[F.when(hop, F.col(p) + F.col(f"gone_{v}") + F.col(f"gone_{p}")).otherwise(F.col(p)).alias(p) for v, p in zip(values, passed)])
        r += 1
    totals = reduce(DataFrame.unionAll, whole)
    # re-expansion: where each node taken out leads, latest round first, then the totals there
    known = None
    for rows in reversed(taken):
        if rows.isEmpty():
            continue
        if known is not None:
            later = known.select(F.col("node").alias("via"), F.col("heir").alias("end"), *[F.col(v).alias(f"more_{v}") for v in values])
            rows = rows.join(later, F.col("heir") == F.col("via"), "left").select(
                "node", F.coalesce("end", "heir").alias("heir"), *[(F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values])
            rows = rows.unionAll(known)
        known = cut(rows)
    if known is None:
        return totals
    ends = totals.select(F.col("node").alias("end"), *[F.col(v).alias(f"end_{v}") for v in values])
    return totals.unionAll(known.join(ends, F.col("heir") == F.col("end")).select("node", *[(F.col(v) + F.col(f"end_{v}")).alias(v) for v in values]))
