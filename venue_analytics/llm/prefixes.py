"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

Every conversation's prefixes are known by running hashes: a turn has 128 bits that depend on its place
and its SHA-256, and a prefix is their exclusive or, which a two-level scan gives for a conversation of
any length. Prefixes alike in depth and hash are one node; the digests are checked along each node's
members, so a clash of hashes is an error, never a wrong node. Texts are read once, to be digested; no
text is shuffled.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venue_analytics.llm.common import cut, numbered, ship, small, table
from venue_analytics.llm.contraction import subtree_totals

#: turns of a conversation that are scanned in one go
BLOCK = 4096
#: children from which on a node is told to them by broadcast
MANY = 256
#: bytes of member ids joined before they move on
CHUNK = 1 << 16
#: the longest shared beginning that rebuilding gives, less one
SHARED = 9
#: every so many conversation ids share a beginning
FAMILY = 5
_NODE = "node struct<d:int,a:bigint,b:bigint>"


def turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv, i, digest, bytes)``: the turns of every conversation, numbered from 1 by turn (null first).

    ``digest`` is the SHA-256 of role and text, ``bytes`` the text's length in UTF-8. Null roles and texts
    are empty. Turns that tie go by role, then digest; rows without a conversation id belong to no
    conversation and are left out."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    held = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
                                                        digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]
    return numbered(held, ["conv"], order, "i").select("conv", "i", "digest", "bytes")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with shared beginnings: ``(conv, d, digest, bytes)`` and ``(conv, length)``.

    With ``h`` the crc32 of the decimal id modulo nine, a conversation takes the first ``h`` turns of the
    conversation whose id is the multiple of five at or below its own (all of fewer, none if absent), then
    its own turns after its first ``h``."""
    sizes = own.groupBy("conv").agg(F.count("*").alias("n"))
    h = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(SHARED))
    plan = sizes.select("conv", "n", h.alias("h"), (F.col("conv") - F.pmod("conv", F.lit(FAMILY))).alias("base"))
    lead = sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    plan = cut(plan.join(lead, "base", "left").select("conv", "base", "n", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("k")))
    first = own.where((F.col("i") < SHARED) & (F.pmod("conv", F.lit(FAMILY)) == 0)).withColumnRenamed("conv", "base")
    shared = plan.select("conv", "base", "h").join(first, "base").where("i <= h").select("conv", F.col("i").alias("d"), "digest", "bytes")
    rest = (own.join(plan.select("conv", "h", "k"), "conv").where("i > h")
            .select("conv", (F.col("k") + F.col("i") - F.col("h")).alias("d"), "digest", "bytes"))
    return shared.unionAll(rest), plan.select("conv", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))


def _prefix_hashes(rows: DataFrame) -> DataFrame:
    """``rows(conv, d, digest, ...)`` with ``a, b``, the hashes of the prefix that ends there, and ``x, y``, the
    turn's own part of them."""
    rows = rows.withColumns({"x": F.xxhash64(F.lit(1), "d", "digest"), "y": F.xxhash64(F.lit(2), "d", "digest"),
                             "block": F.floor((F.col("d") - 1) / BLOCK)})
    here = Window.partitionBy("conv", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    rows = cut(rows.withColumns({"a": F.bit_xor("x").over(here), "b": F.bit_xor("y").over(here)}))
    # blocks after a conversation's first go on from what comes before them
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    long = rows.where("block > 0").select("conv").distinct()
    sums = (rows.join(long, "conv", "left_semi").groupBy("conv", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
            .select("conv", "block", F.bit_xor("x").over(earlier).alias("a0"), F.bit_xor("y").over(earlier).alias("b0")))
    later = rows.where("block > 0").join(sums, ["conv", "block"])
    later = later.withColumns({"a": F.col("a").bitwiseXOR(F.col("a0")), "b": F.col("b").bitwiseXOR(F.col("b0"))})
    return rows.where("block = 0").drop("block").unionAll(later.drop("block", "a0", "b0"))


def _node(d: Column, a: Column, b: Column) -> Column:
    return F.struct(d.cast("int").alias("d"), a.alias("a"), b.alias("b"))


def _same(c: str) -> Column:
    """The one value of a column in a node's rows; two values mean that hashes clash."""
    return F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.raise_error(F.lit("two prefixes share a hash")))


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """``(node, ends_sha256)``: the SHA-256 of each node's ids ``conv``, ascending and comma-joined.

    Ids are sorted over range partitions, so a node of any size lies in several, and joined there into
    chunks; one digest is sequential, so a node's chunks are streamed through it in their order."""
    ship(ends.sparkSession)

    def chunks(batches):
        now, held, size, first = None, [], 0, None
        for b in batches:
            out = []
            for key in zip(*(c.to_pylist() for c in b.columns)):
                if key[:3] != now or size >= CHUNK:
                    if held:
                        out.append((*now, first, ",".join(held)))
                    now, held, size, first = key[:3], [], 0, key[3]
                held.append(str(key[3]))
                size += len(held[-1]) + 1
            if out:
                yield batch(out, pa.string(), "part", True)
        if held:
            yield batch([(*now, first, ",".join(held))], pa.string(), "part", True)

    def digest(batches):
        now, state = None, None
        for b in batches:
            out = []
            for *key, part in zip(*(c.to_pylist() for c in b.columns)):
                if key != now:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256(part.encode())
                else:
                    state.update(b"," + part.encode())
            if out:
                yield batch(out, pa.string(), "ends_sha256", False)
        if now is not None:
            yield batch([(*now, state.hexdigest())], pa.string(), "ends_sha256", False)

    def batch(rows, kind, name, first):
        kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.int64()] * first, kind]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["d", "a", "b", *["first"] * first, name])
    flat = ends.select("node.d", "node.a", "node.b", "conv")
    parts = (flat.repartitionByRange("d", "a", "b", "conv").sortWithinPartitions("d", "a", "b", "conv")
             .mapInArrow(chunks, "d int, a bigint, b bigint, first bigint, part string"))
    got = (parts.repartition("d", "a", "b").sortWithinPartitions("d", "a", "b", "first").select("d", "a", "b", "part")
           .mapInArrow(digest, "d int, a bigint, b bigint, ends_sha256 string"))
    return got.select(F.struct("d", "a", "b").alias("node"), "ends_sha256")


def prefix_trie(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes of the trie over ``rows(conv, d, digest, bytes)``, conversations of ``lengths(conv, length)``.

    Columns ``conv`` (smallest member), ``depth``, ``parent_conv`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved`` and ``ends_sha256``; ``saved`` sums, over the subtree, the bytes of a node's last text
    for every member but one. Conversations without turns end at the root; no conversation, no node."""
    hashed = cut(_prefix_hashes(rows))
    c = F.col
    root = _node(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"))
    above = _node(c("d") - 1, c("a").bitwiseXOR(c("x")), c("b").bitwiseXOR(c("y")))
    node = _node(c("d"), c("a"), c("b"))
    nodes = (hashed.select(node.alias("node"), above.alias("parent"), "conv", "digest", "bytes").groupBy("node")
             .agg(_same("parent").alias("parent"), _same("digest").alias("digest"), F.max("bytes").alias("bytes"), F.min("conv").alias("conv"),
                  F.count("*").alias("n_convs")).drop("digest"))
    top = (lengths.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0")
           .select(root.alias("node"), F.lit(None).cast(nodes.schema["parent"].dataType).alias("parent"), F.lit(0).cast("long").alias("bytes"), "conv", "n_convs"))
    nodes = cut(nodes.unionByName(top))
    kids = nodes.where("parent is not null").groupBy(c("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = cut(nodes.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    totals = subtree_totals(nodes.select("node", "parent", c("node.d").alias("depth"), ((c("n_convs") - 1) * c("bytes")).alias("saved"),
                                         F.when(c("n_children") == 0, 1).otherwise(0).alias("n_leaves")), ["saved", "n_leaves"])
    ends = (hashed.join(lengths, "conv").where(c("d") == c("length")).select(node.alias("node"), "conv")
            .unionAll(lengths.where("length = 0").select(root.alias("node"), "conv")))
    # parents of many children are few and meet theirs by broadcast; the others by a shuffle
    parents = nodes.select(c("node").alias("parent"), c("conv").alias("parent_conv"), "n_children").where("n_children > 0")
    many = small(parents.where(c("n_children") > MANY).drop("n_children"), 1_000_000)
    few = parents.where(c("n_children") <= MANY).drop("n_children")
    rest = nodes.join(many.select("parent"), "parent", "left_anti").join(few, "parent", "left")
    named = nodes.join(many, "parent").unionByName(rest)
    got = named.join(totals, "node").join(digests_of_ends(ends), "node", "left")
    return got.select("conv", c("node.d").cast("long").alias("depth"), "parent_conv", "n_convs", "n_children", "n_leaves", "saved",
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


# ------------------------------------------------------------------------------ query
def op13_trie(spark, sf_dir):
    """The prefix trie of all conversations, rebuilt to share beginnings."""
    rows, lengths = rebuilt(turns(table(spark, sf_dir, "conversations")))
    c = F.col
    return prefix_trie(rows, lengths).select(c("conv").alias("conv_id"), "depth", c("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
                                             "n_leaves", c("saved").alias("saved_tokens"), "ends_sha256")


OP13_SQL = """
WITH bits AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY i) AS t
              FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))),
r AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, n, conv_id - ((conv_id % 5) + 5) % 5 AS base,
             xor(list_reduce(CAST([4294967295] AS BIGINT[]) || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
                             lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 9 AS h
      FROM (SELECT conv_id, count(*) AS n FROM r GROUP BY conv_id), bits),
p AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS k FROM c LEFT JOIN c b ON b.conv_id = c.base),
m AS (SELECT p.conv_id, r.i AS d, role, text FROM p JOIN r ON r.conv_id = p.base AND r.i <= p.h
      UNION ALL SELECT p.conv_id, p.k + r.i - p.h, role, text FROM p JOIN r ON r.conv_id = p.conv_id AND r.i > p.h),
x AS (SELECT conv_id, d, strlen(text) AS bytes, string_agg(strlen(role) || ':' || strlen(text) || ':' || role || text, '' ORDER BY d)
             OVER (PARTITION BY conv_id ORDER BY d) AS prefix FROM m
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
e AS (SELECT *, d = max(d) OVER (PARTITION BY conv_id) AS last FROM x),
n AS (SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
             coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '') AS ends FROM e GROUP BY prefix, d),
up AS (SELECT n.prefix, n.d, n.conv_id, n.n_convs, n.bytes, n.ends, q.conv_id AS parent, q.prefix AS above
       FROM n LEFT JOIN x ON x.conv_id = n.conv_id AND x.d = n.d - 1 LEFT JOIN n q ON q.prefix = x.prefix AND q.d = x.d),
kids AS (SELECT above AS prefix, d - 1 AS d, count(*) AS k FROM up WHERE d > 0 GROUP BY above, d),
f AS (SELECT up.*, coalesce(k, 0) AS k FROM up LEFT JOIN kids USING (prefix, d)),
tot AS (SELECT x.prefix, x.d, sum((f.n_convs - 1) * f.bytes) AS saved, count(*) FILTER (f.k = 0) AS leaves
        FROM f JOIN x ON x.conv_id = f.conv_id AND x.d <= f.d GROUP BY x.prefix, x.d)
SELECT conv_id, CAST(d AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, k AS n_children, leaves AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256 FROM f JOIN tot USING (prefix, d)"""
