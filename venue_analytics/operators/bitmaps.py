"""Distinct posters that can be merged: exact bitmaps over a dictionary of poster ids.

A count of distinct posters can't be added up: posts that come late may be of posters already counted. A
bitmap per (place, month, source) can be merged with another by OR, so late posts of a month are folded in
without reading the month again. The numbers come from a dictionary table that only grows. A bitmap is held in
words of 64 poster numbers, a row each, without the words that have no bit set: there are never more rows than
distinct posters of the place-months, and the more posters a place has, the fewer rows for each. This pays
where places have many posters or months are rerun often; ``reports.posters`` stays the plain way.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venue_analytics.operators.core import Tables, dealt_by, place_posts
from venue_analytics.operators.reports import PLACE_MONTH

_DICTIONARY = "poster_id string, number bigint"
#: number of posts without a poster id, which count as one poster
NOBODY = 0
KEYS = [*PLACE_MONTH, "source"]
#: poster numbers of a word
WORD = 64


def poster_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(poster_id, number) of all posters numbered so far: the folders there now, by name, so that a frame read
    before the dictionary grew is another one to Spark."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folders = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(top)
    return spark.read.schema(_DICTIONARY).parquet(*sorted(f.getPath().toString() for f in folders))


def extend_dictionary(posts: DataFrame, path: str, first: bool = False) -> DataFrame:
    """Number the posters of ``posts`` that the dictionary at ``path`` lacks, from its largest number on, and
    append them as a folder of their own; ``first`` starts a dictionary. Numbers are dense: new ids are dealt by
    hash, numbered where they lie, and moved on by the counts of the parts before, one row per part."""
    spark = posts.sparkSession
    new = posts.where(F.col("poster_id").isNotNull()).select("poster_id").distinct()
    most = 0
    if not first:
        known = poster_dictionary(spark, path)
        most = known.agg(F.max("number")).first()[0] or 0
        new = new.join(known.select("poster_id"), "poster_id", "left_anti")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    new = new.withColumn("part", F.pmod(F.xxhash64("poster_id"), F.lit(parts)))
    sizes = new.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row per part
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    at = F.row_number().over(Window.partitionBy("part").orderBy("poster_id"))
    numbered = new.withColumn("at", at).join(offsets, "part")
    numbered.select("poster_id", (F.col("at") + F.col("offset") + most).alias("number")).write.parquet(f"{path.rstrip('/')}/part-{uuid.uuid4().hex}")
    return poster_dictionary(spark, path)


def poster_bitmaps(t: Tables, dictionary: DataFrame, month: str | None = None, as_of=None) -> DataFrame:
    """(merchant_id, place_name, post_month, source, bucket, bits): the posters of the tables' posts, as the posters
    report has them. Bit i of ``bits`` (bigint) is the poster of number 64 * bucket + i. A poster that the dictionary
    lacks fails: extend it first."""
    pp = dealt_by(place_posts(t, month, [*KEYS, "poster_id"], as_of=as_of), "poster_id").join(dictionary, "poster_id", "left")
    missing = F.raise_error(F.concat(F.lit("poster not in the dictionary: "), F.col("poster_id")))
    number = F.when(F.col("poster_id").isNull(), F.lit(NOBODY)).when(F.col("number").isNull(), missing).otherwise(F.col("number"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("number", F.lit(WORD)).cast("int"))
    numbered = pp.select(*KEYS, number.cast("bigint").alias("number"))
    # dealt by poster, a word's bits meet in no task before the shuffle
    words = dealt_by(numbered.select(*KEYS, F.floor(F.col("number") / WORD).alias("bucket"), bit.alias("bit")), *KEYS, "bucket")
    return words.groupBy(*KEYS, "bucket").agg(F.bit_or("bit").alias("bits"))


def merged(*bitmaps: DataFrame) -> DataFrame:
    """The bitmaps of all posts of several arrivals."""
    rows = bitmaps[0]
    for b in bitmaps[1:]:
        rows = rows.unionByName(b)
    return rows.groupBy(*KEYS, "bucket").agg(F.bit_or("bits").alias("bits"))


def poster_counts(bitmaps: DataFrame) -> DataFrame:
    """(merchant_id, place_name, post_month, source, n) as ``reports.poster_counts``."""
    return bitmaps.groupBy(*KEYS).agg(F.sum(F.bit_count("bits").cast("bigint")).alias("n"))
