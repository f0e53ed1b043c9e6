"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venue_analytics.session import checkpoint_dir

#: ASCII white space as the contracts write it: space, tab, LF, VT, FF, CR.
WHITE = r"[\x20\x09-\x0D]+"


#: bytes of a batch sent to a Python worker, about; a single longer row still goes whole
ARROW_BYTES = 4 << 20
_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers (once per application), as ``--py-files`` would, and bound
    the bytes (not just the rows) of the batches they get."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_venue_analytics_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="va-py-"), "venue_analytics_py.zip")
    with zipfile.ZipFile(path, "w") as z:
        for top, _, names in os.walk(_PACKAGE):
            for name in sorted(names):
                if name.endswith((".py", ".txt")):
                    full = os.path.join(top, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    sc.addPyFile(path)
    sc._venue_analytics_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str) -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the maximal runs of characters outside ASCII white space."""
    return F.array_remove(F.split(text, WHITE), "")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_az(text: Column) -> Column:
    """``text`` with A-Z lowered and every other character, upper case or not, as it is."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def numbered(rows: DataFrame, keys: list[str], order: list[Column], out: str) -> DataFrame:
    """``rows`` with ``out``, a long that counts the rows of each key from 1 in the given order.

    A two-level scan: rows are sorted over range partitions, a key of any size lying in as many as it
    fills, numbered where they lie, and moved on by the rows of the key in earlier partitions, of which
    there is one sum per key and partition. Keys must not be null; rows alike in keys and order are
    numbered in either order."""
    by = [F.col(k) for k in keys]
    part, at, first = f"{out}_part", f"{out}_at", f"{out}_first"
    dealt = cut(rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
                .withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id()}))
    sums = dealt.groupBy(*keys, part).agg(F.min(at).alias(first), F.count("*").alias(out))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, part, first, F.coalesce(F.sum(out).over(before), F.lit(0)).alias(out))
    got = dealt.join(sums, [*keys, part])
    return got.select(*rows.columns, (F.col(out) + F.col(at) - F.col(first) + 1).alias(out))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` bound to a lambda variable, so it is evaluated once per row however
    often (or inside whatever inner lambda) the body refers to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def cut(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the folder the cluster shares (``spark.checkpoint.dir``): computed once,
    and a lost executor costs a re-read instead of the lineage. Spark removes the files with the
    frame when ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set."""
    if checkpoint_dir(df.sparkSession) is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet, in its order, to the folder the cluster shares, and read back: like
    :func:`cut` for larger frames, compressed and read by column. The folder (``va-stored-``) stays, like a
    checkpoint's without the cleaner, until the shared folder is cleared."""
    base = checkpoint_dir(df.sparkSession)
    if base is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{base.rstrip('/')}/va-stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows, at most twice as many, chosen by the hash of ``key``; all rows when there
    are fewer. Same rows on every run. Used only to fit a model or to estimate costs."""
    n = df.count()
    if n <= rows:
        return df
    top = int(rows / n * 2 ** 31)
    return df.where(F.pmod(F.xxhash64(key, F.lit(7)), F.lit(2 ** 31)) < top).limit(2 * rows)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast when it is counted to hold at most ``rows`` rows; else as it is
    (a shuffled join then). ``df`` should be cheap to count, such as a checkpointed aggregate."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
