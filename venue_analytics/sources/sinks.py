"""Report sink: month-partitioned tables replaced one month at a time.

The original deleted a month's documents, then ran the job (a failed run left the month empty).
Two sinks replace a month:

* ``publish_month`` for catalog tables: the rows go to a fresh folder, and one statement of the catalog then
  points the month at it. A reader sees the old month or the new one, never a part, also when the run
  stops half way.
* ``write_report`` for bare folders: dynamic partition overwrite. File commit is atomic per task, so a lost
  executor leaves no partial files, but the job's commit deletes and renames folder by folder; a reader on
  an object store can meet neither month for that moment.
"""

from __future__ import annotations

import time
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

# Month column of each report's output.
MONTH_COLUMN = {
    "content": "post_month", "keywords": "post_month", "posters": "post_month",
    "reviews": "month", "interactions": "month", "response_times": "month", "segments": "month",
}


def clustered(df: DataFrame, by: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """Rows dealt into ranges of ``by`` and sorted by it, so that a value lies in few row groups. ``ties`` deal
    the rows of one value further, so a value with a large share of the rows fills several tasks."""
    keys = [by, *ties]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def _bloom(writer: DataFrameWriter, by: str | None) -> DataFrameWriter:
    """Parquet bloom filters on ``by``: a lookup of a value passes over row groups whose range holds it by chance."""
    return writer if by is None else writer.option(f"parquet.bloom.filter.enabled#{by}", "true")


def append_report(df: DataFrame, fmt: str, **options) -> None:
    """Append report rows to a connector sink configured by options alone (for example a
    document store's database/collection), as the original inserted documents. Replacing a
    month there needs the store's own delete; file and table sinks use ``write_report``."""
    df.write.format(fmt).mode("append").options(**options).save()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system Spark knows; nothing if it isn't there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def write_report(df: DataFrame, path: str, report: str, fmt: str = "parquet",
                 month_col: str | None = None, max_records_per_file: int | None = None,
                 month: str | None = None, cluster_by: str | None = None) -> None:
    """Write ``df`` under ``path`` partitioned by the report's month column, replacing only the
    months that ``df`` contains. With ``month``, that month alone is replaced, by its rows of ``df`` (rows of
    other months are not written): when it has none, its partition is removed after the write. No repartition by month: a
    monthly run holds one month, and funnelling it into one task would serialise the write. With
    ``cluster_by`` (such as merchant_id) the files are sorted by that column and carry bloom filters on it,
    so a lookup of one value reads few row groups."""
    month_col = month_col or MONTH_COLUMN[report]
    seen = Observation()
    if month is not None:
        df = df.where(F.col(month_col) == month).observe(seen, F.count(F.lit(1)).alias("rows"))
    if cluster_by:
        df = clustered(df, cluster_by, tuple(c for c in ("place_name", "place_id", "user") if c in df.columns))
    writer = _bloom(df.write, cluster_by).mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic").partitionBy(month_col)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)
    if month is not None and not seen.get.get("rows"):
        remove(df.sparkSession, f"{path.rstrip('/')}/{month_col}={month}")


#: folder under a published table that holds one folder per publication
RUNS = "_runs"


def _quoted(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_locations(spark: SparkSession, table: str) -> dict[str, str]:
    """Where each partition value of a table published by this module lies."""
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        column, _, value = unquote(row[0]).partition("=")  # shown as a path
        detail = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION ({column}={_quoted(value)})").collect()
        found[value] = next(r[1] for r in detail if r[0] == "Location")
    return found


def _switch(spark: SparkSession, table: str, column: str, value: str, folder: str) -> str | None:
    """Point a partition at ``folder`` by one statement of the catalog; where it pointed before."""
    spec = f"({column}={_quoted(value)})"
    if spark.sql(f"SHOW PARTITIONS {table} PARTITION {spec}").collect():
        detail = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION {spec}").collect()
        before = next(r[1] for r in detail if r[0] == "Location")
        spark.sql(f"ALTER TABLE {table} PARTITION {spec} SET LOCATION {_quoted(folder)}")
    else:
        before = None
        spark.sql(f"ALTER TABLE {table} ADD PARTITION {spec} LOCATION {_quoted(folder)}")
    spark.catalog.refreshTable(table)
    return before


def publish(df: DataFrame, table: str, path: str, column: str, value: str, fmt: str = "parquet", keep_old: bool = False,
            cluster_by: str | None = None) -> str:
    """Make the rows of ``df`` whose ``column`` is ``value`` the partition ``value`` of ``table``, all at once.

    The table is created at ``path`` when it isn't in the catalog. The rows are written in full to a folder of
    their own under ``path``; then the partition is switched to it, so a run that stops before the switch
    leaves the old partition as it was (and a folder for ``tidy``), and a run repeated replaces its partition
    instead of adding to it. No rows make an empty partition. The folder that the partition left is removed
    afterwards unless ``keep_old``: readers that are still at it need it, and ``tidy`` removes it later.
    ``cluster_by`` as for ``write_report``. Returns the new folder. Partition values are text."""
    spark = df.sparkSession
    body = df.where(F.col(column).cast("string") == value).drop(column)
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in body.schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, `{column}` string) USING {fmt} PARTITIONED BY (`{column}`) LOCATION {_quoted(path)}")
    folder = f"{path.rstrip('/')}/{RUNS}/{uuid.uuid4().hex}"
    if cluster_by:
        body = clustered(body, cluster_by, tuple(c for c in ("place_name", "place_id", "user") if c in body.columns))
    _bloom(body.write, cluster_by).format(fmt).save(folder)
    before = _switch(spark, table, column, value, folder)
    if before and not keep_old:
        remove(spark, before)
    return folder


def publish_month(df: DataFrame, table: str, path: str, report: str, month: str, fmt: str = "parquet", keep_old: bool = False,
                  cluster_by: str | None = "merchant_id") -> str:
    """``publish`` a report's month, clustered by merchant for drill-downs."""
    return publish(df, table, path, MONTH_COLUMN[report], month, fmt, keep_old, cluster_by)


def append_run(df: DataFrame, table: str, path: str, run: str, fmt: str = "parquet") -> str:
    """Append the documents of a run to ``table`` as its partition ``run``: they become visible together, and
    the same run repeated replaces its documents instead of doubling them."""
    return publish(df.withColumn("run", F.lit(run)), table, path, "run", run, fmt)


def tidy(spark: SparkSession, table: str, path: str, older_than_s: float = 86_400) -> list[str]:
    """Remove the folders of publications that no partition points at, left by runs that stopped or kept for
    readers, once they are older than ``older_than_s`` (a run under way has a folder without a partition
    too). Returns their names."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{RUNS}")
    fs = top.getFileSystem(conf)
    if not fs.exists(top):
        return []
    used = {location.rstrip("/").rsplit("/", 1)[-1] for location in partition_locations(spark, table).values()}
    gone = []
    for status in fs.listStatus(top):
        name = status.getPath().getName()
        if name not in used and status.getModificationTime() / 1000 < time.time() - older_than_s:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return gone


def read_report(spark: SparkSession, path: str, fmt: str = "parquet", **equals) -> DataFrame:
    """Read report rows back; equality filters on the month column prune partitions."""
    df = spark.read.format(fmt).load(path)
    for k, v in equals.items():
        df = df.filter(F.col(k) == F.lit(v))
    return df
