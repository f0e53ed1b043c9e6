"""Read the four collections with a declared schema and normalise legacy string forms once.

``read_table`` is format-agnostic (parquet, json, orc, or any connector name Spark knows): the
reports only see the typed columns of ``sources.schemas``. Column pruning and filter pushdown
happen at the scan because everything downstream is declarative.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venue_analytics.functions.columns import MONTH_KEY, expiry_time, month_key, parse_legacy_time, venue_id_strip
from venue_analytics.functions.text import tokenize
from venue_analytics.sources.exports import from_documents
from venue_analytics.sources.schemas import SCHEMAS


def _type_of(df: DataFrame, path: str) -> T.DataType | None:
    dtype: T.DataType = df.schema
    for part in path.split("."):
        if not isinstance(dtype, T.StructType) or part not in dtype.names:
            return None
        dtype = dtype[part].dataType
    return dtype


def _checked(raw, parsed, what: str):
    """``parsed``, failing on a text that is there but can't be read (a lost date or list would only show
    as missing rows)."""
    lost = raw.isNotNull() & (F.trim(raw) != "") & parsed.isNull()
    return F.when(lost, F.raise_error(F.concat(F.lit(f"unreadable {what}: "), raw))).otherwise(parsed)


def _as_time(df: DataFrame, name: str):
    dtype = _type_of(df, name)
    raw = F.col(name)
    if isinstance(dtype, T.StringType):
        return _checked(raw, F.coalesce(parse_legacy_time(raw), F.try_to_timestamp(raw)), name)
    return raw


def _as_list(df: DataFrame, name: str):
    """A list column; from text either a JSON array or the loader's '[a, b]'."""
    dtype = _type_of(df, name)
    raw = F.col(name)
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.from_json(raw, T.ArrayType(T.StringType())), tokenize(venue_id_strip(raw)))
    return raw


def _as_expiry(df: DataFrame, name: str):
    """Expiry from epoch milliseconds (number or text), the loader's date text or ISO text."""
    dtype = _type_of(df, name)
    raw = F.col(name)
    if isinstance(dtype, T.StringType):
        millis = expiry_time(F.when(raw.rlike("^-?[0-9]{1,18}$"), raw).cast("bigint"), T.LongType())
        return _checked(raw, F.coalesce(millis, parse_legacy_time(raw), F.try_to_timestamp(raw)), name)
    return expiry_time(raw, dtype)


def normalise(name: str, df: DataFrame) -> DataFrame:
    """Rename ``_id`` to ``id`` and turn string forms into the declared types:
    'Tue Dec 22 12:05:21 EST 2015' or ISO text -> timestamp, '[FB-1, FB-11]' -> array, epoch ms -> timestamp.
    Text that is none of its column's forms fails the query that reads it."""
    if "_id" in df.columns:
        if "id" in df.columns:
            df = df.withColumn("id", F.coalesce(F.col("id"), F.col("_id").cast("string"))).drop("_id")
        else:
            df = df.withColumnRenamed("_id", "id")
    if name == "posts":
        if "post_time" in df.columns:
            df = df.withColumn("post_time", _as_time(df, "post_time"))
        for c in ("secondary_venue_ids", "tag_ids"):
            if c in df.columns:
                df = df.withColumn(c, _as_list(df, c))
    elif name == "places":
        if "venue_ids" in df.columns:
            df = df.withColumn("venue_ids", _as_list(df, "venue_ids"))
    elif name == "merchants":
        dtype = _type_of(df, "subscription.expires_at")
        if dtype is not None and not isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            df = df.withColumn("subscription", F.struct(_as_expiry(df, "subscription.expires_at").alias("expires_at")))
    elif name == "audits":
        if "created_at" in df.columns:
            df = df.withColumn("created_at", _as_time(df, "created_at"))
    return df


TIME_COLUMN = {"posts": "post_time", "audits": "created_at"}


def write_month_partitioned(df: DataFrame, path: str, name: str, fmt: str = "parquet", spread: int | None = None) -> None:
    """Lay a collection out by month (``month_key=yyyy-MM`` directories) so that a monthly report
    opens only that month's files: the reports add the key to their month filter when present.
    A month's rows go to ``spread`` tasks (default: the session's shuffle partitions) by the hash of
    their id, so a month is spread however its times are distributed."""
    ts = TIME_COLUMN[name]
    spread = spread or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.withColumn(MONTH_KEY, month_key(ts))
       .repartition(spread, MONTH_KEY, F.pmod(F.xxhash64("id"), F.lit(spread)))
       .write.mode("overwrite").format(fmt).partitionBy(MONTH_KEY).save(path))


#: folder beside the bucket files that states their layout; readers pass over names that start with '_'
LAYOUT = "_layout"


def write_bucketed(df: DataFrame, path: str, table: str, key: str = "id", buckets: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Lay a collection out in ``buckets`` files by the hash of ``key``, sorted by it, and register it as ``table``.

    A join on the key then shuffles only the other side. Rows are dealt by the same hash first, so each task
    writes one file. ``buckets`` defaults to the session's shuffle partitions; with fewer buckets than a
    session's shuffle partitions Spark shuffles both sides of a join there. The layout is stated beside the
    files, for ``open_bucketed`` in other sessions."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, key).write.mode("overwrite").format(fmt).bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table))
    layout = spark.range(1).select(F.lit(key).alias("key"), F.lit(n).alias("buckets"), F.lit(fmt).alias("fmt"), F.lit(df.schema.json()).alias("schema"))
    layout.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/{LAYOUT}")
    return spark.table(table)


def open_bucketed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The collection that ``write_bucketed`` laid out at ``path``, registered as ``table`` in this session's
    catalog if it isn't there yet; bucketing is a property of the table, not of the files."""
    if not spark.catalog.tableExists(table):
        at = spark.read.schema("key string, buckets int, fmt string, schema string").json(f"{path.rstrip('/')}/{LAYOUT}").first()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(at["schema"])).fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING {at['fmt']} CLUSTERED BY (`{at['key']}`) SORTED BY (`{at['key']}`) "
                  f"INTO {at['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(table)


FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro", "delta", "text", "documents")


def loose_schema(schema: T.StructType) -> T.StructType:
    """``schema`` with times and lists of strings as text, as formats without a schema of their own may
    hold them in any of the forms that ``normalise`` reads."""
    def loose(dtype: T.DataType) -> T.DataType:
        if isinstance(dtype, T.TimestampType) or dtype == T.ArrayType(T.StringType()):
            return T.StringType()
        if isinstance(dtype, T.StructType):
            return loose_schema(dtype)
        return dtype
    return T.StructType([T.StructField(f.name, loose(f.dataType)) for f in schema.fields])


def read_table(spark: SparkSession, name: str, path: str | None, fmt: str = "parquet",
               schema: T.StructType | None = None, **options) -> DataFrame:
    """Scan one collection. A declared schema is used unless ``schema`` is given or the format
    carries its own (parquet/orc), in which case the file schema is read and normalised. Formats
    without a schema are read with times and lists as text, and normalised likewise.
    ``path=None`` suits connectors configured by options alone (e.g. a document store's
    ``database``/``collection``). Format ``documents`` is a text file of one JSON document per line in a
    document store's own types (``sources.exports``)."""
    if fmt == "documents":
        return from_documents(spark.read.options(**options).text(path), name, schema=schema)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt in FILE_FORMATS and fmt not in ("parquet", "orc", "delta") and name in SCHEMAS:
        declared = SCHEMAS[name]
        if "id" in declared.names:   # documents carry their key as _id
            declared = T.StructType(list(declared.fields) + [T.StructField("_id", T.StringType())])
        reader = reader.schema(loose_schema(declared))
    return normalise(name, reader.load(path) if path else reader.load())


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_tables(spark: SparkSession, base: str, fmt: str = "parquet",
                names=("posts", "places", "merchants", "audits"), optional=("venues",), **options) -> dict[str, DataFrame]:
    """``{name: DataFrame}`` for each collection: ``<base>/<name>`` for file formats, those in
    ``optional`` only where they are (the venues serve the mention checks alone); for a
    connector format, ``base`` is the database and ``name`` the collection option."""
    if fmt in FILE_FORMATS:
        names = [*names, *(n for n in optional if _exists(spark, f"{base.rstrip('/')}/{n}"))]
        return {n: read_table(spark, n, f"{base.rstrip('/')}/{n}", fmt, **options) for n in names}
    return {n: read_table(spark, n, None, fmt, database=base, collection=n, **options) for n in names}
