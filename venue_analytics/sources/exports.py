"""Document exports: one JSON document per line, in the store's own types, read through VARIANT.

A document store's exports wrap values that JSON lacks (``{"$oid": "…"}``, ``{"$date": …}``,
``{"$numberLong": "…"}``). Each line is parsed once to a VARIANT, and the declared columns are taken from it
by path, unwrapped to their types; a missing or differently typed value is null, a line that isn't JSON
or a time that can't be read fails. Fields that no column declares are kept as JSON text in ``extra``, so an export can be written back
whole. No schema is inferred, and lines of different shapes may be mixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venue_analytics.functions.columns import parse_legacy_time, venue_id_strip
from venue_analytics.functions.text import tokenize
from venue_analytics.sources.schemas import SCHEMAS

#: wrappers of numbers, in the order they are tried (fixed values of the export format)
NUMBERS = ("$numberLong", "$numberInt", "$numberDouble", "$numberDecimal")
#: wrappers whose text is the value
TEXTS = ("$oid", "$symbol", "$uuid", *NUMBERS)
EXTRA = "extra"


def _at(path: str, key: str) -> str:
    return f"{path}['{key}']"


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _time(v: Column, path: str) -> Column:
    """A time from ``$date`` (epoch milliseconds, wrapped or bare, or ISO text), bare milliseconds, ISO text or the
    loader's text."""
    millis, texts = [], []
    for p in (_at(path, "$date"), path):
        millis += [_get(v, _at(p, "$numberLong"), "bigint"), _get(v, p, "bigint")]
        texts += [_get(v, p, "string")]
    text = F.coalesce(*texts)
    # a bare number is its own text too; the milliseconds go first
    parsed = F.coalesce(F.timestamp_millis(F.coalesce(*millis)), F.try_to_timestamp(text), parse_legacy_time(text)).cast("timestamp")
    lost = parsed.isNull() & (F.trim(text) != "")
    return F.when(lost, F.raise_error(F.concat(F.lit(f"unreadable time at {path}: "), text))).otherwise(parsed)


def typed(v: Column, path: str, dtype: T.DataType) -> Column:
    """The value at ``path`` of a variant as ``dtype``, unwrapped; null where it is missing or of another kind."""
    if isinstance(dtype, T.TimestampType):
        return _time(v, path)
    if isinstance(dtype, T.StringType):
        # an object's own text is its JSON: only a value that starts like one is looked into for wrappers
        plain = _get(v, path, "string")
        return F.when(plain.startswith("{"), F.coalesce(*[_get(v, _at(path, w), "string") for w in TEXTS], plain)).otherwise(plain)
    if isinstance(dtype, T.NumericType):
        kind = dtype.simpleString()
        return F.coalesce(*[_get(v, _at(path, w), kind) for w in NUMBERS], _get(v, path, kind))
    if isinstance(dtype, T.StructType):
        fields = F.struct(*[typed(v, _at(path, f.name), f.dataType).alias(f.name) for f in dtype.fields])
        return F.when(_get(v, path, "map<string,variant>").isNotNull(), fields)
    if isinstance(dtype, T.ArrayType):
        items = F.transform(_get(v, path, "array<variant>"), lambda x: typed(x, "$", dtype.elementType))
        if isinstance(dtype.elementType, T.StringType):  # the loader's '[a, b]' is a text
            plain = _get(v, path, "array<string>")
            items = F.when(~F.exists(plain, lambda x: x.startswith("{")), plain).otherwise(items)
            return F.coalesce(items, tokenize(venue_id_strip(_get(v, path, "string"))))
        return items
    if isinstance(dtype, T.MapType):
        return F.transform_values(_get(v, path, "map<string,variant>"), lambda _, x: typed(x, "$", dtype.valueType))
    return _get(v, path, dtype.simpleString())


def from_documents(lines: DataFrame, name: str, text_col: str = "value", schema: T.StructType | None = None) -> DataFrame:
    """Typed rows of a collection from one JSON document per row of ``lines``.

    ``_id`` is read where the schema has ``id``. ``extra`` maps every other field of a document to its JSON
    text (an empty map without any). Empty lines are passed over."""
    schema = schema or SCHEMAS[name]
    doc = lines.where(F.trim(text_col) != "").select(F.parse_json(text_col).alias("v"))
    v = F.col("v")
    columns = []
    for f in schema.fields:
        value = typed(v, _at("$", f.name), f.dataType)
        columns.append((F.coalesce(value, typed(v, _at("$", "_id"), f.dataType)) if f.name == "id" else value).alias(f.name))
    known = [F.lit(c) for c in [*schema.names, "_id"]]
    fields = F.try_variant_get(v, "$", "map<string,variant>")
    extra = F.transform_values(F.map_filter(fields, lambda k, _: ~k.isin(*known)), lambda _, x: F.to_json(x))
    rows = doc.select(*columns, extra.alias(EXTRA))
    if name == "merchants":  # expiry counts in whole seconds
        rows = rows.withColumn("subscription", F.col("subscription").withField("expires_at", F.date_trunc("second", "subscription.expires_at")))
    return rows
