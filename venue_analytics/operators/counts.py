"""Long-form counts -> zero-filled maps, nested maps and pivoted columns.

The input of each fold is already one row per (group, key) (the long form), so the collected list
per group is bounded by the number of keys (sources x kinds, at most a few dozen); nothing
unbounded is ever collected into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zero_map(keys, value: Column | None = None) -> Column:
    """Literal map key -> 0 (or -> ``value``) over the fixed keys."""
    v = F.lit(0).cast("long") if value is None else value
    return F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[v for _ in keys]))


def merge_onto(zero: Column, m: Column) -> Column:
    """Zero-filled union of two maps: keys of ``zero`` always present, values from ``m`` win,
    keys only in ``m`` are added (``map_concat`` would fail on the duplicated keys)."""
    return F.map_zip_with(zero, m, lambda k, z, v: F.coalesce(v, z))


# A missing key is written as the text 'None', as the original's str(key) did; map keys cannot be null.
NULL_KEY = "None"


def _key(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY))


def _summed(entries: Column) -> Column:
    """Map of (k, n) entries, n summed over equal keys: a missing key and the text 'None' may meet."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    sums = F.transform(keys, lambda k: F.aggregate(F.filter(entries, lambda e: e["k"] == k), F.lit(0).cast("long"),
                                                   lambda a, e: a + e["n"]))
    return F.map_from_arrays(keys, sums)


def fold_map(df: DataFrame, group_cols, key_col: str, n_col: str, zero_keys, out: str = "counts",
             total: str | None = None) -> DataFrame:
    """(group..., key, n) -> (group..., counts map<key, n>) with every zero key present;
    ``total`` adds the sum of n, computed in the same aggregation."""
    entries = F.collect_list(F.struct(_key(key_col).alias("k"), F.col(n_col).cast("long").alias("n")))
    m = F.transform(F.array(entries), _summed)[0]
    aggs = [m.alias("_m")] + ([F.sum(n_col).cast("long").alias(total)] if total else [])
    return (df.groupBy(*group_cols).agg(*aggs)
            .select(*group_cols, merge_onto(zero_map(zero_keys), F.col("_m")).alias(out),
                    *([total] if total else [])))


def fold_nested_map(df: DataFrame, group_cols, outer_col: str, inner_col: str, n_col: str,
                    outer_keys, inner_keys, out: str = "counts", total: str | None = None) -> DataFrame:
    """(group..., outer, inner, n) -> (group..., counts map<outer, map<inner, n>>), zero-filled on
    both levels. Unknown inner keys and unknown outer keys are added beside the fixed ones.
    ``total`` adds the sum of n over both levels, carried through the two aggregations."""
    # outer keys are named before grouping, so a missing one and the text 'None' are one group
    df = df.withColumn(outer_col, _key(outer_col))
    inner = fold_map(df, list(group_cols) + [outer_col], inner_col, n_col, inner_keys, "_inner",
                     total="_sub" if total else None)
    m = F.map_from_entries(F.collect_list(F.struct(_key(outer_col), F.col("_inner"))))
    aggs = [m.alias("_m")] + ([F.sum("_sub").cast("long").alias(total)] if total else [])
    zero = zero_map(outer_keys, zero_map(inner_keys))
    return (inner.groupBy(*group_cols).agg(*aggs)
            .select(*group_cols, merge_onto(zero, F.col("_m")).alias(out), *([total] if total else [])))


def pivot_counts(df: DataFrame, group_cols, key_col: str, n_col: str, keys, prefix: str = "n_",
                 total: str | None = "total") -> DataFrame:
    """Wide form: one column per fixed key (0 when absent) and the total over all keys,
    including keys outside the fixed list."""
    aggs = [F.sum(F.when(F.col(key_col) == k, F.col(n_col)).otherwise(F.lit(0))).cast("long")
            .alias(prefix + k.lower()) for k in keys]
    if total:
        aggs.append(F.sum(n_col).cast("long").alias(total))
    return df.groupBy(*group_cols).agg(*aggs)


def map_entries_long(df: DataFrame, group_cols, map_col: str, key_name: str, value_name: str) -> DataFrame:
    """Inverse of ``fold_map``: explode a map column back into long rows."""
    return df.select(*group_cols, F.explode(map_col).alias(key_name, value_name))


def nested_map_entries(df: DataFrame, group_cols, map_col: str, outer_name: str, inner_name: str,
                       value_name: str = "n", keep=()) -> DataFrame:
    """Inverse of ``fold_nested_map``: one row per (outer, inner) entry, zero entries included."""
    return (df.select(*group_cols, *keep, F.explode(map_col).alias(outer_name, "_inner"))
            .select(*group_cols, *keep, outer_name, F.explode("_inner").alias(inner_name, value_name)))
