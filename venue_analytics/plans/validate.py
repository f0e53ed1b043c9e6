"""Validation entry point: checks over written reports and drill-downs over the sources.

Usage::

    python -m venue_analytics.plans.validate SINK_BASE                 # segment totals (Q8)
    python -m venue_analytics.plans.validate SINK_BASE --source SOURCE_BASE --month 2015Mar \\
        [--merchant M1] [--user "Some One"] [--tags T1,T2]

Every check is one distributed plan; all its rows are printed, or written with ``--out``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from venue_analytics.operators import checks as C
from venue_analytics.operators.core import Tables
from venue_analytics.session import get_spark
from venue_analytics.sources.readers import read_tables
from venue_analytics.sources.sinks import read_report


def segment_check(spark, sink_base: str, month: str | None = None):
    """Q8 on the written segments table: per document and source, hours sum vs 'total'."""
    seg = read_report(spark, f"{sink_base.rstrip('/')}/segments", **({"month": month} if month else {}))
    return C.check_segment_totals(seg)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description="validate the venue reports")
    ap.add_argument("sink", help="base path of the report tables")
    ap.add_argument("--source", help="base path of the source collections (drill-downs)")
    ap.add_argument("--month", help="month, e.g. 2015Mar")
    ap.add_argument("--merchant", help="restrict the drill-downs to one merchant id")
    ap.add_argument("--user", help="user name for the likes drill-down")
    ap.add_argument("--tags", help="comma-separated tag ids for the tagged-post count")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--out", help="base path for the drill-downs' tables (default: all rows are printed)")
    args = ap.parse_args(argv)
    spark = get_spark()
    def report(name: str, df) -> int:
        """All rows: to a table under --out, else printed one by one as they come."""
        if args.out:
            path = f"{args.out.rstrip('/')}/{name}"
            df.write.mode("overwrite").parquet(path)
            n = spark.read.parquet(path).count()
            print(f"{name}: {n} row(s) in {path}")
            return n
        n = 0
        for n, row in enumerate(df.toLocalIterator(), 1):
            print(f"{name}: {row.asDict(recursive=True)}")
        print(f"{name}: {n} row(s)")
        return n
    chk = segment_check(spark, args.sink, args.month)
    n_bad = report("segment_violations", chk.filter(~F.col("ok")))
    print(f"segment totals: {n_bad} violation(s)")
    if args.source:
        t = Tables(**read_tables(spark, args.source, args.format))
        only = (lambda df: df.filter(F.col("merchant_id") == args.merchant)) if args.merchant else (lambda df: df)
        report("merchant_posts", only(C.merchant_post_count(t, args.month)))
        report("mention_terms", only(C.mention_terms(t)))
        if args.tags:
            report("tagged_posts", only(C.tagged_post_count(t, args.tags.split(","), args.month)))
        if args.user:
            report("user_likes", only(C.user_likes(t, args.user, args.month)))
    return 1 if n_bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
