"""Monthly job: compute the chosen reports for a month and replace that month in the sink.

Differences from the original runner (see README): the month is replaced *after* the rows are
computed (dynamic partition overwrite, atomic per partition), the keywords and segments reports
clear their own table, and ``response_times`` can be run by name.

Usage::

    python -m venue_analytics.plans.jobs SOURCE_BASE SINK_BASE [--month 2015Jan] [--report content]
        [--format parquet] [--as-of 2015-06-01] [--database reports] [--resume]
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import uuid

from pyspark.sql import SparkSession

from venue_analytics.operators import reports as R
from venue_analytics.operators.core import Tables, match_table
from venue_analytics.plans import journal
from venue_analytics.session import checkpoint_dir, get_spark
from venue_analytics.sources.readers import read_tables
from venue_analytics.sources.sinks import MONTH_COLUMN, publish_month, remove, write_report

# Reports run when none is named (segments only on request, as before).
DEFAULT_REPORTS = ["content", "interactions", "posters", "reviews", "keywords"]
ALL_REPORTS = DEFAULT_REPORTS + ["segments", "response_times"]
# Reports built on the place/post venue match (all but response_times).
MATCH_REPORTS = {"content", "interactions", "posters", "reviews", "keywords", "segments"}


def current_month(today: dt.date | None = None) -> str:
    return (today or dt.datetime.now(dt.timezone.utc).date()).strftime("%Y%b")


def build_report(t: Tables, report: str, month: str | None, as_of=None, wrap_days: bool = False):
    """Map-form DataFrame of one report (what is written to the sink). ``wrap_days`` keeps only the seconds
    within a day of the response times, as the original stored them."""
    if report == "response_times":
        return R.response_times(t, month, wrap_days)
    return R.REPORTS[report](t, month, as_of)


def share_matches(spark: SparkSession, t: Tables, month: str | None, as_of=None,
                  with_text: bool = False) -> Tables:
    """Compute the month's place/post match once and write it as a Parquet table in the shared
    checkpoint folder (reliable storage: it survives lost executors and cuts the lineage). The
    reports of the run read it instead of each scanning posts and joining places again, and each
    reads only the columns it needs (only keywords reads the text). The caller removes the table at
    ``matches_path``. A cluster without a checkpoint folder is an error: run without sharing there."""
    base = checkpoint_dir(spark)
    if base is None:
        raise ValueError("sharing the match needs spark.checkpoint.dir; set it or pass share=False")
    path = f"{base.rstrip('/')}/va-matches-{month or 'all'}-{uuid.uuid4().hex}"
    match_table(t, month, as_of, with_text).write.mode("error").parquet(path)
    return dataclasses.replace(t, matches=spark.read.parquet(path), matches_month=month, matches_path=path)


def share_counts(spark: SparkSession, t: Tables, month: str | None, as_of=None) -> Tables:
    """Count the match once for all count reports (``reports.count_reports``) and keep the counts, like the
    match, as a table in the shared checkpoint folder. The caller removes it at ``counts_path``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/va-counts-{month or 'all'}-{uuid.uuid4().hex}"
    R.count_reports(t, month, as_of).write.mode("error").parquet(path)
    return dataclasses.replace(t, counts=spark.read.parquet(path), counts_path=path)


def run_reports(spark: SparkSession, t: Tables, sink_base: str, month: str,
                reports=None, fmt: str = "parquet", as_of=None, share: bool = True,
                wrap_days: bool = False, database: str | None = None, resume: bool = False) -> dict[str, str]:
    """Run ``reports`` (default: DEFAULT_REPORTS) for ``month`` and write each to ``<sink_base>/<report>``
    partitioned by its month column. Returns the paths, of the reports that ran.

    Each report is computed lazily and written once; a failed task is re-run from lineage, and exactly
    the month's partition is replaced, also by nothing. With ``share`` the venue match is computed
    once for all reports of the run (``share_matches``), likewise the counts of two or more count reports
    (``share_counts``), and both are removed at the end. With ``database`` the reports are published as
    tables of that catalog database (``sinks.publish_month``) instead of bare folders.

    Every report that is done is noted in the run journal under the sink. With ``resume`` a report whose
    note is there, for the same inputs and parameters, is passed over, so a run that failed goes on at the
    report where it stopped, and a changed input runs again."""
    names = list(reports) if reports else list(DEFAULT_REPORTS)
    unknown = [n for n in names if n not in ALL_REPORTS]
    if unknown:
        raise ValueError(f"unknown report(s): {unknown}; choose from {ALL_REPORTS}")
    book = journal.Journal(spark, sink_base, month)
    state = journal.fingerprint(spark, t, as_of=str(as_of), wrap_days=wrap_days, fmt=fmt, database=database)
    if resume:
        names = [n for n in names if not book.done(n, state)]
    out = {}
    try:
        if share and len(MATCH_REPORTS.intersection(names)) > 1:
            t = share_matches(spark, t, month, as_of, with_text="keywords" in names)
            if len(set(R.COUNT_REPORTS).intersection(names)) > 1:
                t = share_counts(spark, t, month, as_of)
        for name in names:
            path = f"{sink_base.rstrip('/')}/{name}"
            df = build_report(t, name, month, as_of, wrap_days)
            book.begin(name)
            if database:
                publish_month(df, f"{database}.{name}", path, name, month, fmt)
            else:
                write_report(df, path, name, fmt, month=month)
            book.finish(name, state)
            out[name] = path
    finally:
        for shared in (t.matches_path, t.counts_path):
            if shared:
                remove(spark, shared)
    return out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="run the monthly venue reports")
    ap.add_argument("source", help="base path holding posts/ places/ merchants/ audits/")
    ap.add_argument("sink", help="base path of the report tables")
    ap.add_argument("--month", help="month to run, e.g. 2015Jan (default: current month)")
    ap.add_argument("--report", action="append", choices=ALL_REPORTS, help="report to run (repeatable)")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--as-of", help="expiry reference date YYYY-MM-DD (default: now)")
    ap.add_argument("--wrap-days", action="store_true", help="response times modulo a day, as originally stored")
    ap.add_argument("--no-share", action="store_true", help="match places and posts for each report anew")
    ap.add_argument("--database", help="publish the reports as tables of this catalog database")
    ap.add_argument("--resume", action="store_true", help="pass over reports that are done for the same inputs")
    args = ap.parse_args(argv)
    spark = get_spark()
    t = Tables(**read_tables(spark, args.source, args.format))
    as_of = dt.datetime.strptime(args.as_of, "%Y-%m-%d") if args.as_of else None
    month = args.month or current_month()
    for name, path in run_reports(spark, t, args.sink, month, args.report, args.format, as_of,
                                  share=not args.no_share, wrap_days=args.wrap_days, database=args.database,
                                  resume=args.resume).items():
        print(f"{name}: {path} ({MONTH_COLUMN[name]}={month})")


if __name__ == "__main__":
    main()
