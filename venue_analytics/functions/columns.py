"""Scalar Column -> Column helpers: source code, dates, month ranges, expiry, venue lists.

All are built-in expressions, so they stay inside whole-stage codegen and never leave the JVM.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def source_of(post_id: ColumnOrName) -> Column:
    """First two characters of a post id ('FB-aa' -> 'FB')."""
    return F.substring(_c(post_id), 1, 2)


def parse_legacy_time(s: ColumnOrName) -> Column:
    """Parse 'Tue Dec 22 12:05:21 EST 2015' as naive wall-clock time (zone text ignored).

    The weekday and zone words are dropped first, because Spark's parser rejects 'EEE'.
    Unparseable text gives null.
    """
    core = F.regexp_replace(F.trim(_c(s)), r"^\S+\s+(\S+)\s+(\d{1,2})\s+(\d{1,2}:\d{2}:\d{2})\s+\S+\s+(\d{4})$",
                            "$1 $2 $3 $4")
    return F.try_to_timestamp(core, F.lit("MMM d H:mm:ss yyyy"))


def month_str(ts: ColumnOrName) -> Column:
    """'2015Jan' style month label."""
    return F.date_format(_c(ts), "yyyyMMM")


def day_str(ts: ColumnOrName) -> Column:
    """Zero-padded day of month, '01'..'31'."""
    return F.date_format(_c(ts), "dd")


def hour_str(ts: ColumnOrName) -> Column:
    """Zero-padded hour of day, '00'..'23'."""
    return F.date_format(_c(ts), "HH")


def hour_key(h: ColumnOrName) -> Column:
    """Integer hour -> '00'..'23'."""
    return F.lpad(_c(h).cast("string"), 2, "0")


def month_bounds(month: str) -> tuple[_dt.datetime, _dt.datetime]:
    """'2015Dec' -> (2015-12-01, 2016-01-01): the half-open range of the month."""
    start = _dt.datetime.strptime(month, "%Y%b")
    end = _dt.datetime(start.year + (start.month == 12), start.month % 12 + 1, 1)
    return start, end


def month_bounds_col(month: ColumnOrName) -> tuple[Column, Column]:
    """Column form of ``month_bounds``; December rolls over to January."""
    start = F.to_timestamp(_c(month), "yyyyMMM")
    return start, F.add_months(start, 1).cast("timestamp")


def in_month(ts_col: str, month: str | None, dtype: T.DataType | None = None) -> Column:
    """Predicate ``start <= ts < end`` for the month, typed like the column so it reaches the
    Parquet scan as PushedFilters. ``month=None`` means every month (always true)."""
    if month is None:
        return F.lit(True)
    start, end = month_bounds(month)
    dtype = dtype or T.TimestampType()
    lo = F.lit(start.strftime("%Y-%m-%d %H:%M:%S")).cast(dtype)
    hi = F.lit(end.strftime("%Y-%m-%d %H:%M:%S")).cast(dtype)
    return (F.col(ts_col) >= lo) & (F.col(ts_col) < hi)


# Partition column of a month-partitioned collection (see sources.readers.write_month_partitioned).
MONTH_KEY = "month_key"


def month_key(ts: ColumnOrName) -> Column:
    """'2015-01' style key of a timestamp: the directory name of a month-partitioned layout."""
    return F.date_format(_c(ts), "yyyy-MM")


def month_pred(df, ts_col: str, month: str | None) -> Column:
    """``in_month`` for ``df``; when ``df`` is laid out by ``month_key`` the key is constrained
    too, so whole month directories are pruned (PartitionFilters) before any file is opened."""
    pred = in_month(ts_col, month, df.schema[ts_col].dataType)
    if month is not None and MONTH_KEY in df.columns:
        pred = pred & (F.col(MONTH_KEY) == F.lit(month_bounds(month)[0].strftime("%Y-%m")))
    return pred


def ms_to_seconds(ms: ColumnOrName) -> Column:
    """Epoch milliseconds -> whole epoch seconds (integer division)."""
    return F.floor(_c(ms) / 1000).cast("long")


def expiry_time(expires_at: ColumnOrName, dtype: T.DataType | None = None) -> Column:
    """Expiry as a timestamp; epoch-millisecond numbers are truncated to whole seconds."""
    c = _c(expires_at)
    if isinstance(dtype, T.NumericType):
        return F.timestamp_seconds(ms_to_seconds(c))
    return c


def is_expired(expires_at: ColumnOrName, as_of=None, dtype: T.DataType | None = None) -> Column:
    """True when ``as_of`` is strictly after the expiry. A missing expiry counts as expired.

    ``as_of`` is a datetime (UTC when it has no zone, whatever the machine's zone), a Column, or None
    for the current time."""
    if isinstance(as_of, _dt.datetime):
        at = as_of.astimezone(_dt.timezone.utc) if as_of.tzinfo else as_of
        now = F.to_timestamp(F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f+00:00")))
    else:
        now = F.current_timestamp() if as_of is None else as_of
    exp = expiry_time(expires_at, dtype)
    return F.coalesce(now.cast("timestamp") > exp.cast("timestamp"), F.lit(True))


def venue_id_strip(s: ColumnOrName) -> Column:
    """Text between the first '[' and the first following ']' of a rendered list
    ('[FB-1, FB-11]' -> 'FB-1, FB-11'); a string without brackets is kept whole."""
    return F.regexp_extract(_c(s), r"^(?:[^\[]*\[)?([^\]]*)", 1)


def time_diff(start: ColumnOrName, end: ColumnOrName, wrap_days: bool = False) -> Column:
    """Whole seconds from ``start`` to ``end``. ``wrap_days=True`` keeps only the seconds part
    of the day-difference (result modulo 86400, never negative), as the original helper did."""
    d = F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))
    return F.pmod(d, F.lit(86400)) if wrap_days else d


def full_match(c: ColumnOrName, pattern: str) -> Column:
    """Whole-string regex match (``rlike`` alone also accepts a match inside the string:
    'unlike' contains 'like'). A literal pattern is better written as ``==``, which pushes down."""
    return _c(c).rlike(f"\\A(?:{pattern})\\z")  # \z: '$' would also match before a final newline
