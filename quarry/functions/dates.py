"""Date/time scalars (2.10) with the calendar rules of the original:
Monday=0 weekdays, ISO weeks, two-digit years pivoting at 69, parse
failures that yield empty strings instead of errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_ts(col, fmt: str | None = None, ntz: bool = True) -> Column:
    """String -> timestamp; unparsable -> NULL (``try_`` form, ANSI-safe)."""
    c = _c(col)
    ts = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    return ts.cast("timestamp_ntz") if ntz else ts


def format_ts(col, fmt: str) -> Column:
    return F.date_format(_c(col), fmt)


def parse_month_year(col, prefix: str | None = None) -> dict[str, Column]:
    """``'Jan-74'`` -> ``{'<p>_month': '01', '<p>_year': '1974'}``.

    Two-digit years follow the C/POSIX pivot (00-68 -> 20xx, 69-99 ->
    19xx; trap T13): Spark's ``yy`` maps into 2000-2099, so 100 years are
    taken off years above 2068. A failed parse gives ``''`` for both parts
    (T14). Returns the two columns for ``withColumns``.
    """
    c = _c(col)
    name = prefix or (col if isinstance(col, str) else "date")
    ts = F.try_to_timestamp(c, F.lit("MMM-yy"))
    ts = F.when(F.year(ts) > 2068, F.add_months(ts, -1200)).otherwise(ts)
    return {
        f"{name}_month": F.coalesce(F.date_format(ts, "MM"), F.lit("")),
        f"{name}_year": F.coalesce(F.date_format(ts, "yyyy"), F.lit("")),
    }


def calendar_features(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """hour, dayofweek (Mon=0), quarter, month, year, dayofyear,
    dayofmonth, weekofyear (ISO) in one projection (op 10.4 / 16.2)."""
    t = F.col(ts)
    return df.withColumns({
        f"{prefix}hour": F.hour(t),
        f"{prefix}dayofweek": F.weekday(t),
        f"{prefix}quarter": F.quarter(t),
        f"{prefix}month": F.month(t),
        f"{prefix}year": F.year(t),
        f"{prefix}dayofyear": F.dayofyear(t),
        f"{prefix}dayofmonth": F.dayofmonth(t),
        f"{prefix}weekofyear": F.weekofyear(t),
    })


_PARTS = {
    "hour": F.hour, "date": F.to_date, "year": F.year, "month": F.month, "day": F.dayofmonth,
    "weekday": F.weekday, "quarter": F.quarter,
    "weekday_name": lambda c: F.date_format(c, "EEEE"),
    "month_name": lambda c: F.date_format(c, "MMMM"),
}


def date_part(col, part: str) -> Column:
    """One calendar part (op 10.5): hour, date, year, month, day, weekday
    (Mon=0), quarter, weekday_name, month_name."""
    return _PARTS[part](_c(col))


def days_between(start, end) -> Column:
    """Difference of calendar dates, end - start (T18)."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def minutes_between(start, end) -> Column:
    """Exact elapsed minutes (fractional), end - start (T18); microsecond
    difference, independent of the session time zone for TIMESTAMP_NTZ."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / 6.0e7


def add_days(col, n: int) -> Column:
    return F.date_add(_c(col), n)


def add_months(col, n: int) -> Column:
    return F.add_months(_c(col), n)


def recency(df: DataFrame, key: str, date: str, offset_days: int = 2, name: str = "recency") -> DataFrame:
    """Days from each key's last date to (global max date + offset).

    The global max is a scalar subquery (one tiny job), not a join; the
    per-key max is a partially aggregated group-by.
    """
    ref = F.date_add(df.select(F.max(F.to_date(date))).scalar(), offset_days)
    return (df.groupBy(key).agg(F.max(F.to_date(date)).alias("__last"))
            .select(key, F.datediff(ref, F.col("__last")).alias(name)))
