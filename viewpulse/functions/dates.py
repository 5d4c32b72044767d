"""Date and clock expressions. `today`/`now` are always arguments, never the wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = str | dt.date


def day(value: DateLike | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def clock(value: str | dt.datetime | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 (each side truncated before any difference is taken), independent of the session zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def week_start(d: Column) -> Column:
    """Monday of the week."""
    return F.trunc(d, "week")


def date_key(d: Column) -> Column:
    """yyyyMMdd as an integer."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_bit(d: Column) -> Column:
    """One bit per weekday: bit_or over a week followed by bit_count is an exact distinct-day count."""
    return F.element_at(F.array(*[F.lit(1 << i) for i in range(7)]), F.weekday(d) + 1)


def between_days(column: Column, first: DateLike | Column, last: DateLike | Column) -> Column:
    return (column >= day(first)) & (column <= day(last))


def back(d: DateLike, days: int) -> dt.date:
    """Plain calendar arithmetic on a run's own date, so that partition filters stay literals."""
    return dt.date.fromisoformat(str(d)) - dt.timedelta(days=days)


def monday(d: DateLike) -> dt.date:
    """Monday of the week of a run's own date."""
    return back(d, dt.date.fromisoformat(str(d)).weekday())
