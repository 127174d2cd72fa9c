"""Row filters as conditions on bare columns, so that they reach the file scan."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _stamp(value: str | date | datetime) -> Column:
    """A zone-less literal; comparing it with a zone-less column needs no cast on the column."""
    if isinstance(value, datetime):
        text = value.isoformat(sep=" ")
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def in_window(column: str, start, end) -> Column:
    """start <= column < end."""
    return (F.col(column) >= _stamp(start)) & (F.col(column) < _stamp(end))


def on_day(column: str, day: str | date) -> Column:
    """All of one day, written as a window rather than a cast of the column."""
    first = date.fromisoformat(str(day))
    return in_window(column, first, first + timedelta(days=1))


def in_month(column: str, year: int, month: int) -> Column:
    after = date(year + month // 12, month % 12 + 1, 1)
    return in_window(column, date(year, month, 1), after)


def partition_window(column: str, start, end, grain: str = "day") -> Column:
    """The days or months a time window touches, for a partition column that holds their first date.

    The column is derived, so Spark cannot work this out from the window itself.
    """
    first, last = touched_days(start, end, grain)
    return F.col(column).between(F.lit(first), F.lit(last))


def partition_date(column: str, grain: str = "day") -> Column:
    """The value of the partition that a time belongs to: its date, or the first day of its month."""
    if grain not in ("day", "month"):
        raise ValueError(f"no partitions by {grain}")
    return F.to_date(column) if grain == "day" else F.trunc(column, "month")


def touched_days(start, end, grain: str = "day") -> tuple[date, date]:
    begin, stop = _as_datetime(start), _as_datetime(end)
    first, last = begin.date(), (stop - timedelta(microseconds=1)).date()
    return (first, last) if grain == "day" else (first.replace(day=1), last.replace(day=1))


def _as_datetime(value) -> datetime:
    if isinstance(value, datetime):
        return value
    return datetime.fromisoformat(str(value))


def no_nulls(*names: str) -> Column:
    out = F.lit(True)
    for name in names:
        out = out & F.col(name).isNotNull()
    return out


def none_negative(*names: str) -> Column:
    """All at least zero; a null does not pass."""
    out = F.lit(True)
    for name in names:
        out = out & (F.col(name) >= 0)
    return out


def newer_than(df: DataFrame, column: str, target: DataFrame) -> DataFrame:
    """Rows past the largest value in the target; none while the target is empty.

    The scalar subquery runs once, ahead of the scan, and its value takes part in the scan's
    filter. `materialize.newer_rows` is the form for loads, with a first run that takes all rows.
    """
    return df.where(F.col(column) > target.agg(F.max(column)).scalar())
