"""Date and time functions.

There are two different differences: :func:`elapsed` counts whole units that have passed,
:func:`boundaries` counts calendar borders crossed. One day 23 hours is 1 elapsed day, and two
borders when it spans two midnights.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewind.functions.text import _col

TIME_UNITS = ("hour", "minute", "second")


def elapsed(end: Column | str, start: Column | str, unit: str = "day") -> Column:
    """Whole units between two instants, truncated toward zero (negative when end < start)."""
    return F.timestamp_diff(unit.upper(), _col(start), _col(end))


def truncate(part: str, ts: Column | str) -> Column:
    """Start of the ``part`` holding ``ts``, as timestamp. Weeks start on Sunday, ISO weeks on Monday."""
    ts = _col(ts).cast("timestamp")
    if part == "week":
        return F.date_sub(ts.cast("date"), F.dayofweek(ts) - 1).cast("timestamp")
    return F.date_trunc("week" if part == "isoweek" else part, ts)


def boundaries(first: Column | str, second: Column | str, part: str = "day") -> Column:
    """Number of ``part`` borders between ``first`` and ``second``."""
    a, b = _col(first).cast("timestamp"), _col(second).cast("timestamp")
    if part in TIME_UNITS:
        return F.timestamp_diff(part.upper(), F.date_trunc(part, a), F.date_trunc(part, b))
    if part == "day":
        return F.datediff(b, a).cast("bigint")
    if part in ("week", "isoweek"):
        return (F.datediff(truncate(part, b), truncate(part, a)) / 7).cast("bigint")
    if part == "month":
        return ((F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)).cast("bigint")
    if part == "quarter":
        return ((F.year(b) - F.year(a)) * 4 + F.quarter(b) - F.quarter(a)).cast("bigint")
    if part == "year":
        return (F.year(b) - F.year(a)).cast("bigint")
    raise ValueError(f"unknown date part: {part}")


def date_add(part: str, n: Column | int, ts: Column | str) -> Column:
    """``ts`` moved by ``n`` parts, as a timestamp without zone."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.timestamp_add(part.upper(), n.cast("int"), _col(ts).cast("timestamp")).cast("timestamp_ntz")


def last_day(d: Column | str, part: str = "month") -> Column:
    """Last day of the month, quarter or year holding ``d``."""
    return date_add("day", -1, date_add(part, 1, truncate(part, d))).cast("date")


def make_date(year: Column | int, month: Column | int, day: Column | int) -> Column:
    return F.make_date(*[F.lit(x) if isinstance(x, int) else _col(x) for x in (year, month, day)])


def to_timestamp(text: Column | str) -> Column:
    return F.to_timestamp(F.lit(text) if isinstance(text, str) else text)


def time_literal(t: datetime) -> Column:
    """A Python time as timestamp. Without a zone it is meant in the session's zone; ``F.lit`` would
    take it in the zone of the driver machine."""
    return F.lit(t) if t.tzinfo else F.lit(t.isoformat(" ")).cast("timestamp")


def current_timestamp() -> Column:
    return F.current_timestamp()


def intervals_between(spark: SparkSession, start: str, end: str, part: str) -> int:
    """Borders between two literal dates, as a number; 1 when there is no answer."""
    row = spark.range(1).select(boundaries(F.lit(start), F.lit(end), part)).first()
    return 1 if row is None or row[0] is None else row[0]


def date_spine(spark: SparkSession, part: str, start: str, end: str) -> DataFrame:
    """One row per ``part`` from ``start`` up to, not including, ``end`` (column ``date_<part>``)."""
    n = max(intervals_between(spark, start, end, part), 0)
    return spark.range(n).select(date_add(part, F.col("id"), F.lit(start)).alias(f"date_{part}"))


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """Numbers 1 … ``upper_bound``."""
    if upper_bound <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def _days(text: str | int | date, fmt: str) -> tuple[date, date]:
    """First and last day of ``'start'`` or ``'start,end'``."""
    ends = [t.strip() for t in (text.strftime(fmt) if isinstance(text, date) else str(text)).split(",")]
    if len(ends) > 2:
        raise ValueError(f"a range of days is 'start' or 'start,end': {text!r}")
    first, last = datetime.strptime(ends[0], fmt).date(), datetime.strptime(ends[-1], fmt).date()
    if last < first:
        raise ValueError(f"a range of days must not end before it starts: {text!r}")
    return first, last


def in_days(column: Column | str, text: str | int | date, fmt: str = "%Y%m%d") -> Column:
    """Whether a date or time lies in the days that ``text`` names, both ends included. The column stays bare, so the
    filter reaches the scan and prunes partitions."""
    first, last = _days(text, fmt)
    return (_col(column) >= F.lit(first)) & (_col(column) < F.lit(last + timedelta(days=1)))


def day_range(spark: SparkSession, text: str | int | date, fmt: str = "%Y%m%d", out: str | None = "yyyyMMdd") -> DataFrame:
    """One row per day that ``text`` names: column ``day``, as text in the pattern ``out`` or as a date."""
    first, last = _days(text, fmt)
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"))
    return days.select(F.date_format("day", out).alias("day")) if out else days
