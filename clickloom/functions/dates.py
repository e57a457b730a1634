"""Calendar helpers. "Now" is always an argument, never read from the host."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Asia/Taipei"
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def local_time(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """UTC wall-clock time to local wall-clock time, independent of the session zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def local_date(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(local_time(ts, zone))


def local_hour(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.hour(local_time(ts, zone))


def parse_date(c: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.to_date(F.try_to_timestamp(c, F.lit(pattern)))


def midnight(ts: Column) -> Column:
    return F.date_trunc("DAY", ts)


def days_before(d: Column, days: int | Column = 1) -> Column:
    """Date shifted back; negative days go forward."""
    return F.date_sub(F.to_date(d), days)


def expiry_date(d: Column, days: int | Column) -> Column:
    return F.date_add(F.to_date(d), days)


def days_in_month(d: Column) -> Column:
    return F.dayofmonth(F.last_day(d))


def days_in_year(d: Column) -> Column:
    return F.dayofyear(F.make_date(F.year(d), F.lit(12), F.lit(31)))


def format_date(d: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(d, pattern)


def date_int(d: Column) -> Column:
    """yyyyMMdd as an integer."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def date_range(start: Column, days: int | Column) -> Column:
    """Array of ``days`` consecutive dates from ``start``."""
    days = F.lit(days) if isinstance(days, int) else days
    return F.sequence(F.to_date(start), F.date_add(F.to_date(start), days - 1))


def hour_edges(start: Column, days: int, hours: int = 2) -> Column:
    """Bucket edges from ``start``: one more edge than buckets."""
    end = start + F.make_dt_interval(days=F.lit(days))
    return F.sequence(start, end, F.make_dt_interval(hours=F.lit(hours)))


def hour_bucket(ts: Column, hours: int = 2) -> Column:
    """Start hour of the half-open bucket that holds ``ts``."""
    return F.floor(F.hour(ts) / hours).cast("int") * hours


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a wall-clock time, independent of the session zone."""
    return F.timestamp_diff("SECOND", F.expr(EPOCH), ts)


def from_epoch_seconds(c: Column) -> Column:
    return F.timestamp_add("SECOND", c, F.expr(EPOCH))


def utc_instant(ts: Column) -> Column:
    """Wall-clock UTC time to an instant (what stream watermarks and windows need)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(EPOCH), ts))


def utc_clock(instant: Column) -> Column:
    """Instant to wall-clock UTC time, cut to the second."""
    return from_epoch_seconds(F.unix_seconds(instant))


def from_epoch_millis(c: Column) -> Column:
    """Epoch milliseconds to wall-clock time, cut to the second."""
    return from_epoch_seconds(F.floor(c / 1000).cast("long"))


def iso_weekday(d: Column) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(d) + 1


def months_before(d: Column, months: int = 2) -> Column:
    """First day of the month ``months`` back, right across a year change too."""
    return F.trunc(F.add_months(F.to_date(d), -months), "month")


def day_index(d: Column, ref: Column) -> Column:
    """1 for the reference date itself."""
    return F.datediff(F.to_date(d), F.to_date(ref)) + 1
