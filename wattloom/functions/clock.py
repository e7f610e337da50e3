"""Time helpers on zone-less UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def unix_to_utc(seconds: str) -> Column:
    """Seconds since 1970 to a zone-less UTC timestamp, whatever the session zone is."""
    return F.expr(f"{EPOCH} + make_dt_interval(0, 0, 0, `{seconds}`)")


def hour_of(ts: Column | str) -> Column:
    return _trunc("hour", ts)


def month_of(ts: Column | str) -> Column:
    return F.to_date(_trunc("month", ts))


def _trunc(unit: str, ts: Column | str) -> Column:
    # date_trunc answers with the session-zone type, so the zone-less type is restored
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def local_time(utc: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a zone-less UTC timestamp, daylight saving included."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def weekday(ts: Column | str) -> Column:
    return F.dayname(F.to_date(ts))


def days_covered(first: Column, last: Column) -> Column:
    return F.datediff(last, first) + 1
