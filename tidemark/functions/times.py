"""Time on the epoch-microsecond columns of the change log.

Integer arithmetic and TIMESTAMP_NTZ throughout, so results do not depend on
the session time zone.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60 * 1_000_000
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE
MICROS_PER_DAY = 24 * MICROS_PER_HOUR

AsOf = datetime | Column | None


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def _floored(micros: Column, width: int) -> Column:
    return micros - F.pmod(micros, F.lit(width))


def utc_timestamp(micros: Column) -> Column:
    """Epoch microseconds as a UTC wall-clock timestamp."""
    return F.timestamp_add("MICROSECOND", micros, _epoch())


def micros_of(ts: Column) -> Column:
    """Epoch microseconds of a wall-clock (NTZ) timestamp."""
    seconds = (ts - _epoch()).cast("interval second").cast("decimal(20,6)")
    return (seconds * 1_000_000).cast("bigint")


def day_of(micros: Column) -> Column:
    return F.date_from_unix_date((_floored(micros, MICROS_PER_DAY) / MICROS_PER_DAY).cast("int"))


def month_of(micros: Column) -> Column:
    """Month as the integer yyyymm."""
    day = day_of(micros)
    return F.year(day) * 100 + F.month(day)


def hour_of(micros: Column) -> Column:
    in_day = F.pmod(micros, F.lit(MICROS_PER_DAY))
    return (_floored(in_day, MICROS_PER_HOUR) / MICROS_PER_HOUR).cast("int")


def day_start(micros: Column) -> Column:
    """Microsecond at which the day of ``micros`` begins."""
    return _floored(micros, MICROS_PER_DAY)


def minutes_crossed(start: Column, end: Column) -> Column:
    """Minute boundaries between two epoch-microsecond values.

    Counts crossings, so 00:00:59 to 00:01:01 is one minute.
    """
    whole = _floored(end, MICROS_PER_MINUTE) - _floored(start, MICROS_PER_MINUTE)
    return (whole / MICROS_PER_MINUTE).cast("bigint")


def as_of_micros(as_of: AsOf) -> Column:
    """The clock of a relative metric, as epoch microseconds.

    ``None`` is the current time, a datetime without zone is read as UTC, and
    a column is taken to hold epoch microseconds already.
    """
    if as_of is None:
        return F.unix_micros(F.current_timestamp())
    if isinstance(as_of, Column):
        return as_of
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    since = as_of - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return F.lit((since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds)
