"""Date and time expressions (session time zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO weekday names, Monday = 1 ... Sunday = 7.
DOW_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def iso_dow(d) -> Column:
    """ISO day of week, Monday = 1 (``dayofweek`` would give Sunday = 1)."""
    return F.weekday(_c(d)) + 1


def dow_name(d) -> Column:
    """Three-letter ISO weekday name of a date."""
    names = F.array(*[F.lit(n) for n in DOW_NAMES])
    return F.element_at(names, iso_dow(d))


def make_date(y, m, d) -> Column:
    return F.make_date(_c(y), _c(m), _c(d))


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of a zone-less timestamp, read
    as UTC whatever the session time zone is."""
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.timestamp_diff("MICROSECOND", epoch, _c(ts).cast("timestamp_ntz"))


def epoch_millis(ts) -> Column:
    """Milliseconds since the epoch (UTC), floored."""
    return F.floor(epoch_micros(ts) / F.lit(1000)).cast("bigint")


def minus_hours(ts, hours: int) -> Column:
    return F.timestamp_add("HOUR", F.lit(-hours), _c(ts))


def plus_minutes(ts, minutes) -> Column:
    return F.timestamp_add("MINUTE", _c(minutes).cast("int"), _c(ts))
