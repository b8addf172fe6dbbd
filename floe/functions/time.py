"""Event-time conversions that do not depend on the session time zone.

Test tables carry ``TIMESTAMP_NTZ``; ``withWatermark`` needs ``TIMESTAMP``.
Both directions go through epoch microseconds read as UTC, so epoch-aligned
windows are identical on either type whatever the session zone is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz_to_instant(ts: Column) -> Column:
    """TIMESTAMP_NTZ wall clock -> TIMESTAMP instant (wall clock read as UTC).

    Built from the wall-clock fields with an explicit UTC zone: casting or
    diffing NTZ values goes through the session zone and is off by an hour
    inside a daylight-saving gap.
    """
    return F.make_timestamp(
        F.year(ts),
        F.month(ts),
        F.dayofmonth(ts),
        F.hour(ts),
        F.minute(ts),
        F.date_part(F.lit("SECOND"), ts),
        F.lit("UTC"),
    )


def ntz_micros(ts: Column) -> Column:
    return F.unix_micros(ntz_to_instant(ts))


def ntz_seconds(ts: Column) -> Column:
    return F.unix_seconds(ntz_to_instant(ts))


def instant_to_ntz(ts: Column) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ wall clock in UTC."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr(_EPOCH_NTZ))


def from_epoch_millis(millis: Column) -> Column:
    """Epoch milliseconds -> TIMESTAMP (ascending-millis sources)."""
    return F.timestamp_millis(millis)


def from_epoch_seconds(seconds: Column) -> Column:
    """Epoch seconds -> TIMESTAMP (click logs count seconds)."""
    return F.timestamp_seconds(seconds)
