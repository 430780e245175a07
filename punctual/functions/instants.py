"""Instants and calendar dates."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = datetime | Column


def utc(instant: datetime) -> datetime:
    """Read a datetime without a zone as UTC."""

    return instant.astimezone(UTC) if instant.tzinfo else instant.replace(tzinfo=UTC)


def instant(as_of: AsOf) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(utc(as_of))


def shifted(as_of: AsOf, **delta: int) -> Column:
    """``as_of`` plus an exact duration, as a literal where possible so scans can use it."""

    if isinstance(as_of, Column):
        seconds = int(timedelta(**delta).total_seconds())
        return F.timestamp_micros(F.unix_micros(as_of) + F.lit(seconds * 1_000_000))
    return F.lit(utc(as_of) + timedelta(**delta))


def midnight(as_of: AsOf, days_before: int) -> Column:
    """Midnight UTC of the date ``days_before`` days before ``as_of``."""

    if isinstance(as_of, Column):
        return F.date_sub(F.to_date(as_of), days_before).cast("timestamp")
    day = utc(as_of).replace(hour=0, minute=0, second=0, microsecond=0)
    return F.lit(day - timedelta(days=days_before))


def epoch_ms_to_ts(milliseconds: Column) -> Column:
    """Epoch milliseconds to an instant; zero counts as missing."""

    return F.timestamp_millis(F.nullif(milliseconds, F.lit(0).cast("bigint")))


def local_date(ts: Column, zone: Column) -> Column:
    """Calendar date of a UTC instant in the row's own zone."""

    return F.to_date(F.from_utc_timestamp(ts, zone))


def deadline_instant(date: Column, time: Column, zone: Column) -> Column:
    """UTC instant of a local date and HH:MM time.

    The local reading is built by arithmetic, which is exact in a UTC session and needs no parsing
    per deadline; only the conversion from the zone looks at daylight saving.
    """

    minutes = F.substring(time, 1, 2).cast("int") * 60 + F.substring(time, 4, 2).cast("int")
    local = F.timestamp_seconds(F.unix_date(date).cast("bigint") * 86_400 + minutes * 60)
    return F.to_utc_timestamp(local, zone)


def whole_seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)
