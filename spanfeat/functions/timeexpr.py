"""Expressions on instants, dates and clock numbers."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..session import require_utc

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000
MINUTE_US = 60_000_000


def span_us(span: timedelta) -> int:
    """Whole microseconds of a timedelta."""
    return span // timedelta(microseconds=1)


def instant(when: datetime, kind: DataType | str = "timestamp_ntz") -> Column:
    """Literal instant of a column's own type, whatever the driver's local zone.

    It folds to a constant, so comparisons with it reach the parquet reader.
    """
    return F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz").cast(kind)


def micros(col: Column | str) -> Column:
    """Microseconds since the epoch, for timestamp and timestamp_ntz (UTC session)."""
    col = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(col.cast("timestamp"))


def from_micros(col: Column) -> Column:
    """Inverse of ``micros``, zone-free."""
    return F.timestamp_micros(col).cast("timestamp_ntz")


def date_parts(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """Year, month, day of month and hour of one timestamp, in one projection."""
    c = F.col(ts)
    return df.withColumns(
        {
            f"{prefix}year": F.year(c),
            f"{prefix}month": F.month(c),
            f"{prefix}day_of_month": F.dayofmonth(c),
            f"{prefix}hour": F.hour(c),
        }
    )


def hour_block(col: Column) -> Column:
    """Label of the clock hour, e.g. ``0800-0859``."""
    hh = F.date_format(col, "HH")
    return F.concat(hh, F.lit("00-"), hh, F.lit("59"))


def minutes_after_midnight(col: Column) -> Column:
    return F.hour(col) * 60 + F.minute(col)


def clock_to_ts(date: Column, hhmm: Column) -> Column:
    """Date and HHMM number to an instant; 2400 is 00:00 of the next day.

    A clock outside 0000-2400 or with minutes over 59 gives null.
    """
    hour = F.floor(hhmm / 100).cast("int")
    minute = F.pmod(hhmm, F.lit(100)).cast("int")
    total = hour * 60 + minute
    valid = (hhmm >= 0) & (hhmm <= 2400) & (minute < 60)
    midnight = F.date_trunc("day", date.cast("timestamp_ntz")).cast("timestamp_ntz")
    shifted = midnight + F.make_dt_interval(mins=total)
    return F.when(valid, shifted)


def roll_after(start: Column, end: Column) -> Column:
    """An end clock earlier than its start belongs to the next day."""
    return F.when(end < start, end + F.expr("INTERVAL 1 DAY")).otherwise(end)


def to_utc(ts: Column, zone: Column | str) -> Column:
    """Local wall-clock time to UTC by a per-row zone name; DST gaps follow Java's rules.

    The active session's zone must be UTC, in which the wall clock is read.
    """
    session = SparkSession.getActiveSession()
    if session is not None:
        require_utc(session)
    zone = F.lit(zone) if isinstance(zone, str) else zone
    return F.to_utc_timestamp(ts.cast("timestamp"), zone).cast("timestamp_ntz")


def parse_day(col: Column, fmt: str = "yyyyMMdd") -> Column:
    """Text to timestamp; malformed text gives null."""
    return F.try_to_timestamp(col, F.lit(fmt))


def lookback_bounds(
    df: DataFrame,
    ts: str,
    min_lag: timedelta,
    max_age: timedelta,
    lower: str = "ts_min",
    upper: str = "ts_max",
) -> DataFrame:
    """Bounds of the look-back window ``[ts - max_age, ts - min_lag]``."""
    return df.withColumns({lower: F.col(ts) - F.lit(max_age), upper: F.col(ts) - F.lit(min_lag)})
