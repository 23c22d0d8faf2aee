"""Time arithmetic on whole numbers (microseconds since 1970 UTC), so that plans do not depend on the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Nominal seconds of the period labels.
PERIOD_SECONDS = {"15min": 900, "hourly": 3600, "daily": 86400}

DAY_US = 86_400_000_000


def epoch_us(ts: Column) -> Column:
    """Microseconds since 1970 UTC of a timestamp column (with or without zone; without means UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def epoch_s(ts: Column) -> Column:
    """Whole seconds since 1970 UTC, rounded down (also before 1970)."""
    return floor_div(epoch_us(ts), 1_000_000)


def floor_div(a: Column, b) -> Column:
    """Integer division rounding down, for negative numbers too."""
    b = b if isinstance(b, Column) else F.lit(b)
    return F.call_function("div", a - F.pmod(a, b), b)


def period_seconds(label: Column) -> Column:
    """Seconds of a period label, trimmed and without regard to case; NULL for an unknown label."""
    out = F.lit(None).cast("bigint")
    key = F.lower(F.trim(label))
    for name, seconds in PERIOD_SECONDS.items():
        out = F.when(key == name, F.lit(seconds).cast("bigint")).otherwise(out)
    return out


def text_of_s(seconds: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of whole seconds since 1970 UTC."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss")


def text_of_us(us: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSSSSS`` of microseconds since 1970 UTC."""
    return F.date_format(F.timestamp_micros(us), "yyyy-MM-dd HH:mm:ss.SSSSSS")
