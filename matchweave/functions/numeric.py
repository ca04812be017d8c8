"""Rounding the way SQL ``numeric`` does it, and times as integers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_up(value: Column, digits: int) -> Column:
    """Half-up rounding on an exact decimal, returned as double."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def pct(fraction: Column, digits: int = 1) -> Column:
    return half_up(fraction * 100, digits)


def ratio_pct(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part / whole`` in percent; null when ``whole`` is 0."""
    value = part / F.nullif(whole, F.lit(0)) * 100
    return value if digits is None else half_up(value, digits)


def clock_micros(time: Column) -> Column:
    """Microseconds of a zone-free timestamp, in its own order whatever the session zone."""
    days = F.unix_date(time.cast("date")).cast("bigint")
    seconds = days * 86_400 + F.hour(time) * 3_600 + F.minute(time) * 60
    return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), time) * 1_000_000).cast("bigint")
