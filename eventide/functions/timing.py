"""Column helpers for event time: durations, window bounds, ISO text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Microseconds per duration unit.
UNIT_MICROS = {
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def duration_micros(text: str) -> int:
    """Length of a duration such as ``"5 minutes"`` in microseconds."""
    number, unit = text.split()
    return round(float(number) * UNIT_MICROS[unit.rstrip("s")])


def plus(ts: Column, micros: int | Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + micros)


def slot(ts: Column, width_micros: int) -> Column:
    """Start of the epoch-aligned slot holding ``ts``, in microseconds (floors before 1970 too)."""
    at = F.unix_micros(ts)
    return at - F.pmod(at, F.lit(width_micros))


def window_bounds(ts: Column, size: str) -> tuple[Column, Column]:
    """Start and end of the tumbling window holding ``ts``, as plain row-level expressions."""
    width = duration_micros(size)
    start = slot(ts, width)
    return F.timestamp_micros(start), F.timestamp_micros(start + width)


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(6e7)


def iso_instant(ts: Column) -> Column:
    """ISO-8601 UTC text with milliseconds, whole seconds left bare as in ``2024-10-22T18:00:00Z``."""
    whole = F.pmod(F.unix_millis(ts), F.lit(1000)) == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    )


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.lit(100.0) * part / whole, 2)
