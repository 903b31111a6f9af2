"""Event-time helpers in UTC: floors as plain integer arithmetic on microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = {"1m": 60_000_000, "5m": 300_000_000, "15m": 900_000_000, "1h": 3_600_000_000, "4h": 14_400_000_000, "1d": 86_400_000_000}


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def floor_to(ts: Column, timeframe: str) -> Column:
    """Start of the window of a timeframe that holds ``ts``, aligned to the epoch."""
    us = micros(ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(MICROS[timeframe])))


def day(ts: Column) -> Column:
    return F.to_date(ts)


def shifted(ts: Column, us: int) -> Column:
    return F.timestamp_micros(micros(ts) + us)


def age_minutes(later: Column, earlier: Column) -> Column:
    """Whole minutes between two instants, towards zero."""
    return ((micros(later) - micros(earlier)) / 60_000_000).cast("long")


UNITS = {"s": 1_000_000, "m": MICROS["1m"], "h": MICROS["1h"], "d": MICROS["1d"]}


def duration(text: str) -> int:
    """Microseconds of a duration such as 90s, 240m, 24h or 7d."""
    number, unit = text.strip()[:-1], text.strip()[-1:]
    if unit not in UNITS or not number.isdigit():
        raise ValueError(f"no duration: {text!r}; use 90s, 240m, 24h or 7d")
    return int(number) * UNITS[unit]
