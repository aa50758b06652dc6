"""Time arithmetic shared by the operators.

Durations are written the way Spark writes window lengths ("10 minutes").
Everything here is zone-free on TIMESTAMP_NTZ and exact on TIMESTAMP.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: "Now", as a literal, a column or a scalar subquery.
AsOf = Column | dt.datetime


def instant(as_of: AsOf) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(duration: str) -> int:
    """Microseconds of a duration such as ``"10 minutes"``, ``"1 hour 30 minutes"`` or ``"0.5 seconds"``."""
    parts = duration.split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    total = Decimal(0)
    for amount, unit in zip(parts[::2], parts[1::2], strict=True):
        name = unit.lower().removesuffix("s")
        if name not in _MICROS:
            raise ValueError(f"{unit!r} has no fixed length")
        total += Decimal(amount) * _MICROS[name]
    return int(total)


def interval(duration: str) -> Column:
    """A day-time interval from a duration."""
    return F.expr(f"INTERVAL '{Decimal(micros(duration)) / 1_000_000:f}' SECOND")


def bucket_start(time: str | Column, width: str) -> Column:
    """Start of the epoch-aligned tumbling bucket that holds ``time``."""
    return F.window(time, width)["start"]
