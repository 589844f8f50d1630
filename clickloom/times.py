"""Durations and timestamps as microseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNIT_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def micros(duration: str) -> int:
    """``"5 minutes"`` as microseconds; a leading minus is allowed."""
    number, unit = duration.split()
    return round(float(number) * _UNIT_US[unit.rstrip("s")])


def interval(us: int) -> Column:
    """A day-time interval of ``us`` microseconds."""
    return F.expr(f"INTERVAL '{us / 1e6:.6f}' SECOND")


def position(df: DataFrame, name: str) -> Column:
    """An order column as a long: microseconds for timestamps, the value itself for integers.

    A timestamp without zone is turned into wall-clock microseconds field by field, so the session
    zone and its clock changes play no part.
    """
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, T.TimestampNTZType):
        day = F.unix_date(F.to_date(col)).cast("long") * _UNIT_US["day"]
        minute = (F.hour(col) * 60 + F.minute(col)).cast("long") * _UNIT_US["minute"]
        return day + minute + (F.extract(F.lit("SECOND"), col) * 1_000_000).cast("long")
    if isinstance(kind, T.IntegralType):
        return col.cast("long")
    raise TypeError(f"cannot order by {name}: {kind.simpleString()}")
