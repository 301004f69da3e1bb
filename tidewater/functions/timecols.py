"""Time helpers: bucket boundaries, intervals, event-time casts.

The data's timestamps are ``timestamp_ntz``. The session runs in UTC, so a
cast to ``timestamp`` keeps the wall clock, and back again on output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS = 1_000_000


def seconds(n: int | float) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n))


def micros_of(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def from_micros(m: Column, ntz: bool = True) -> Column:
    t = F.timestamp_micros(m)
    return t.cast("timestamp_ntz") if ntz else t


def bucket_start(c: Column | str, size_seconds: int, offset_seconds: int = 0, ntz: bool = True) -> Column:
    """Start of the size-aligned bucket holding ``c`` (origin 1970-01-01 + offset),
    the same grid ``F.window`` uses."""
    size = size_seconds * MICROS
    off = offset_seconds * MICROS
    m = micros_of(c)
    start = m - F.pmod(m - F.lit(off), F.lit(size))
    return from_micros(start, ntz)


def bucket_end(c: Column | str, size_seconds: int, offset_seconds: int = 0, ntz: bool = True) -> Column:
    return bucket_start(c, size_seconds, offset_seconds, ntz) + seconds(size_seconds)


def as_event_time(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """``timestamp_ntz`` -> ``timestamp`` so ``withWatermark`` accepts it."""
    return df.withColumn(out or col, F.col(col).cast("timestamp"))


def as_ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df
