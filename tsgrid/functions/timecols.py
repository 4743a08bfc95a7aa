"""Time conversions and calendar features.

The session time zone is UTC (see session.py), so casting TIMESTAMP_NTZ to
TIMESTAMP and back never shifts the wall clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(c) -> Column:
    """TIMESTAMP / TIMESTAMP_NTZ -> whole epoch seconds (BIGINT)."""
    return F.unix_seconds(_c(c).cast("timestamp"))


def epoch_micros(c) -> Column:
    return F.unix_micros(_c(c).cast("timestamp"))


def from_epoch_seconds(c) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ (naive UTC)."""
    return F.timestamp_seconds(_c(c)).cast("timestamp_ntz")


def epoch_ms_to_ts(c) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ read as naive UTC (1383260400000 -> 2013-10-31 23:00)."""
    return F.timestamp_millis(_c(c)).cast("timestamp_ntz")


def floor_time(c, seconds: int) -> Column:
    """Floor a timestamp to a multiple of ``seconds`` since the epoch (TIMESTAMP_NTZ)."""
    s = epoch_seconds(c)
    return from_epoch_seconds(s - F.pmod(s, F.lit(seconds)))


def with_calendar(df: DataFrame, time: str = "datetime", epoch_ms: str | None = None) -> DataFrame:
    """Add datetime (from epoch ms if given), hour, day_of_week (Mon=0) and ISO week, as TINYINT."""
    if epoch_ms is not None:
        df = df.withColumn(time, epoch_ms_to_ts(epoch_ms))
    t = F.col(time)
    return (df.withColumn("hour", F.hour(t).cast("tinyint"))
              .withColumn("day_of_week", F.weekday(t).cast("tinyint"))
              .withColumn("week", F.weekofyear(t).cast("tinyint")))
