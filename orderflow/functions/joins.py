"""Join helpers: size-checked broadcast and interval-join conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.expressions import interval

# A replicated (broadcast) side must stay below this many bytes.
# The estimate is that of compressed files, so rows in memory may be several times larger.
DEFAULT_BROADCAST_LIMIT = 16 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def replicated(df: DataFrame, limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Broadcast ``df`` only when its estimated size is below ``limit``.

    Otherwise leave the choice to the planner/AQE (a shuffle join, converted
    to a broadcast at runtime only if the measured shuffle output is small).
    """
    if estimated_bytes(df) <= limit:
        return F.broadcast(df)
    return df


def within(left_ts: Column, right_ts: Column, window: str) -> Column:
    """``right_ts`` within +-window of ``left_ts``, both ends inclusive."""
    w = interval(window)
    return (right_ts >= left_ts - w) & (right_ts <= left_ts + w)
