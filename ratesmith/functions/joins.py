"""Size-checked broadcast.

A side is broadcast only when the optimizer's size estimate of its plan is
under a bound; otherwise it is left to the planner (sort-merge join, which
adaptive execution may still turn into a broadcast join once the real size of
the shuffled side is known, and whose skewed partitions it splits).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 8 MiB: below Spark's own 10 MiB auto-broadcast threshold.
DEFAULT_BROADCAST_BYTES = 8 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan, or None if unavailable."""
    if not hasattr(df, "_jdf"):  # Spark Connect
        return None
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df
