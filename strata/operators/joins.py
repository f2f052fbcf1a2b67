"""Join helpers: broadcast a side only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST = 64 << 20  # 64 MB


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` (file sizes / column stats; no job runs)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST) -> DataFrame:
    """``broadcast(df)`` when its estimated size is at most ``max_bytes``, else ``df`` unchanged
    (the planner and AQE then choose from runtime sizes)."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df
