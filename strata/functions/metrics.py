"""Metric helpers: tiering by thresholds and guarded division."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def tier(value: str | Column, thresholds: Sequence[tuple[float, str]], default: str) -> Column:
    """First label whose threshold ``value >= t`` holds, checked in the given order.

    A NULL value matches nothing and gets ``default`` (a customer with no orders
    is 'New').
    """
    v = F.col(value) if isinstance(value, str) else value
    expr = None
    for threshold, label in thresholds:
        expr = F.when(v >= F.lit(threshold), F.lit(label)) if expr is None else expr.when(v >= F.lit(threshold), F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def safe_divide(num: str | Column, den: str | Column, guard: Column | None = None, default: float = 0.0) -> Column:
    """``num / den`` when ``guard`` (default ``den > 0``) holds, else ``default``.

    Written as a CASE so that ANSI mode never sees a division by zero.
    """
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    cond = guard if guard is not None else d > 0
    return F.when(cond, n / d).otherwise(F.lit(default))
