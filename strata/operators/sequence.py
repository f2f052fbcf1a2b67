"""Skew-safe ordered operations within groups: row numbers and previous-row values.

A plain ``row_number()/lag() over (partition by g order by t)`` sends every row
of a group to one task; a group holding a third of the data becomes one huge
sort. These helpers split each group into *time buckets* (``bucket``
expression, e.g. the day of ``t``): the per-row work is a window over
(group, bucket), and the hand-over between buckets goes through a small table
with one row per (group, bucket) — its size is groups × buckets, not rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _asc(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def bucketed_row_number(df: DataFrame, group: Sequence[str], order: Sequence[str], bucket: Column, name: str) -> DataFrame:
    """``row_number() over (partition by group order by order)``, computed per bucket.

    ``bucket`` must be monotone in ``order`` (e.g. ``date_trunc('day', t)``).
    """
    b = df.withColumn("__bucket", bucket)
    local = b.withColumn("__rn", F.row_number().over(Window.partitionBy(*group, "__bucket").orderBy(*_asc(order))))
    counts = b.groupBy(*group, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n")
    out = _join_null_safe(local, offsets, [*group, "__bucket"])
    return out.withColumn(name, (F.col("__off") + F.col("__rn")).cast("int")).drop("__bucket", "__rn", "__off")


def _join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join in which NULL group values match each other."""
    right = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    cond = reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"__r_{c}"]) for c in on])
    return left.join(right, cond, "left").drop(*[f"__r_{c}" for c in on])


def bucketed_lag(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    cols: Sequence[str],
    prefix: str = "prev_",
) -> DataFrame:
    """``lag(c) over (partition by group order by order)`` for each ``c`` in ``cols``.

    Inside a bucket it is a normal lag. The first and last rows of all buckets of a group then
    meet in a second window, where the row before a bucket's first is the last of the nearest
    earlier bucket; other rows stay with their bucket. ``df`` is read once, and a group's edge
    rows are at most two for each bucket. NULL group values are a group; NULL buckets come last.
    """
    b = df.withColumn("__bucket", bucket)
    w_in = Window.partitionBy(*group, "__bucket").orderBy(*_asc(order))
    local = b.withColumns(
        {
            **{f"__lag_{c}": F.lag(c).over(w_in) for c in cols},
            "__rn": F.row_number().over(w_in),
            # the bucket's last row is the one without a successor: no extra aggregate
            "__edge": (F.row_number().over(w_in) == 1) | F.lead(F.lit(1)).over(w_in).isNull(),
        }
    ).withColumn("__place", F.when(~F.col("__edge"), F.col("__bucket")))
    # the row number orders edge rows of one bucket: rows that tie in ``order`` keep the first window's order
    w_edge = Window.partitionBy(*group, "__edge", "__place").orderBy(*_asc(["__bucket", "__rn"]))
    out = local.withColumns({f"__before_{c}": F.lag(c).over(w_edge) for c in cols})
    return out.withColumns(
        {f"{prefix}{c}": F.when(F.col("__rn") == 1, F.col(f"__before_{c}")).otherwise(F.col(f"__lag_{c}")) for c in cols}
    ).drop("__bucket", "__rn", "__edge", "__place", *[f"__{k}_{c}" for k in ("lag", "before") for c in cols])
