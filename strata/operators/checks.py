"""Data-quality checks compiled to as few passes as possible.

All row-level checks of one table (not_null, accepted_values, between,
match_regex, each optionally with a ``where``) become ``count_if`` terms of a
*single* aggregate: one scan, map-side partial aggregation, a one-row
result. ``unique`` costs one aggregate by the column (partial aggregation
collapses hot values before the shuffle) and ``relationships`` the same
aggregate plus a join of the counts to the parent keys.
The summary is returned as a DataFrame (lazily); ``raise_on_error`` is the
only place that collects it (a handful of rows).

NULL passes accepted_values, between, regex and relationships and is ignored
by unique; only not_null catches it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.metadata import ts_literal

ROW_CHECKS = ("not_null", "accepted_values", "between", "match_regex")


@dataclass(frozen=True)
class Check:
    kind: str  # not_null | accepted_values | between | match_regex | unique | relationships | row_count_between
    column: str | None = None
    values: tuple = ()
    min: float | None = None
    max: float | None = None
    strictly: bool = False
    regex: str | None = None
    where: str | None = None
    severity: str = "error"  # error | warn
    to: DataFrame | None = field(default=None, compare=False)  # parent for relationships
    field_: str | None = None  # parent column for relationships

    @property
    def name(self) -> str:
        return self.kind + ("_where" if self.where else "")


def failure_condition(c: Check) -> Column:
    """TRUE for a failing row (NULL never fails anything but not_null)."""
    col = F.col(c.column)
    if c.kind == "not_null":
        cond = col.isNull()
    elif c.kind == "accepted_values":
        cond = col.isNotNull() & ~col.isin(*c.values)
    elif c.kind == "between":
        lo = hi = F.lit(False)
        if c.min is not None:
            lo = col <= c.min if c.strictly else col < c.min
        if c.max is not None:
            hi = col >= c.max if c.strictly else col > c.max
        cond = col.isNotNull() & (lo | hi)
    elif c.kind == "match_regex":
        cond = col.isNotNull() & ~col.rlike(c.regex)
    else:
        raise ValueError(f"{c.kind} is not a row-level check")
    if c.where:
        cond = F.expr(c.where) & cond
    return F.coalesce(cond, F.lit(False))


def _status(failures: Column, severity: Column) -> Column:
    return F.when(failures == 0, F.lit("pass")).otherwise(severity)


_SUMMARY = ("table_name", "column_name", "check_name", "severity", "row_count", "failures", "status")


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One summary row per check: (table_name, column_name, check_name, severity, row_count, failures, status).

    Passes over ``df``: one aggregate for all row-level checks and row-count
    bounds, plus one per unique check (group by the column, then a global
    aggregate of the group counts) and one per relationships check (counts per
    key joined to the distinct parent keys, then a global aggregate). Each pass yields its
    own row count, so no check needs an extra count job.
    """
    row_checks = [c for c in checks if c.kind in ROW_CHECKS or c.kind == "row_count_between"]
    other = [c for c in checks if c not in row_checks]
    parts: list[DataFrame] = []
    if row_checks:
        aggs = [F.count(F.lit(1)).alias("__rows")]
        for i, c in enumerate(row_checks):
            if c.kind == "row_count_between":
                continue
            aggs.append(F.count_if(failure_condition(c)).alias(f"__f{i}"))
        one = df.agg(*aggs)  # the single pass
        terms = []
        for i, c in enumerate(row_checks):
            col = "CAST(NULL AS STRING)" if c.column is None else f"'{c.column}'"
            if c.kind == "row_count_between":
                lo = c.min if c.min is not None else -1
                hi = c.max if c.max is not None else 2**62
                fail = f"CAST(IF(__rows < {lo} OR __rows > {hi}, 1, 0) AS BIGINT)"
            else:
                fail = f"__f{i}"
            terms.append(f"{col}, '{c.name}', '{c.severity}', {fail}")
        rows = one.selectExpr("__rows", f"stack({len(terms)}, {', '.join(terms)}) as (column_name, check_name, severity, failures)")
        parts.append(rows.select(F.lit(table).alias("table_name"), "column_name", "check_name", "severity", F.col("__rows").alias("row_count"), "failures"))
    for c in other:
        if c.kind == "unique":
            groups = df.groupBy(c.column).agg(F.count(F.lit(1)).alias("__n"))
            res = groups.agg(
                F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("row_count"),
                F.count_if(F.col(c.column).isNotNull() & (F.col("__n") > 1)).alias("failures"),
            )
        elif c.kind == "relationships":
            # child rows are counted by key before the join: a hot key, or all NULLs, is one row of it
            keys = c.to.select(F.col(c.field_ or c.column).alias("__pk")).where(F.col("__pk").isNotNull()).distinct()
            keys = keys.withColumn("__hit", F.lit(True))
            counts = df.groupBy(F.col(c.column).alias("__fk")).agg(F.count(F.lit(1)).alias("__n"))
            missed = F.col("__fk").isNotNull() & F.col("__hit").isNull()
            res = counts.join(keys, F.col("__fk") == F.col("__pk"), "left").agg(
                F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("row_count"),
                F.coalesce(F.sum(F.when(missed, F.col("__n"))), F.lit(0)).alias("failures"),
            )
        else:
            raise ValueError(f"unknown check {c.kind!r}")
        parts.append(
            res.select(
                F.lit(table).alias("table_name"),
                F.lit(c.column).cast("string").alias("column_name"),
                F.lit(c.name).alias("check_name"),
                F.lit(c.severity).alias("severity"),
                "row_count",
                F.col("failures").cast("bigint").alias("failures"),
            )
        )
    if not parts:
        raise ValueError("no checks given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", _status(F.col("failures"), F.col("severity"))).select(*_SUMMARY)


def raise_on_error(summary: DataFrame) -> list:
    """Collect the (small) summary; raise if an error-severity check failed."""
    rows = summary.collect()
    bad = [r for r in rows if r["status"] == "error"]
    if bad:
        raise AssertionError("data-quality checks failed: " + "; ".join(f"{r['table_name']}.{r['column_name']} {r['check_name']} ({r['failures']})" for r in bad))
    return rows


def unique_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values of ``cols`` that occur more than once (NULLs ignored), with their count."""
    nn = None
    for c in cols:
        cond = F.col(c).isNotNull()
        nn = cond if nn is None else nn & cond
    return df.where(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL ``fk`` is absent from ``parent.pk`` (anti-join)."""
    keys = parent.select(F.col(pk).alias("__pk"))
    c = child.where(F.col(fk).isNotNull())
    return c.join(keys, c[fk] == keys["__pk"], "left_anti")


def grain_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Singular grain test: keys with more than one row (``having count(*) > 1``)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def row_count_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: source_rows, target_rows, diff = source − target (0 = reconciled)."""
    s = source.select(F.lit(1).alias("__s"), F.lit(0).alias("__t"))
    t = target.select(F.lit(0).alias("__s"), F.lit(1).alias("__t"))
    agg = s.unionByName(t).agg(F.sum("__s").cast("bigint").alias("source_rows"), F.sum("__t").cast("bigint").alias("target_rows"))
    agg = agg.select(F.coalesce("source_rows", F.lit(0)).alias("source_rows"), F.coalesce("target_rows", F.lit(0)).alias("target_rows"))
    return agg.withColumn("row_diff", F.col("source_rows") - F.col("target_rows")).withColumn(
        "status", F.when(F.col("row_diff") == 0, "match").otherwise("mismatch")
    )


def source_freshness(
    df: DataFrame,
    col: str,
    now: dt.datetime | str,
    warn_after: dt.timedelta = dt.timedelta(hours=12),
    error_after: dt.timedelta = dt.timedelta(hours=24),
    table: str = "source",
) -> DataFrame:
    """(table_name, max_loaded_at, age_hours, status): pass / warn / error; empty source → error."""
    now_c = ts_literal(now)
    mx = df.agg(F.max(col).alias("max_loaded_at"))
    age_h = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), now_c) / F.lit(3_600_000_000.0)
    status = (
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(age_h > error_after.total_seconds() / 3600, "error")
        .when(age_h > warn_after.total_seconds() / 3600, "warn")
        .otherwise("pass")
    )
    return mx.select(F.lit(table).alias("table_name"), "max_loaded_at", F.round(age_h, 4).alias("age_hours"), status.alias("status"))


# --------------------------------------------------------------------------- contracts
def contract_violations(df: DataFrame, contract: T.StructType) -> list[str]:
    """Names and types must match (order and nullability ignored); no implicit casts."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    issues = [f"missing column {c} ({t.simpleString()})" for c, t in want.items() if c not in have]
    issues += [f"undeclared column {c} ({t.simpleString()})" for c, t in have.items() if c not in want]
    issues += [
        f"column {c} is {have[c].simpleString()}, contract says {t.simpleString()}"
        for c, t in want.items()
        if c in have and have[c] != t
    ]
    return issues


def enforce_contract(df: DataFrame, contract: T.StructType, coerce: bool = False) -> DataFrame:
    """Return ``df`` in contract column order, or raise listing every violation.

    ``coerce=True`` casts mistyped columns instead of failing on them (missing
    or undeclared columns still fail).
    """
    issues = contract_violations(df, contract)
    if coerce:
        issues = [i for i in issues if not i.startswith("column ")]
    if issues:
        raise ValueError("contract violated: " + "; ".join(issues))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if coerce else F.col(f.name) for f in contract.fields])
