"""Incremental load patterns on plain parquet (no table format needed).

Pure DataFrame functions compute *what* the target becomes; ``*_table``
functions persist it. The only driver round-trip is the one-row high-water
mark, which is then a literal: parquet row-group stats and a date-partitioned
target turn it into partition pruning.

=============  ==============================================================
append         rows strictly newer than ``coalesce(max(target.col), default)``
merge          target rows whose key is not in the source, plus the source
delete+insert  target outside the window, plus the source inside it
lookback       high-water mark minus an interval, then merge
microbatch     the same per time slice; one slice can be redone alone
schema change  ignore / append_new_columns / sync_all_columns / fail
=============  ==============================================================
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.keys import row_hash
from strata.operators.dedup import latest_per_key
from strata.sources.tables import cut_lineage, table_exists, write_table

DEFAULT_HWM = "1900-01-01 00:00:00"
# the default mark of integer columns: below every value a load would carry
_LEAST = {T.ByteType: "-128", T.ShortType: "-32768", T.IntegerType: "-2147483648", T.LongType: "-9223372036854775808"}


# --------------------------------------------------------------------------- high-water mark
def high_water_mark(target: DataFrame | None, col: str, default=DEFAULT_HWM):
    """``coalesce(max(target.col), default)``; an empty or missing target gives the default.

    Always coalesced: an empty-but-existing target must not block every later load.
    """
    if target is None:
        return default
    # a zoned timestamp travels as text: a Python datetime would be shifted by the machine's time zone
    mark = F.max(col)
    mark = mark.cast("string") if isinstance(_type_of(target, col), T.TimestampType) else mark
    value = target.agg(mark.alias("hwm")).first()["hwm"]
    return default if value is None else value


def typed_literal(value, data_type: T.DataType | None = None) -> Column:
    """A literal typed like the column it is compared with (NTZ stays NTZ)."""
    if value == DEFAULT_HWM and isinstance(data_type, T.NumericType):
        value = "-Infinity" if isinstance(data_type, (T.FloatType, T.DoubleType)) else _LEAST.get(type(data_type), "-" + "9" * (getattr(data_type, "precision", 1) - getattr(data_type, "scale", 0) or 1))
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    lit = F.lit(value)
    if data_type is not None:
        return lit.cast(data_type)
    return lit.cast("timestamp_ntz") if isinstance(value, str) else lit


def _type_of(df: DataFrame, col: str) -> T.DataType:
    return df.schema[col].dataType


def new_rows_since(
    src: DataFrame,
    target: DataFrame | None,
    col: str,
    default=DEFAULT_HWM,
    lookback: str | None = None,
) -> DataFrame:
    """Source rows with ``col > hwm`` (``hwm - lookback`` when a lookback is given).

    ``lookback`` is an interval text such as ``'3 days'``.
    """
    hwm = high_water_mark(target, col, default)
    bound = typed_literal(hwm, _type_of(src, col))
    if lookback:
        bound = bound - F.expr(f"INTERVAL {lookback}")
    return src.where(F.col(col) > bound)


# --------------------------------------------------------------------------- append
def append_incremental(
    src: DataFrame, target: DataFrame | None, col: str, default=DEFAULT_HWM, lookback: str | None = None
) -> DataFrame:
    """The target after an append load: target ∪ (source rows newer than its high-water mark,
    minus ``lookback`` when given — re-taken rows then need a merge, see ``lookback_merge``)."""
    new = new_rows_since(src, target, col, default, lookback)
    return new if target is None else target.unionByName(new)


def append_table(
    src: DataFrame,
    path: str,
    col: str,
    partition_by: Sequence[str] = (),
    full_refresh: bool = False,
    hwm_path: str | None = None,
    on_schema_change: str = "ignore",
    own_partitions: bool = False,
) -> int:
    """Append newer rows to the parquet table at ``path``; returns rows appended.

    ``on_schema_change`` when the source's columns differ from the table's:
    ``ignore`` appends the table's columns only (missing ones NULL);
    ``append_new_columns`` appends files with the wider schema (parquet readers
    merge schemas, old files read NULL for new columns — nothing is rewritten);
    ``sync_all_columns`` rewrites the table to the source's columns (staged swap);
    ``fail`` raises.

    First run (no table) or ``full_refresh`` writes everything. With
    ``hwm_path`` the high-water mark comes from a small side table (one row per
    load) instead of a ``max()`` over the whole target, and the new mark is taken
    from ``observe`` metrics of the write itself: no extra scan either way.

    ``own_partitions`` (with ``hwm_path``): ``partition_by`` follows from ``col``, so rows beyond the mark
    have partitions of their own, and the load replaces these. A load that was stopped before its mark was
    written can then be repeated: it leaves one copy.
    """
    if own_partitions and not (hwm_path and partition_by):
        raise ValueError("own_partitions needs partition_by and hwm_path")
    spark = src.sparkSession
    exists = table_exists(spark, path) and not full_refresh
    if exists:
        # the merged schema needs every file footer; only the column-changing modes need it
        merge = on_schema_change in ("append_new_columns", "sync_all_columns", "fail")
        current = spark.read.option("mergeSchema", str(merge).lower()).parquet(path)
        aligned_target, src = align_schema(current, src, on_schema_change)
        if on_schema_change == "sync_all_columns" and aligned_target.dtypes != current.dtypes:
            write_table(cut_lineage(aligned_target), path, partition_by=partition_by)  # rewrite old rows to the new column set
        if hwm_path and table_exists(spark, hwm_path):
            hwm = high_water_mark(spark.read.parquet(hwm_path), "hwm")
        else:
            hwm = high_water_mark(spark.read.parquet(path), col)
        new = src.where(F.col(col) > typed_literal(hwm, _type_of(src, col)))
    else:
        new = src
    obs = Observation("appended")
    new = new.observe(obs, F.count(F.lit(1)).alias("rows"), F.max(col).cast("string").alias("hwm"))
    if exists and own_partitions:
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    else:
        write_table(new, path, mode="append" if exists else "overwrite", partition_by=partition_by)
    metrics = obs.get
    rows = int(metrics["rows"])
    if hwm_path and rows:
        mark = spark.createDataFrame([(metrics["hwm"], rows)], "hwm string, rows bigint")
        mark = mark.withColumn("hwm", F.col("hwm").cast(src.schema[col].dataType))
        write_table(mark, hwm_path, mode="append" if table_exists(spark, hwm_path) and not full_refresh else "overwrite")
    return rows


# --------------------------------------------------------------------------- merge
def _key_cond(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k]
        cond = c if cond is None else cond & c
    return cond


def merge_upsert(
    target: DataFrame | None,
    src: DataFrame,
    keys: Sequence[str],
    dedupe_order: Sequence[str | Column] | None = None,
    null_safe: bool = True,
    check_unique: bool = True,
) -> DataFrame:
    """Matched keys take the source row, unmatched rows of both sides are kept.

    The source must be unique on ``keys``: pass ``dedupe_order`` to keep the
    latest source row per key; otherwise duplicates raise (``check_unique=False`` only
    where the caller has made the source unique). With ``null_safe`` NULL key parts match each
    other, which makes the merge idempotent (a second application is a no-op).
    Plan: one anti-join of the target against the (usually small) source, so
    AQE can broadcast the source side from its runtime size, plus a union.
    """
    if not keys:
        raise ValueError("merge needs key columns")
    if dedupe_order:
        src = latest_per_key(src, keys, dedupe_order)
    elif check_unique:
        # one aggregate job; only a single offending key is fetched
        dup = src.groupBy(*keys).count().where("count > 1").limit(1).collect()
        if dup:
            raise ValueError(f"merge source is not unique on {list(keys)}: {dup[0].asDict()}")
    if target is None:
        return src
    src = src.select(*target.columns) if set(target.columns) == set(src.columns) else src
    kept = target.join(src, _key_cond(target, src, keys, null_safe), "left_anti")
    return kept.unionByName(src, allowMissingColumns=True)


def merge_table(
    src: DataFrame,
    path: str,
    keys: Sequence[str],
    dedupe_order: Sequence[str | Column] | None = None,
    partition_by: Sequence[str] = (),
    full_refresh: bool = False,
) -> None:
    """Persist a merge. Partitioned targets only rewrite the partitions the source touches.

    ``full_refresh`` rebuilds the table from the source alone.

    The merged result is checkpointed (reliably) before it replaces what it was
    read from, so an executor loss during the write cannot lose data.
    """
    spark = src.sparkSession
    if full_refresh or not table_exists(spark, path):
        write_table(merge_upsert(None, src, keys, dedupe_order), path, partition_by=partition_by)
        return
    whole = target = spark.read.parquet(path)
    if dedupe_order:
        src = cut_lineage(latest_per_key(src, keys, dedupe_order))
        dedupe_order = None
    moved = False
    if partition_by:
        # a key that changes its partition leaves the old one, which a dynamic overwrite would not touch
        there = target.select(*[F.col(c).alias(f"__t_{c}") for c in dict.fromkeys([*keys, *partition_by])])
        same_key = reduce(lambda a, b: a & b, [src[k].eqNullSafe(there[f"__t_{k}"]) for k in keys])
        same_part = reduce(lambda a, b: a & b, [src[c].eqNullSafe(there[f"__t_{c}"]) for c in partition_by])
        moved = not src.join(there, same_key & ~same_part, "left_semi").isEmpty()  # ``bucketed.merge_parts`` moves keys without a whole rewrite
        touched = src.select(*[F.col(c).alias(f"__p_{c}") for c in partition_by]).distinct()
        inside = reduce(lambda a, b: a & b, [target[c].eqNullSafe(touched[f"__p_{c}"]) for c in partition_by])
        target = whole if moved else target.join(touched, inside, "left_semi")
    merged = cut_lineage(merge_upsert(target, src, keys, dedupe_order))
    if partition_by and moved:
        write_table(merged, path, partition_by=partition_by)
    elif partition_by:
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    else:
        write_table(merged, path)


# --------------------------------------------------------------------------- delete + insert
def delete_insert(target: DataFrame, src: DataFrame, col: str, start, end) -> DataFrame:
    """Replace the half-open window ``[start, end)`` of ``col``: target outside ∪ source inside."""
    def inside(df: DataFrame) -> Column:
        t = _type_of(df, col)
        return (F.col(col) >= typed_literal(start, t)) & (F.col(col) < typed_literal(end, t))

    outside = target.where(~inside(target) | F.col(col).isNull())
    return outside.unionByName(src.where(inside(src)))


def delete_insert_table(src: DataFrame, path: str, partition_col: str) -> None:
    """Dynamic partition overwrite: only the partitions present in ``src`` are replaced."""
    (
        src.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


# --------------------------------------------------------------------------- lookback
def lookback_merge(target: DataFrame, src: DataFrame, col: str, keys: Sequence[str], lookback: str = "3 days") -> DataFrame:
    """Late data: re-take source rows with ``col > max(target.col) - lookback`` and merge them."""
    late = new_rows_since(src, target, col, lookback=lookback)
    return merge_upsert(target, late, keys)


# --------------------------------------------------------------------------- microbatch
def time_slices(start: dt.datetime, end: dt.datetime, size: dt.timedelta) -> Iterator[tuple[dt.datetime, dt.datetime]]:
    """Half-open slices [s, s+size) covering [start, end)."""
    s = start
    while s < end:
        yield s, min(s + size, end)
        s += size


def assign_batch(df: DataFrame, col: str, unit: str = "day", name: str = "_batch_start") -> DataFrame:
    """Tag each row with the start of its time slice (one pass, no per-slice scans)."""
    return df.withColumn(name, F.date_trunc(unit, F.col(col)).cast("timestamp_ntz"))


def run_microbatch(
    src: DataFrame,
    col: str,
    start: dt.datetime,
    end: dt.datetime,
    size: dt.timedelta,
    transform: Callable[[DataFrame], DataFrame],
    sink: Callable[[DataFrame, dt.datetime, dt.datetime], None],
    only: Sequence[dt.datetime] | None = None,
) -> list[tuple[dt.datetime, dt.datetime]]:
    """Process ``[start, end)`` slice by slice; ``only`` re-runs chosen slices.

    Each slice is an independent job (its own filter, pushed to the scan) and an
    idempotent sink write, so a failed slice is retried without touching others.
    """
    done = []
    for s, e in time_slices(start, end, size):
        if only is not None and s not in only:
            continue
        t = _type_of(src, col)
        part = src.where((F.col(col) >= typed_literal(s, t)) & (F.col(col) < typed_literal(e, t)))
        sink(transform(part), s, e)
        done.append((s, e))
    return done


# --------------------------------------------------------------------------- schema change
SCHEMA_MODES = ("ignore", "append_new_columns", "sync_all_columns", "fail")


def align_schema(target: DataFrame, src: DataFrame, mode: str = "ignore") -> tuple[DataFrame, DataFrame]:
    """Return (target, source) projected to the column set ``mode`` prescribes.

    ignore: keep the target's columns (new source columns dropped, missing → NULL);
    append_new_columns: target columns + new ones (old rows NULL there);
    sync_all_columns: exactly the source columns (removed ones dropped);
    fail: raise on any difference.
    """
    if mode not in SCHEMA_MODES:
        raise ValueError(f"unknown schema change mode {mode!r}")
    t_types = {f.name: f.dataType for f in target.schema.fields}
    s_types = {f.name: f.dataType for f in src.schema.fields}
    added = [c for c in src.columns if c not in t_types]
    removed = [c for c in target.columns if c not in s_types]
    retyped = [c for c in src.columns if c in t_types and t_types[c] != s_types[c]]
    if mode == "fail":
        if added or removed or retyped:
            raise ValueError(f"schema changed: added={added} removed={removed} retyped={retyped}")
        return target, src.select(*target.columns)

    def project(df: DataFrame, cols: Sequence[str], types: dict) -> DataFrame:
        have = set(df.columns)
        return df.select(*[(F.col(c) if c in have else F.lit(None)).cast(types[c]).alias(c) for c in cols])

    if mode == "ignore":
        cols, types = list(target.columns), t_types
    elif mode == "append_new_columns":
        cols, types = list(target.columns) + added, {**s_types, **t_types}
    else:
        cols, types = list(src.columns), s_types
    return project(target, cols, types), project(src, cols, types)


def append_with_schema_change(target: DataFrame, src: DataFrame, mode: str = "append_new_columns") -> DataFrame:
    t, s = align_schema(target, src, mode)
    return t.unionByName(s)


# --------------------------------------------------------------------------- change detection
def diff(old: DataFrame, new: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None) -> DataFrame:
    """Classify keys as insert / update / delete / same (one full outer join).

    Returns the keys, ``_change`` and the new row's compared columns (old ones
    for deletes). Rows are compared column by column, NULL equal to NULL, so a value
    that moves between nullable columns is an update; the shuffle carries the compared columns.
    NULL keys match each other.
    """
    compare = list(compare) if compare is not None else [c for c in new.columns if c not in keys]
    h = lambda df, n: df.select(*[F.col(k).alias(f"{n}_{k}") for k in keys], F.lit(True).alias(n), F.struct(*compare).alias(n + "_row"))
    o, n = h(old, "_old"), h(new, "_new")
    j = o.join(n, reduce(lambda a, b: a & b, [o[f"_old_{k}"].eqNullSafe(n[f"_new_{k}"]) for k in keys]), "full_outer")
    j = j.withColumns({k: F.when(F.col("_new"), F.col(f"_new_{k}")).otherwise(F.col(f"_old_{k}")) for k in keys})
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(~F.col("_old_row").eqNullSafe(F.col("_new_row")), "update")
        .otherwise("same")
    )
    row = F.coalesce(F.col("_new_row"), F.col("_old_row"))
    return j.select(*keys, change.alias("_change"), row.alias("_row")).select(*keys, "_change", "_row.*")


def only_changed(src: DataFrame, previous: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None) -> DataFrame:
    """Source rows that are new or differ from ``previous`` (anti-join on key + row hash)."""
    compare = list(compare) if compare is not None else [c for c in src.columns if c not in keys]
    prev = previous.select(*[F.col(k).alias(f"_prev_{k}") for k in keys], row_hash(*compare).alias("_prev_h"))
    cur = src.withColumn("_h", row_hash(*compare))
    same = reduce(lambda a, b: a & b, [cur[k].eqNullSafe(prev[f"_prev_{k}"]) for k in keys], cur["_h"] == prev["_prev_h"])
    return cur.join(prev, same, "left_anti").drop("_h")
