"""Merges that rewrite only what they touch, on versioned tables.

A row's part follows from its columns: a hash bucket of the key, a range of the key, a
month. A merge finds the parts of its source rows and of the target rows they replace,
reads and writes these alone, and commits; all other files stay as they are. It also
returns what changed, row by row, which is what models downstream need to touch as little.

=============  ==========================================================================
merge          ``merge_parts``: upserts and deletes by key; a key may move between parts
delete+insert  ``replace_window``: the parts of a time window
lookback       ``lookback_parts``: late data inside a window before the high-water mark
schema change  ``sync_table``: the four modes, with columns added, dropped and retyped
=============  ==========================================================================
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.keys import row_hash
from strata.operators.dedup import latest_per_key
from strata.operators.load import SCHEMA_MODES, align_schema, high_water_mark, typed_literal
from strata.sources.tables import forget, materialize
from strata.sources.versioned import ALL, PART, Version, load_version, read_version, write_parts

NO_DATE = "none"  # the part of rows without a time
OLD, NEW = "_old", "_new"


def hash_part(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a key's hash; NULL parts count, so a NULL key has a bucket too."""
    return F.lpad(F.pmod(row_hash(*keys), F.lit(buckets)).cast("string"), 5, "0")


def range_part(key: str, width: int) -> Column:
    """Ranges of an integer key: keys that were given out together lie together. NULLs have a part of their own."""
    return F.coalesce(F.floor(F.col(key) / F.lit(width)).cast("string"), F.lit(NO_DATE))


def time_part(col: str, fmt: str = "yyyyMM") -> Column:
    """Days (yyyyMMdd), months or years of a time; rows without one have a part of their own."""
    return F.coalesce(F.date_format(F.col(col), fmt), F.lit(NO_DATE))


@dataclass
class Change:
    """A merge's result: the version it made and, per changed key, the row before and after (NULL: none)."""

    version: Version
    rows: DataFrame  # keys, _old struct, _new struct
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    stored: tuple[DataFrame, ...] = ()  # tables under the checkpoint directory that ``rows`` reads

    def forget(self) -> None:
        """Delete what ``rows`` reads, where only the numbers are of use."""
        forget(*self.stored)

    @property
    def any(self) -> bool:
        return bool(self.inserted or self.updated or self.deleted)


def _unique(src: DataFrame, keys: Sequence[str], what: str) -> None:
    dup = src.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if dup:
        raise ValueError(f"{what} is not unique on {list(keys)}: {dup[0].asDict()}")


def merge_parts(
    src: DataFrame,
    path: str,
    keys: Sequence[str],
    part: Column,
    deletes: DataFrame | None = None,
    dedupe_order: Sequence[str | Column] | None = None,
    part_of_key: bool = True,
    compare: Sequence[str] | None = None,
    full_refresh: bool = False,
    meta: dict | None = None,
) -> Change:
    """Upsert ``src`` and remove the keys of ``deletes``; NULL key parts match each other.

    ``part`` gives a row's part from its columns. ``part_of_key``: it uses key columns only, so a
    key never moves; otherwise the target's parts of the source's keys are looked up first (key
    and part columns of the target, nothing else). Rows whose ``compare`` columns (default: all but the keys) are
    unchanged are not rewritten: a repeated merge commits nothing and touches no file.
    The source must be unique on ``keys`` unless ``dedupe_order`` picks the first. Without a table
    (or with ``full_refresh``) the source becomes the table. ``meta`` is kept with the commit.
    """
    spark = src.sparkSession
    keys = list(keys)
    if dedupe_order:
        src = latest_per_key(src, keys, dedupe_order)
    base = load_version(spark, path)
    fresh = base is None or full_refresh
    if not fresh:  # the table's columns and types stay, new columns join
        _, src = align_schema(spark.createDataFrame([], base.schema), src, "append_new_columns")
    src = materialize(src.withColumn(PART, part), "merge_source")
    if not dedupe_order:
        _unique(src, keys, "merge source")
    if fresh:
        version = write_parts(src, path, base, replaced=None, meta=meta)
        old_type = T.StructType([f for f in src.schema.fields if f.name not in (PART, *keys)])
        rows = src.select(*keys, F.lit(None).cast(old_type).alias(OLD), F.struct(*[f.name for f in old_type.fields]).alias(NEW))
        return Change(version, rows, inserted=src.count(), stored=(src,))
    schema = T.StructType([f for f in src.schema.fields if f.name != PART])
    gone = None if deletes is None else deletes.select(*keys).distinct()
    asked = src.select(*keys) if gone is None else src.select(*keys).unionByName(gone)
    if part_of_key:
        touched = asked.select(part.alias(PART)).distinct()
    else:  # where the keys are now
        target = read_version(spark, path, base).select(*keys, part.alias(PART))
        named = asked.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
        same = reduce(lambda a, b: a & b, [target[k].eqNullSafe(named[f"_k_{k}"]) for k in keys])
        touched = target.join(named, same, "left_semi").select(PART).unionByName(src.select(PART)).distinct()
    parts = [r[0] for r in touched.collect()]  # at most as many as the layout has parts
    before = read_version(spark, path, base, parts)
    before, _ = align_schema(before, src.drop(PART), "append_new_columns")
    values = [c for c in schema.names if c not in keys]
    compare = [c for c in (compare if compare is not None else values) if c in values]
    old = before.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.struct(*values).alias(OLD))
    new = src.select(*keys, F.struct(*values).alias(NEW), F.lit(False).alias("_gone"))
    if gone is not None:
        gone = gone.join(src.select(*[F.col(k).alias(f"_k_{k}") for k in keys]), reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]), "left_anti")
        new = new.unionByName(gone.select(*keys, F.lit(None).cast(new.schema[NEW].dataType).alias(NEW), F.lit(True).alias("_gone")))
    # every source row meets the rows it replaces, if there are any
    same = reduce(lambda a, b: a & b, [new[k].eqNullSafe(old[f"_k_{k}"]) for k in keys])
    both = new.join(old, same, "left_outer")

    def picked(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}") for c in compare])

    equal = picked(OLD).eqNullSafe(picked(NEW)) & F.col(OLD).isNotNull() & F.col(NEW).isNotNull() if compare else F.col(OLD).isNotNull() & F.col(NEW).isNotNull()
    changed = ~equal & ~(F.col(OLD).isNull() & F.col("_gone"))
    rows = materialize(both.where(changed).select(*keys, OLD, NEW), "merge_changes")  # rows that stay are read again, not stored twice
    kinds = rows.agg(
        F.count_if(F.col(OLD).isNull()), F.count_if(F.col(OLD).isNotNull() & F.col(NEW).isNotNull()), F.count_if(F.col(NEW).isNull())
    ).first()
    change = Change(base, rows, *(int(x) for x in kinds), stored=(rows,))
    same_schema = {f.name: f.dataType for f in base.schema.fields} == {f.name: f.dataType for f in schema.fields}
    if not change.any and same_schema:
        if any(base.meta.get(k) != v for k, v in (meta or {}).items()):  # a commit without files
            change.version = write_parts(src.limit(0), path, base, meta=meta, schema=base.schema)
        forget(src)
        return change
    # of the parts read, only those with a change are written
    dirty = rows.where(F.col(OLD).isNotNull()).select(*keys, f"{OLD}.*").select(part.alias(PART)).unionByName(rows.where(F.col(NEW).isNotNull()).select(*keys, f"{NEW}.*").select(part.alias(PART))).distinct()
    dirty = [r[0] for r in dirty.collect()]
    stay, _ = align_schema(read_version(spark, path, base, dirty), src.drop(PART), "append_new_columns")
    stay = stay.select(*keys, F.struct(*values).alias(OLD))
    hit = rows.where(F.col(OLD).isNotNull()).dropDuplicates(keys).select(*[F.col(k).alias(f"_k_{k}") for k in keys], NEW, F.lit(True).alias("_hit"))
    stay = stay.join(hit, reduce(lambda a, b: a & b, [stay[k].eqNullSafe(hit[f"_k_{k}"]) for k in keys]), "left_outer")
    now = F.when(F.col("_hit") & ~equal, F.col(NEW)).otherwise(F.col(OLD))
    after = stay.select(*keys, now.alias("_now")).unionByName(rows.where(F.col(OLD).isNull()).select(*keys, F.col(NEW).alias("_now")))
    after = after.where("_now is not null").select(*keys, "_now.*").select(*schema.names).withColumn(PART, part)
    change.version = write_parts(after, path, base, replaced=dirty, schema=schema, meta=meta)
    forget(src)
    return change


def changes(spark: SparkSession, path: str, keys: Sequence[str], old: Version | None, new: Version | None = None) -> DataFrame:
    """What lies between two versions of a table: keys, _old and _new structs (NULL: no row), changed rows only.

    Only parts whose directories differ are read, so the cost follows what the writes in between have touched.
    """
    new = new or load_version(spark, path)
    if new is None:
        raise FileNotFoundError(f"no version of {path} has been committed")
    keys = list(keys)
    before_parts = old.parts if old is not None else {}
    differ = [p for p in {*before_parts, *new.parts} if before_parts.get(p) != new.parts.get(p)]
    now = read_version(spark, path, new, differ)
    values = [c for c in now.columns if c not in keys]
    was = read_version(spark, path, old, differ) if old is not None else now.limit(0)
    was, _ = align_schema(was, spark.createDataFrame([], now.schema), "sync_all_columns")
    a = was.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.struct(*values).alias(OLD), F.lit(True).alias("_was"))
    b = now.select(*keys, F.struct(*values).alias(NEW), F.lit(True).alias("_is"))
    both = a.join(b, reduce(lambda x, y: x & y, [b[k].eqNullSafe(a[f"_k_{k}"]) for k in keys]), "full_outer")
    both = both.where(~F.col(OLD).eqNullSafe(F.col(NEW)))
    return both.select(*[F.when(F.col("_is"), F.col(k)).otherwise(F.col(f"_k_{k}")).alias(k) for k in keys], OLD, NEW)


def digests(df: DataFrame, keys: Sequence[str], buckets: int, compare: Sequence[str] | None = None) -> DataFrame:
    """(_bucket, _n, _sum): rows of each hash bucket and the sum of their hashes, whatever their order. One row for each bucket."""
    compare = list(compare) if compare is not None else [c for c in df.columns if c not in keys]
    hashed = df.select(F.pmod(row_hash(*keys), F.lit(buckets)).alias("_bucket"), row_hash(*keys, *compare).cast("decimal(20,0)").alias("_h"))
    return hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"), F.sum("_h").alias("_sum"))


def diff_by_digest(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int = 4096, compare: Sequence[str] | None = None, old_digests: DataFrame | None = None) -> DataFrame:
    """Keys that were inserted, updated or deleted between two extracts: keys, ``_change`` and the new row's values (the old ones of a delete).

    Digests of key buckets are compared first (``old_digests``: kept from the last time, then equal
    extracts never read the old one); only rows of buckets that differ are shuffled and joined.
    NULL keys match each other. Rows are told apart by 64-bit hashes summed over a bucket: two
    different buckets pass as equal with a chance of about 2 to the -64.
    """
    compare = list(compare) if compare is not None else [c for c in new.columns if c not in keys]
    a, b = old_digests if old_digests is not None else digests(old, keys, buckets, compare), digests(new, keys, buckets, compare)
    a, b = a.withColumnsRenamed({"_n": "_an", "_sum": "_as"}), b.withColumnsRenamed({"_n": "_bn", "_sum": "_bs"})
    unlike = a.join(b, "_bucket", "full_outer").where(~(F.col("_an").eqNullSafe(F.col("_bn")) & F.col("_as").eqNullSafe(F.col("_bs"))))
    which = [r[0] for r in unlike.select("_bucket").collect()]  # at most ``buckets`` numbers

    def side(df: DataFrame, name: str) -> DataFrame:
        if not which:
            df = df.limit(0)
        elif len(which) < buckets:
            df = df.where(F.pmod(row_hash(*keys), F.lit(buckets)).isin(which))
        return df.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], F.struct(*compare).alias(f"{name}_row"), F.lit(True).alias(f"{name}_is"))

    o, n = side(old, "_o"), side(new, "_n")
    both = o.join(n, reduce(lambda x, y: x & y, [o[f"_o_{k}"].eqNullSafe(n[f"_n_{k}"]) for k in keys]), "full_outer")
    change = F.when(F.col("_o_is").isNull(), "insert").when(F.col("_n_is").isNull(), "delete").when(~F.col("_o_row").eqNullSafe(F.col("_n_row")), "update")
    row = F.when(F.col("_n_is"), F.col("_n_row")).otherwise(F.col("_o_row"))
    out = both.select(*[F.when(F.col("_n_is"), F.col(f"_n_{k}")).otherwise(F.col(f"_o_{k}")).alias(k) for k in keys], change.alias("_change"), row.alias("_row"))
    return out.where("_change is not null").select(*keys, "_change", "_row.*")


# --------------------------------------------------------------------------- windows of time
def replace_window(src: DataFrame, path: str, col: str, start, end, fmt: str = "yyyyMM") -> Version:
    """Delete + insert on a stored table laid out by ``time_part(col, fmt)``: the half-open window [start, end) takes its rows from ``src``.

    Parts the window does not meet keep their files; in the parts at its ends the rows outside stay.
    Rows without a time lie in no window.
    """
    spark = src.sparkSession
    base = load_version(spark, path)
    t = src.schema[col].dataType
    inside = (F.col(col) >= typed_literal(start, t)) & (F.col(col) < typed_literal(end, t))
    fresh = src.where(inside)
    if base is None:
        return write_parts(fresh.withColumn(PART, time_part(col, fmt)), path, None)
    lo, hi = (spark.range(1).select(F.date_format(typed_literal(x, t), fmt)).first()[0] for x in (start, end))
    met = [p for p in base.parts if p != NO_DATE and lo <= p <= hi]
    kept = read_version(spark, path, base, met).where(~inside)
    rows = kept.unionByName(fresh.select(*kept.columns)).withColumn(PART, time_part(col, fmt))
    return write_parts(rows, path, base, replaced=met, schema=base.schema)


def lookback_parts(src: DataFrame, path: str, col: str, keys: Sequence[str], lookback: str = "3 days", fmt: str = "yyyyMMdd") -> Change:
    """Late data on a stored table laid out by time: rows with ``col > max - lookback``, and rows without a time, are merged.

    The high-water mark reads the newest part only; the merge reads and writes the window's parts (and
    the part without times), wherever a late row's key stood before.
    """
    spark = src.sparkSession
    base = load_version(spark, path)
    part = time_part(col, fmt)
    if base is None:
        return merge_parts(src, path, keys, part, part_of_key=False)
    dated = sorted(p for p in base.parts if p != NO_DATE)
    newest = read_version(spark, path, base, dated[-1:], [col]) if dated else None
    bound = typed_literal(high_water_mark(newest, col), src.schema[col].dataType) - F.expr(f"INTERVAL {lookback}")
    return merge_parts(src.where((F.col(col) > bound) | F.col(col).isNull()), path, keys, part, part_of_key=False)


# --------------------------------------------------------------------------- schema changes
def sync_table(src: DataFrame, path: str, mode: str = "append_new_columns", part: Callable[[], Column] | None = None) -> Version:
    """Append to a stored table under a schema-change mode; no file of earlier loads is rewritten.

    ignore: the table's columns and types stay (what does not fit a type becomes NULL);
    append_new_columns: new columns join, types stay; sync_all_columns: exactly the source's
    columns and types from now on, old rows are read as these; fail: any difference raises.
    """
    if mode not in SCHEMA_MODES:
        raise ValueError(f"unknown schema change mode {mode!r}")
    spark = src.sparkSession
    base = load_version(spark, path)
    laid = lambda df: df if part is None else df.withColumn(PART, part().cast("string"))
    one_part = ALL if part is None else None
    if base is None:
        return write_parts(laid(src), path, None, one_part=one_part)
    have, come = ({f.name: f.dataType for f in s.fields} for s in (base.schema, src.schema))
    if mode == "fail":
        align_schema(spark.createDataFrame([], base.schema), src, "fail")
    if mode == "sync_all_columns":
        fields = list(src.schema.fields)
    else:
        fields = list(base.schema.fields) + ([f for f in src.schema.fields if f.name not in have] if mode == "append_new_columns" else [])
    rows = src.select(*[(F.lit(None).cast(f.dataType) if f.name not in come else F.col(f.name) if come[f.name] == f.dataType else F.col(f.name).try_cast(f.dataType)).alias(f.name) for f in fields])
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    return write_parts(laid(rows), path, base, schema=schema, one_part=one_part)


def compact(spark: SparkSession, path: str, most: int = 1) -> Version | None:
    """Rewrite the parts that have more than ``most`` directories, or an old schema, as one each; other parts stay."""
    base = load_version(spark, path)
    if base is None:
        return None
    now = T.StructType([T.StructField(f.name, f.dataType, True) for f in base.schema.fields]).json()
    worn = [p for p, dirs in base.parts.items() if len(dirs) > most or any(base.kinds[d] != now for d in dirs)]
    if not worn:
        return base
    rows = reduce(lambda a, b: a.unionByName(b), [read_version(spark, path, base, [p]).withColumn(PART, F.lit(p)) for p in worn])
    return write_parts(rows, path, base, replaced=worn, schema=base.schema)


__all__ = ["Change", "changes", "compact", "diff_by_digest", "digests", "hash_part", "lookback_parts", "merge_parts", "range_part", "replace_window", "sync_table", "time_part"]
