"""Plain raw tables of the four entities: the declared schema is asserted, never inferred or silently cast.

Fixed values: the columns and types are those of the seed schemas, the ids that must not be NULL are
those of the raw DDL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.checks import Check, run_checks
from strata.sources.seeds import SEED_SCHEMAS

RAW_NOT_NULL = {
    "customers": ("customer_id",),
    "orders": ("order_id", "customer_id"),
    "order_items": ("order_item_id", "order_id", "product_id"),
    "products": ("product_id",),
}

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _fits(have: T.DataType, want: T.DataType) -> bool:
    """Whether every value of one type has the same value in the other."""
    if have == want:
        return True
    if isinstance(want, T.LongType):
        return isinstance(have, _INTEGERS)
    if isinstance(want, T.DecimalType):
        whole = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10}.get(type(have))
        if isinstance(have, T.DecimalType):
            return have.scale <= want.scale and have.precision - have.scale <= want.precision - want.scale
        return whole is not None and whole <= want.precision - want.scale
    if isinstance(want, T.StringType):
        return isinstance(have, (T.VarcharType, T.CharType))
    # a zoned time is read as the session's local time
    return isinstance(want, T.TimestampNTZType) and isinstance(have, T.TimestampType)


def schema_issues(df: DataFrame, entity: str) -> list[str]:
    """Missing columns and columns of a type that would lose values; names match in any case, further columns are no issue."""
    have = {f.name.lower(): f.dataType for f in df.schema.fields}
    out = []
    for f in SEED_SCHEMAS[entity].fields:
        if f.name not in have:
            out.append(f"missing column {f.name} ({f.dataType.simpleString()})")
        elif not _fits(have[f.name], f.dataType):
            out.append(f"column {f.name} is {have[f.name].simpleString()}, declared {f.dataType.simpleString()}")
    return out


def assert_schema(df: DataFrame, entity: str) -> DataFrame:
    """The declared columns with their declared types, or one error that lists every issue."""
    issues = schema_issues(df, entity)
    if issues:
        raise ValueError(f"raw {entity}: " + "; ".join(issues))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SEED_SCHEMAS[entity].fields])


def read_raw(spark: SparkSession, raw_dir: str, entity: str) -> DataFrame:
    """The parquet table ``<raw_dir>/<entity>``; a scan reads the declared columns only."""
    return assert_schema(spark.read.parquet(f"{raw_dir.rstrip('/')}/{entity}"), entity)


def raw_checks(df: DataFrame, entity: str, severity: str = "warn") -> DataFrame:
    """NOT NULL of the ids, one aggregate; NULL ids are rejected by the technical rules, so they warn by default."""
    return run_checks(df, f"raw_{entity}", [Check("not_null", c, severity=severity) for c in RAW_NOT_NULL[entity]])
