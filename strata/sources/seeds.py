"""Seed CSVs (dev environment) with fixed schemas; never ``inferSchema``.

Money columns are decimal(18,2) as in the raw DDL, ids bigint, timestamps
``timestamp_ntz``; ``zip_code`` stays a string (leading zeros).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_S, _L, _TS = T.StringType(), T.LongType(), T.TimestampNTZType()
_MONEY = T.DecimalType(18, 2)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SEED_SCHEMAS = {
    "customers": _schema(
        ("customer_id", _L), ("first_name", _S), ("last_name", _S), ("email", _S), ("phone", _S),
        ("address", _S), ("city", _S), ("state", _S), ("zip_code", _S), ("country", _S),
        ("created_at", _TS), ("updated_at", _TS),
    ),
    "orders": _schema(
        ("order_id", _L), ("customer_id", _L), ("order_date", T.DateType()), ("status", _S),
        ("total_amount", _MONEY), ("shipping_address", _S), ("billing_address", _S), ("payment_method", _S),
        ("created_at", _TS), ("updated_at", _TS),
    ),
    "order_items": _schema(
        ("order_item_id", _L), ("order_id", _L), ("product_id", _L), ("quantity", _L),
        ("unit_price", _MONEY), ("total_price", _MONEY), ("discount_amount", _MONEY), ("created_at", _TS),
    ),
    "products": _schema(
        ("product_id", _L), ("product_name", _S), ("category", _S), ("subcategory", _S), ("brand", _S),
        ("price", _MONEY), ("cost", _MONEY), ("description", _S), ("is_active", T.BooleanType()),
        ("created_at", _TS), ("updated_at", _TS),
    ),
}


def read_seed(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """Header CSV with the entity's fixed schema; empty fields read as NULL."""
    return (
        spark.read.schema(SEED_SCHEMAS[entity])
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def read_entity(spark: SparkSession, env: str, entity: str, *, seeds_dir: str | None = None, sf_dir: str | None = None, raw_dir: str | None = None) -> DataFrame:
    """Environment switch: seed CSVs in ``dev``; elsewhere the raw tables of ``raw_dir``, or the stand-ins over ``sf_dir``."""
    if env == "dev":
        if seeds_dir is None:
            raise ValueError("dev environment needs seeds_dir")
        return read_seed(spark, f"{seeds_dir.rstrip('/')}/raw_{entity}.csv", entity)
    if raw_dir is not None:
        from strata.sources.raw import read_raw

        return read_raw(spark, raw_dir, entity)
    if sf_dir is None:
        raise ValueError("non-dev environments need raw_dir (raw tables) or sf_dir (stand-ins)")
    from strata.sources.tpch import raw_entity

    return raw_entity(spark, sf_dir, entity)
