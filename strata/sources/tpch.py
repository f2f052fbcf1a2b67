"""Raw entities derived from the TPC-H style driver tables.

The four entities of the pipeline (customers, orders, order_items, products)
are projected from ``customer``/``nation``/``region``, ``orders``,
``lineitem`` and ``part``. The projection is pure column arithmetic (plus a
lookup of the fixed-size ``nation``/``region`` dimensions), so the raw scan
stays a narrow, pushdown-friendly parquet read at any scale factor.

Deliberate dirt so every rule has work to do: padded and mixed-case text,
invalid e-mails (negative balance), one-character postal codes (nation 0), a
blank country (nation 24), NULL e-mails (balance in [0, 100)), NULL order
totals (below 2,000), an unknown status ('on hold': pending + urgent),
parts whose cost is negative (size 49) or above the price (size 50), and
(l_orderkey, l_linenumber) duplicates in lineitem that dedupe must resolve.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.tables import _jvm_path
from strata.operators.joins import broadcast_if_small

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


# Money is exact, as in the raw DDL: decimal(18,2), and decimal(18,4) for
# products of two 2-decimal amounts. Sums stay exact on any engine.
MONEY = "decimal(18,2)"
MONEY4 = "decimal(18,4)"


def _money(c: F.Column) -> F.Column:
    return c.cast(MONEY)


_SCHEMAS: dict[str, object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read an input table. The schema taken from the parquet footers is reused as long as the
    listing (names, sizes, times) is the same: such reads skip footer inference (~5x cheaper to
    construct), and a column that later files bring is read."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    fs, p = _jvm_path(spark, path)
    stamp = tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p)))
    known = _SCHEMAS.get(path)
    if known is None or known[0] != stamp:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = (stamp, df.schema)
        return df
    return spark.read.schema(known[1]).parquet(path)


def clear_schema_cache() -> None:
    _SCHEMAS.clear()


def _days_after(base: str, days) -> F.Column:
    return F.date_add(F.lit(base).cast("date"), days).cast("timestamp_ntz")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    # nation (25 rows) and region (5 rows) are fixed-size dimensions: broadcast,
    # behind a size check on the optimizer's estimate
    geo = n.join(broadcast_if_small(r), n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    j = c.join(broadcast_if_small(geo), c.c_nationkey == geo.n_nationkey, "left")
    dotted = F.replace(F.col("c_name"), F.lit("#"), F.lit("."))
    created = _days_after("2020-01-01", F.col("c_nationkey"))
    return j.select(
        F.col("c_custkey").alias("customer_id"),
        F.lower("c_mktsegment").alias("first_name"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("last_name"),
        F.when((F.col("c_acctbal") >= 0) & (F.col("c_acctbal") < 100), F.lit(None).cast("string"))
        .when(F.col("c_acctbal") < 0, F.concat(F.lower(dotted), F.lit("@example")))
        .otherwise(F.concat(F.lit(" "), dotted, F.lit("@Example.COM")))
        .alias("email"),
        F.concat(F.lit("+"), F.col("c_nationkey").cast("string"), F.lit("-"), F.col("c_custkey").cast("string")).alias("phone"),
        F.concat(F.col("c_custkey").cast("string"), F.lit(" Main St ")).alias("address"),
        F.lower("n_name").alias("city"),
        F.concat(F.lit(" "), F.lower("n_name")).alias("state"),
        F.when(F.col("c_nationkey") == 0, F.lit("0"))
        .otherwise(F.lpad(F.col("c_custkey").cast("string"), 5, "0"))
        .alias("zip_code"),
        F.when(F.col("c_nationkey") == 24, F.lit(" ")).otherwise(F.col("r_name")).alias("country"),
        created.alias("created_at"),
        created.alias("updated_at"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit("Completed"))
        .when(F.col("o_orderstatus") == "O", F.lit(" processing"))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit("on hold"))
        .otherwise(F.lit("pending "))
    )
    addr = F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" Main St"))
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        status.alias("status"),
        F.when(F.col("o_totalprice") < 2000, F.lit(None)).otherwise(_money(F.col("o_totalprice"))).cast(MONEY).alias("total_amount"),
        addr.alias("shipping_address"),
        addr.alias("billing_address"),
        F.lower("o_orderpriority").alias("payment_method"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        (_money(F.col("l_extendedprice")) * (1 - _money(F.col("l_discount")))).cast(MONEY4).alias("total_price"),
        # abs(): the source has -0.0 discounts; keep money columns sign-clean.
        (_money(F.col("l_extendedprice")) * F.abs(_money(F.col("l_discount")))).cast(MONEY4).alias("discount_amount"),
        F.col("l_shipdate").alias("created_at"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    created = _days_after("2020-01-01", F.col("p_size"))
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("  "), F.col("p_name")).alias("product_name"),
        F.lower("p_type").alias("category"),
        F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("subcategory"),
        F.lower("p_brand").alias("brand"),
        _money(F.col("p_retailprice")).alias("price"),
        # 1.2 * and 0.6 * a 2-decimal price never end in a 5 at the third
        # decimal, so the cast back to 2 decimals never meets a rounding tie.
        F.when(F.col("p_size") == 50, _money(F.col("p_retailprice")) * F.lit(1.2).cast("decimal(2,1)"))
        .when(F.col("p_size") == 49, F.lit(-1))
        .otherwise(_money(F.col("p_retailprice")) * F.lit(0.6).cast("decimal(2,1)"))
        .cast(MONEY)
        .alias("cost"),
        F.concat(F.col("p_name"), F.lit(" by "), F.col("p_brand"), F.lit(" ")).alias("description"),
        (F.col("p_size") <= 45).alias("is_active"),
        created.alias("created_at"),
        created.alias("updated_at"),
    )


RAW_READERS = {
    "customers": raw_customers,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "products": raw_products,
}


def raw_entity(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return RAW_READERS[entity](spark, sf_dir)


class RawEntities(dict):
    """entity → raw DataFrame, constructed on first lookup."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._sf = spark, sf_dir

    def __missing__(self, entity: str) -> DataFrame:
        if entity not in RAW_READERS:
            raise KeyError(entity)
        df = self[entity] = raw_entity(self._spark, self._sf, entity)
        return df


# Which model each event type stands for in the run-log stand-in,
# and the statement type it was written with.
EVENT_MODEL = {"click": "dim_customers", "view": "fct_orders", "purchase": "agg_daily_revenue", "error": "dim_products"}
EVENT_QUERY_TYPE = {"click": "INSERT", "view": "CREATE_TABLE_AS_SELECT", "purchase": "MERGE", "error": "INSERT"}


def _lookup(col: str, mapping: dict) -> F.Column:
    """CASE col WHEN k THEN v ... END (NULL otherwise), JVM-side."""
    out = None
    for k, v in mapping.items():
        cond = F.col(col) == F.lit(k)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out


def raw_query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model-run log derived from ``events``: one row per event.

    invocation = user × day, model from the event type (signup → no model in
    the tag), status FAIL for errors, duration = ``value`` seconds, rows
    inserted = the ``k`` of the JSON ``props``. Tags are real JSON built with
    ``to_json``; rows with ``value < 1`` carry a malformed tag, and statements
    whose ``k >= 95`` are plain SELECTs, so the parse filter has work to do.
    """
    ev = read_table(spark, sf_dir, "events")
    day = F.col("ts").cast("date").cast("string")
    model = _lookup("event_type", EVENT_MODEL)
    qtype = _lookup("event_type", EVENT_QUERY_TYPE)
    k = F.get_json_object("props", "$.k").cast("bigint")
    tag = F.to_json(
        F.struct(
            F.concat(F.lit("inv-"), F.col("user_id").cast("string"), F.lit("-"), day).alias("invocation_id"),
            F.lit("daily_build").alias("job"),
            F.when(F.col("user_id") % 3 == 0, F.lit("dev")).otherwise(F.lit("prod")).alias("env"),
            model.alias("model"),
            F.lit("gold").alias("schema"),
            F.lit("table").alias("materialized"),
            F.concat(F.lit("scheduled__"), day).alias("airflow_run_id"),
        )
    )
    micros = F.round(F.col("value") * 1_000_000).cast("bigint")
    is_err = F.col("event_type") == "error"
    return ev.select(
        F.when(F.col("value") < 1, F.concat(F.lit("{bad json "), F.col("event_id").cast("string"))).otherwise(tag).alias("query_tag"),
        F.concat(F.lit("q-"), F.col("event_id").cast("string")).alias("query_id"),
        F.col("ts").alias("start_time"),
        F.timestamp_add("MICROSECOND", micros, F.col("ts")).alias("end_time"),
        F.round(F.col("value") * 1000).cast("bigint").alias("execution_time_ms"),
        F.when(is_err, F.lit("FAIL")).otherwise(F.lit("SUCCESS")).alias("execution_status"),
        F.when(is_err, F.lit("100183")).alias("error_code"),
        F.when(is_err, F.concat(F.lit("model failed for user "), F.col("user_id").cast("string"))).alias("error_message"),
        k.alias("rows_inserted"),
        F.lit(0).cast("bigint").alias("rows_updated"),
        F.lit(0).cast("bigint").alias("rows_deleted"),
        k.alias("rows_produced"),
        F.when(k >= 95, F.lit("SELECT")).otherwise(F.coalesce(qtype, F.lit("SELECT"))).alias("query_type"),
    )


def customer_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two extracts of the customer table, for history (SCD2) and change detection.

    v1 (taken 2024-01-01): every customer except those with balance < -900.
    v2 (taken 2024-02-01): balance > 5000 → segment lower-cased and updated;
    balance in [9000, 9250) → gone (hard delete); balance < -900 → new.
    """
    c = read_table(spark, sf_dir, "customer")
    base = [F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation_key")]
    jan = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    feb = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    v1 = c.where(F.col("c_acctbal") >= -900).select(*base, F.col("c_mktsegment").alias("segment"), jan.alias("updated_at"))
    rich = F.col("c_acctbal") > 5000
    v2 = c.where(~((F.col("c_acctbal") >= 9000) & (F.col("c_acctbal") < 9250))).select(
        *base,
        F.when(rich, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(rich, feb).otherwise(jan).alias("updated_at"),
    )
    return v1, v2
