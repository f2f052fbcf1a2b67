"""Gold (dimensions, fact) and gold-analytics models, plus their contracts.

Thresholds are parameters; the defaults are the reference's values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.metrics import safe_divide, tier

# Tier thresholds and labels (checked in this order).
CUSTOMER_TIERS = ((1000, "VIP"), (500, "Premium"), (100, "Regular"))
CUSTOMER_TIER_DEFAULT = "New"
PRODUCT_TIERS = ((10000, "High Performance"), (5000, "Medium Performance"), (1000, "Low Performance"))
PRODUCT_TIER_DEFAULT = "No Sales"

_L, _D, _S, _TS, _DT, _B = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType(), T.DateType(), T.BooleanType()


def _contract(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


DIM_CUSTOMERS_CONTRACT = _contract(
    ("customer_id", _L), ("first_name", _S), ("last_name", _S), ("email", _S), ("phone", _S), ("address", _S),
    ("city", _S), ("state_code", _S), ("postal_code", _S), ("country_code", _S), ("created_at", _TS),
    ("updated_at", _TS), ("total_orders", _L), ("total_spent", _D), ("first_order_date", _DT),
    ("last_order_date", _DT), ("customer_tier", _S),
)
DIM_PRODUCTS_CONTRACT = _contract(
    ("product_id", _L), ("product_name", _S), ("category", _S), ("subcategory", _S), ("brand", _S),
    ("price", _D), ("cost", _D), ("description", _S), ("is_active", _B), ("created_at", _TS), ("updated_at", _TS),
    ("total_orders", _L), ("total_quantity_sold", _L), ("total_revenue", _D), ("avg_selling_price", _D),
    ("profit_margin", _D), ("performance_category", _S),
)
FCT_ORDERS_CONTRACT = _contract(
    ("order_item_id", _L), ("order_id", _L), ("customer_id", _L), ("product_id", _L), ("order_date", _DT),
    ("status", _S), ("payment_method", _S), ("quantity", _L), ("unit_price", _D), ("total_price", _D),
    ("discount_amount", _D), ("order_total", _D), ("created_at", _TS),
)


def dim_customers(
    customers: DataFrame,
    orders: DataFrame,
    tiers: Sequence[tuple[float, str]] = CUSTOMER_TIERS,
    default_tier: str = CUSTOMER_TIER_DEFAULT,
) -> DataFrame:
    """Customers ⟕ per-customer order metrics (every status counts).

    The metrics aggregate is hash-partitioned by customer_id, which the
    following join reuses: orders are shuffled once, as partial aggregates.
    """
    met = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("m_orders"),
        F.sum("total_amount").alias("m_spent"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    j = customers.join(met, "customer_id", "left")
    return j.select(
        "customer_id", "first_name", "last_name", "email", "phone", "address", "city", "state_code",
        "postal_code", "country_code", "created_at", "updated_at",
        F.coalesce("m_orders", F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce(F.col("m_spent").cast("double"), F.lit(0.0)).alias("total_spent"),
        "first_order_date", "last_order_date",
        tier(F.col("m_spent"), tiers, default_tier).alias("customer_tier"),
    )


def dim_products(
    products: DataFrame,
    items: DataFrame,
    tiers: Sequence[tuple[float, str]] = PRODUCT_TIERS,
    default_tier: str = PRODUCT_TIER_DEFAULT,
) -> DataFrame:
    """Products ⟕ per-product line-item metrics (total_orders counts line items)."""
    met = items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("m_orders"),
        F.sum("quantity").alias("m_qty"),
        F.sum("total_price").alias("m_revenue"),
        F.avg("unit_price").alias("m_avg_price"),
    )
    j = products.join(met, "product_id", "left")
    return j.select(
        "product_id", "product_name", "category", "subcategory", "brand",
        F.col("price").cast("double").alias("price"), F.col("cost").cast("double").alias("cost"),
        "description", "is_active", "created_at", "updated_at",
        F.coalesce("m_orders", F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce("m_qty", F.lit(0)).cast("bigint").alias("total_quantity_sold"),
        F.coalesce(F.col("m_revenue").cast("double"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.col("m_avg_price").cast("double"), F.lit(0.0)).alias("avg_selling_price"),
        (F.col("price") - F.col("cost")).cast("double").alias("profit_margin"),
        tier(F.col("m_revenue"), tiers, default_tier).alias("performance_category"),
    )


def fct_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order item whose order survived silver (inner join on order_id)."""
    o = orders.select(
        "order_id", "customer_id", "order_date", "status", "payment_method", F.col("total_amount").alias("order_total")
    )
    j = items.join(o, "order_id", "inner")
    return j.select(
        "order_item_id", "order_id", "customer_id", "product_id", "order_date", "status", "payment_method",
        F.col("quantity").cast("bigint").alias("quantity"),
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("total_price").cast("double").alias("total_price"),
        F.col("discount_amount").cast("double").alias("discount_amount"),
        F.col("order_total").cast("double").alias("order_total"),
        "created_at",
    )


# --------------------------------------------------------------------------- gold analytics
def agg_daily_revenue(fct: DataFrame) -> DataFrame:
    """Per order date: distinct orders, distinct customers, revenue, units, discounts, avg unit price.

    Each order has one date and one customer, so the plan first collapses items
    to (date, order, customer) partials — a plain partial/final hash aggregate
    — and then needs only one distinct count (customers) instead of an Expand
    over two distinct columns.
    """
    per_order = fct.groupBy("order_date", "order_id", "customer_id").agg(
        F.sum("total_price").alias("rev"),
        F.sum("quantity").alias("units"),
        F.sum("discount_amount").alias("disc"),
        F.sum("unit_price").alias("price_sum"),
        F.count("unit_price").alias("price_n"),
    )
    day = per_order.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.sum("rev").alias("total_revenue"),
        F.sum("units").alias("total_units_sold"),
        F.sum("disc").alias("total_discounts"),
        F.sum("price_sum").alias("__ps"),
        F.sum("price_n").alias("__pn"),
    )
    return day.select(
        "order_date",
        F.col("total_orders").cast("bigint").alias("total_orders"),
        F.col("unique_customers").cast("bigint").alias("unique_customers"),
        "total_revenue",
        F.col("total_units_sold").cast("bigint").alias("total_units_sold"),
        "total_discounts",
        F.when(F.col("__pn") > 0, F.col("__ps") / F.col("__pn")).alias("avg_unit_price"),
    )


def agg_sales_by_customer(dim: DataFrame) -> DataFrame:
    return dim.select(
        "customer_id", "first_name", "last_name", "customer_tier", "city", "state_code", "country_code",
        "total_orders", "total_spent", "first_order_date", "last_order_date",
        F.datediff(F.col("last_order_date"), F.col("first_order_date")).cast("bigint").alias("customer_lifetime_days"),
        safe_divide(F.col("total_spent"), F.col("total_orders"), F.col("total_orders") > 0).alias("avg_order_value"),
    )


def agg_sales_by_product(dim: DataFrame) -> DataFrame:
    margin = (F.col("total_revenue") - F.col("cost") * F.col("total_quantity_sold")) / F.col("total_revenue")
    return dim.select(
        "product_id", "product_name", "category", "subcategory", "brand", "price", "cost", "profit_margin",
        "performance_category", "total_orders", "total_quantity_sold", "total_revenue", "avg_selling_price",
        F.when(F.col("total_revenue") > 0, margin).otherwise(F.lit(0.0)).alias("gross_margin_pct"),
    )
