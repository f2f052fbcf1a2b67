"""Per-entity facts the zones need: key, columns, standardisation, reject keys.

Fixed values: the column names, the per-column standardisation rule, the
renames and the reject-key columns below are the reference's, stated as data.
The dedupe tie-break orders are ours (the reference leaves ties open).
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    columns: tuple[str, ...]  # raw / transient / bronze business columns, in order
    silver_spec: tuple[tuple, ...]  # (source, rule[, output]) for clean_columns
    transient_reject_key: tuple[str, ...]
    silver_reject_key: tuple[str, ...]
    silver_reject_columns: tuple[str, ...]  # business columns kept in silver rejects
    # Order after _bronze_inserted_at desc (latest first); what is still equal is decided by a hash of the row.
    dedupe_order: tuple[str, ...] = ()


CUSTOMERS = Entity(
    name="customers",
    key="customer_id",
    columns=("customer_id", "first_name", "last_name", "email", "phone", "address", "city", "state",
             "zip_code", "country", "created_at", "updated_at"),
    silver_spec=(
        ("customer_id", "keep"), ("first_name", "initcap"), ("last_name", "initcap"), ("email", "lower"),
        ("phone", "trim"), ("address", "trim"), ("city", "initcap"), ("state", "upper", "state_code"),
        ("zip_code", "trim", "postal_code"), ("country", "upper", "country_code"),
        ("created_at", "keep"), ("updated_at", "keep"),
    ),
    transient_reject_key=("customer_id", "email"),
    silver_reject_key=("customer_id", "email"),
    silver_reject_columns=("customer_id", "first_name", "last_name", "email"),
    dedupe_order=("updated_at desc",),
)

ORDERS = Entity(
    name="orders",
    key="order_id",
    columns=("order_id", "customer_id", "order_date", "status", "total_amount", "shipping_address",
             "billing_address", "payment_method", "created_at", "updated_at"),
    silver_spec=(
        ("order_id", "keep"), ("customer_id", "keep"), ("order_date", "keep"), ("status", "upper"),
        ("total_amount", "keep"), ("shipping_address", "trim"), ("billing_address", "trim"),
        ("payment_method", "upper"), ("created_at", "keep"), ("updated_at", "keep"),
    ),
    transient_reject_key=("order_id", "customer_id", "order_date"),
    silver_reject_key=("order_id", "customer_id"),
    silver_reject_columns=("order_id", "customer_id", "order_date", "status", "total_amount"),
    dedupe_order=("updated_at desc",),
)

ORDER_ITEMS = Entity(
    name="order_items",
    key="order_item_id",
    columns=("order_item_id", "order_id", "product_id", "quantity", "unit_price", "total_price",
             "discount_amount", "created_at"),
    silver_spec=(
        ("order_item_id", "keep"), ("order_id", "keep"), ("product_id", "keep"), ("quantity", "keep"),
        ("unit_price", "keep"), ("total_price", "keep"), ("discount_amount", "keep"), ("created_at", "keep"),
    ),
    transient_reject_key=("order_item_id", "order_id", "product_id"),
    silver_reject_key=("order_item_id", "order_id"),
    silver_reject_columns=("order_item_id", "order_id", "product_id", "quantity", "unit_price", "total_price"),
    dedupe_order=("created_at desc", "product_id desc", "quantity desc", "unit_price desc",
                  "total_price desc", "discount_amount desc"),
)

PRODUCTS = Entity(
    name="products",
    key="product_id",
    columns=("product_id", "product_name", "category", "subcategory", "brand", "price", "cost",
             "description", "is_active", "created_at", "updated_at"),
    silver_spec=(
        ("product_id", "keep"), ("product_name", "initcap"), ("description", "trim"), ("category", "initcap"),
        ("subcategory", "initcap"), ("brand", "initcap"), ("price", "keep"), ("cost", "keep"),
        ("is_active", "keep"), ("created_at", "keep"), ("updated_at", "keep"),
    ),
    transient_reject_key=("product_id", "product_name"),
    silver_reject_key=("product_id", "product_name"),
    silver_reject_columns=("product_id", "product_name", "category", "brand", "price", "cost"),
    dedupe_order=("updated_at desc",),
)

ENTITIES = {e.name: e for e in (CUSTOMERS, ORDERS, ORDER_ITEMS, PRODUCTS)}
