"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The stand-in raw entities, the zones and the gold models are re-stated here
in plain SQL over the driver's tables, independently of the Spark code.
Double columns are rounded to 4 places on both sides (engines sum doubles in
different orders).
"""

from __future__ import annotations

BATCH_ID = "run-0001"
BATCH_TS = "2024-02-01 06:00:00"
NULL_MARK = "_strata_null_"


def initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def skey(*cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_MARK}')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def ts(v: str = BATCH_TS) -> str:
    return f"TIMESTAMP '{v}'"


def rounded(sql: str, cols: list[str], places: int = 4, doubles: list[str] = ()) -> str:
    """Round aggregated doubles; cast exact decimals to double (as the Spark side does)."""
    rep = [f"round({c}, {places}) AS {c}" for c in cols] + [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles]
    if not rep:
        return sql
    return f"SELECT * REPLACE ({', '.join(rep)}) FROM ({sql}) AS _r"


# --------------------------------------------------------------------------- raw stand-ins
RAW_CUSTOMERS = f"""
SELECT c.c_custkey AS customer_id,
       lower(c.c_mktsegment) AS first_name,
       ' ' || c.c_name || ' ' AS last_name,
       CASE WHEN c.c_acctbal >= 0 AND c.c_acctbal < 100 THEN NULL
            WHEN c.c_acctbal < 0 THEN lower(replace(c.c_name, '#', '.')) || '@example'
            ELSE ' ' || replace(c.c_name, '#', '.') || '@Example.COM' END AS email,
       '+' || CAST(c.c_nationkey AS VARCHAR) || '-' || CAST(c.c_custkey AS VARCHAR) AS phone,
       CAST(c.c_custkey AS VARCHAR) || ' Main St ' AS address,
       lower(g.n_name) AS city,
       ' ' || lower(g.n_name) AS state,
       CASE WHEN c.c_nationkey = 0 THEN '0' ELSE lpad(CAST(c.c_custkey AS VARCHAR), 5, '0') END AS zip_code,
       CASE WHEN c.c_nationkey = 24 THEN ' ' ELSE g.r_name END AS country,
       CAST(DATE '2020-01-01' + c.c_nationkey AS TIMESTAMP) AS created_at,
       CAST(DATE '2020-01-01' + c.c_nationkey AS TIMESTAMP) AS updated_at
FROM customer c
LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey) g
       ON c.c_nationkey = g.n_nationkey
"""

RAW_ORDERS = """
SELECT o_orderkey AS order_id,
       o_custkey AS customer_id,
       CAST(o_orderdate AS DATE) AS order_date,
       CASE WHEN o_orderstatus = 'F' THEN 'Completed'
            WHEN o_orderstatus = 'O' THEN ' processing'
            WHEN o_orderpriority = '1-URGENT' THEN 'on hold'
            ELSE 'pending ' END AS status,
       CAST(CASE WHEN o_totalprice < 2000 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS total_amount,
       ' ' || CAST(o_custkey AS VARCHAR) || ' Main St' AS shipping_address,
       ' ' || CAST(o_custkey AS VARCHAR) || ' Main St' AS billing_address,
       lower(o_orderpriority) AS payment_method,
       o_orderdate AS created_at,
       o_orderdate AS updated_at
FROM orders
"""

RAW_ORDER_ITEMS = """
SELECT l_orderkey * 100 + l_linenumber AS order_item_id,
       l_orderkey AS order_id,
       l_partkey AS product_id,
       CAST(l_quantity AS BIGINT) AS quantity,
       l_extendedprice / l_quantity AS unit_price,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,4)) AS total_price,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * abs(CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,4)) AS discount_amount,
       l_shipdate AS created_at
FROM lineitem
"""

RAW_PRODUCTS = """
SELECT p_partkey AS product_id,
       '  ' || p_name AS product_name,
       lower(p_type) AS category,
       'size ' || CAST(p_size AS VARCHAR) AS subcategory,
       lower(p_brand) AS brand,
       CAST(p_retailprice AS DECIMAL(18,2)) AS price,
       CAST(CASE WHEN p_size = 50 THEN CAST(p_retailprice AS DECIMAL(18,2)) * CAST(1.2 AS DECIMAL(2,1))
            WHEN p_size = 49 THEN -1
            ELSE CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.6 AS DECIMAL(2,1)) END AS DECIMAL(18,2)) AS cost,
       p_name || ' by ' || p_brand || ' ' AS description,
       p_size <= 45 AS is_active,
       CAST(DATE '2020-01-01' + p_size AS TIMESTAMP) AS created_at,
       CAST(DATE '2020-01-01' + p_size AS TIMESTAMP) AS updated_at
FROM part
"""

RAW = {"customers": RAW_CUSTOMERS, "orders": RAW_ORDERS, "order_items": RAW_ORDER_ITEMS, "products": RAW_PRODUCTS}

TECH = {
    "customers": ["customer_id", "email", "created_at"],
    "orders": ["order_id", "customer_id", "order_date", "total_amount"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity"],
    "products": ["product_id", "product_name", "price", "cost"],
}

KEY = {"customers": "customer_id", "orders": "order_id", "order_items": "order_item_id", "products": "product_id"}
DEDUPE = {
    "customers": "updated_at DESC NULLS LAST",
    "orders": "updated_at DESC NULLS LAST",
    "order_items": "created_at DESC NULLS LAST, product_id DESC NULLS LAST, quantity DESC NULLS LAST, "
    "unit_price DESC NULLS LAST, total_price DESC NULLS LAST, discount_amount DESC NULLS LAST",
    "products": "updated_at DESC NULLS LAST",
}
TAGS = {
    "customers": ("fivetran", "customer", "pii"),
    "orders": ("fivetran", "order", "confidential"),
    "order_items": ("fivetran", "order", "confidential"),
    "products": ("fivetran", "product", "public"),
}

STD = {
    "customers": f"""customer_id, {initcap('first_name')} AS first_name, {initcap('last_name')} AS last_name,
        lower(trim(email)) AS email, trim(phone) AS phone, trim(address) AS address, {initcap('city')} AS city,
        upper(trim(state)) AS state_code, trim(zip_code) AS postal_code, upper(trim(country)) AS country_code,
        created_at, updated_at""",
    "orders": """order_id, customer_id, order_date, upper(trim(status)) AS status, total_amount,
        trim(shipping_address) AS shipping_address, trim(billing_address) AS billing_address,
        upper(trim(payment_method)) AS payment_method, created_at, updated_at""",
    "order_items": "order_item_id, order_id, product_id, quantity, unit_price, total_price, discount_amount, created_at",
    "products": f"""product_id, {initcap('product_name')} AS product_name, trim(description) AS description,
        {initcap('category')} AS category, {initcap('subcategory')} AS subcategory, {initcap('brand')} AS brand,
        price, cost, is_active, created_at, updated_at""",
}

BUSINESS = {
    "customers": """CASE WHEN email NOT LIKE '%@%.%' THEN 'invalid email format'
        WHEN length(trim(postal_code)) < 3 THEN 'invalid postal code'
        WHEN country_code IS NULL OR trim(country_code) = '' THEN 'missing country code' END""",
    "orders": """CASE WHEN order_date IS NULL THEN 'missing order date'
        WHEN total_amount <= 0 THEN 'invalid total amount'
        WHEN status NOT IN ('COMPLETED', 'SHIPPED', 'PROCESSING', 'CANCELLED', 'PENDING') THEN 'unknown order status' END""",
    "order_items": """CASE WHEN quantity <= 0 THEN 'invalid quantity'
        WHEN unit_price <= 0 THEN 'invalid unit price'
        WHEN total_price <= 0 THEN 'invalid total price' END""",
    "products": """CASE WHEN price <= 0 THEN 'invalid price'
        WHEN cost < 0 THEN 'invalid cost'
        WHEN cost > price THEN 'cost exceeds price' END""",
}

SILVER_COLS = {
    "customers": "customer_id, first_name, last_name, email, phone, address, city, state_code, postal_code, country_code, created_at, updated_at",
    "orders": "order_id, customer_id, order_date, status, total_amount, shipping_address, billing_address, payment_method, created_at, updated_at",
    "order_items": "order_item_id, order_id, product_id, quantity, unit_price, total_price, discount_amount, created_at",
    "products": "product_id, product_name, description, category, subcategory, brand, price, cost, is_active, created_at, updated_at",
}


def technical_reason(entity: str) -> str:
    whens = " ".join(f"WHEN {c} IS NULL THEN '{c} is null'" for c in TECH[entity])
    return f"CASE {whens} END"


def transient(entity: str, batch_id: str = BATCH_ID, batch_ts: str = BATCH_TS, where: str = "TRUE") -> str:
    cond = " AND ".join(f"{c} IS NOT NULL" for c in TECH[entity])
    return (
        f"SELECT *, ({cond}) AS _is_valid, {ts(batch_ts)} AS _loaded_at, '{batch_id}' AS _batch_id "
        f"FROM ({RAW[entity]}) AS raw WHERE {where}"
    )


def bronze(entity: str, batch_id: str = BATCH_ID, batch_ts: str = BATCH_TS, where: str = "TRUE") -> str:
    s, d, t = TAGS[entity]
    return (
        f"SELECT * EXCLUDE (_is_valid), '{s}' AS _source_system, '{d}' AS _domain, '{t}' AS _sensitivity_tag, "
        f"{ts(batch_ts)} AS _bronze_inserted_at, {skey(KEY[entity], '_batch_id')} AS _bronze_sk "
        f"FROM ({transient(entity, batch_id, batch_ts, where)}) AS trn WHERE _is_valid"
    )


def silver_validated(entity: str) -> str:
    latest = (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {KEY[entity]} ORDER BY _bronze_inserted_at DESC NULLS LAST, "
        f"{DEDUPE[entity]}) AS _rn FROM ({bronze(entity)}) AS b) AS d WHERE _rn = 1"
    )
    std = f"SELECT {STD[entity]}, _source_system, _domain, _sensitivity_tag, {ts()} AS _silver_processed_at FROM ({latest}) AS l"
    return f"SELECT *, ({BUSINESS[entity]}) AS _reject_reason FROM ({std}) AS s"


def silver_validated_flagged(entity: str) -> str:
    return f"SELECT *, _reject_reason IS NULL AS _is_business_valid FROM ({silver_validated(entity)}) AS v"


def silver(entity: str) -> str:
    return (
        f"SELECT {SILVER_COLS[entity]}, _source_system, _domain, _sensitivity_tag, _silver_processed_at "
        f"FROM ({silver_validated(entity)}) AS v WHERE _reject_reason IS NULL"
    )


# --------------------------------------------------------------------------- gold
CUST_TIERS = ((3_000_000, "VIP"), (2_000_000, "Premium"), (1_000_000, "Regular"))
PROD_TIERS = ((2_000_000, "High Performance"), (1_500_000, "Medium Performance"), (1_000_000, "Low Performance"))


def tier_sql(col: str, tiers, default: str) -> str:
    whens = " ".join(f"WHEN {col} >= {t} THEN '{lbl}'" for t, lbl in tiers)
    return f"CASE {whens} ELSE '{default}' END"


def dim_customers() -> str:
    return f"""
SELECT c.customer_id, c.first_name, c.last_name, c.email, c.phone, c.address, c.city, c.state_code,
       c.postal_code, c.country_code, c.created_at, c.updated_at,
       CAST(coalesce(m.n, 0) AS BIGINT) AS total_orders,
       coalesce(CAST(m.spent AS DOUBLE), 0.0) AS total_spent,
       m.first_order_date, m.last_order_date,
       {tier_sql('m.spent', CUST_TIERS, 'New')} AS customer_tier
FROM ({silver('customers')}) AS c
LEFT JOIN (SELECT customer_id, count(*) AS n, sum(total_amount) AS spent,
                  min(order_date) AS first_order_date, max(order_date) AS last_order_date
           FROM ({silver('orders')}) AS o GROUP BY customer_id) AS m
       ON c.customer_id = m.customer_id"""


def dim_products() -> str:
    return f"""
SELECT p.product_id, p.product_name, p.category, p.subcategory, p.brand,
       CAST(p.price AS DOUBLE) AS price, CAST(p.cost AS DOUBLE) AS cost, p.description, p.is_active,
       p.created_at, p.updated_at,
       CAST(coalesce(m.n, 0) AS BIGINT) AS total_orders,
       CAST(coalesce(m.qty, 0) AS BIGINT) AS total_quantity_sold,
       coalesce(CAST(m.revenue AS DOUBLE), 0.0) AS total_revenue,
       coalesce(CAST(m.avg_price AS DOUBLE), 0.0) AS avg_selling_price,
       CAST(p.price - p.cost AS DOUBLE) AS profit_margin,
       {tier_sql('m.revenue', PROD_TIERS, 'No Sales')} AS performance_category
FROM ({silver('products')}) AS p
LEFT JOIN (SELECT product_id, count(*) AS n, sum(quantity) AS qty, sum(total_price) AS revenue,
                  avg(unit_price) AS avg_price
           FROM ({silver('order_items')}) AS i GROUP BY product_id) AS m
       ON p.product_id = m.product_id"""


def fct_orders() -> str:
    return f"""
SELECT i.order_item_id, i.order_id, o.customer_id, i.product_id, o.order_date, o.status, o.payment_method,
       CAST(i.quantity AS BIGINT) AS quantity, CAST(i.unit_price AS DOUBLE) AS unit_price,
       CAST(i.total_price AS DOUBLE) AS total_price, CAST(i.discount_amount AS DOUBLE) AS discount_amount,
       CAST(o.total_amount AS DOUBLE) AS order_total, i.created_at
FROM ({silver('order_items')}) AS i
JOIN ({silver('orders')}) AS o ON i.order_id = o.order_id"""


def agg_daily_revenue() -> str:
    return f"""
SELECT order_date,
       CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders,
       CAST(count(DISTINCT customer_id) AS BIGINT) AS unique_customers,
       sum(total_price) AS total_revenue,
       CAST(sum(quantity) AS BIGINT) AS total_units_sold,
       sum(discount_amount) AS total_discounts,
       avg(unit_price) AS avg_unit_price
FROM ({fct_orders()}) AS f GROUP BY order_date"""


def agg_sales_by_customer() -> str:
    return f"""
SELECT customer_id, first_name, last_name, customer_tier, city, state_code, country_code,
       total_orders, total_spent, first_order_date, last_order_date,
       CAST(datediff('day', first_order_date, last_order_date) AS BIGINT) AS customer_lifetime_days,
       CASE WHEN total_orders > 0 THEN total_spent / total_orders ELSE 0.0 END AS avg_order_value
FROM ({dim_customers()}) AS d"""


def agg_sales_by_product() -> str:
    return f"""
SELECT product_id, product_name, category, subcategory, brand, price, cost, profit_margin,
       performance_category, total_orders, total_quantity_sold, total_revenue, avg_selling_price,
       CASE WHEN total_revenue > 0 THEN (total_revenue - (cost * total_quantity_sold)) / total_revenue
            ELSE 0.0 END AS gross_margin_pct
FROM ({dim_products()}) AS d"""


# --------------------------------------------------------------------------- loads
LOAD1_TS = "2024-01-01 00:00:00"
LOAD2_TS = "2024-02-01 06:00:00"
SNAP1_TS = "2024-01-02 00:00:00"
SNAP2_TS = "2024-02-02 00:00:00"
LOG_NOW = "2024-01-31 00:00:00"
FRESHNESS_NOW = "2024-01-31 06:00:00"


def _dbl(sql: str, cols) -> str:
    return rounded(sql, [], doubles=list(cols))


def incremental_append() -> str:
    first = bronze("orders", "load-2024-01-01", LOAD1_TS, "order_date < DATE '1998-01-01'")
    second = bronze("orders", "load-2024-02-01", LOAD2_TS)
    return _dbl(
        f"SELECT * FROM ({first}) AS a UNION ALL SELECT * FROM ({second}) AS b "
        f"WHERE _loaded_at > (SELECT coalesce(max(_loaded_at), TIMESTAMP '1900-01-01') FROM ({first}) AS f)",
        ["total_amount"],
    )


def incremental_append_empty_target() -> str:
    return _dbl(bronze("orders", "load-2024-02-01", LOAD2_TS), ["total_amount"])


def _orders_v(version: int, where: str = "TRUE") -> str:
    return (
        f"SELECT order_id, customer_id, order_date, status, CAST(total_amount AS DOUBLE) AS total_amount, "
        f"{version} AS version FROM ({RAW_ORDERS}) AS o WHERE {where}"
    )


def merge_upsert() -> str:
    tgt = _orders_v(1, "order_date < DATE '1998-01-01'")
    src = _orders_v(2, "order_date >= DATE '1997-01-01'")
    return (
        f"WITH tgt AS ({tgt}), src AS ({src}) "
        "SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.order_id IS NOT DISTINCT FROM tgt.order_id) "
        "UNION ALL SELECT * FROM src"
    )


def delete_insert_window() -> str:
    tgt = _orders_v(1)
    src = _orders_v(2, "order_date BETWEEN DATE '1995-07-01' AND DATE '1997-06-30'")
    inside = "order_date >= DATE '1996-01-01' AND order_date < DATE '1997-01-01'"
    return (
        f"SELECT * FROM ({tgt}) AS t WHERE NOT ({inside}) OR order_date IS NULL "
        f"UNION ALL SELECT * FROM ({src}) AS s WHERE {inside}"
    )


def late_lookback() -> str:
    cols = "event_id, ts, user_id, event_type, value"
    return (
        f"WITH tgt AS (SELECT {cols}, 1 AS version FROM events WHERE ts < TIMESTAMP '2024-01-20'), "
        f"late AS (SELECT {cols}, 2 AS version FROM events WHERE ts > (SELECT max(ts) FROM tgt) - INTERVAL 3 DAY) "
        "SELECT * FROM tgt WHERE event_id NOT IN (SELECT event_id FROM late) UNION ALL SELECT * FROM late"
    )


def microbatch_days() -> str:
    return (
        "SELECT date_trunc('day', ts) AS _batch_start, event_type, count(*) AS events, "
        "round(sum(value), 4) AS value_sum FROM events GROUP BY ALL"
    )


def schema_change_append_cols() -> str:
    return (
        f"WITH o AS ({RAW_ORDERS}) "
        "SELECT order_id, customer_id, order_date, status, CAST(NULL AS VARCHAR) AS payment_method, "
        "CAST(NULL AS INTEGER) AS priority_rank FROM o WHERE order_date < DATE '1998-01-01' "
        "UNION ALL SELECT order_id, customer_id, order_date, status, payment_method, "
        "CAST(substr(payment_method, 1, 1) AS INTEGER) AS priority_rank FROM o WHERE order_date >= DATE '1998-01-01'"
    )


def schema_change_sync() -> str:
    return (
        f"WITH o AS ({RAW_ORDERS}) "
        "SELECT order_id, customer_id, order_date, CAST(NULL AS VARCHAR) AS payment_method FROM o "
        "WHERE order_date < DATE '1998-01-01' "
        "UNION ALL SELECT order_id, customer_id, order_date, payment_method FROM o WHERE order_date >= DATE '1998-01-01'"
    )


# --------------------------------------------------------------------------- history
V1 = (
    "SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS nation_key, c_mktsegment AS segment, "
    "TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM customer WHERE c_acctbal >= -900"
)
V2 = (
    "SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS nation_key, "
    "CASE WHEN c_acctbal > 5000 THEN lower(c_mktsegment) ELSE c_mktsegment END AS segment, "
    "CASE WHEN c_acctbal > 5000 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS updated_at "
    "FROM customer WHERE NOT (c_acctbal >= 9000 AND c_acctbal < 9250)"
)


def snapshot_diff() -> str:
    cols = ["name", "nation_key", "segment", "updated_at"]
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in cols)
    pick = ", ".join(f"CASE WHEN n.customer_id IS NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in cols)
    return (
        f"WITH v1 AS ({V1}), v2 AS ({V2}) SELECT coalesce(n.customer_id, o.customer_id) AS customer_id, "
        f"CASE WHEN o.customer_id IS NULL THEN 'insert' WHEN n.customer_id IS NULL THEN 'delete' "
        f"WHEN {differs} THEN 'update' ELSE 'same' END AS _change, {pick} "
        "FROM v1 AS o FULL OUTER JOIN v2 AS n ON o.customer_id = n.customer_id"
    )


def _hist_row(alias: str, valid_from: str, valid_to: str) -> str:
    return (
        f"{alias}.customer_id, {alias}.name, {alias}.nation_key, {alias}.segment, {alias}.updated_at, "
        f"CAST({valid_from} AS TIMESTAMP) AS valid_from, CAST({valid_to} AS TIMESTAMP) AS valid_to"
    )


def scd2_timestamp() -> str:
    body = (
        f"SELECT {_hist_row('o', 'o.updated_at', ts(SNAP2_TS))} FROM v1 o WHERE o.customer_id NOT IN (SELECT customer_id FROM v2) "
        f"UNION ALL SELECT {_hist_row('o', 'o.updated_at', 'n.updated_at')} FROM v1 o JOIN v2 n USING (customer_id) WHERE n.updated_at > o.updated_at "
        f"UNION ALL SELECT {_hist_row('n', 'n.updated_at', 'NULL')} FROM v1 o JOIN v2 n USING (customer_id) WHERE n.updated_at > o.updated_at "
        f"UNION ALL SELECT {_hist_row('o', 'o.updated_at', 'NULL')} FROM v1 o JOIN v2 n USING (customer_id) WHERE NOT (n.updated_at > o.updated_at) "
        f"UNION ALL SELECT {_hist_row('n', 'n.updated_at', 'NULL')} FROM v2 n WHERE n.customer_id NOT IN (SELECT customer_id FROM v1)"
    )
    return f"WITH v1 AS ({V1}), v2 AS ({V2}) SELECT *, {skey('customer_id', 'valid_from')} AS scd_id FROM ({body}) AS h"


def scd2_hard_delete() -> str:
    return f"SELECT * FROM ({scd2_timestamp()}) AS h WHERE valid_to = {ts(SNAP2_TS)}"


def scd2_as_of() -> str:
    t = ts("2024-02-01 12:00:00")
    return f"SELECT * FROM ({scd2_timestamp()}) AS h WHERE valid_from <= {t} AND (valid_to IS NULL OR {t} < valid_to)"


def scd2_check() -> str:
    def row(a, vf, vt):
        return (f"{a}.customer_id, {a}.name, {a}.nation_key, {a}.segment, CAST({vf} AS TIMESTAMP) AS valid_from, "
                f"CAST({vt} AS TIMESTAMP) AS valid_to")
    chg = "(o.segment IS DISTINCT FROM n.segment OR o.name IS DISTINCT FROM n.name)"
    s1, s2 = ts(SNAP1_TS), ts(SNAP2_TS)
    body = (
        f"SELECT {row('o', s1, s2)} FROM v1 o WHERE o.customer_id NOT IN (SELECT customer_id FROM v2) "
        f"UNION ALL SELECT {row('o', s1, s2)} FROM v1 o JOIN v2 n USING (customer_id) WHERE {chg} "
        f"UNION ALL SELECT {row('n', s2, 'NULL')} FROM v1 o JOIN v2 n USING (customer_id) WHERE {chg} "
        f"UNION ALL SELECT {row('o', s1, 'NULL')} FROM v1 o JOIN v2 n USING (customer_id) WHERE NOT {chg} "
        f"UNION ALL SELECT {row('n', s2, 'NULL')} FROM v2 n WHERE n.customer_id NOT IN (SELECT customer_id FROM v1)"
    )
    return f"WITH v1 AS ({V1}), v2 AS ({V2}) SELECT *, {skey('customer_id', 'valid_from')} AS scd_id FROM ({body}) AS h"


# --------------------------------------------------------------------------- checks
def _summary(table: str, column: str | None, check: str, severity: str, rows: str, failures: str, frm: str) -> str:
    col = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return (
        f"SELECT '{table}' AS table_name, {col} AS column_name, '{check}' AS check_name, '{severity}' AS severity, "
        f"CAST({rows} AS BIGINT) AS row_count, CAST({failures} AS BIGINT) AS failures, "
        f"CASE WHEN {failures} = 0 THEN 'pass' ELSE '{severity}' END AS status FROM {frm}"
    )


def check_not_null() -> str:
    return _summary("customers", "email", "not_null", "error", "count(*)", "count(*) FILTER (WHERE email IS NULL)", f"({RAW_CUSTOMERS}) AS t")


def check_not_null_where() -> str:
    trn = transient("customers", "run", LOAD2_TS)
    return _summary("trn_customers", "email", "not_null_where", "error", "count(*)",
                    "count(*) FILTER (WHERE _is_valid = true AND email IS NULL)", f"({trn}) AS t")


def check_unique() -> str:
    dup = f"(SELECT count(*) FROM (SELECT order_item_id FROM ({RAW_ORDER_ITEMS}) AS i WHERE order_item_id IS NOT NULL GROUP BY order_item_id HAVING count(*) > 1) AS d)"
    return _summary("order_items", "order_item_id", "unique", "error", f"(SELECT count(*) FROM ({RAW_ORDER_ITEMS}) AS i2)", dup, "(SELECT 1) AS one")


STATUS_LIST = "('COMPLETED', 'SHIPPED', 'PROCESSING', 'CANCELLED', 'PENDING')"


def check_accepted_values() -> str:
    return _summary("orders", "status", "accepted_values", "error", "count(*)",
                    f"count(*) FILTER (WHERE status IS NOT NULL AND status NOT IN {STATUS_LIST})",
                    f"(SELECT upper(trim(status)) AS status FROM ({RAW_ORDERS}) AS o) AS t")


def check_relationships() -> str:
    f, p = fct_orders(), silver("products")
    orph = f"(SELECT count(*) FROM ({f}) AS f WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM ({p}) AS p WHERE product_id IS NOT NULL))"
    return _summary("fct_orders", "product_id", "relationships", "error", f"(SELECT count(*) FROM ({f}) AS f2)", orph, "(SELECT 1) AS one")


def check_between() -> str:
    frm = f"({RAW_PRODUCTS}) AS t"
    a = _summary("products", "cost", "between", "error", "count(*)", "count(*) FILTER (WHERE cost IS NOT NULL AND cost < 0)", frm)
    b = _summary("products", "price", "between", "error", "count(*)",
                 "count(*) FILTER (WHERE price IS NOT NULL AND (price <= 0 OR price >= 2000))", frm)
    return f"{a} UNION ALL {b}"


def check_regex() -> str:
    return _summary("customers", "email", "match_regex", "warn", "count(*)",
                    "count(*) FILTER (WHERE email IS NOT NULL AND NOT regexp_matches(email, '^[a-z0-9._]+@[a-z0-9]+\\.[a-z]+$'))",
                    f"(SELECT lower(trim(email)) AS email FROM ({RAW_CUSTOMERS}) AS c) AS t")


def check_grain() -> str:
    return f"SELECT order_item_id, count(*) AS row_count FROM ({RAW_ORDER_ITEMS}) AS i GROUP BY order_item_id HAVING count(*) > 1"


def check_row_count_between() -> str:
    return _summary("fct_orders", None, "row_count_between", "error", "count(*)",
                    "CASE WHEN count(*) < 1 THEN 1 ELSE 0 END", f"({fct_orders()}) AS f")


def row_count_diff() -> str:
    return (
        f"SELECT s, t, s - t AS row_diff, CASE WHEN s = t THEN 'match' ELSE 'mismatch' END AS status FROM "
        f"(SELECT (SELECT count(*) FROM ({RAW_ORDERS}) AS a) AS s, (SELECT count(*) FROM ({silver('orders')}) AS b) AS t) AS x"
    ).replace("SELECT s, t,", "SELECT s AS source_rows, t AS target_rows,")


def source_freshness() -> str:
    return (
        f"SELECT 'events' AS table_name, m AS max_loaded_at, round(age, 4) AS age_hours, "
        f"CASE WHEN m IS NULL THEN 'error' WHEN age > 24 THEN 'error' WHEN age > 12 THEN 'warn' ELSE 'pass' END AS status "
        f"FROM (SELECT m, (epoch_us({ts(FRESHNESS_NOW)}) - epoch_us(m)) / 3600000000.0 AS age FROM (SELECT max(ts) AS m FROM events) AS a) AS b"
    )


CUST_LABELS = "('VIP', 'Premium', 'Regular', 'New')"
PROD_LABELS = "('High Performance', 'Medium Performance', 'Low Performance', 'No Sales')"


def quality_summary() -> str:
    dc, dp, f = "dc", "dp", "f"
    n = lambda c: f"count(*) FILTER (WHERE {c} IS NULL)"
    dup = lambda t, c: f"(SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) AS d)"
    cnt = lambda t: f"(SELECT count(*) FROM {t})"
    orph = lambda c, t: f"(SELECT count(*) FROM f WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {t} WHERE {c} IS NOT NULL))"
    parts = [
        _summary("dim_customers", "customer_id", "not_null", "error", "count(*)", n("customer_id"), dc),
        _summary("dim_customers", "customer_id", "unique", "error", cnt(dc), dup(dc, "customer_id"), "(SELECT 1) AS one"),
        _summary("dim_customers", "email", "not_null", "error", "count(*)", n("email"), dc),
        _summary("dim_customers", "email", "match_regex", "warn", "count(*)",
                 "count(*) FILTER (WHERE email IS NOT NULL AND NOT regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$'))", dc),
        _summary("dim_customers", "total_orders", "between", "error", "count(*)", "count(*) FILTER (WHERE total_orders < 0)", dc),
        _summary("dim_customers", "total_spent", "between", "error", "count(*)", "count(*) FILTER (WHERE total_spent < 0)", dc),
        _summary("dim_customers", "customer_tier", "accepted_values", "error", "count(*)",
                 f"count(*) FILTER (WHERE customer_tier IS NOT NULL AND customer_tier NOT IN {CUST_LABELS})", dc),
        _summary("dim_products", "product_id", "not_null", "error", "count(*)", n("product_id"), dp),
        _summary("dim_products", "product_id", "unique", "error", cnt(dp), dup(dp, "product_id"), "(SELECT 1) AS one"),
        _summary("dim_products", "price", "between", "error", "count(*)", "count(*) FILTER (WHERE price <= 0)", dp),
        _summary("dim_products", "total_revenue", "between", "error", "count(*)", "count(*) FILTER (WHERE total_revenue < 0)", dp),
        _summary("dim_products", "performance_category", "accepted_values", "error", "count(*)",
                 f"count(*) FILTER (WHERE performance_category IS NOT NULL AND performance_category NOT IN {PROD_LABELS})", dp),
        _summary("fct_orders", "order_item_id", "not_null", "error", "count(*)", n("order_item_id"), f),
        _summary("fct_orders", "order_item_id", "unique", "error", cnt(f), dup(f, "order_item_id"), "(SELECT 1) AS one"),
        _summary("fct_orders", "order_id", "not_null", "error", "count(*)", n("order_id"), f),
        _summary("fct_orders", "customer_id", "relationships", "warn", cnt(f), orph("customer_id", dc), "(SELECT 1) AS one"),
        _summary("fct_orders", "product_id", "relationships", "warn", cnt(f), orph("product_id", dp), "(SELECT 1) AS one"),
        _summary("fct_orders", "quantity", "between", "error", "count(*)", "count(*) FILTER (WHERE quantity <= 0)", f),
        _summary("fct_orders", "unit_price", "between", "error", "count(*)", "count(*) FILTER (WHERE unit_price <= 0)", f),
    ]
    return f"WITH dc AS ({dim_customers()}), dp AS ({dim_products()}), f AS ({fct_orders()}) " + " UNION ALL ".join(parts)


# --------------------------------------------------------------------------- run log
EVENT_MODEL = {"click": "dim_customers", "view": "fct_orders", "purchase": "agg_daily_revenue", "error": "dim_products"}
EVENT_QTYPE = {"click": "INSERT", "view": "CREATE_TABLE_AS_SELECT", "purchase": "MERGE", "error": "INSERT"}


def _case(col: str, mapping: dict) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def query_log_parsed() -> str:
    ok = "value >= 1"
    base = (
        "SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"
    )
    sel = f"""
SELECT CASE WHEN {ok} THEN 'inv-' || CAST(user_id AS VARCHAR) || '-' || day END AS invocation_id,
       CASE WHEN {ok} THEN 'daily_build' END AS job,
       CASE WHEN {ok} THEN (CASE WHEN user_id % 3 = 0 THEN 'dev' ELSE 'prod' END) END AS env,
       CASE WHEN {ok} THEN {_case('event_type', EVENT_MODEL)} END AS model,
       CASE WHEN {ok} THEN 'gold' END AS model_schema,
       CASE WHEN {ok} THEN 'table' END AS materialized,
       CASE WHEN {ok} THEN 'scheduled__' || day END AS airflow_run_id,
       'q-' || CAST(event_id AS VARCHAR) AS query_id,
       ts AS start_time,
       ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS end_time,
       round(CAST(round(value * 1000) AS BIGINT) / 1000.0, 2) AS duration_seconds,
       CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'SUCCESS' END AS status,
       CASE WHEN event_type = 'error' THEN '100183' END AS error_code,
       CASE WHEN event_type = 'error' THEN 'model failed for user ' || CAST(user_id AS VARCHAR) END AS error_message,
       k AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted, k AS rows_produced,
       CASE WHEN k >= 95 THEN 'SELECT' ELSE coalesce({_case('event_type', EVENT_QTYPE)}, 'SELECT') END AS query_type
FROM ({base}) AS e"""
    kept = (
        f"SELECT * FROM ({sel}) AS p WHERE invocation_id IS NOT NULL AND model IS NOT NULL "
        "AND query_type IN ('CREATE_TABLE_AS_SELECT', 'MERGE', 'INSERT', 'UPDATE', 'DELETE')"
    )
    return (
        "SELECT *, CAST(row_number() OVER (PARTITION BY invocation_id ORDER BY start_time, query_id) AS INTEGER) AS event_sequence "
        f"FROM ({kept}) AS k"
    )


def runlog_sequence() -> str:
    return (
        "SELECT invocation_id, event_sequence, model, model_schema, materialized, duration_seconds, status, rows_inserted, "
        f"error_message FROM ({query_log_parsed()}) AS l WHERE airflow_run_id = 'scheduled__2024-01-15'"
    )


def runlog_slowest() -> str:
    return (
        "SELECT model, round(avg(duration_seconds), 1) AS avg_seconds, max(duration_seconds) AS max_seconds, "
        f"count(*) AS run_count FROM ({query_log_parsed()}) AS l WHERE env = 'prod' AND status = 'SUCCESS' "
        f"AND start_time >= {ts(LOG_NOW)} - INTERVAL 30 DAY GROUP BY model"
    )


def runlog_failures() -> str:
    return (
        f"SELECT invocation_id, model, error_message, start_time FROM ({query_log_parsed()}) AS l "
        f"WHERE status = 'FAIL' AND start_time >= {ts(LOG_NOW)} - INTERVAL 7 DAY"
    )


def runlog_row_trend() -> str:
    return (
        "SELECT CAST(start_time AS DATE) AS run_date, start_time, query_id, rows_inserted, duration_seconds "
        f"FROM ({query_log_parsed()}) AS l WHERE model = 'dim_customers' AND env = 'prod' "
        "ORDER BY start_time DESC, query_id DESC LIMIT 30"
    )


def runlog_summary() -> str:
    return (
        "SELECT invocation_id, min(start_time) AS started_at, max(end_time) AS ended_at, count(*) AS models_run, "
        "count(*) FILTER (WHERE status = 'FAIL') AS models_failed, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted "
        f"FROM ({query_log_parsed()}) AS l GROUP BY invocation_id"
    )


def runlog_trend_monitor() -> str:
    w = "OVER (PARTITION BY model, env ORDER BY start_time, query_id)"
    inner = (
        f"SELECT model, env, query_id, start_time, duration_seconds, lag(duration_seconds) {w} AS prev_duration_seconds, "
        f"rows_inserted, lag(rows_inserted) {w} AS prev_rows_inserted FROM ({query_log_parsed()}) AS l"
    )
    ratio = "CASE WHEN prev_rows_inserted > 0 THEN rows_inserted / prev_rows_inserted END"
    growth = "CASE WHEN prev_duration_seconds > 0 THEN duration_seconds / prev_duration_seconds END"
    return (
        f"SELECT *, {ratio} AS row_change_ratio, CASE WHEN prev_rows_inserted IS NULL THEN 'first' "
        f"WHEN {ratio} > 2.0 THEN 'spike' WHEN {ratio} < 0.5 THEN 'drop' ELSE 'ok' END AS row_flag, "
        f"{growth} AS duration_ratio, coalesce({growth} > 1.5, FALSE) AS is_slower FROM ({inner}) AS t"
    )


def runlog_run_failures() -> str:
    return f"SELECT count(*) FILTER (WHERE status = 'FAIL') AS failures FROM ({query_log_parsed()}) AS l WHERE airflow_run_id = 'scheduled__2024-01-15'"


def runlog_recent() -> str:
    return f"SELECT * FROM ({query_log_parsed()}) AS l WHERE start_time >= {ts(LOG_NOW)} - INTERVAL 7 DAY"


def runlog_invocation_detail() -> str:
    return (
        "SELECT event_sequence, model, model_schema, materialized, start_time, end_time, duration_seconds, status, rows_inserted, "
        f"rows_updated, rows_deleted, error_message FROM ({query_log_parsed()}) AS l WHERE invocation_id = 'inv-33-2024-01-28'"
    )


# --------------------------------------------------------------------------- declared tests
REJECT_KEY = {
    "trn": {"customers": ("customer_id", "email"), "orders": ("order_id", "customer_id", "order_date"), "order_items": ("order_item_id", "order_id", "product_id"), "products": ("product_id", "product_name")},
    "slv": {"customers": ("customer_id", "email"), "orders": ("order_id", "customer_id"), "order_items": ("order_item_id", "order_id"), "products": ("product_id", "product_name")},
}


def _rejects(prefix: str, entity: str) -> str:
    source = f"SELECT *, {technical_reason(entity)} AS _reject_reason FROM ({RAW[entity]}) AS raw" if prefix == "trn" else silver_validated(entity)
    return f"SELECT {skey(*REJECT_KEY[prefix][entity])} AS _reject_id, _reject_reason FROM ({source}) AS r WHERE _reject_reason IS NOT NULL"


# Per zone, in SQL terms: (table, checks); a check is "column kind [what a failing row satisfies | parent table]".
DECLARED = {
    "transient": [
        ("trn_customers", ["customer_id not_null_where", "_is_valid not_null", "_loaded_at not_null", "_batch_id not_null"]),
        ("trn_orders", ["order_id not_null_where", "_is_valid not_null", "_loaded_at not_null"]),
        ("trn_order_items", ["order_item_id not_null_where", "_is_valid not_null", "_loaded_at not_null"]),
        ("trn_products", ["product_id not_null_where", "_is_valid not_null", "_loaded_at not_null"]),
        *[(f"trn_{e}_rejects", ["_reject_id not_null", "_reject_id unique", "_reject_reason not_null"]) for e in RAW],
    ],
    "bronze": [
        ("brz_customers", ["_bronze_sk not_null", "_bronze_sk unique", "customer_id not_null", "_source_system not_null", "_source_system accepted_values NOT IN ('fivetran')",
                           "_sensitivity_tag not_null", "_sensitivity_tag accepted_values NOT IN ('pii', 'public', 'confidential')"]),
        ("brz_orders", ["_bronze_sk not_null", "_bronze_sk unique", "order_id not_null", "_source_system not_null"]),
        ("brz_order_items", ["_bronze_sk not_null", "_bronze_sk unique", "order_item_id not_null", "_source_system not_null"]),
        ("brz_products", ["_bronze_sk not_null", "_bronze_sk unique", "product_id not_null", "_source_system not_null"]),
    ],
    "silver": [
        ("slv_customers", ["customer_id not_null", "customer_id unique", "email not_null", "email unique", "first_name not_null", "last_name not_null", "state_code not_null", "country_code not_null"]),
        ("slv_orders", ["order_id not_null", "order_id unique", "customer_id not_null", "customer_id relationships slv_customers", "total_amount not_null", "status not_null", f"status accepted_values NOT IN {STATUS_LIST}"]),
        ("slv_order_items", ["order_item_id not_null", "order_item_id unique", "order_id not_null", "order_id relationships slv_orders", "product_id not_null", "product_id relationships slv_products", "quantity not_null"]),
        ("slv_products", ["product_id not_null", "product_id unique", "price not_null", "cost not_null"]),
        ("slv_customers_rejects", ["_reject_id not_null", "_reject_id unique", "_reject_reason not_null"]),
        *[(f"slv_{e}_rejects", ["_reject_id not_null", "_reject_id unique"]) for e in ("orders", "order_items", "products")],
    ],
    "gold": [
        ("dim_customers", ["customer_id not_null", "customer_id unique", "email match_regex", "total_orders not_null", "total_orders between < 0", "total_spent not_null", "total_spent between < 0",
                           "customer_tier not_null", f"customer_tier accepted_values NOT IN {CUST_LABELS}"]),
        ("dim_products", ["product_id not_null", "product_id unique", "price between <= 0", "cost between < 0", "total_orders not_null", "total_orders between < 0", "total_quantity_sold not_null",
                          "total_quantity_sold between < 0", "total_revenue not_null", "total_revenue between < 0", "avg_selling_price between < 0", "profit_margin not_null",
                          "performance_category not_null", f"performance_category accepted_values NOT IN {PROD_LABELS}"]),
        ("fct_orders", ["order_item_id not_null", "order_item_id unique", "order_id not_null", "customer_id not_null", "customer_id relationships dim_customers", "product_id not_null",
                        "product_id relationships dim_products", "order_date not_null", "status not_null", "quantity not_null", "quantity between < 1", "unit_price not_null", "unit_price between <= 0",
                        "total_price not_null", "total_price between < 0", "discount_amount not_null", "discount_amount between < 0", "order_total not_null", "order_total between < 0", "created_at not_null"]),
    ],
    "gold_analytics": [
        ("agg_sales_by_customer", ["customer_id not_null", "customer_id unique", "customer_tier not_null", f"customer_tier accepted_values NOT IN {CUST_LABELS}", "total_orders not_null", "total_orders between < 0",
                                   "total_spent not_null", "total_spent between < 0"]),
        ("agg_sales_by_product", ["product_id not_null", "product_id unique", "performance_category not_null", f"performance_category accepted_values NOT IN {PROD_LABELS}", "total_revenue not_null", "total_revenue between < 0"]),
        ("agg_daily_revenue", ["order_date not_null", "order_date unique", "total_revenue not_null", "total_revenue between < 0", "total_orders not_null", "total_orders between < 1", "unique_customers not_null",
                               "unique_customers between < 1", "total_units_sold not_null", "total_units_sold between < 1", "total_discounts not_null", "total_discounts between < 0", "avg_unit_price not_null",
                               "avg_unit_price between <= 0"]),
    ],
}


def _declared_table(name: str) -> str:
    prefix, _, entity = name.partition("_")
    if name.endswith("_rejects"):
        return _rejects(prefix, entity.removesuffix("_rejects"))
    zones = {"trn": transient, "brz": bronze, "slv": silver}
    return zones[prefix](entity) if prefix in zones else globals()[name]()


def declared_tests(zone: str) -> str:
    def row(table: str, check: str) -> str:
        col, kind, *rest = check.split(" ", 2)
        if kind == "unique":
            failures = f"(SELECT count(*) FROM (SELECT {col} FROM {table} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1) AS d)"
        elif kind == "relationships":
            failures = f"(SELECT count(*) FROM {table} AS c WHERE c.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {rest[0]} AS p WHERE p.{col} = c.{col}))"
        else:
            bad = {"not_null": f"{col} IS NULL", "not_null_where": f"_is_valid AND {col} IS NULL", "match_regex": f"NOT regexp_matches({col}, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')"}.get(kind) or f"{col} {rest[0]}"
            failures = f"(SELECT count(*) FROM {table} WHERE {bad})"
        return _summary(table, col, kind, "error", f"(SELECT count(*) FROM {table})", failures, "(SELECT 1) AS one")

    ctes = ", ".join(f"{t} AS MATERIALIZED ({_declared_table(t)})" for t, _ in DECLARED[zone])
    return f"WITH {ctes} " + " UNION ALL ".join(row(t, c) for t, checks in DECLARED[zone] for c in checks)


def sampled_clone() -> str:
    bucket = "CAST('0x' || substr(md5('7:' || coalesce(CAST(order_id AS VARCHAR), '')), 1, 8) AS BIGINT) % 10000"
    return f"SELECT * FROM ({RAW_ORDER_ITEMS}) AS i WHERE {bucket} < 1000"


# --------------------------------------------------------------------------- clones
def mask_pii() -> str:
    b = bronze("customers", "run", LOAD2_TS)
    return (
        "SELECT customer_id, CASE WHEN _sensitivity_tag = 'pii' THEN regexp_replace(email, '^[^@]*', '***') ELSE email END AS email, "
        "CASE WHEN _sensitivity_tag = 'pii' THEN '***' || right(phone, 4) ELSE phone END AS phone, "
        "CASE WHEN _sensitivity_tag = 'pii' THEN sha256(address) ELSE address END AS address, "
        "CASE WHEN _sensitivity_tag = 'pii' THEN CAST(NULL AS VARCHAR) ELSE last_name END AS last_name, "
        f"_sensitivity_tag FROM ({b}) AS b"
    )


def slim_clone() -> str:
    masked = "sha256(shipping_address) AS shipping_address, sha256(billing_address) AS billing_address"
    return rounded(f"SELECT * REPLACE ({masked}) FROM ({silver('orders')}) AS s", [], doubles=["total_amount"])


def full_clone_masked() -> str:
    masked = (
        "customer_id, sha256(first_name) AS first_name, sha256(last_name) AS last_name, regexp_replace(email, '^[^@]*', '***') AS email, "
        "'***' || right(phone, 4) AS phone, sha256(address) AS address, sha256(city) AS city"
    )
    return f"SELECT 'silver' AS zone, {masked} FROM ({silver('customers')}) AS s UNION ALL SELECT 'gold' AS zone, {masked} FROM ({dim_customers()}) AS d"


def technical_rejects(entity: str) -> str:
    return f"""SELECT * EXCLUDE (_r), _r AS _reject_reason, {ts()} AS _rejected_at, '{BATCH_ID}' AS _batch_id,
           {skey(*REJECT_KEY['trn'][entity])} AS _reject_id
        FROM (SELECT *, {technical_reason(entity)} AS _r FROM ({RAW[entity]}) AS raw) AS t WHERE _r IS NOT NULL"""


# Business columns that silver rejects keep.
REJECT_COLS = {
    "customers": "customer_id, first_name, last_name, email",
    "orders": "order_id, customer_id, order_date, status, total_amount",
    "order_items": "order_item_id, order_id, product_id, quantity, unit_price, total_price",
}


def business_rejects(entity: str) -> str:
    return f"""SELECT {REJECT_COLS[entity]}, _reject_reason, _silver_processed_at, {ts()} AS _rejected_at,
           {skey(*REJECT_KEY['slv'][entity])} AS _reject_id
        FROM ({silver_validated(entity)}) AS v WHERE _reject_reason IS NOT NULL"""


def with_metadata_columns() -> str:
    return _dbl(
        f"SELECT *, 'fivetran' AS _source_system, 'product' AS _domain, 'public' AS _sensitivity_tag, "
        f"{ts(LOAD2_TS)} AS _processed_at, 'run-0002' AS _batch_id FROM ({RAW_PRODUCTS}) AS p",
        ["price", "cost"],
    )


def only_changed_customers() -> str:
    cols = ["name", "nation_key", "segment", "updated_at"]
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in cols)
    return (
        f"WITH v1 AS ({V1}), v2 AS ({V2}) SELECT n.* FROM v2 AS n LEFT JOIN v1 AS o ON n.customer_id = o.customer_id "
        f"WHERE o.customer_id IS NULL OR {differs}"
    )


def orders_fk_rule() -> str:
    orphan = (f"customer_id IS NOT NULL AND customer_id NOT IN "
              f"(SELECT customer_id FROM ({silver('customers')}) AS c WHERE customer_id IS NOT NULL)")
    return (
        f"SELECT order_id, customer_id, CASE WHEN {orphan} THEN 'orphan customer' END AS _reject_reason, "
        f"NOT coalesce({orphan}, false) AS _is_fk_valid FROM ({silver('orders')}) AS o"
    )


# --------------------------------------------------------------------------- stored, versioned tables
RUN1, RUN2, RUN3, MOVED_AT = "2024-02-01 06:00:00", "2024-02-02 06:00:00", "2024-02-03 06:00:00", "2024-02-01 12:00:00"
_SNAP_COLS = "customer_id, first_name, last_name, email, phone, address, city, state_code, postal_code, country_code, created_at, updated_at"


def snap_customers() -> str:
    later = f"SELECT * REPLACE (CASE WHEN customer_id % 7 = 0 THEN 'Moved' ELSE city END AS city, CASE WHEN customer_id % 7 = 0 THEN {ts(MOVED_AT)} ELSE updated_at END AS updated_at) FROM a"
    body = (
        f"SELECT *, updated_at AS valid_from, {ts(RUN2)} AS valid_to FROM a WHERE customer_id % 10 = 3 "
        f"UNION ALL SELECT *, {ts(RUN3)}, NULL FROM b WHERE customer_id % 10 = 3 "
        f"UNION ALL SELECT *, updated_at, {ts(MOVED_AT)} FROM a WHERE customer_id % 7 = 0 AND customer_id % 10 <> 3 "
        "UNION ALL SELECT *, updated_at, NULL FROM b WHERE customer_id % 10 <> 3"
    )
    return f"WITH a AS (SELECT {_SNAP_COLS} FROM ({silver('customers')}) AS s), b AS ({later}) SELECT *, {skey('customer_id', 'valid_from')} AS scd_id FROM ({body}) AS h"


def snap_customers_check() -> str:
    body = (
        f"SELECT customer_id, first_name, city, NULL::VARCHAR AS hint, {ts(RUN1)} AS valid_from, CASE WHEN customer_id % 4 = 0 THEN {ts(RUN2)} END AS valid_to FROM a "
        f"UNION ALL SELECT customer_id, first_name, city, 'h', {ts(RUN2)}, NULL FROM a WHERE customer_id % 4 = 0"
    )
    one = f"SELECT customer_id, first_name, city FROM ({silver('customers')}) AS s"
    return f"WITH s AS ({one}), a AS (SELECT * FROM s UNION ALL SELECT NULL, 'Nobody', max(city) FROM s) SELECT *, {skey('customer_id', 'valid_from')} AS scd_id FROM ({body}) AS h"


def merge_buckets() -> str:
    return f"SELECT * FROM ({merge_upsert()}) AS m WHERE NOT (order_date < DATE '1993-01-01' AND order_id % 11 = 0)"


def merge_moved_keys() -> str:
    return f"SELECT * REPLACE (CASE WHEN order_id % 13 = 0 THEN (order_date + INTERVAL 45 DAY)::DATE ELSE order_date END AS order_date, CASE WHEN order_id % 13 = 0 THEN 2 ELSE 1 END AS version) FROM ({_orders_v(1)}) AS t"


def stored_lookback() -> str:
    cols = "event_id, ts, user_id, event_type, value"
    return (
        f"WITH tgt AS (SELECT {cols}, 1 AS version FROM events WHERE ts < TIMESTAMP '2024-01-20'), "
        f"src AS (SELECT * REPLACE (CASE WHEN event_id % 50 <> 0 THEN ts END AS ts), 2 AS version FROM (SELECT {cols} FROM events) AS e), "
        "late AS (SELECT * FROM src WHERE ts IS NULL OR ts > (SELECT max(ts) - INTERVAL 3 DAY FROM tgt)) "
        "SELECT * FROM tgt WHERE event_id NOT IN (SELECT event_id FROM late) UNION ALL SELECT * FROM late"
    )


def stored_schema_change() -> str:
    old, new = "FROM o WHERE order_date < DATE '1998-01-01'", "FROM o WHERE order_date >= DATE '1998-01-01'"
    num = "CASE WHEN order_id % 3 <> 0 THEN CAST(customer_id AS VARCHAR) END"
    txt = "CASE WHEN order_id % 3 = 0 THEN 'C' ELSE '' END || CAST(customer_id AS VARCHAR)"
    row = lambda mode, c, s, p, frm: f"SELECT '{mode}' AS mode, order_id, {c} AS customer_id, {s} AS status, {p} AS payment_method {frm}"
    cid, no, null = "CAST(customer_id AS VARCHAR)", "'no column'", "CAST(NULL AS VARCHAR)"
    parts = [
        row("ignore", cid, "status", no, old), row("ignore", num, null, no, new),
        row("append_new_columns", cid, "status", null, old), row("append_new_columns", num, null, "payment_method", new),
        row("sync_all_columns", cid, no, null, old), row("sync_all_columns", txt, no, "payment_method", new),
    ]
    return f"WITH o AS ({RAW_ORDERS}) " + " UNION ALL ".join(parts)


def incremental_gold() -> str:
    """The tables as one run over the present rows makes them."""
    parts = [
        f"SELECT '{name}' AS table_name, CAST({key} AS VARCHAR) AS key, {n} AS n, round({amount}, 4) AS amount FROM ({sql}) AS {name}"
        for name, key, n, amount, sql in (
            ("fct_orders", "order_item_id", "quantity", "order_total", fct_orders()),
            ("agg_daily_revenue", "order_date", "total_orders", "total_revenue", agg_daily_revenue()),
            ("agg_sales_by_customer", "customer_id", "total_orders", "total_spent", agg_sales_by_customer()),
            ("dim_products", "product_id", "total_orders", "total_revenue", dim_products()),
        )
    ]
    return " UNION ALL ".join(parts)


def stream_ingest_orders() -> str:
    cols = "order_id, customer_id, order_date, status, CAST(total_amount AS DOUBLE) AS total_amount"
    return (
        f"WITH raw AS (SELECT *, {technical_reason('orders')} AS _r FROM ({RAW_ORDERS}) AS o) "
        f"SELECT CASE WHEN _r IS NULL THEN 'bronze' ELSE 'rejects' END AS zone, {cols}, _r AS _reject_reason FROM raw"
    )


def stream_dedupe_late() -> str:
    return (
        "WITH e AS (SELECT * FROM events WHERE ts IS NOT NULL), m AS (SELECT max(ts) - INTERVAL 3 DAY AS mark FROM e) "
        "SELECT 'kept' AS kind, event_id, 1::BIGINT AS n FROM e "
        "UNION ALL SELECT 'late', event_id, 1 FROM e, m WHERE event_id % 4 = 0 AND ts < mark "
        "UNION ALL SELECT 'untimed', event_id, 1 FROM e WHERE event_id % 100 = 1"
    )


def sampled_clone_linked() -> str:
    bucket = "CAST('0x' || substr(md5('42:' || coalesce(CAST(customer_id AS VARCHAR), '')), 1, 8) AS BIGINT) % 10000"
    return (
        f"WITH c AS (SELECT customer_id, sha256(city) AS masked FROM ({silver('customers')}) AS s WHERE {bucket} < 1000), "
        f"o AS (SELECT order_id, sha256(shipping_address) AS masked FROM ({silver('orders')}) AS s WHERE customer_id IN (SELECT customer_id FROM c)), "
        f"i AS (SELECT order_item_id, product_id FROM ({silver('order_items')}) AS s WHERE order_id IN (SELECT order_id FROM o)), "
        f"p AS (SELECT product_id FROM ({silver('products')}) AS s WHERE product_id IN (SELECT product_id FROM i)) "
        "SELECT 'slv_customers' AS table_name, customer_id AS key, masked FROM c UNION ALL SELECT 'slv_orders', order_id, masked FROM o "
        "UNION ALL SELECT 'slv_order_items', order_item_id, NULL FROM i UNION ALL SELECT 'slv_products', product_id, NULL FROM p"
    )


def digest_diff() -> str:
    return f"SELECT * FROM ({snapshot_diff()}) AS d WHERE _change <> 'same'"
