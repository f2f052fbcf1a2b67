"""

Every query reads the driver's tables (through the stand-in raw entities of
``strata.sources.tpch``) and runs over whole tables. Money is exact decimal
up to the output, where it becomes double; only aggregates of doubles are
rounded (4 places, both sides), because engines sum in different orders.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# importable by file path from any working directory
_ROOT = os.path.dirname(os.path.abspath(__file__))
if _ROOT not in sys.path:
    sys.path.insert(0, _ROOT)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracle_queries as O  # noqa: E402
from strata.functions.keys import surrogate_key  # noqa: E402
from strata.operators.rules import business_rules, tag_rules  # noqa: E402
from strata.plans import catalog as K  # noqa: E402
from strata.plans import stored as S  # noqa: E402
from strata.plans import zones as Z  # noqa: E402
from strata.plans.pipeline import TPCH_TIERS, Batch, build  # noqa: E402
from strata.sources.tpch import RawEntities, raw_entity  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
BATCH = Batch(O.BATCH_ID, O.BATCH_TS)
ENTITIES = ("customers", "orders", "order_items", "products")


def _out(df: DataFrame, round_cols: tuple[str, ...] = (), places: int = 4) -> DataFrame:
    """Result projection for the oracle compare: exact decimals → double,
    listed aggregate doubles rounded (summation order differs by engine)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        if f.name in round_cols:
            c = F.round(c, places)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _raws(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return RawEntities(spark, sf)


def _gold(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return build(_raws(spark, sf), BATCH, TPCH_TIERS)[name]


# --------------------------------------------------------------------------- zone operators
def q_technical_split_orders(spark, sf):
    return _out(Z.transient(raw_entity(spark, sf, "orders"), "orders", BATCH.batch_id, BATCH.batch_ts))


def q_technical_rejects_reason(spark, sf):
    return Z.transient_rejects(raw_entity(spark, sf, "customers"), "customers", BATCH.batch_id, BATCH.batch_ts)


def _validated(spark, sf, entity):
    trn = Z.transient(raw_entity(spark, sf, entity), entity, BATCH.batch_id, BATCH.batch_ts)
    return Z.silver_validated(Z.bronze(trn, entity, BATCH.batch_ts), entity, BATCH.batch_ts)


def q_business_validate_customers(spark, sf):
    return _validated(spark, sf, "customers")


def q_business_rejects_products(spark, sf):
    return _out(Z.silver_rejects(_validated(spark, sf, "products"), "products", BATCH.batch_ts))


def q_surrogate_key(spark, sf):
    raw = raw_entity(spark, sf, "customers")
    return raw.select("customer_id", "email", surrogate_key("customer_id", "email", df=raw).alias("customer_sk"))


def q_with_metadata(spark, sf):
    trn = Z.transient(raw_entity(spark, sf, "customers"), "customers", BATCH.batch_id, BATCH.batch_ts)
    return Z.bronze(trn, "customers", BATCH.batch_ts)


def q_latest_per_key_lineitem(spark, sf):
    return _out(_gold(spark, sf, "slv_order_items"))


def q_standardize_parts(spark, sf):
    return _out(_gold(spark, sf, "slv_products"))


def q_null_passes_rule(spark, sf):
    raw = raw_entity(spark, sf, "orders").withColumn("status", F.upper(F.trim("status")))
    out = tag_rules(raw, business_rules("orders"), "_is_business_valid", "_reject_reason")
    return _out(out.select("order_id", "order_date", "status", "total_amount", "_reject_reason", "_is_business_valid"))


def _gold_query(name, round_cols=()):
    return lambda spark, sf: _out(_gold(spark, sf, name), tuple(round_cols))


_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "technical_split_orders": (q_technical_split_orders, O.rounded(O.transient("orders"), [], doubles=["total_amount"])),
    "technical_rejects_reason": (
        q_technical_rejects_reason,
        f"""SELECT * EXCLUDE (_r), _r AS _reject_reason, {O.ts()} AS _rejected_at, '{O.BATCH_ID}' AS _batch_id,
               {O.skey('customer_id', 'email')} AS _reject_id
            FROM (SELECT *, {O.technical_reason('customers')} AS _r FROM ({O.RAW_CUSTOMERS}) AS raw) AS t
            WHERE _r IS NOT NULL""",
    ),
    "business_validate_customers": (q_business_validate_customers, O.silver_validated_flagged("customers")),
    "business_rejects_products": (
        q_business_rejects_products,
        O.rounded(
            f"""SELECT product_id, product_name, category, brand, price, cost, _reject_reason, _silver_processed_at,
                   {O.ts()} AS _rejected_at, {O.skey('product_id', 'product_name')} AS _reject_id
                FROM ({O.silver_validated('products')}) AS v WHERE _reject_reason IS NOT NULL""",
            [],
            doubles=["price", "cost"],
        ),
    ),
    "surrogate_key": (
        q_surrogate_key,
        f"SELECT customer_id, email, {O.skey('customer_id', 'email')} AS customer_sk FROM ({O.RAW_CUSTOMERS}) AS raw",
    ),
    "with_metadata": (q_with_metadata, O.bronze("customers")),
    "latest_per_key_lineitem": (
        q_latest_per_key_lineitem,
        O.rounded(O.silver("order_items"), [], doubles=["total_price", "discount_amount"]),
    ),
    "standardize_parts": (q_standardize_parts, O.rounded(O.silver("products"), [], doubles=["price", "cost"])),
    "null_passes_rule": (
        q_null_passes_rule,
        O.rounded(
            f"""SELECT order_id, order_date, status, total_amount, _reject_reason, _reject_reason IS NULL AS _is_business_valid
                FROM (SELECT *, ({O.BUSINESS['orders']}) AS _reject_reason
                      FROM (SELECT * REPLACE (upper(trim(status)) AS status) FROM ({O.RAW_ORDERS}) AS r) AS s) AS t""",
            [],
            doubles=["total_amount"],
        ),
    ),
    # gold + gold analytics
    "fct_orders": (
        _gold_query("fct_orders"),
        O.fct_orders(),
    ),
    "dim_customers": (_gold_query("dim_customers"), O.dim_customers()),
    "dim_products": (
        _gold_query("dim_products", ["avg_selling_price"]),
        O.rounded(O.dim_products(), ["avg_selling_price"]),
    ),
    "agg_daily_revenue": (
        _gold_query("agg_daily_revenue", ["total_revenue", "total_discounts", "avg_unit_price"]),
        O.rounded(O.agg_daily_revenue(), ["total_revenue", "total_discounts", "avg_unit_price"]),
    ),
    "agg_sales_by_customer": (
        _gold_query("agg_sales_by_customer"),
        O.agg_sales_by_customer(),
    ),
    "agg_sales_by_product": (
        _gold_query("agg_sales_by_product", ["avg_selling_price"]),
        O.rounded(O.agg_sales_by_product(), ["avg_selling_price"]),
    ),
}


def _k(fn, round_cols=()):
    return lambda spark, sf: _out(fn(spark, sf), tuple(round_cols))


def _technical_rejects(entity):
    return _k(lambda spark, sf: Z.transient_rejects(raw_entity(spark, sf, entity), entity, BATCH.batch_id, BATCH.batch_ts))


def _business_rejects(entity):
    return _k(lambda spark, sf: Z.silver_rejects(_validated(spark, sf, entity), entity, BATCH.batch_ts))


_MONEY = {"orders": ["total_amount"], "order_items": ["unit_price", "total_price", "discount_amount"], "products": ["price", "cost"]}
_QUERIES.update({f"technical_rejects_{e}": (_technical_rejects(e), O.rounded(O.technical_rejects(e), [], doubles=_MONEY[e])) for e in ("orders", "order_items", "products")})
_QUERIES.update({
    "business_rejects_customers": (_business_rejects("customers"), O.business_rejects("customers")),
    "business_rejects_orders": (_business_rejects("orders"), O.rounded(O.business_rejects("orders"), [], doubles=["total_amount"])),
    "business_rejects_order_items": (_business_rejects("order_items"), O.rounded(O.business_rejects("order_items"), [], doubles=[c for c in _MONEY["order_items"] if c in O.REJECT_COLS["order_items"]])),
})

# load patterns, history, checks, run log, clones (strata.plans.catalog)
_QUERIES.update(
    {
        "incremental_append": (_k(K.incremental_append), O.incremental_append()),
        "incremental_append_empty_target": (_k(K.incremental_append_empty_target), O.incremental_append_empty_target()),
        "merge_upsert": (_k(K.merge_upsert), O.merge_upsert()),
        "stored_append": (_k(K.stored_append), O.incremental_append()),
        "stored_full_refresh": (_k(K.stored_full_refresh), O.incremental_append_empty_target()),
        "stored_merge": (_k(K.stored_merge), O.merge_upsert()),
        "stored_snapshot": (_k(K.stored_snapshot), O.scd2_timestamp()),
        "delete_insert_window": (_k(K.delete_insert_window), O.delete_insert_window()),
        "late_lookback": (_k(K.late_lookback), O.late_lookback()),
        "microbatch_days": (_k(K.microbatch_days), O.microbatch_days()),
        "schema_change_append_cols": (_k(K.schema_change_append_cols), O.schema_change_append_cols()),
        "schema_change_sync": (_k(K.schema_change_sync), O.schema_change_sync()),
        "snapshot_diff": (_k(K.snapshot_diff), O.snapshot_diff()),
        "only_changed_customers": (_k(K.only_changed_customers), O.only_changed_customers()),
        "orders_fk_rule": (_k(K.orders_fk_rule), O.orders_fk_rule()),
        "scd2_timestamp": (_k(K.scd2_timestamp), O.scd2_timestamp()),
        "scd2_hard_delete": (_k(K.scd2_hard_delete), O.scd2_hard_delete()),
        "scd2_as_of": (_k(K.scd2_as_of), O.scd2_as_of()),
        "scd2_check": (_k(K.scd2_check), O.scd2_check()),
        "check_not_null": (_k(K.check_not_null), O.check_not_null()),
        "check_not_null_where": (_k(K.check_not_null_where), O.check_not_null_where()),
        "check_unique": (_k(K.check_unique), O.check_unique()),
        "check_accepted_values": (_k(K.check_accepted_values), O.check_accepted_values()),
        "check_relationships": (_k(K.check_relationships), O.check_relationships()),
        "check_between": (_k(K.check_between), O.check_between()),
        "check_regex": (_k(K.check_regex), O.check_regex()),
        "check_grain": (_k(K.check_grain), O.check_grain()),
        "check_row_count_between": (_k(K.check_row_count_between), O.check_row_count_between()),
        "row_count_diff": (_k(K.row_count_diff), O.row_count_diff()),
        "source_freshness": (_k(K.source_freshness), O.source_freshness()),
        "contract_fct_orders": (_k(K.contract_fct_orders), O.fct_orders()),
        "quality_summary": (_k(K.quality_summary), O.quality_summary()),
        "runlog_parse": (_k(K.runlog_parse), O.query_log_parsed()),
        "runlog_sequence": (_k(K.runlog_sequence), O.runlog_sequence()),
        "runlog_sequence_bucketed": (_k(K.runlog_sequence_bucketed), O.query_log_parsed()),
        "runlog_slowest": (_k(K.runlog_slowest), O.runlog_slowest()),
        "runlog_failures": (_k(K.runlog_failures), O.runlog_failures()),
        "runlog_row_trend": (_k(K.runlog_row_trend), O.runlog_row_trend()),
        "runlog_summary": (_k(K.runlog_summary), O.runlog_summary()),
        "runlog_run_failures": (_k(K.runlog_run_failures), O.runlog_run_failures()),
        "runlog_recent": (_k(K.runlog_recent), O.runlog_recent()),
        "runlog_invocation_detail": (_k(K.runlog_invocation_detail), O.runlog_invocation_detail()),
        "runlog_trend_monitor": (_k(K.runlog_trend_monitor), O.runlog_trend_monitor()),
        "with_metadata_columns": (_k(K.with_metadata_columns), O.with_metadata_columns()),
        "streaming_dedupe_events": (_k(K.streaming_dedupe_events), "SELECT DISTINCT ON (event_id) * FROM events"),
        "mask_pii": (_k(K.mask_pii), O.mask_pii()),
        "slim_clone": (_k(K.slim_clone), O.slim_clone()),
        "full_clone_masked": (_k(K.full_clone_masked), O.full_clone_masked()),
        "sampled_clone": (_k(K.sampled_clone), O.rounded(O.sampled_clone(), [], doubles=["unit_price", "total_price", "discount_amount"])),
        **{f"declared_tests_{z}": (_k(K.declared_tests(z)), O.declared_tests(z)) for z in ("transient", "bronze", "silver", "gold", "gold_analytics")},
    }
)

# several runs against versioned tables (strata.plans.stored)
_QUERIES.update(
    {
        "snap_customers": (_k(S.snap_customers), O.snap_customers()),
        "snap_customers_check": (_k(S.snap_customers_check), O.snap_customers_check()),
        "merge_buckets": (_k(S.merge_buckets), O.merge_buckets()),
        "merge_moved_keys": (_k(S.merge_moved_keys), O.merge_moved_keys()),
        "stored_window": (_k(S.stored_window), O.delete_insert_window()),
        "stored_lookback": (_k(S.stored_lookback), O.stored_lookback()),
        "sampled_clone_linked": (_k(S.sampled_clone_linked), O.sampled_clone_linked()),
        "digest_diff": (_k(S.digest_diff), O.digest_diff()),
        "stream_ingest_orders": (_k(S.stream_ingest_orders), O.stream_ingest_orders()),
        "stream_dedupe_late": (_k(S.stream_dedupe_late), O.stream_dedupe_late()),
        "incremental_gold": (_k(S.incremental_gold), O.incremental_gold()),
        "stored_schema_change": (_k(S.stored_schema_change), O.stored_schema_change()),
    }
)


# the training-data operators and the corpus pipeline, where they are installed
_LLM: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_LLM_SQL: dict[str, str] = {}
try:  # the folders may be gone, or a library that only they need
    import corpus_pipeline
    from strata.llm.queries import ORACLE_SQL as _LLM_SQL
    from strata.llm.queries import QUERIES as _LLM
except ImportError:
    pass
else:
    _LLM = {**_LLM, "pipeline": corpus_pipeline.run}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: daily revenue through all five zones on /root/testdata/sf0.001."""
    return queries()["agg_daily_revenue"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**core_queries(), **_LLM}


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v[0] for k, v in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {**{k: v[1] for k, v in _QUERIES.items() if v[1] is not None}, **_LLM_SQL}
