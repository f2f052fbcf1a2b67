"""Operator queries over the driver tables (load patterns, history, checks, run log, clones).

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame; the
registry in ``__spark_entry__`` pairs them with oracle SQL. Fixed times below
are the batch clocks of the scenarios.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import checks as chk
from strata.operators import load as L
from strata.operators import runlog as R
from strata.operators import scd2 as H
from strata.operators.clone import clone_zones, mask_columns, sample_by_key
from strata.operators.rules import ORDER_STATUSES
from strata.plans import gold as G
from strata.plans import zones as Z
from strata.plans.declared import zone_checks
from strata.plans.pipeline import TPCH_TIERS, Batch, build, gold_checks
from strata.sources.tables import ensure_checkpoint_dir, materialize, write_table
from strata.sources.tpch import RawEntities, customer_versions, raw_entity, raw_query_history, read_table

ENTITIES = ("customers", "orders", "order_items", "products")
# Scenario clocks.
LOAD1_TS = "2024-01-01 00:00:00"
LOAD2_TS = "2024-02-01 06:00:00"
SNAP1_TS = "2024-01-02 00:00:00"
SNAP2_TS = "2024-02-02 00:00:00"
AS_OF_TS = "2024-01-15 00:00:00"
LOG_NOW = "2024-01-31 00:00:00"
FRESHNESS_NOW = "2024-01-31 06:00:00"
SPLIT_DATE = "1998-01-01"


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder for one query's stored tables, in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata_stored/{name}-{uuid.uuid4().hex}"


def _all(spark: SparkSession, sf: str, batch: Batch) -> dict[str, DataFrame]:
    return build(RawEntities(spark, sf), batch, TPCH_TIERS)


# --------------------------------------------------------------------------- loads
def _trn_orders(spark, sf, ts, where=None):
    raw = raw_entity(spark, sf, "orders")
    if where is not None:
        raw = raw.where(where)
    return Z.transient(raw, "orders", f"load-{ts[:10]}", ts)


def incremental_append(spark, sf):
    """Bronze after two loads: first orders before 1998, then the full reload (newer ``_loaded_at``)."""
    first = Z.bronze(_trn_orders(spark, sf, LOAD1_TS, F.col("order_date") < SPLIT_DATE), "orders", LOAD1_TS)
    second = Z.bronze(_trn_orders(spark, sf, LOAD2_TS), "orders", LOAD2_TS)
    return L.append_incremental(second, first, "_loaded_at")


def incremental_append_empty_target(spark, sf):
    """Existing but empty target: the high-water mark falls back to its default, all rows load."""
    first = Z.bronze(_trn_orders(spark, sf, LOAD1_TS), "orders", LOAD1_TS).where(F.lit(False))
    second = Z.bronze(_trn_orders(spark, sf, LOAD2_TS), "orders", LOAD2_TS)
    return L.append_incremental(second, first, "_loaded_at")


def stored_append(spark, sf):
    """The two loads of ``incremental_append`` on a stored table with a side mark; the second is run twice."""
    path = _scratch(spark, "append")
    first = Z.bronze(_trn_orders(spark, sf, LOAD1_TS, F.col("order_date") < SPLIT_DATE), "orders", LOAD1_TS)
    second = Z.bronze(_trn_orders(spark, sf, LOAD2_TS), "orders", LOAD2_TS)
    for batch in (first, second, second):
        L.append_table(batch, f"{path}/orders", "_loaded_at", hwm_path=f"{path}/orders.__hwm")
    return spark.read.parquet(f"{path}/orders")


def stored_full_refresh(spark, sf):
    """A stored table of the first load, rebuilt from the second."""
    path = _scratch(spark, "refresh")
    first = Z.bronze(_trn_orders(spark, sf, LOAD1_TS, F.col("order_date") < SPLIT_DATE), "orders", LOAD1_TS)
    second = Z.bronze(_trn_orders(spark, sf, LOAD2_TS), "orders", LOAD2_TS)
    L.append_table(first, f"{path}/orders", "_loaded_at", hwm_path=f"{path}/orders.__hwm")
    L.append_table(second, f"{path}/orders", "_loaded_at", hwm_path=f"{path}/orders.__hwm", full_refresh=True)
    return spark.read.parquet(f"{path}/orders")


def stored_merge(spark, sf):
    """The merge of ``merge_upsert`` on a stored table that is partitioned by version: updated keys move to another partition."""
    path = f"{_scratch(spark, 'merge')}/orders"
    L.merge_table(_orders_versioned(spark, sf, 1, F.col("order_date") < SPLIT_DATE), path, ["order_id"], partition_by=["version"])
    L.merge_table(_orders_versioned(spark, sf, 2, F.col("order_date") >= "1997-01-01"), path, ["order_id"], partition_by=["version"])
    return spark.read.parquet(path)


def stored_snapshot(spark, sf):
    """Two snapshot runs against a stored history, the second one twice (the repeat changes nothing)."""
    path = f"{_scratch(spark, 'snapshot')}/customers"
    v1, v2 = customer_versions(spark, sf)
    for src, ts in ((v1, SNAP1_TS), (v2, SNAP2_TS), (v2, SNAP2_TS)):
        H.snapshot_table(src, path, "customer_id", ts, updated_at="updated_at")
    return spark.read.parquet(path)


def _orders_versioned(spark, sf, version: int, where=None):
    o = raw_entity(spark, sf, "orders")
    if where is not None:
        o = o.where(where)
    return o.select("order_id", "customer_id", "order_date", "status", "total_amount", F.lit(version).alias("version"))


def merge_upsert(spark, sf):
    """Target: orders before 1998 (v1). Source: orders from 1997 on (v2). Overlap 1997 is updated."""
    tgt = _orders_versioned(spark, sf, 1, F.col("order_date") < SPLIT_DATE)
    src = _orders_versioned(spark, sf, 2, F.col("order_date") >= "1997-01-01")
    return L.merge_upsert(tgt, src, ["order_id"])


def delete_insert_window(spark, sf):
    """Replace 1996 of the order table with a re-processed 1996 (v2)."""
    tgt = _orders_versioned(spark, sf, 1)
    src = _orders_versioned(spark, sf, 2, F.col("order_date").between("1995-07-01", "1997-06-30"))
    return L.delete_insert(tgt, src, "order_date", dt.date(1996, 1, 1), dt.date(1997, 1, 1))


def _events_v(spark, sf, version: int, where=None):
    ev = read_table(spark, sf, "events")
    if where is not None:
        ev = ev.where(where)
    return ev.select("event_id", "ts", "user_id", "event_type", "value", F.lit(version).alias("version"))


def late_lookback(spark, sf):
    """Target: events before Jan 20 (v1). Source: all events (v2). Re-take the last 3 days and merge."""
    tgt = _events_v(spark, sf, 1, F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return L.lookback_merge(tgt, _events_v(spark, sf, 2), "ts", ["event_id"], "3 days")


def microbatch_days(spark, sf):
    """Events by day and type, written a week at a time by ``run_microbatch``; one week is then run again and replaces itself."""
    path = _scratch(spark, "microbatch")
    events = read_table(spark, sf, "events").where("ts is not null")
    first, last = events.agg(F.min(F.to_date("ts").cast("string")), F.max(F.to_date("ts").cast("string"))).first()
    empty = first is None
    begin = dt.datetime.fromisoformat(first or SPLIT_DATE)
    end = dt.datetime.fromisoformat(last or SPLIT_DATE) + dt.timedelta(days=1)

    def per_day(part: DataFrame) -> DataFrame:
        return L.assign_batch(part, "ts", "day").groupBy("_batch_start", "event_type").agg(
            F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 4).alias("value_sum"))

    def sink(part: DataFrame, start: dt.datetime, _: dt.datetime) -> None:
        part = part.withColumn("slice", F.lit(f"S{start:%Y%m%d}"))
        part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slice").parquet(path)

    if empty:
        return per_day(events)
    L.run_microbatch(events, "ts", begin, end, dt.timedelta(days=7), per_day, sink)
    L.run_microbatch(events, "ts", begin, end, dt.timedelta(days=7), per_day, sink, only=[begin])
    return spark.read.parquet(path).drop("slice")


def schema_change_append_cols(spark, sf):
    """Old slice without payment_method, new slice with it and a new column: append_new_columns."""
    old = raw_entity(spark, sf, "orders").where(F.col("order_date") < SPLIT_DATE).select("order_id", "customer_id", "order_date", "status")
    new = (
        raw_entity(spark, sf, "orders")
        .where(F.col("order_date") >= SPLIT_DATE)
        .select("order_id", "customer_id", "order_date", "status", "payment_method")
        .withColumn("priority_rank", F.substring("payment_method", 1, 1).cast("int"))
    )
    return L.append_with_schema_change(old, new, "append_new_columns")


def schema_change_sync(spark, sf):
    """sync_all_columns: the result has exactly the new slice's columns (status dropped)."""
    old = raw_entity(spark, sf, "orders").where(F.col("order_date") < SPLIT_DATE).select("order_id", "customer_id", "order_date", "status")
    new = raw_entity(spark, sf, "orders").where(F.col("order_date") >= SPLIT_DATE).select("order_id", "customer_id", "order_date", "payment_method")
    return L.append_with_schema_change(old, new, "sync_all_columns")


# --------------------------------------------------------------------------- history
def snapshot_diff(spark, sf):
    v1, v2 = customer_versions(spark, sf)
    return L.diff(v1, v2, ["customer_id"])


def only_changed_customers(spark, sf):
    """D2 option: of the second extract, only rows that are new or differ from the first."""
    v1, v2 = customer_versions(spark, sf)
    return L.only_changed(v2, v1, ["customer_id"])


def orders_fk_rule(spark, sf):
    """Optional FK business rule: silver orders whose customer is not a silver customer."""
    from strata.operators.rules import Rule, foreign_key_rule, tag_rules

    t = _all(spark, sf, Batch())
    tagged = foreign_key_rule(t["slv_orders"], t["slv_customers"], "customer_id")
    out = tag_rules(tagged, [Rule("orphan customer", F.col("_fk_missing"))], "_is_fk_valid", "_reject_reason")
    return out.select("order_id", "customer_id", "_reject_reason", "_is_fk_valid")


def _history(spark, sf) -> DataFrame:
    v1, v2 = customer_versions(spark, sf)
    h1 = H.snapshot_timestamp(None, v1, "customer_id", "updated_at", SNAP1_TS)
    return H.snapshot_timestamp(h1, v2, "customer_id", "updated_at", SNAP2_TS)


def scd2_timestamp(spark, sf):
    return _history(spark, sf)


def scd2_hard_delete(spark, sf):
    """Versions closed at the second run's clock: keys that vanished from the source."""
    return _history(spark, sf).where(F.col("valid_to") == F.lit(SNAP2_TS).cast("timestamp_ntz"))


def scd2_as_of(spark, sf):
    return H.as_of(_history(spark, sf), "2024-02-01 12:00:00")


def scd2_check(spark, sf):
    v1, v2 = customer_versions(spark, sf)
    v1, v2 = v1.drop("updated_at"), v2.drop("updated_at")
    h1 = H.snapshot_check(None, v1, "customer_id", ["segment", "name"], SNAP1_TS)
    return H.snapshot_check(h1, v2, "customer_id", ["segment", "name"], SNAP2_TS)


# --------------------------------------------------------------------------- checks
C = chk.Check


def check_not_null(spark, sf):
    return chk.run_checks(raw_entity(spark, sf, "customers"), "customers", [C("not_null", "email")])


def check_not_null_where(spark, sf):
    trn = Z.transient(raw_entity(spark, sf, "customers"), "customers", "run", LOAD2_TS)
    return chk.run_checks(trn, "trn_customers", [C("not_null", "email", where="_is_valid = true")])


def check_unique(spark, sf):
    return chk.run_checks(raw_entity(spark, sf, "order_items"), "order_items", [C("unique", "order_item_id")])


def check_accepted_values(spark, sf):
    o = raw_entity(spark, sf, "orders").withColumn("status", F.upper(F.trim("status")))
    return chk.run_checks(o, "orders", [C("accepted_values", "status", values=tuple(ORDER_STATUSES))])


def check_relationships(spark, sf):
    t = _all(spark, sf, Batch())
    return chk.run_checks(t["fct_orders"], "fct_orders", [C("relationships", "product_id", to=t["slv_products"], field_="product_id")])


def check_between(spark, sf):
    return chk.run_checks(raw_entity(spark, sf, "products"), "products", [C("between", "cost", min=0), C("between", "price", min=0, max=2000, strictly=True)])


def check_regex(spark, sf):
    c = raw_entity(spark, sf, "customers").withColumn("email", F.lower(F.trim("email")))
    return chk.run_checks(c, "customers", [C("match_regex", "email", regex=r"^[a-z0-9._]+@[a-z0-9]+\.[a-z]+$", severity="warn")])


def check_grain(spark, sf):
    return chk.grain_violations(raw_entity(spark, sf, "order_items"), ["order_item_id"])


def check_row_count_between(spark, sf):
    t = _all(spark, sf, Batch())
    return chk.run_checks(t["fct_orders"], "fct_orders", [C("row_count_between", None, min=1)])


def row_count_diff(spark, sf):
    t = _all(spark, sf, Batch())
    return chk.row_count_diff(raw_entity(spark, sf, "orders"), t["slv_orders"])


def source_freshness(spark, sf):
    return chk.source_freshness(read_table(spark, sf, "events"), "ts", FRESHNESS_NOW, table="events")


def contract_fct_orders(spark, sf):
    return chk.enforce_contract(_all(spark, sf, Batch())["fct_orders"], G.FCT_ORDERS_CONTRACT)


def quality_summary(spark, sf):
    """The gold test suite over materialised gold tables, as the job runs it.

    The checks read each table several times with different column sets, so the
    tables are first written once (parquet under the session's checkpoint dir)
    instead of being recomputed from raw per check.
    """
    from concurrent.futures import ThreadPoolExecutor

    t = _all(spark, sf, Batch())
    names = ("fct_orders", "dim_customers", "dim_products")
    built = [t[n] for n in names]  # construct on this thread, write concurrently
    with ThreadPoolExecutor(max_workers=3) as pool:
        fct, dc, dp = pool.map(lambda nd: materialize(nd[1], nd[0]), zip(names, built))
    return gold_checks(fct, dc, dp, TPCH_TIERS)


def declared_tests(zone: str):
    """A query over the zone's tables with every declared test of the zone; each table is written once, as several passes read it."""
    def tables(spark, sf) -> dict[str, DataFrame]:
        b = Batch()
        if zone in ("gold", "gold_analytics"):
            names = {"gold": ("dim_customers", "dim_products", "fct_orders"), "gold_analytics": ("agg_sales_by_customer", "agg_sales_by_product", "agg_daily_revenue")}[zone]
            t = _all(spark, sf, b)
            return {n: t[n] for n in names}
        out = {}
        for e in ENTITIES:
            raw = raw_entity(spark, sf, e)
            trn = Z.transient(raw, e, b.batch_id, b.batch_ts)
            brz = Z.bronze(trn, e, b.batch_ts)
            if zone == "transient":
                out |= {f"trn_{e}": trn, f"trn_{e}_rejects": Z.transient_rejects(raw, e, b.batch_id, b.batch_ts)}
            elif zone == "bronze":
                out[f"brz_{e}"] = brz
            else:
                val = materialize(Z.silver_validated(brz, e, b.batch_ts), f"validated_{e}")
                out |= {f"slv_{e}": Z.silver_clean(val, e), f"slv_{e}_rejects": Z.silver_rejects(val, e, b.batch_ts)}
        return out

    def query(spark, sf):
        built = {n: materialize(df, n) for n, df in tables(spark, sf).items()}
        return zone_checks(zone, built, TPCH_TIERS.customer, TPCH_TIERS.product)

    return query


# --------------------------------------------------------------------------- run log
def _log(spark, sf):
    return R.parse_log(raw_query_history(spark, sf))


def runlog_parse(spark, sf):
    return _log(spark, sf)


def runlog_sequence(spark, sf):
    return R.run_in_order(_log(spark, sf), "scheduled__2024-01-15")


def runlog_sequence_bucketed(spark, sf):
    """Same numbering as runlog_parse, computed with hourly buckets (skew-safe form)."""
    return R.parse_log(raw_query_history(spark, sf), sequence_bucket=F.date_trunc("hour", "start_time"))


def runlog_slowest(spark, sf):
    return R.slowest_models(_log(spark, sf), LOG_NOW, env="prod", days=30)


def runlog_failures(spark, sf):
    return R.failures(_log(spark, sf), LOG_NOW, days=7)


def runlog_row_trend(spark, sf):
    return R.row_trend(_log(spark, sf), "dim_customers", env="prod", limit=30)


def runlog_summary(spark, sf):
    return R.invocation_summary(_log(spark, sf))


def runlog_trend_monitor(spark, sf):
    return R.trend_monitor(_log(spark, sf))


def runlog_run_failures(spark, sf):
    return R.run_failures(_log(spark, sf), "scheduled__2024-01-15")


def runlog_recent(spark, sf):
    return R.recent(_log(spark, sf), LOG_NOW, days=7)


def runlog_invocation_detail(spark, sf):
    """One invocation, a row for each model write."""
    return R.invocation_detail(_log(spark, sf), "inv-33-2024-01-28")


def with_metadata_columns(spark, sf):
    """The generic metadata macro: five tag columns on raw products."""
    from strata.operators.metadata import with_metadata

    return with_metadata(raw_entity(spark, sf, "products"), "fivetran", "product", "public", LOAD2_TS, "run-0002")


def streaming_dedupe_events(spark, sf):
    """Events with re-deliveries in later files, as a file stream of several epochs; one row for each event stays.

    Purchases land a second time (a file of their own) and every event lands a third time, so
    re-deliveries meet rows of their own epoch and of earlier ones, and are far later than the newest event seen.
    """
    from strata.streaming import dedupe_stream_to_table

    events = read_table(spark, sf, "events")
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata_streams/events-{uuid.uuid4().hex}"
    for landed in (events, events.where(F.col("event_type") == "purchase"), events):
        landed.write.mode("append").parquet(f"{root}/landing")
    return dedupe_stream_to_table(spark, f"{root}/landing", events.schema, ["event_id"], f"{root}/sink", f"{root}/_checkpoint", max_files_per_trigger=2)


# --------------------------------------------------------------------------- clones
def mask_pii(spark, sf):
    brz = Z.bronze(Z.transient(raw_entity(spark, sf, "customers"), "customers", "run", LOAD2_TS), "customers", LOAD2_TS)
    masked = mask_columns(brz, {"email": "redact_email", "phone": "keep_last4", "address": "hash", "last_name": "null"})
    return masked.select("customer_id", "email", "phone", "address", "last_name", "_sensitivity_tag")


def slim_clone(spark, sf):
    """Of a lake's silver tables one is listed: the written clone of it, addresses masked."""
    lake, t = _scratch(spark, "slim_clone"), _all(spark, sf, Batch())
    for name in ("slv_orders", "slv_products"):
        write_table(t[name], f"{lake}/silver/{name}")
    clone_zones(spark, lake, "silver", f"{lake}/ci", "PR_1", table_list="SILVER.SLV_ORDERS")
    return spark.read.parquet(f"{lake}/ci/PR_1/SILVER_SLV_ORDERS")


def full_clone_masked(spark, sf):
    """A full clone of two zones, which masks personal data by default: the clones of both customer tables, told apart by ``zone``."""
    lake, t = _scratch(spark, "full_clone"), _all(spark, sf, Batch())
    columns = ["customer_id", "first_name", "last_name", "email", "phone", "address", "city"]
    write_table(t["slv_customers"], f"{lake}/silver/slv_customers")
    write_table(t["dim_customers"], f"{lake}/gold/dim_customers")
    clone_zones(spark, lake, "silver,gold", f"{lake}/ci", "PR_2")
    cloned = {z: spark.read.parquet(f"{lake}/ci/PR_2/{n}").select(F.lit(z).alias("zone"), *columns) for z, n in (("silver", "SILVER_SLV_CUSTOMERS"), ("gold", "GOLD_DIM_CUSTOMERS"))}
    return cloned["silver"].unionByName(cloned["gold"])


def sampled_clone(spark, sf):
    """A tenth of the orders' items, whole orders: the sample is by key, so any engine draws the same."""
    return sample_by_key(raw_entity(spark, sf, "order_items"), "order_id", 10, seed=7)
