"""Operator queries over stored, versioned tables: several runs against one table, then a read of it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import bucketed as B
from strata.operators import history as H
from strata.operators.clone import Reference, clone_name, clone_zones
from strata.plans import catalog as K
from strata.plans.lake import run_lake
from strata.plans.pipeline import ENTITY_NAMES, TPCH_TIERS, Batch
from strata.sources.tables import write_table
from strata.sources.tpch import customer_versions, raw_entity, read_table
from strata.sources.versioned import read_version, replace_table
from strata.streaming.epochs import dedupe_epochs, ingest_epochs

# Clocks of the runs.
RUN1, RUN2, RUN3 = "2024-02-01 06:00:00", "2024-02-02 06:00:00", "2024-02-03 06:00:00"
MOVED_AT = "2024-02-01 12:00:00"


def _silver_customers(spark: SparkSession, sf: str) -> DataFrame:
    silver = K._all(spark, sf, Batch("run-0001", RUN1))["slv_customers"]
    return silver.select(*[c for c in silver.columns if not c.startswith("_")])


def snap_customers(spark: SparkSession, sf: str) -> DataFrame:
    """History of silver customers over three runs: some move, some vanish and come back."""
    path = K._scratch(spark, "snap_customers")
    first = _silver_customers(spark, sf)
    moved = F.col("customer_id") % 7 == 0
    later = first.withColumns({"city": F.when(moved, "Moved").otherwise(F.col("city")), "updated_at": F.when(moved, F.lit(MOVED_AT).cast("timestamp_ntz")).otherwise(F.col("updated_at"))})
    H.snapshot_run(first, path, "customer_id", RUN1, updated_at="updated_at")
    H.snapshot_run(later.where("customer_id % 10 <> 3"), path, "customer_id", RUN2, updated_at="updated_at")
    for _ in range(2):  # the repeat changes nothing
        H.snapshot_run(later, path, "customer_id", RUN3, updated_at="updated_at")
    return H.read_history(spark, path)


def snap_customers_check(spark: SparkSession, sf: str) -> DataFrame:
    """Check strategy: the second source has one more column, both have a row without key."""
    path = K._scratch(spark, "snap_check")
    first = _silver_customers(spark, sf).select("customer_id", "first_name", "city")
    nobody = first.agg(F.lit(None).cast("bigint").alias("customer_id"), F.lit("Nobody").alias("first_name"), F.max("city").alias("city"))
    first = first.unionByName(nobody)
    second = first.withColumn("hint", F.when(F.col("customer_id") % 4 == 0, F.lit("h")))
    H.snapshot_run(first, path, "customer_id", RUN1)
    H.snapshot_run(second, path, "customer_id", RUN2)
    return H.read_history(spark, path)


def merge_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in hash buckets: one merge updates and inserts, one deletes."""
    path = f"{K._scratch(spark, 'buckets')}/orders"
    part = B.hash_part(["order_id"], 16)
    B.merge_parts(K._orders_versioned(spark, sf, 1, F.col("order_date") < K.SPLIT_DATE), path, ["order_id"], part)
    newer = K._orders_versioned(spark, sf, 2, F.col("order_date") >= "1997-01-01")
    for _ in range(2):
        B.merge_parts(newer, path, ["order_id"], part)
    gone = raw_entity(spark, sf, "orders").where((F.col("order_date") < "1993-01-01") & (F.col("order_id") % 11 == 0)).select("order_id")
    B.merge_parts(newer.limit(0), path, ["order_id"], part, deletes=gone)
    return read_version(spark, path)


def merge_moved_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by month: the merge moves some of them to another month."""
    path = f"{K._scratch(spark, 'moved')}/orders"
    part = B.time_part("order_date")
    orders = K._orders_versioned(spark, sf, 1)
    B.merge_parts(orders, path, ["order_id"], part, part_of_key=False)
    late = orders.where("order_id % 13 = 0").withColumns({"order_date": F.date_add("order_date", 45), "version": F.lit(2)})
    B.merge_parts(late, path, ["order_id"], part, part_of_key=False)
    return read_version(spark, path)


def stored_window(spark: SparkSession, sf: str) -> DataFrame:
    """``delete_insert_window`` on a stored table laid out by month."""
    path = f"{K._scratch(spark, 'window')}/orders"
    replace_table(K._orders_versioned(spark, sf, 1), path, B.time_part("order_date"))
    src = K._orders_versioned(spark, sf, 2, F.col("order_date").between("1995-07-01", "1997-06-30"))
    B.replace_window(src, path, "order_date", dt.date(1996, 1, 1), dt.date(1997, 1, 1))
    return read_version(spark, path)


def stored_lookback(spark: SparkSession, sf: str) -> DataFrame:
    """Events by day: the second load re-takes three days, and rows whose time is missing."""
    path = f"{K._scratch(spark, 'lookback')}/events"
    replace_table(K._events_v(spark, sf, 1, F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")), path, B.time_part("ts", "yyyyMMdd"))
    src = K._events_v(spark, sf, 2)
    src = src.withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts")))
    for _ in range(2):
        B.lookback_parts(src, path, "ts", ["event_id"], "3 days")
    return read_version(spark, path)


def stored_schema_change(spark: SparkSession, sf: str) -> DataFrame:
    """A second load whose customer_id is text (some of it no number), without status and with a new column, under each mode that takes it."""
    raw = raw_entity(spark, sf, "orders")
    old = raw.where(F.col("order_date") < K.SPLIT_DATE).select("order_id", "customer_id", "status")
    odd = F.when(F.col("order_id") % 3 == 0, F.concat(F.lit("C"), F.col("customer_id").cast("string"))).otherwise(F.col("customer_id").cast("string"))
    new = raw.where(F.col("order_date") >= K.SPLIT_DATE).select("order_id", odd.alias("customer_id"), "payment_method")
    out = None
    for mode in ("ignore", "append_new_columns", "sync_all_columns"):
        path = f"{K._scratch(spark, 'schema')}/{mode}"
        B.sync_table(old, path, mode)
        B.sync_table(new, path, mode)
        got = read_version(spark, path)
        told = got.select(F.lit(mode).alias("mode"), "order_id", F.col("customer_id").cast("string").alias("customer_id"), *[(F.col(c) if c in got.columns else F.lit("no column")).alias(c) for c in ("status", "payment_method")])
        out = told if out is None else out.unionByName(told)
    return out


def incremental_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Gold after two runs of the incremental job: the second finds later orders, and other prices and customers of some it had.

    One row per row of fct_orders, agg_daily_revenue, agg_sales_by_customer and dim_products: table_name, key, n, amount.
    """
    root = K._scratch(spark, "lake")
    now = {e: raw_entity(spark, sf, e) for e in ENTITY_NAMES}
    was = F.col("order_id") % 97 == 0
    orders = now["orders"].where(F.col("order_date") < "1998-06-01")
    orders = orders.withColumns({"total_amount": F.when(was, F.col("total_amount") + 1).otherwise(F.col("total_amount")), "customer_id": F.when(was, F.lit(1).cast("bigint")).otherwise(F.col("customer_id"))})
    for raws, run, ts in (({**now, "orders": orders}, "r1", RUN1), (now, "r2", RUN2)):
        run_lake(spark, raws, root, batch=Batch(run, ts), tiers=TPCH_TIERS, parts=4, fact_part="yyyy")
    out = None
    for zone, name, key, n, amount in (
        ("gold", "fct_orders", "order_item_id", "quantity", "order_total"),
        ("gold_analytics", "agg_daily_revenue", "order_date", "total_orders", "total_revenue"),
        ("gold_analytics", "agg_sales_by_customer", "customer_id", "total_orders", "total_spent"),
        ("gold", "dim_products", "product_id", "total_orders", "total_revenue"),
    ):
        told = read_version(spark, f"{root}/{zone}/{name}").select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("key"), F.col(n).alias("n"), F.round(amount, 4).alias("amount"))
        out = told if out is None else out.unionByName(told)
    return out


# --------------------------------------------------------------------------- clones and extracts
LINKS = (
    Reference("slv_orders", "slv_customers", "customer_id"), Reference("slv_order_items", "slv_orders", "order_id"),
    Reference("slv_order_items", "slv_products", "product_id"),
)


def sampled_clone_linked(spark: SparkSession, sf: str) -> DataFrame:
    """A clone of the silver zone: a tenth of the customers with their orders, items and these items' products."""
    lake, t = K._scratch(spark, "linked_clone"), K._all(spark, sf, Batch())
    keys = {"slv_customers": ("customer_id", "city"), "slv_orders": ("order_id", "shipping_address"), "slv_order_items": ("order_item_id", None), "slv_products": ("product_id", None)}
    for name in keys:
        write_table(t[name], f"{lake}/silver/{name}")
    clone_zones(spark, lake, "silver", f"{lake}/ci", "PR_3", pct=10, by_key=("slv_customers", "customer_id"), references=LINKS)
    out = None
    for name, (key, masked) in keys.items():
        got = spark.read.parquet(f"{lake}/ci/PR_3/{clone_name('silver', name)}")
        told = got.select(F.lit(name).alias("table_name"), F.col(key).alias("key"), (F.col(masked) if masked else F.lit(None).cast("string")).alias("masked"))
        out = told if out is None else out.unionByName(told)
    return out


def digest_diff(spark: SparkSession, sf: str) -> DataFrame:
    """What changed between two customer extracts, by bucket digests first: only buckets that differ are joined."""
    v1, v2 = customer_versions(spark, sf)
    return B.diff_by_digest(v1, v2, ["customer_id"], buckets=256)


# --------------------------------------------------------------------------- streams
def _landed(spark: SparkSession, name: str, loads: list[DataFrame], run: Callable[[str], None]) -> str:
    """A landing folder in which loads arrive one after the other; ``run(root)`` takes each up, as one epoch.

    A load has as many files as it has tasks, so neither its writer nor its reader is one task.
    """
    root = K._scratch(spark, name)
    for df in loads:
        df.write.mode("append").parquet(f"{root}/landing")
        run(root)
    return root


def stream_ingest_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Raw orders that land in four loads, ingested one load an epoch; bronze and rejects told apart by ``zone``."""
    raw = raw_entity(spark, sf, "orders")
    run = lambda root: ingest_epochs(spark, f"{root}/landing", raw.schema, "orders", f"{root}/bronze", f"{root}/rejects", f"{root}/checkpoint", "s", RUN1)
    root = _landed(spark, "ingest", [raw.where(F.col("order_id") % 4 == i) for i in range(4)], run)
    cols = ["order_id", "customer_id", "order_date", "status", "total_amount"]
    bronze = read_version(spark, f"{root}/bronze").select(F.lit("bronze").alias("zone"), *cols, F.lit(None).cast("string").alias("_reject_reason"))
    return bronze.unionByName(read_version(spark, f"{root}/rejects").select(F.lit("rejects").alias("zone"), *cols, "_reject_reason"))


def stream_dedupe_late(spark: SparkSession, sf: str) -> DataFrame:
    """Events, then a quarter of them again, some long after their time, and some without a time: (kind, event_id, n)."""
    events = read_table(spark, sf, "events").where("ts is not null")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    again = events.where("event_id % 4 = 0")
    untimed = events.where("event_id % 100 = 1").withColumn("ts", F.lit(None).cast(events.schema["ts"].dataType))
    run = lambda root: dedupe_epochs(spark, f"{root}/landing", events.schema, ["event_id"], "ts", f"{root}/sink", f"{root}/late", f"{root}/state", f"{root}/checkpoint", "3 days")
    root = _landed(spark, "dedupe", [events.where(early).unionByName(events.where(early & (F.col("event_id") % 3 == 0))), events.where(~early), again.unionByName(untimed)], run)
    kept = read_version(spark, f"{root}/sink").groupBy("event_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("kind"), "event_id", "n")
    aside = read_version(spark, f"{root}/late").groupBy("_reason", "event_id").agg(F.count(F.lit(1)).alias("n"))
    return kept.unionByName(aside.select(F.col("_reason").alias("kind"), "event_id", "n"))
