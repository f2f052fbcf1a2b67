"""The five-zone job: raw → transient → bronze → silver → gold → gold analytics.

``build`` wires the models lazily (one Catalyst plan per output, useful for
one-off answers and tests). ``run_pipeline`` is the production path: every
zone is *written*, and downstream models read the written tables, so each
stage's lineage is cut at a table in shared storage (an executor loss
re-runs one stage, not the whole flow), the tagged transient table is
computed once and serves both bronze and the rejects, and incremental
models (bronze append, reject merges, snapshot) see their previous state.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import checks as chk
from strata.operators.load import append_table, high_water_mark, merge_upsert, new_rows_since, typed_literal
from strata.operators.metadata import ts_literal
from strata.operators.runlog import log_entry, tag_text
from strata.operators.scd2 import snapshot_timestamp
from strata.plans import gold as G
from strata.plans import zones as Z
from strata.plans.declared import EMAIL, zone_checks
from strata.plans.entities import ENTITIES
from strata.sources.tables import cut_lineage, read_table, table_exists, write_table, zone_path

ENTITY_NAMES = ("customers", "orders", "order_items", "products")


@dataclass
class Batch:
    batch_id: str = "run-0001"
    batch_ts: str = "2024-02-01 06:00:00"
    run_id: str | None = None  # the orchestrator's run id, for the log's tags


@dataclass
class Tiers:
    customer: tuple = G.CUSTOMER_TIERS
    product: tuple = G.PRODUCT_TIERS


# Thresholds that spread the TPC-H stand-in data over all tiers (order totals
# per customer run to millions); the reference defaults stay in ``Tiers()``.
TPCH_TIERS = Tiers(
    customer=((3_000_000, "VIP"), (2_000_000, "Premium"), (1_000_000, "Regular")),
    product=((2_000_000, "High Performance"), (1_500_000, "Medium Performance"), (1_000_000, "Low Performance")),
)


def silver_of(raw: DataFrame, entity: str, batch: Batch) -> DataFrame:
    return Z.silver_from_raw(raw, entity, batch.batch_id, batch.batch_ts)


class _Tables(dict):
    """Table name → lazy DataFrame, each built on first access (and only its inputs)."""

    def __init__(self, raws: dict[str, DataFrame], batch: Batch, tiers: Tiers):
        super().__init__()
        self._raws, self._batch, self._tiers = raws, batch, tiers
        self._recipes = {
            **{f"slv_{e}": (lambda e=e: silver_of(self._raws[e], e, self._batch)) for e in ENTITY_NAMES},
            "dim_customers": lambda: G.dim_customers(self["slv_customers"], self["slv_orders"], self._tiers.customer),
            "dim_products": lambda: G.dim_products(self["slv_products"], self["slv_order_items"], self._tiers.product),
            "fct_orders": lambda: G.fct_orders(self["slv_order_items"], self["slv_orders"]),
            "agg_daily_revenue": lambda: G.agg_daily_revenue(self["fct_orders"]),
            "agg_sales_by_customer": lambda: G.agg_sales_by_customer(self["dim_customers"]),
            "agg_sales_by_product": lambda: G.agg_sales_by_product(self["dim_products"]),
        }

    def __missing__(self, name: str) -> DataFrame:
        if name not in self._recipes:
            raise KeyError(name)
        df = self[name] = self._recipes[name]()
        return df

    def keys(self):  # every table that can be built, not only the ones built so far
        return self._recipes.keys()


def build(raws: dict[str, DataFrame], batch: Batch = Batch(), tiers: Tiers = Tiers()) -> dict[str, DataFrame]:
    """Silver, gold and analytics tables as lazy DataFrames (single batch).

    Returns a mapping that constructs a table (and only what it depends on) when
    it is first looked up: building a DataFrame costs analysis round-trips, so a
    caller that needs one table does not pay for all of them.
    """
    return _Tables(raws, batch, tiers)


# --------------------------------------------------------------------------- production run
@dataclass
class RunResult:
    written: dict[str, int] = field(default_factory=dict)
    checks: list = field(default_factory=list)
    reconciliation: dict[str, int] = field(default_factory=dict)  # raw rows − transient rows
    silver_checks: list = field(default_factory=list)
    zone_checks: dict[str, list] = field(default_factory=dict)  # summary rows of every zone's declared tests
    freshness: dict[str, str] = field(default_factory=dict)  # entity → pass / warn


def run_pipeline(
    spark: SparkSession,
    raws: dict[str, DataFrame],
    root: str,
    env: str = "prod",
    batch: Batch = Batch(),
    tiers: Tiers = Tiers(),
    ci_schema: str | None = None,
    log_path: str | None = None,
    incremental_silver: bool = True,
    threads: int = 4,
    fk_severity: str = "warn",
    bronze_key_severity: str = "warn",
    bronze_only_changed: bool = False,
    full_refresh: bool = False,
    freshness: Mapping[str, str] | None = None,
) -> RunResult:
    """Write every zone for one batch; returns per-table row counts and check results.

    ``incremental_silver``: silver folds in only the bronze rows it has not seen;
    the result equals a full rebuild. Off, silver is rebuilt from all bronze history.
    ``bronze_only_changed``: bronze appends only the rows of keys whose latest
    version differs from the last one loaded (SURVEY D2 option); silver is the same.
    Every zone's declared tests run on its written tables, before the next zone is built
    (transient, bronze and silver before gold); a failed test of severity ``error`` stops the job.
    ``fk_severity``: relationship tests warn by default, because a child
    whose parent was rejected is an expected orphan; ``"error"`` makes them block.
    ``bronze_key_severity``: likewise for repeated bronze keys, which raw duplicates give and silver resolves.
    ``full_refresh``: bronze, rejects and silver forget earlier runs and are rebuilt from this
    batch; the snapshot's history stays, as nothing could bring it back.
    ``freshness`` (entity → time column): before anything is written, a source whose newest row is
    older than a day at the batch's time, or that is empty, stops the job; one older than half a day warns.
    A transient table whose rows do not add up to the raw rows stops it too.
    """
    res = RunResult()
    path = lambda zone, table: zone_path(root, env, zone, table, ci_schema)
    log_rows: list[DataFrame] = []
    failed: list[str] = []

    def record(model: str, zone: str, materialized: str, df: DataFrame, write) -> None:
        start = dt.datetime.now()
        tag = tag_text(invocation_id=batch.batch_id, job=f"build_{env}", env=env, model=model, schema=zone, materialized=materialized, airflow_run_id=batch.run_id)
        spark.sparkContext.setJobDescription(tag)

        obs = Observation(model)
        status, err, n = "SUCCESS", None, None
        try:
            counted = write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
            # a write that filters (incremental append) reports its own row count
            n = counted if isinstance(counted, int) else int(obs.get["rows"])
            res.written[model] = n
        except Exception as exc:  # logged, then re-raised
            status, err = "FAIL", str(exc)
            failed.append(model)
            raise
        finally:
            if log_path:
                qtype = {"table": "CREATE_TABLE_AS_SELECT", "incremental": "INSERT", "merge": "MERGE", "snapshot": "MERGE"}[materialized]
                log_rows.append(log_entry(spark, tag, f"{batch.batch_id}:{model}", start, dt.datetime.now(), status, n, query_type=qtype, error_message=err))

    def entity_chain(e: str) -> None:
        ent = ENTITIES[e]
        # transient: full rebuild, partitioned by the validity flag so bronze and
        # the rejects each read only their half.
        trn_path = path("transient", f"trn_{e}")
        trn_df = Z.transient(raws[e], e, batch.batch_id, batch.batch_ts)
        record(f"trn_{e}", "transient", "table", trn_df,
               lambda d, p=trn_path: write_table(d, p, partition_by=["_is_valid"]))
        trn_all = read_table(spark, trn_path, schema=trn_df.schema)
        # row-count reconciliation: raw rows observed flowing into the write vs rows
        # in the written table (a footer-only count; the raw source is not re-scanned)
        res.reconciliation[e] = res.written[f"trn_{e}"] - trn_all.count()
        if res.reconciliation[e]:
            raise RuntimeError(f"trn_{e} lacks {res.reconciliation[e]} of the raw rows")
        # technical rejects from the written table's invalid partition, not from raw again
        rej_path = path("transient", f"trn_{e}_rejects")
        rej = Z.transient_rejects(trn_all.where(~F.col("_is_valid")), e, batch.batch_id, batch.batch_ts)
        old = spark.read.parquet(rej_path) if table_exists(spark, rej_path) and not full_refresh else None
        if old is not None:
            rej = new_rows_since(rej, old, "_rejected_at")
        record(f"trn_{e}_rejects", "transient", "merge", merge_upsert(old, rej, ["_reject_id"], dedupe_order=_reject_order(rej)),
               lambda d, p=rej_path: write_table(d, p))
        # bronze: append valid rows newer than the high-water mark, kept in a
        # one-row-per-load side table (no max() over the growing bronze table);
        # partitioned by load date so later readers prune whole loads, and by load, so that
        # a load that was stopped before its mark is replaced when it is repeated
        brz_path = path("bronze", f"brz_{e}")
        brz_new = Z.bronze(trn_all, e, batch.batch_ts).withColumns(
            {"_load_date": F.to_date("_loaded_at"), "_load": F.concat(F.lit("L"), F.regexp_replace(F.col("_loaded_at").cast("string"), "[^0-9]", ""))})
        commit_state = None
        if bronze_only_changed:
            brz_new, commit_state = _only_changed_keys(spark, brz_new, ent, f"{brz_path}.__state", full_refresh)
        record(f"brz_{e}", "bronze", "incremental", brz_new,
               lambda d, p=brz_path: append_table(d, p, "_loaded_at", partition_by=["_load_date", "_load"], hwm_path=f"{p}.__hwm", own_partitions=True, full_refresh=full_refresh))
        if commit_state is not None:
            commit_state()  # only after the append landed: a failed append is retried in full
        # silver: validated once (written, partitioned by the business flag), then
        # clean and rejects read from it. Incremental mode validates only bronze
        # rows newer than silver's own mark and replaces those keys in silver.
        val_path = path("silver", f"_slv_{e}_validated")
        slv_path = path("silver", f"slv_{e}")
        slv_mark = f"{slv_path}.__hwm"
        brz = read_table(spark, brz_path, schema=brz_new.schema)
        incremental = incremental_silver and not full_refresh and table_exists(spark, slv_path) and table_exists(spark, slv_mark)
        if incremental:
            # the date predicate prunes old load partitions; the exact one keeps rows after the mark
            hwm = typed_literal(high_water_mark(spark.read.parquet(slv_mark), "hwm"), T.TimestampNTZType())
            brz = brz.where((F.col("_load_date") >= F.to_date(hwm)) & (F.col("_loaded_at") > hwm))
        seen = Observation(f"{e}_bronze_seen")
        brz = brz.observe(seen, F.max("_loaded_at").alias("hwm"))
        val_df = Z.silver_validated(brz, e, batch.batch_ts)
        record(f"slv_{e}_validated", "silver", "table", val_df,
               lambda d, p=val_path: write_table(d, p, partition_by=["_is_business_valid"]))
        val = read_table(spark, val_path, schema=val_df.schema)
        clean = Z.silver_clean(val, e)
        if incremental:
            touched = val.select(ent.key)
            clean = spark.read.parquet(slv_path).join(touched, ent.key, "left_anti").unionByName(clean)
            # the table is rewritten anyway: stamp every row with this run, as a rebuild does
            clean = clean.withColumn("_silver_processed_at", ts_literal(batch.batch_ts))
        record(f"slv_{e}", "silver", "table", clean, lambda d, p=slv_path: write_table(d, p))
        srej_path = path("silver", f"slv_{e}_rejects")
        srej = Z.silver_rejects(val, e, batch.batch_ts)
        sold = spark.read.parquet(srej_path) if table_exists(spark, srej_path) and not full_refresh else None
        if sold is not None:
            srej = new_rows_since(srej, sold, "_rejected_at")
        record(f"slv_{e}_rejects", "silver", "merge", merge_upsert(sold, srej, ["_reject_id"], dedupe_order=_reject_order(srej)),
               lambda d, p=srej_path: write_table(d, p))
        # the mark last: a stop before this line repeats the batch instead of losing its rejects
        mark = seen.get.get("hwm")
        if mark is not None:
            write_table(spark.createDataFrame([(mark,)], "hwm timestamp_ntz"), slv_mark,
                        mode="append" if table_exists(spark, slv_mark) and not full_refresh else "overwrite")

    def check_freshness(e: str, col: str) -> None:
        row = chk.source_freshness(raws[e], col, batch.batch_ts, table=e).first()
        res.freshness[e] = row["status"]
        if row["status"] == "error":
            raise RuntimeError(f"raw {e} is stale: newest {col} is {row['max_loaded_at']}, {row['age_hours']} h before the batch")

    def run_tests(zone: str, tables: dict[str, DataFrame]) -> list:
        summary = zone_checks(zone, tables, tiers.customer, tiers.product, fk_severity, bronze_key_severity)
        res.zone_checks[zone] = chk.raise_on_error(summary)
        return res.zone_checks[zone]

    started = dt.datetime.now()
    try:
        _run_all([lambda e=e, c=c: check_freshness(e, c) for e, c in (freshness or {}).items()], threads)
        # the four entity chains are independent: submit them concurrently
        # (``threads`` like the reference's client parallelism; 1 = serial)
        _run_all([lambda e=e: entity_chain(e) for e in ENTITY_NAMES], threads)

        slv = {e: spark.read.parquet(path("silver", f"slv_{e}")) for e in ENTITY_NAMES}
        # tests of the zones below run before gold: an error-severity failure stops everything downstream
        stored = lambda zone, *names: {n: spark.read.parquet(path(zone, n)) for n in names}
        lower = {
            "transient": [f"trn_{e}{x}" for e in ENTITY_NAMES for x in ("", "_rejects")],
            "bronze": [f"brz_{e}" for e in ENTITY_NAMES],
            "silver": [f"slv_{e}{x}" for e in ENTITY_NAMES for x in ("", "_rejects")],
        }
        _run_all([lambda z=z, names=names: run_tests(z, stored(z, *names)) for z, names in lower.items()], threads)
        res.silver_checks = res.zone_checks["silver"]
        gold = {
            "dim_customers": (G.dim_customers(slv["customers"], slv["orders"], tiers.customer), G.DIM_CUSTOMERS_CONTRACT),
            "dim_products": (G.dim_products(slv["products"], slv["order_items"], tiers.product), G.DIM_PRODUCTS_CONTRACT),
            "fct_orders": (G.fct_orders(slv["order_items"], slv["orders"]), G.FCT_ORDERS_CONTRACT),
        }
        # snapshot (SCD2) of silver customers, independent of gold
        snap_path = path("bronze", "snap_customers")
        hist = spark.read.parquet(snap_path) if table_exists(spark, snap_path) else None
        snap_src = slv["customers"].select(*[c for c in slv["customers"].columns if not c.startswith("_")])
        jobs = [
            lambda: record("snap_customers", "bronze", "snapshot",
                           snapshot_timestamp(hist, snap_src, "customer_id", "updated_at", batch.batch_ts),
                           lambda d: write_table(d, snap_path))
        ]
        jobs += [
            lambda name=name, df=df, contract=contract: record(
                name, "gold", "table", chk.enforce_contract(df, contract), lambda d, p=path("gold", name): write_table(d, p))
            for name, (df, contract) in gold.items()
        ]
        _run_all(jobs, threads)
        built = stored("gold", *gold)
        res.checks = run_tests("gold", built)
        dc, dp, fo = built["dim_customers"], built["dim_products"], built["fct_orders"]
        _run_all([
            lambda name=name, df=df: record(name, "gold_analytics", "table", df, lambda d, p=path("gold_analytics", name): write_table(d, p))
            for name, df in (
                ("agg_daily_revenue", G.agg_daily_revenue(fo)),
                ("agg_sales_by_customer", G.agg_sales_by_customer(dc)),
                ("agg_sales_by_product", G.agg_sales_by_product(dp)),
            )
        ], threads)

        run_tests("gold_analytics", stored("gold_analytics", "agg_daily_revenue", "agg_sales_by_customer", "agg_sales_by_product"))
    except Exception as exc:  # a failed check has no model of its own: it gets a log row, then is raised again
        if log_path and not failed:
            tag = tag_text(invocation_id=batch.batch_id, job=f"build_{env}", env=env, model="checks", schema="checks", materialized="test", airflow_run_id=batch.run_id)
            log_rows.append(log_entry(spark, tag, f"{batch.batch_id}:checks", started, dt.datetime.now(), "FAIL", None, query_type="SELECT", error_message=str(exc)))
        raise
    finally:
        if log_path and log_rows:
            all_rows = log_rows[0]
            for r in log_rows[1:]:
                all_rows = all_rows.unionByName(r)
            write_table(all_rows.coalesce(1), log_path, mode="append" if table_exists(spark, log_path) else "overwrite")
    return res


def _only_changed_keys(spark: SparkSession, brz_new: DataFrame, ent, state_path: str, full_refresh: bool = False):
    """Rows of the keys whose latest version in this batch is new or changed.

    A key can repeat within a batch, so change is decided per key on its latest
    version (silver's order, then a row hash); all of the batch's rows of a
    changed key are kept, which leaves silver's within-batch choice unchanged.
    The state (key, hash of the latest loaded version) is one row per key; the
    returned ``commit`` writes it and must run only after the append succeeded.
    """
    from strata.functions.keys import row_hash
    from strata.operators.dedup import latest_per_key

    key = ent.key
    latest = latest_per_key(brz_new.withColumn("_row_hash", row_hash(*ent.columns)), [key], list(ent.dedupe_order) or [key],
                            tie_break=[F.col("_row_hash").desc()])
    cand = latest.select(key, "_row_hash")
    prev = spark.read.parquet(state_path) if table_exists(spark, state_path) and not full_refresh else None
    changed = cand if prev is None else cand.join(prev, [key, "_row_hash"], "left_anti")
    # the bronze filter and the later state update must see the same set: cut it once
    changed = cut_lineage(changed)

    def commit() -> None:
        write_table(merge_upsert(prev, changed, [key], check_unique=False), state_path)

    return brz_new.join(changed.select(key), key, "left_semi"), commit


def _reject_order(rej: DataFrame) -> list:
    """Total order for rejects sharing a ``_reject_id`` (NULL key parts collide, SURVEY D6):
    latest first, then a hash of the whole row, so one row per id is kept deterministically."""
    return ["_rejected_at desc", F.xxhash64(*rej.columns).desc()]


def _run_all(jobs: list, threads: int) -> None:
    """Run independent write jobs, ``threads`` at a time; the first failure is raised."""
    if threads <= 1:
        for j in jobs:
            j()
        return
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=threads) as pool:
        for f in [pool.submit(j) for j in jobs]:
            f.result()


def gold_checks(fct: DataFrame, dim_c: DataFrame, dim_p: DataFrame, tiers: Tiers = Tiers()) -> DataFrame:
    """A short gold suite with warnings instead of errors (the declared tests are in ``strata.plans.declared``)."""
    C = chk.Check
    c_labels = tuple(lbl for _, lbl in tiers.customer) + (G.CUSTOMER_TIER_DEFAULT,)
    p_labels = tuple(lbl for _, lbl in tiers.product) + (G.PRODUCT_TIER_DEFAULT,)
    s = chk.run_checks(dim_c, "dim_customers", [
        C("not_null", "customer_id"), C("unique", "customer_id"), C("not_null", "email"),
        C("match_regex", "email", regex=EMAIL, severity="warn"),
        C("between", "total_orders", min=0), C("between", "total_spent", min=0),
        C("accepted_values", "customer_tier", values=c_labels),
    ])
    s = s.unionByName(chk.run_checks(dim_p, "dim_products", [
        C("not_null", "product_id"), C("unique", "product_id"), C("between", "price", min=0, strictly=True),
        C("between", "total_revenue", min=0), C("accepted_values", "performance_category", values=p_labels),
    ]))
    s = s.unionByName(chk.run_checks(fct, "fct_orders", [
        C("not_null", "order_item_id"), C("unique", "order_item_id"), C("not_null", "order_id"),
        C("relationships", "customer_id", to=dim_c, field_="customer_id", severity="warn"),
        C("relationships", "product_id", to=dim_p, field_="product_id", severity="warn"),
        C("between", "quantity", min=0, strictly=True), C("between", "unit_price", min=0, strictly=True),
    ]))
    return s


def main(argv: list[str] | None = None) -> None:
    """``python -m strata.plans.pipeline --root DIR (--raw-dir DIR | --sf-dir DIR | --seeds DIR) [--env prod]``."""
    import argparse
    import json

    from strata.sources.seeds import read_entity

    ap = argparse.ArgumentParser(description="run the five-zone pipeline for one batch")
    ap.add_argument("--root", required=True, help="lake root (shared storage)")
    ap.add_argument("--env", default="prod", choices=["dev", "ci", "uat", "prod"])
    ap.add_argument("--ci-schema")
    ap.add_argument("--sf-dir", help="directory with the raw (TPC-H style) tables")
    ap.add_argument("--raw-dir", help="directory with the raw parquet tables customers, orders, order_items and products")
    ap.add_argument("--seeds", help="seed CSV directory (dev)")
    ap.add_argument("--full-refresh", action="store_true", help="rebuild bronze, rejects and silver from this batch (the snapshot stays)")
    ap.add_argument("--freshness", action="append", default=[], metavar="ENTITY=COLUMN", help="stop when the source's newest time is over a day old")
    ap.add_argument("--batch-id", default="run-0001")
    ap.add_argument("--batch-ts", default="2024-02-01 06:00:00")
    ap.add_argument("--tpch-tiers", action="store_true", help="use thresholds suited to the TPC-H stand-ins")
    ap.add_argument("--log", help="run-log table path")
    ap.add_argument("--run-id", help="the orchestrator's run id, for the run log")
    ap.add_argument("--bronze-only-changed", action="store_true", help="append only keys whose latest version changed")
    ap.add_argument("--threads", type=int, default=4)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("strata-pipeline").getOrCreate()
    env = "dev" if a.seeds else a.env
    raws = {e: read_entity(spark, env, e, seeds_dir=a.seeds, sf_dir=a.sf_dir, raw_dir=a.raw_dir) for e in ENTITY_NAMES}
    res = run_pipeline(spark, raws, a.root, env=a.env, batch=Batch(a.batch_id, a.batch_ts, a.run_id),
                       tiers=TPCH_TIERS if a.tpch_tiers else Tiers(), ci_schema=a.ci_schema, log_path=a.log,
                       bronze_only_changed=a.bronze_only_changed, threads=a.threads, full_refresh=a.full_refresh,
                       freshness=dict(x.split("=", 1) for x in a.freshness))
    print(json.dumps({"written": res.written, "checks": [r.asDict() for r in res.checks]}, default=str))


if __name__ == "__main__":
    main()
