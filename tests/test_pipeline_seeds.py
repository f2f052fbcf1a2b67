"""Five-zone run on the seed fixtures against hand-computed goldens, then a second run."""

from __future__ import annotations

import pytest

from strata.plans.pipeline import Batch, build, run_pipeline
from strata.sources.seeds import read_entity
from tests.conftest import SEEDS

ENTITIES = ("customers", "orders", "order_items", "products")


@pytest.fixture(scope="module")
def raws(spark):
    return {e: read_entity(spark, "dev", e, seeds_dir=SEEDS) for e in ENTITIES}


@pytest.fixture(scope="module")
def tables(raws):
    return build(raws, Batch("b1", "2024-02-01 06:00:00"))


def test_silver_splits(tables):
    assert sorted(r.customer_id for r in tables["slv_customers"].collect()) == [1, 2]
    assert sorted(r.order_id for r in tables["slv_orders"].collect()) == [101, 102, 103, 106]
    assert sorted(r.product_id for r in tables["slv_products"].collect()) == [1, 2, 5]
    c1 = tables["slv_customers"].where("customer_id = 1").first()
    assert (c1.first_name, c1.last_name, c1.email, c1.state_code, c1.country_code) == ("Ana", "Smith", "ana@mail.com", "IL", "US")
    c2 = tables["slv_customers"].where("customer_id = 2").first()
    assert (c2.first_name, c2.last_name, c2.postal_code) == ("Bo", "Lee-park", "02139")  # zip keeps its zero


def test_gold_goldens(tables):
    fct = tables["fct_orders"]
    assert sorted(r.order_item_id for r in fct.collect()) == [1001, 1002, 1003, 1004, 1005, 1008]
    dc = {r.customer_id: (r.total_orders, r.total_spent, r.customer_tier, str(r.first_order_date)) for r in tables["dim_customers"].collect()}
    assert dc == {1: (2, 1500.0, "VIP", "2024-01-15"), 2: (1, 550.0, "Premium", "2024-01-16")}
    dp = {r.product_id: (r.total_orders, r.total_quantity_sold, r.total_revenue, r.avg_selling_price, r.profit_margin, r.performance_category)
          for r in tables["dim_products"].collect()}
    assert dp == {
        1: (2, 2, 1450.0, 750.0, 400.0, "Low Performance"),
        2: (3, 4, 400.0, 100.0, 60.0, "No Sales"),  # revenue from silver items incl. the rejected order's item
        5: (1, 1, 80.0, 80.0, 60.0, "No Sales"),
    }
    daily = {str(r.order_date): (r.total_orders, r.unique_customers, r.total_revenue, r.total_units_sold, r.total_discounts, round(r.avg_unit_price, 4))
             for r in tables["agg_daily_revenue"].collect()}
    assert daily == {
        "2024-01-15": (1, 1, 1200.0, 3, 0.0, 550.0),
        "2024-01-16": (2, 2, 850.0, 5, 50.0, 233.3333),
        "2024-01-18": (1, 1, 80.0, 1, 0.0, 80.0),
    }
    by_c = {r.customer_id: (r.customer_lifetime_days, r.avg_order_value) for r in tables["agg_sales_by_customer"].collect()}
    assert by_c == {1: (1, 750.0), 2: (0, 550.0)}
    by_p = {r.product_id: round(r.gross_margin_pct, 4) for r in tables["agg_sales_by_product"].collect()}
    assert by_p == {1: round((1450 - 600 * 2) / 1450, 4), 2: 0.6, 5: 0.75}


def test_run_pipeline_writes_zones_and_is_rerunnable(spark, raws, scratch):
    root = f"{scratch}/lake"
    log = f"{scratch}/runlog"
    r1 = run_pipeline(spark, raws, root, env="prod", batch=Batch("b1", "2024-02-01 06:00:00"), log_path=log)
    assert r1.written["trn_customers_rejects"] == 1 and r1.written["trn_orders_rejects"] == 1
    assert r1.written["slv_customers_rejects"] == 3 and r1.written["fct_orders"] == 6
    assert r1.reconciliation == {e: 0 for e in ENTITIES}
    statuses = {(x["table_name"], x["column_name"], x["check_name"]): x["status"] for x in r1.checks}
    assert statuses[("fct_orders", "customer_id", "relationships")] == "warn"  # order 106's customer 9 is unknown
    read = lambda z, t: spark.read.parquet(f"{root}/{z}/{t}")
    assert read("bronze", "brz_orders").count() == 6
    # second run, later batch: bronze appends a full copy, silver still one row per key,
    # reject merges stay idempotent, the snapshot does not change
    r2 = run_pipeline(spark, raws, root, env="prod", batch=Batch("b2", "2024-02-02 06:00:00"), log_path=log)
    assert read("bronze", "brz_orders").count() == 12
    assert read("silver", "slv_orders").count() == 4
    assert read("transient", "trn_customers_rejects").count() == 1
    assert read("silver", "slv_customers_rejects").count() == 3
    assert read("bronze", "snap_customers").count() == 2
    assert r2.written["fct_orders"] == 6
    from strata.operators.runlog import parse_log

    parsed = parse_log(spark.read.parquet(log))
    assert parsed.select("invocation_id").distinct().count() == 2
    assert parsed.where("invocation_id = 'b1'").count() == len(r1.written)


def test_ci_zone_routing(spark, raws, scratch):
    from strata.sources.tables import zone_path

    assert zone_path("/lake", "ci", "gold", "dim_customers", "PR_1") == "/lake/PR_1/dim_customers"
    assert zone_path("/lake", "prod", "gold", "dim_customers") == "/lake/gold/dim_customers"
    assert zone_path("/lake", "prod", " ", "x") == "/lake/default/x"


def _changed(raws):
    """Second-day extract: customer 1 moves, 3 fixes its e-mail, 2 breaks it; order 104 gets a valid status."""
    from pyspark.sql import functions as F

    c = raws["customers"]
    c = (c.withColumn("city", F.when(F.col("customer_id") == 1, F.lit("chicago")).otherwise(F.col("city")))
         .withColumn("email", F.when(F.col("customer_id") == 3, F.lit("cy@mail.com"))
                     .when(F.col("customer_id") == 2, F.lit("bo-at-mail")).otherwise(F.col("email"))))
    o = raws["orders"].withColumn("status", F.when(F.col("order_id") == 104, F.lit("shipped")).otherwise(F.col("status")))
    return {**raws, "customers": c, "orders": o}


def test_incremental_silver_equals_full_rebuild(spark, raws, scratch):
    from strata.plans import zones as Z

    inc, full = f"{scratch}/inc", f"{scratch}/full"
    runs = [(raws, "2024-02-01 06:00:00"), (_changed(raws), "2024-02-02 06:00:00"), (_changed(raws), "2024-02-03 06:00:00")]
    for i, (r, ts) in enumerate(runs):
        run_pipeline(spark, r, inc, batch=Batch(f"b{i}", ts), incremental_silver=True)
        run_pipeline(spark, r, full, batch=Batch(f"b{i}", ts), incremental_silver=False)
    for e in ENTITIES:
        a = spark.read.parquet(f"{inc}/silver/slv_{e}")
        b = spark.read.parquet(f"{full}/silver/slv_{e}")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, e
        # and both equal the definition: latest per key over all bronze, then valid
        brz = spark.read.parquet(f"{full}/bronze/brz_{e}")
        ref = Z.silver_clean(Z.silver_validated(brz, e, "2024-02-03 06:00:00"), e)
        assert ref.exceptAll(a).count() == 0 and a.exceptAll(ref).count() == 0, e
    cust = {r.customer_id: r.city for r in spark.read.parquet(f"{inc}/silver/slv_customers").collect()}
    assert cust == {1: "Chicago", 3: "Austin"}
    assert 104 in {r.order_id for r in spark.read.parquet(f"{inc}/silver/slv_orders").collect()}
    assert spark.read.parquet(f"{inc}/gold/fct_orders").count() == 7


def test_silver_checks_block_gold_on_error(spark, raws, scratch):
    from pyspark.sql import functions as F

    r = run_pipeline(spark, raws, f"{scratch}/ok", batch=Batch("b1", "2024-02-01 06:00:00"))
    st = {(x["table_name"], x["column_name"], x["check_name"]): x["status"] for x in r.silver_checks}
    assert st[("slv_orders", "customer_id", "relationships")] == "warn"  # order 106 → unknown customer 9
    assert st[("slv_customers", "email", "unique")] == "pass"
    # two customers with the same e-mail: silver's unique(email) fails, gold is never built
    dup = {**raws, "customers": raws["customers"].withColumn(
        "email", F.when(F.col("customer_id") == 2, F.lit("ana@mail.com")).otherwise(F.col("email")))}
    with pytest.raises(AssertionError, match="unique"):
        run_pipeline(spark, dup, f"{scratch}/bad", batch=Batch("b1", "2024-02-01 06:00:00"))
    from strata.sources.tables import table_exists

    assert table_exists(spark, f"{scratch}/bad/silver/slv_customers")
    assert not table_exists(spark, f"{scratch}/bad/gold/dim_customers")


def test_clone_zones_full_and_slim(spark, raws, scratch):
    from strata.operators.clone import clone_zones
    from strata.sources.tables import list_tables

    root = f"{scratch}/lake"
    run_pipeline(spark, raws, root, batch=Batch("b1", "2024-02-01 06:00:00"))
    gold = list_tables(spark, f"{root}/gold")
    assert gold == ["dim_customers", "dim_products", "fct_orders"]
    msg = clone_zones(spark, root, "gold, gold_analytics", f"{scratch}/ci", "PR_9", pct=0,
                      masks={"dim_customers": {"email": "redact_email"}})
    assert "6 tables" in msg and "mode=full" in msg
    assert spark.read.parquet(f"{scratch}/ci/PR_9/GOLD_FCT_ORDERS").count() == 6
    emails = {r.email for r in spark.read.parquet(f"{scratch}/ci/PR_9/GOLD_DIM_CUSTOMERS").collect()}
    assert emails == {"***@mail.com"}
    slim = clone_zones(spark, root, "silver", f"{scratch}/ci", "PR_10", pct=0, table_list="silver.slv_orders")
    assert "1 tables" in slim and list_tables(spark, f"{scratch}/ci/PR_10") == ["SILVER_SLV_ORDERS"]


def test_reject_ids_stay_unique_when_key_parts_collide(spark, raws, scratch):
    from pyspark.sql import functions as F

    # two raw customers with id 6 and a NULL e-mail: same reject id (id, NULL marker)
    extra = raws["customers"].where("customer_id = 6").withColumn("first_name", F.lit("twin"))
    dup = {**raws, "customers": raws["customers"].unionByName(extra)}
    root = f"{scratch}/d6"
    for i in range(2):
        run_pipeline(spark, dup, root, batch=Batch(f"b{i}", f"2024-02-0{i + 1} 06:00:00"))
    rej = spark.read.parquet(f"{root}/transient/trn_customers_rejects")
    assert rej.count() == 1 and rej.select("_reject_id").distinct().count() == 1


def test_reports_on_the_jobs_own_run_log(spark, raws, scratch):
    from strata.operators import runlog as R

    log_path = f"{scratch}/own_log"
    for i in range(2):
        run_pipeline(spark, raws, f"{scratch}/lake2", env="prod", batch=Batch(f"b{i}", f"2024-02-0{i + 1} 06:00:00"),
                     log_path=log_path)
    log = R.parse_log(spark.read.parquet(log_path))
    n_models = log.where("invocation_id = 'b0'").count()
    assert n_models == log.where("invocation_id = 'b1'").count() > 25
    seq = [r.event_sequence for r in log.where("invocation_id = 'b1'").orderBy("event_sequence").collect()]
    assert seq == list(range(1, n_models + 1))
    import datetime as dt

    slow = R.slowest_models(log, dt.datetime.now(), env="prod", days=1).collect()
    assert len(slow) == n_models and all(r.run_count == 2 for r in slow)
    trend = R.trend_monitor(log).where("model = 'fct_orders'").orderBy("start_time").collect()
    assert [r.row_flag for r in trend] == ["first", "ok"] and trend[1].prev_rows_inserted == 6
    summary = {r.invocation_id: (r.models_run, r.models_failed) for r in R.invocation_summary(log).collect()}
    assert summary == {"b0": (n_models, 0), "b1": (n_models, 0)}


def test_change_only_bronze_gives_the_same_silver(spark, raws, scratch):
    full, chg = f"{scratch}/fullcopy", f"{scratch}/changes"
    runs = [(raws, "2024-02-01 06:00:00"), (_changed(raws), "2024-02-02 06:00:00"), (_changed(raws), "2024-02-03 06:00:00")]
    for i, (r, ts) in enumerate(runs):
        run_pipeline(spark, r, full, batch=Batch(f"b{i}", ts))
        run_pipeline(spark, r, chg, batch=Batch(f"b{i}", ts), bronze_only_changed=True)
    for e in ENTITIES:
        a = spark.read.parquet(f"{full}/silver/slv_{e}")
        b = spark.read.parquet(f"{chg}/silver/slv_{e}")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, e
    # run 2 changed two customers (1: city, 2: e-mail) and fixed one (3); run 3 changed nothing
    loads = {str(r._load_date): r["count"] for r in spark.read.parquet(f"{chg}/bronze/brz_customers").groupBy("_load_date").count().collect()}
    assert loads == {"2024-02-01": 5, "2024-02-02": 3}
    assert spark.read.parquet(f"{full}/bronze/brz_customers").count() == 5 + 5 + 5
    assert spark.read.parquet(f"{chg}/gold/fct_orders").count() == spark.read.parquet(f"{full}/gold/fct_orders").count() == 7
