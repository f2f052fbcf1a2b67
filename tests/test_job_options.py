"""Raw tables, schema assertion, freshness, full refresh, repeated loads, default masks."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import clone as C
from strata.operators import load as L
from strata.plans.pipeline import Batch, run_pipeline
from strata.sources import raw as R
from strata.sources.seeds import read_entity
from strata.sources.tables import drop_path
from tests.conftest import SEEDS

ENTITIES = ("customers", "orders", "order_items", "products")
B1, B2 = Batch("b1", "2024-02-01 06:00:00"), Batch("b2", "2024-02-02 06:00:00")


@pytest.fixture(scope="module")
def raws(spark):
    return {e: read_entity(spark, "dev", e, seeds_dir=SEEDS) for e in ENTITIES}


def test_raw_tables_have_their_schema_asserted(spark, raws, scratch):
    for e, df in raws.items():
        df.withColumn("further", F.lit(1)).withColumnRenamed(df.columns[0], df.columns[0].upper()).write.parquet(f"{scratch}/{e}")
    for e in ENTITIES:
        got = read_entity(spark, "prod", e, raw_dir=scratch)
        assert got.schema.simpleString() == raws[e].schema.simpleString()
        assert got.exceptAll(raws[e]).isEmpty() and raws[e].exceptAll(got).isEmpty()
    wrong = raws["orders"].drop("status", "created_at").withColumn("order_id", F.col("order_id").cast("double"))
    with pytest.raises(ValueError) as e:
        R.assert_schema(wrong, "orders")
    assert all(x in str(e.value) for x in ("missing column status", "missing column created_at", "order_id is double"))
    narrow = raws["order_items"].withColumns({"quantity": F.col("quantity").cast("int"), "unit_price": F.col("unit_price").cast("decimal(8,1)")})
    assert R.schema_issues(narrow, "order_items") == []
    rows = {r["column_name"]: (r["status"], r["failures"]) for r in R.raw_checks(raws["orders"].withColumn("customer_id", F.lit(None).cast("bigint")), "orders").collect()}
    assert rows["order_id"][0] == "pass" and rows["customer_id"] == ("warn", raws["orders"].count())


def test_stale_and_empty_sources_stop_the_job(spark, raws, scratch):
    with pytest.raises(RuntimeError, match="stale"):
        run_pipeline(spark, raws, f"{scratch}/a", batch=B1, freshness={"orders": "updated_at"})
    empty = {**raws, "orders": raws["orders"].where("false")}
    with pytest.raises(RuntimeError, match="stale"):
        run_pipeline(spark, empty, f"{scratch}/b", batch=B1, freshness={"orders": "updated_at"})


def test_full_refresh_forgets_earlier_runs_but_not_the_snapshot(spark, raws, scratch):
    root, read = f"{scratch}/lake", lambda t: spark.read.parquet(f"{scratch}/lake/{t}")
    run_pipeline(spark, raws, root, batch=B1)
    fewer = {**raws, "customers": raws["customers"].where("customer_id <> 2")}
    run_pipeline(spark, fewer, root, batch=B2, full_refresh=True)
    assert {r[0] for r in read("bronze/brz_customers").select("_batch_id").distinct().collect()} == {"b2"}
    assert [r[0] for r in read("silver/slv_customers").select("customer_id").collect()] == [1]
    assert {r[0] for r in read("bronze/snap_customers").select("customer_id").collect()} == {1, 2}
    # the marks are those of the refresh: a later run goes on from them
    run_pipeline(spark, fewer, root, batch=Batch("b3", "2024-02-03 06:00:00"))
    assert read("bronze/brz_orders").count() == 2 * read("bronze/brz_orders").where("_batch_id = 'b3'").count()


def test_a_load_stopped_before_its_mark_is_replaced(spark, scratch):
    path, marks = f"{scratch}/t", f"{scratch}/t.__hwm"
    make = lambda rows: spark.createDataFrame(rows, "id int, ts timestamp_ntz").withColumn("day", F.date_format("ts", "'D'yyyyMMdd"))
    load = lambda df: L.append_table(df, path, "ts", partition_by=["day"], hwm_path=marks, own_partitions=True)
    first, second = make([(1, dt.datetime(2024, 1, 1))]), make([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2)), (2, dt.datetime(2024, 1, 2))])
    assert load(first) == 1
    kept = [tuple(r) for r in spark.read.parquet(marks).collect()]
    assert load(second) == 2
    drop_path(spark, marks)  # as if the second load had not come to its mark
    spark.createDataFrame(kept, "hwm timestamp_ntz, rows bigint").write.parquet(marks)
    assert load(second) == 2 and load(second) == 0
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2, 2]
    with pytest.raises(ValueError):
        L.append_table(first, path, "ts", own_partitions=True)


def test_clones_mask_personal_data_by_default(spark, scratch):
    schema = "customer_id int, email string, first_name string"
    tagged = spark.createDataFrame([(1, "a@x.com", "Ann", "pii"), (2, "b@x.com", "Bo", "public"), (3, None, None, "pii")], f"{schema}, _sensitivity_tag string")
    tables = {("silver", "slv_c"): tagged, ("gold", "dim_c"): tagged.drop("_sensitivity_tag"), ("gold", "n"): tagged.select("customer_id")}
    C.clone_for_ci(spark, tables, scratch, "PR_1")
    emails = lambda s, t: [r["email"] for r in spark.read.parquet(f"{scratch}/{s}/{t}").orderBy("customer_id").collect()]
    assert emails("PR_1", "SILVER_SLV_C") == ["***@x.com", "b@x.com", None] and emails("PR_1", "GOLD_DIM_C") == ["***@x.com", "***@x.com", None]
    C.clone_for_ci(spark, tables, scratch, "PR_2", masks={})
    assert emails("PR_2", "GOLD_DIM_C") == ["a@x.com", "b@x.com", None]
