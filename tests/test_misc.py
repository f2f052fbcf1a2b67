from __future__ import annotations

import json

from pyspark.sql import functions as F

from strata.operators.metadata import with_metadata
from strata.operators.rules import Rule, foreign_key_rule, tag_rules
from strata.operators.runlog import job_tag, model_tag
from strata.sources.tables import register_views
from tests.conftest import SEEDS


def test_tags_are_valid_json(spark):
    df = spark.createDataFrame([("inv\"1", "prod")], "inv string, env string")
    r = df.select(
        job_tag(F.col("inv"), F.lit("build"), F.col("env"), F.lit("manual"), F.lit("local")).alias("j"),
        model_tag(F.col("inv"), F.lit("build"), F.col("env"), F.lit("dim_x"), F.lit("gold"), F.lit("table"), F.lit("manual")).alias("m"),
    ).first()
    assert json.loads(r.j) == {"invocation_id": 'inv"1', "job": "build", "env": "prod", "airflow_run_id": "manual", "github_run_id": "local"}
    assert json.loads(r.m)["model"] == "dim_x"


def test_foreign_key_rule(spark):
    orders = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "order_id int, customer_id int")
    customers = spark.createDataFrame([(10,), (10,), (11,)], "customer_id int")
    tagged = foreign_key_rule(orders, customers, "customer_id")
    out = tag_rules(tagged, [Rule("orphan customer", F.col("_fk_missing"))])
    assert {r.order_id: r._reject_reason for r in out.collect()} == {1: None, 2: "orphan customer", 3: None}


def test_metadata_and_views(spark):
    df = with_metadata(spark.range(2), "fivetran", "order", "confidential", "2024-01-01 00:00:00", "b1")
    assert dict(df.dtypes)["_processed_at"] == "timestamp_ntz"
    register_views({"md_view": df})
    assert spark.sql("select count(distinct _batch_id) n from md_view").first().n == 1


def test_cli_runs_on_seeds(spark, scratch, capsys):
    from strata.plans.pipeline import main

    main(["--root", f"{scratch}/lake", "--seeds", SEEDS, "--env", "dev"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["written"]["fct_orders"] == 6


def test_scale_conf():
    from strata.session import scale_conf

    c = scale_conf(100 * 2**40, cores=8000)  # 100 TB on 8,000 cores
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(10 * 2**20, cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_broadcast_if_small(spark):
    from strata.operators.joins import broadcast_if_small, estimated_bytes

    small = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    big = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    assert estimated_bytes(small) < 1 << 20
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda side: big.join(side, big.c_nationkey == side.n_nationkey)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(broadcast_if_small(small))
        assert "BroadcastHashJoin" not in plan(broadcast_if_small(small, max_bytes=1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_input_schema_cache(spark):
    from strata.sources import tpch

    tpch.clear_schema_cache()
    a = tpch.read_table(spark, "/root/testdata/sf0.001", "region")
    assert "/root/testdata/sf0.001/region.parquet" in tpch._SCHEMAS
    b = tpch.read_table(spark, "/root/testdata/sf0.001", "region")
    assert a.schema == b.schema and b.count() == a.count() == 5
    tpch.clear_schema_cache()
    assert not tpch._SCHEMAS
