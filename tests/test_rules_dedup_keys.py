from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.functions.keys import NULL_MARKER, surrogate_key
from strata.functions.metrics import safe_divide, tier
from strata.functions.text import clean_columns
from strata.operators.dedup import latest_per_key
from strata.operators.rules import Rule, business_rules, split_valid, tag_rules, technical_rules


def test_first_failing_rule_wins_and_null_passes(spark):
    df = spark.createDataFrame(
        [(1, None, 5), (2, -1, -1), (3, 4, -2), (4, 3, 3)], "id int, a int, b int"
    )
    rules = [Rule("a negative", F.col("a") < 0), Rule("b negative", F.col("b") < 0)]
    got = {r.id: (r._reject_reason, r._is_valid) for r in tag_rules(df, rules).collect()}
    assert got == {1: (None, True), 2: ("a negative", False), 3: ("b negative", False), 4: (None, True)}


def test_split_is_a_partition_of_the_input(spark):
    df = spark.range(100).withColumn("x", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 5))
    clean, rej = split_valid(df, [Rule("x is four", F.col("x") == 4)])
    assert clean.count() + rej.count() == 100
    assert clean.join(rej, "id").count() == 0
    assert rej.where(F.col("x") != 4).count() == 0


def test_technical_rule_order_and_names():
    assert [r.reason for r in technical_rules("orders")] == [
        "order_id is null", "customer_id is null", "order_date is null", "total_amount is null",
    ]


def test_business_rules_three_valued_logic(spark):
    # NULL total passes 'total_amount <= 0'; NULL status fails nothing either (NOT IN on NULL is NULL)
    df = spark.createDataFrame(
        [(1, "2024-01-01", "WEIRD", 5.0), (2, "2024-01-01", None, None), (3, None, "PENDING", -1.0), (4, "2024-01-01", "PENDING", 0.0)],
        "order_id int, order_date string, status string, total_amount double",
    )
    got = {r.order_id: r._reject_reason for r in tag_rules(df, business_rules("orders")).collect()}
    assert got == {1: "unknown order status", 2: None, 3: "missing order date", 4: "invalid total amount"}


def test_latest_per_key_total_order(spark):
    df = spark.createDataFrame(
        [(1, 10, "a"), (1, 20, "b"), (1, 20, "c"), (2, 5, "x"), (2, None, "y")], "k int, t int, v string"
    )
    got = {r.k: r.v for r in latest_per_key(df, ["k"], ["t desc"], tie_break=["v desc"]).collect()}
    assert got == {1: "c", 2: "x"}  # NULL sorts last; tie broken by v desc
    with pytest.raises(ValueError):
        latest_per_key(df, ["k"], [])


def test_latest_per_key_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = latest_per_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_surrogate_key_null_marker_and_refuses_doubles(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (1, 1)], "a int, b int")
    keys = [r.k for r in df.select(surrogate_key("a", "b", df=df).alias("k")).collect()]
    assert len(set(keys)) == 3
    one = df.where("a = 1 and b is null").select(surrogate_key("a", "b").alias("k")).first().k
    exp = df.sparkSession.sql(f"select md5('1-{NULL_MARKER}') as k").first().k
    assert one == exp
    dbl = spark.createDataFrame([(1.5,)], "x double")
    with pytest.raises(TypeError):
        surrogate_key("x", df=dbl)


def test_standardize_and_rename(spark):
    df = spark.createDataFrame([("  ana maria ", " IL ", " Bo@Mail.COM ")], "name string, state string, email string")
    r = clean_columns(df, [("name", "initcap"), ("state", "upper", "state_code"), ("email", "lower")]).first()
    assert (r.name, r.state_code, r.email) == ("Ana Maria", "IL", "bo@mail.com")


def test_tier_and_safe_divide(spark):
    df = spark.createDataFrame([(None, 0), (1500.0, 3), (600.0, 2), (150.0, 1), (5.0, 1)], "v double, n int")
    th = [(1000, "VIP"), (500, "Premium"), (100, "Regular")]
    rows = df.select(tier(F.col("v"), th, "New").alias("t"), safe_divide(F.coalesce("v", F.lit(0.0)), F.col("n")).alias("d")).collect()
    assert [r.t for r in rows] == ["New", "VIP", "Premium", "Regular", "New"]
    assert rows[0].d == 0.0 and rows[1].d == 500.0
