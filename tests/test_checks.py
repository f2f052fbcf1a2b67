from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import checks as chk

C = chk.Check


def test_one_pass_row_checks_null_semantics(spark):
    df = spark.createDataFrame(
        [(1, "a", 5.0, "x@y.z"), (2, None, -1.0, "bad"), (2, "q", None, None), (None, "a", 10.0, "u@v.w")],
        "id int, s string, n double, e string",
    )
    checks = [
        C("not_null", "id"), C("not_null", "s"), C("accepted_values", "s", values=("a",)),
        C("between", "n", min=0, max=10), C("between", "n", min=0, max=10, strictly=True, severity="warn"),
        C("match_regex", "e", regex=r"^[^@]+@[^@]+\.[^@]+$"), C("unique", "id"),
        C("not_null", "s", where="id = 2"),
    ]
    summary = chk.run_checks(df, "t", checks)
    got = [(r.column_name, r.check_name, r.failures, r.status) for r in summary.collect()]
    assert ("id", "not_null", 1, "error") in got
    assert ("s", "not_null", 1, "error") in got
    assert ("s", "accepted_values", 1, "error") in got  # 'q' fails, NULL passes
    assert ("n", "between", 1, "error") in got  # -1 fails, NULL passes, 10 inclusive
    assert ("n", "between", 2, "warn") in got  # strictly: -1 and 10 fail
    assert ("e", "match_regex", 1, "error") in got
    assert ("id", "unique", 1, "error") in got  # value 2 twice; NULL ignored
    assert ("s", "not_null_where", 1, "error") in got
    assert all(r.row_count == 4 for r in summary.collect())
    # the row-level checks are one aggregate over one scan
    plan = chk.run_checks(df, "t", checks)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Scan ExistingRDD") == 2  # one for all row checks, one for unique


def test_relationships_and_grain(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, None), (12, 2)], "cid int, pid int")
    assert chk.orphans(child, "pid", parent, "id").count() == 1
    s = chk.run_checks(child, "child", [C("relationships", "pid", to=parent, field_="id", severity="warn")]).first()
    assert (s.failures, s.status, s.row_count) == (1, "warn", 4)
    assert [(r.cid, r.row_count) for r in chk.grain_violations(child, ["cid"]).collect()] == [(12, 2)]
    with pytest.raises(AssertionError):
        chk.raise_on_error(chk.run_checks(child, "child", [C("unique", "cid")]))


def test_row_count_diff_and_freshness(spark):
    a, b = spark.range(10), spark.range(7)
    r = chk.row_count_diff(a, b).first()
    assert (r.source_rows, r.target_rows, r.row_diff, r.status) == (10, 7, 3, "mismatch")
    r0 = chk.row_count_diff(a.where("false"), b.where("false")).first()
    assert (r0.source_rows, r0.row_diff, r0.status) == (0, 0, "match")
    ev = spark.createDataFrame([(dt.datetime(2024, 1, 31, 0, 0),)], "ts timestamp_ntz")
    status = lambda now: chk.source_freshness(ev, "ts", now).first().status
    assert status("2024-01-31 06:00:00") == "pass"
    assert status("2024-01-31 13:00:00") == "warn"
    assert status("2024-02-01 01:00:00") == "error"
    assert chk.source_freshness(ev.where("false"), "ts", "2024-01-31 06:00:00").first().status == "error"


def test_contract(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id bigint, s string, x double")
    ok = T.StructType([T.StructField("s", T.StringType()), T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType())])
    assert chk.enforce_contract(df, ok).columns == ["s", "id", "x"]
    bad = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("y", T.StringType())])
    with pytest.raises(ValueError) as e:
        chk.enforce_contract(df, bad)
    msg = str(e.value)
    assert "missing column y" in msg and "undeclared column s" in msg and "column id is bigint" in msg
    coerced = chk.enforce_contract(df.drop("s", "x").withColumn("y", F.lit("k")), bad, coerce=True)
    assert dict(coerced.dtypes) == {"id": "int", "y": "string"}


def test_unique_violations_lists_offending_values(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert [(r.k, r.row_count) for r in chk.unique_violations(df, ["k"]).collect()] == [(1, 2)]
