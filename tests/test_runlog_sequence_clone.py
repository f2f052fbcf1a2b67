from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import runlog as R
from strata.operators.clone import clone_for_ci, drop_ci_schema, mask_columns, parse_table_list, sample_table
from strata.operators.sequence import bucketed_lag, bucketed_row_number
from strata.sources.tables import table_exists

T = dt.datetime


def _events(spark, n=400, groups=3, seed=3):
    rnd = random.Random(seed)
    # group 0 is hot: about a third of the rows sit in one key
    rows = [(rnd.choice([0, 0, 0, 1, 2][: 3 + groups - 1]), T(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(60 * 24 * 5)), i, rnd.randrange(100)) for i in range(n)]
    return spark.createDataFrame(rows, "g int, ts timestamp_ntz, qid int, x int")


def test_bucketed_row_number_equals_window(spark):
    df = _events(spark)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("ts", "qid")))
    got = bucketed_row_number(df, ["g"], ["ts", "qid"], F.date_trunc("day", "ts"), "rn")
    assert sorted(map(tuple, got.select("qid", "rn").collect())) == sorted(map(tuple, ref.select("qid", "rn").collect()))


def test_bucketed_lag_equals_window(spark):
    df = _events(spark)
    ref = df.withColumn("prev_x", F.lag("x").over(Window.partitionBy("g").orderBy("ts", "qid")))
    got = bucketed_lag(df, ["g"], ["ts", "qid"], F.date_trunc("day", "ts"), ["x"])
    assert sorted(map(tuple, got.select("qid", "prev_x").collect())) == sorted(map(tuple, ref.select("qid", "prev_x").collect()))


def test_bucketed_lag_with_ties_and_missing_times_reads_its_input_once(spark, tmp_path):
    day = lambda d: None if d is None else T(2024, 1, d)
    rows = [(g, day(d), i) for i, (g, d) in enumerate([(1, 1), (1, 1), (1, 1), (1, 4), (1, None), (1, None), (1, 9), (None, 2), (None, 3), (2, None)])]
    spark.createDataFrame(rows, "g int, ts timestamp_ntz, q int").write.parquet(f"{tmp_path}/log")
    df = spark.read.parquet(f"{tmp_path}/log")
    out = bucketed_lag(df, ["g"], ["ts"], F.date_trunc("day", "ts"), ["q", "ts"])
    assert out.columns == ["g", "ts", "q", "prev_q", "prev_ts"]
    got = out.collect()
    for g, times in ((1, [1, 1, 1, 4, 9, None, None]), (None, [2, 3]), (2, [None])):
        before = {r.q: r.prev_q for r in got if r.g == g}
        chain = [q for q in before if before[q] is None]
        while len(chain) < len(before):  # whichever way ties fall, every row follows exactly one other
            chain += [q for q in before if before[q] == chain[-1]]
        assert [rows[q][1] for q in chain] == [day(d) for d in times] and len(chain) == len(times)
        assert all(r.prev_ts == (None if r.prev_q is None else rows[r.prev_q][1]) for r in got if r.g == g)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Join" not in plan


def test_parse_log_filters_and_sequences(spark):
    tag = lambda **kw: R.tag_text(**kw)
    rows = [
        (tag(invocation_id="i1", job="j", env="prod", model="m1"), "q1", T(2024, 1, 1, 1), T(2024, 1, 1, 1, 1), 60000, "SUCCESS", None, None, 5, 0, 0, 5, "INSERT"),
        (tag(invocation_id="i1", job="j", env="prod", model="m2"), "q2", T(2024, 1, 1, 2), T(2024, 1, 1, 2, 1), 1500, "FAIL", "1", "boom", None, None, None, None, "MERGE"),
        (tag(invocation_id="i1", job="j", env="prod"), "q3", T(2024, 1, 1, 3), T(2024, 1, 1, 3), 10, "SUCCESS", None, None, 1, 0, 0, 1, "INSERT"),
        ("{not json", "q4", T(2024, 1, 1, 4), T(2024, 1, 1, 4), 10, "SUCCESS", None, None, 1, 0, 0, 1, "INSERT"),
        (tag(invocation_id="i1", job="j", env="prod", model="m3"), "q5", T(2024, 1, 1, 5), T(2024, 1, 1, 5), 10, "SUCCESS", None, None, 1, 0, 0, 1, "SELECT"),
        (None, "q6", T(2024, 1, 1, 6), T(2024, 1, 1, 6), 10, "SUCCESS", None, None, 1, 0, 0, 1, "INSERT"),
    ]
    log = R.parse_log(spark.createDataFrame(rows, R.LOG_SCHEMA))
    got = sorted((r.query_id, r.model, r.event_sequence, r.duration_seconds) for r in log.collect())
    assert got == [("q1", "m1", 1, 60.0), ("q2", "m2", 2, 1.5)]
    s = R.invocation_summary(log).first()
    assert (s.models_run, s.models_failed, s.rows_inserted) == (2, 1, 5)


def test_log_entry_roundtrip(spark):
    tag = R.tag_text(invocation_id="inv", job="build", env="dev", model="dim_x", schema="gold", materialized="table")
    e = R.log_entry(spark, tag, "q", T(2024, 1, 1), T(2024, 1, 1, 0, 0, 2), "SUCCESS", 10)
    r = R.parse_log(e).first()
    assert (r.model, r.duration_seconds, r.rows_inserted, r.event_sequence) == ("dim_x", 2.0, 10, 1)


def test_mask_and_clone(spark, scratch):
    df = spark.createDataFrame([(1, "ann@x.com", "555-1234", "pii"), (2, "bo@y.com", "555-9876", "public")], "id int, email string, phone string, _sensitivity_tag string")
    m = {r.id: (r.email, r.phone) for r in mask_columns(df, {"email": "redact_email", "phone": "keep_last4"}).collect()}
    assert m == {1: ("***@x.com", "***1234"), 2: ("bo@y.com", "555-9876")}
    assert sample_table(df, 0).count() == 2
    assert parse_table_list(" SILVER.SLV_A , GOLD.DIM_B") == [("SILVER", "SLV_A"), ("GOLD", "DIM_B")]
    tables = {("SILVER", "slv_a"): df, ("GOLD", "dim_b"): df}
    msg = clone_for_ci(spark, tables, scratch, "PR_7", pct=0, table_list="SILVER.SLV_A")
    assert "1 tables" in msg and "mode=slim" in msg
    assert table_exists(spark, f"{scratch}/PR_7/SILVER_SLV_A")
    with pytest.raises(ValueError):
        clone_for_ci(spark, tables, scratch, "GOLD", pct=0)
    drop_ci_schema(spark, scratch, "PR_7")
    assert not table_exists(spark, f"{scratch}/PR_7")
    big = spark.range(20000)
    n = sample_table(big, 10, seed=1).count()
    assert 1500 < n < 2500


def test_null_mask_keeps_type(spark):
    df = spark.createDataFrame([(1, 42, "pii")], "id int, secret int, _sensitivity_tag string")
    out = mask_columns(df, {"secret": "null"})
    assert dict(out.dtypes)["secret"] == "int" and out.first().secret is None
    with pytest.raises(ValueError):
        mask_columns(df, {"secret": "rot13"})
