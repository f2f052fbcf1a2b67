from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import load as L
from strata.sources.tables import table_exists, write_table


def _df(spark, rows):
    return spark.createDataFrame(rows, "id int, v string, ts timestamp_ntz")


T = dt.datetime


def test_high_water_mark_empty_target_uses_default(spark):
    empty = _df(spark, [(1, "a", T(2024, 1, 1))]).where(F.lit(False))
    assert L.high_water_mark(empty, "ts") == L.DEFAULT_HWM
    src = _df(spark, [(1, "a", T(2024, 1, 1)), (2, "b", T(2024, 1, 2))])
    assert L.new_rows_since(src, empty, "ts").count() == 2  # an empty target must not block loads


def test_append_strictly_newer_and_lookback(spark):
    tgt = _df(spark, [(1, "a", T(2024, 1, 10))])
    src = _df(spark, [(1, "a", T(2024, 1, 10)), (2, "b", T(2024, 1, 8)), (3, "c", T(2024, 1, 11))])
    assert sorted(r.id for r in L.new_rows_since(src, tgt, "ts").collect()) == [3]
    assert sorted(r.id for r in L.new_rows_since(src, tgt, "ts", lookback="3 days").collect()) == [1, 2, 3]
    assert L.append_incremental(src, tgt, "ts").count() == 2


def test_merge_upsert_idempotent_and_null_keys(spark):
    tgt = _df(spark, [(1, "old", T(2024, 1, 1)), (2, "keep", T(2024, 1, 1)), (None, "nullk", T(2024, 1, 1))])
    src = _df(spark, [(1, "new", T(2024, 1, 2)), (3, "ins", T(2024, 1, 2)), (None, "nullk2", T(2024, 1, 2))])
    once = L.merge_upsert(tgt, src, ["id"])
    got = sorted((r.id if r.id is not None else -1, r.v) for r in once.collect())
    assert got == [(-1, "nullk2"), (1, "new"), (2, "keep"), (3, "ins")]
    twice = L.merge_upsert(once, src, ["id"])
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_merge_dedupes_source(spark):
    src = _df(spark, [(1, "a", T(2024, 1, 1)), (1, "b", T(2024, 1, 2))])
    out = L.merge_upsert(None, src, ["id"], dedupe_order=["ts desc"]).collect()
    assert [(r.id, r.v) for r in out] == [(1, "b")]


def test_delete_insert_window(spark):
    tgt = _df(spark, [(1, "t", T(2024, 1, 1)), (2, "t", T(2024, 1, 5)), (3, "t", T(2024, 1, 9))])
    src = _df(spark, [(2, "s", T(2024, 1, 5)), (4, "s", T(2024, 1, 6)), (5, "s", T(2024, 1, 20))])
    out = L.delete_insert(tgt, src, "ts", T(2024, 1, 4), T(2024, 1, 8))
    assert sorted((r.id, r.v) for r in out.collect()) == [(1, "t"), (2, "s"), (3, "t"), (4, "s")]


def test_schema_change_modes(spark):
    tgt = spark.createDataFrame([(1, "a")], "id int, a string")
    src = spark.createDataFrame([(2, 5)], "id int, b int")
    assert L.append_with_schema_change(tgt, src, "ignore").columns == ["id", "a"]
    assert L.append_with_schema_change(tgt, src, "append_new_columns").columns == ["id", "a", "b"]
    assert L.append_with_schema_change(tgt, src, "sync_all_columns").columns == ["id", "b"]
    with pytest.raises(ValueError, match="schema changed"):
        L.append_with_schema_change(tgt, src, "fail")


def test_diff_and_only_changed(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "id int, v string")
    got = {r.id: r._change for r in L.diff(old, new, ["id"]).collect()}
    assert got == {1: "same", 2: "update", 3: "delete", 4: "insert"}
    assert sorted(r.id for r in L.only_changed(new, old, ["id"]).collect()) == [2, 4]


def test_append_table_second_run(spark, scratch):
    path = f"{scratch}/brz"
    first = _df(spark, [(1, "a", T(2024, 1, 1))])
    assert L.append_table(first, path, "ts") == 1
    second = _df(spark, [(1, "a", T(2024, 1, 1)), (2, "b", T(2024, 1, 2))])
    assert L.append_table(second, path, "ts") == 1
    assert L.append_table(second, path, "ts") == 0
    assert spark.read.parquet(path).count() == 2


def test_merge_table_partitioned_rewrites_only_touched(spark, scratch):
    path = f"{scratch}/tgt"
    base = spark.createDataFrame([(1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2")], "id int, v string, day string")
    L.merge_table(base, path, ["id"], partition_by=["day"])
    upd = spark.createDataFrame([(2, "B", "d1"), (4, "D", "d1")], "id int, v string, day string")
    L.merge_table(upd, path, ["id"], partition_by=["day"])
    got = sorted((r.id, r.v, r.day) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a", "d1"), (2, "B", "d1"), (3, "c", "d2"), (4, "D", "d1")]
    L.merge_table(upd, path, ["id"], partition_by=["day"])  # idempotent
    assert spark.read.parquet(path).count() == 4


def test_merge_table_unpartitioned_staged_swap(spark, scratch):
    path = f"{scratch}/t2"
    L.merge_table(spark.createDataFrame([(1, "a")], "id int, v string"), path, ["id"])
    L.merge_table(spark.createDataFrame([(1, "z"), (2, "b")], "id int, v string"), path, ["id"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "z"), (2, "b")]


def test_delete_insert_table_dynamic_partitions(spark, scratch):
    path = f"{scratch}/di"
    write_table(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, day string"), path, partition_by=["day"])
    L.delete_insert_table(spark.createDataFrame([(9, "2024-01-02")], "id int, day string"), path, "day")
    assert sorted(map(tuple, spark.read.parquet(path).selectExpr("id", "cast(day as string) as day").collect())) == [(1, "2024-01-01"), (9, "2024-01-02")]


def test_run_microbatch_and_retry_one_slice(spark, scratch):
    path = f"{scratch}/mb"
    ev = spark.createDataFrame([(i, T(2024, 1, 1 + i % 3, 5)) for i in range(9)], "id int, ts timestamp_ntz")

    def sink(df, s, e):
        df.withColumn("slice", F.lit(s.date().isoformat())).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("slice").parquet(path)

    done = L.run_microbatch(ev, "ts", T(2024, 1, 1), T(2024, 1, 4), dt.timedelta(days=1), lambda d: d, sink)
    assert len(done) == 3 and spark.read.parquet(path).count() == 9
    redo = L.run_microbatch(ev, "ts", T(2024, 1, 1), T(2024, 1, 4), dt.timedelta(days=1), lambda d: d, sink, only=[T(2024, 1, 2)])
    assert len(redo) == 1 and spark.read.parquet(path).count() == 9
    assert table_exists(spark, path)


def test_append_table_with_side_watermark(spark, scratch):
    path, marks = f"{scratch}/brz2", f"{scratch}/brz2_hwm"
    first = _df(spark, [(1, "a", T(2024, 1, 1)), (2, "b", T(2024, 1, 3))])
    assert L.append_table(first, path, "ts", hwm_path=marks) == 2
    assert spark.read.parquet(marks).first().hwm == T(2024, 1, 3)
    second = _df(spark, [(2, "b", T(2024, 1, 3)), (3, "c", T(2024, 1, 4))])
    assert L.append_table(second, path, "ts", hwm_path=marks) == 1
    assert L.append_table(second, path, "ts", hwm_path=marks) == 0
    assert spark.read.parquet(path).count() == 3
    assert L.high_water_mark(spark.read.parquet(marks), "hwm") == T(2024, 1, 4)


def test_append_table_schema_change_modes(spark, scratch):
    base = spark.createDataFrame([(1, "a", T(2024, 1, 1))], "id int, v string, ts timestamp_ntz")
    wider = spark.createDataFrame([(2, "b", T(2024, 1, 2), 7)], "id int, v string, ts timestamp_ntz, extra int")
    narrower = spark.createDataFrame([(3, T(2024, 1, 3))], "id int, ts timestamp_ntz")
    read = lambda p: spark.read.option("mergeSchema", "true").parquet(p)

    p1 = f"{scratch}/ign"
    L.append_table(base, p1, "ts")
    L.append_table(wider, p1, "ts", on_schema_change="ignore")
    assert sorted(read(p1).columns) == ["id", "ts", "v"] and read(p1).count() == 2

    p2 = f"{scratch}/add"
    L.append_table(base, p2, "ts")
    L.append_table(wider, p2, "ts", on_schema_change="append_new_columns")
    got = sorted((r.id, r.extra) for r in read(p2).collect())
    assert got == [(1, None), (2, 7)]

    p3 = f"{scratch}/sync"
    L.append_table(base, p3, "ts")
    L.append_table(narrower, p3, "ts", on_schema_change="sync_all_columns")
    assert sorted(read(p3).columns) == ["id", "ts"] and read(p3).count() == 2

    p4 = f"{scratch}/fail"
    L.append_table(base, p4, "ts")
    with pytest.raises(ValueError, match="schema changed"):
        L.append_table(wider, p4, "ts", on_schema_change="fail")


def test_high_water_mark_literal_ignores_python_time_zone(spark):
    import os
    import time

    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        src = _df(spark, [(1, "a", T(2024, 1, 1, 10)), (2, "b", T(2024, 1, 1, 12))])
        tgt = _df(spark, [(0, "t", T(2024, 1, 1, 11))])
        assert [r.id for r in L.new_rows_since(src, tgt, "ts").collect()] == [2]
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        time.tzset()


def test_merge_check_unique_raises(spark):
    src = _df(spark, [(1, "a", T(2024, 1, 1)), (1, "b", T(2024, 1, 2))])
    with pytest.raises(ValueError, match="not unique"):
        L.merge_upsert(None, src, ["id"], check_unique=True)
    assert L.merge_upsert(None, src.where("v = 'a'"), ["id"], check_unique=True).count() == 1


def test_delete_insert_keeps_null_window_values_and_retyped_columns(spark):
    tgt = _df(spark, [(1, "t", None), (2, "t", T(2024, 1, 5))])
    src = _df(spark, [(3, "s", T(2024, 1, 6))])
    out = L.delete_insert(tgt, src, "ts", T(2024, 1, 4), T(2024, 1, 8))
    assert sorted((r.id, r.v) for r in out.collect()) == [(1, "t"), (3, "s")]  # NULL ts is outside every window
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(2, 5)], "id int, v int")
    with pytest.raises(ValueError, match="retyped=\\['v'\\]"):
        L.align_schema(a, b, "fail")
    t, s = L.align_schema(a, b, "ignore")  # the target's type wins
    assert dict(s.dtypes)["v"] == "string" and t.unionByName(s).count() == 2
