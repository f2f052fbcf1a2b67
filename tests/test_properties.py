"""Property tests on random small frames (few examples each: every one is a Spark job)."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.load import merge_upsert
from strata.operators.rules import Rule, split_valid
from strata.operators.sequence import bucketed_lag, bucketed_row_number

SET = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
small_int = st.one_of(st.none(), st.integers(-3, 3))


@SET
@given(st.lists(st.tuples(small_int, small_int), min_size=0, max_size=30))
def test_clean_and_rejects_partition_the_input(spark, rows):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "id int, a int, b int")
    clean, rej = split_valid(df, [Rule("a", F.col("a") < 0), Rule("b", F.col("b") > F.col("a"))])
    c, r = {x.id for x in clean.collect()}, {x.id for x in rej.collect()}
    assert c.isdisjoint(r) and c | r == set(range(len(rows)))


@SET
@given(
    st.lists(st.tuples(small_int, st.integers(0, 9)), max_size=15),
    st.dictionaries(small_int, st.integers(0, 9), max_size=8),
)
def test_merge_is_idempotent_and_source_wins(spark, target, source):
    tgt = spark.createDataFrame(target, "k int, v int") if target else spark.createDataFrame([], "k int, v int")
    src = spark.createDataFrame(list(source.items()), "k int, v int") if source else spark.createDataFrame([], "k int, v int")
    once = merge_upsert(tgt, src, ["k"])
    twice = merge_upsert(once, src, ["k"])
    key = lambda r: (r.k is None, r.k or 0, r.v)
    assert sorted(once.collect(), key=key) == sorted(twice.collect(), key=key)
    got = once.collect()
    for k, v in source.items():
        assert [r.v for r in got if r.k == k] == [v]


@SET
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 60 * 24 * 4), st.integers(0, 50)), min_size=1, max_size=40))
def test_bucketed_sequence_and_lag_equal_plain_windows(spark, rows):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(g, base + dt.timedelta(minutes=m), i, x) for i, (g, m, x) in enumerate(rows)], "g int, ts timestamp_ntz, q int, x int"
    )
    w = Window.partitionBy("g").orderBy("ts", "q")
    ref = df.select("q", F.row_number().over(w).alias("rn"), F.lag("x").over(w).alias("prev_x"))
    b = F.date_trunc("day", "ts")
    got_rn = bucketed_row_number(df, ["g"], ["ts", "q"], b, "rn").select("q", "rn")
    got_lag = bucketed_lag(df, ["g"], ["ts", "q"], b, ["x"]).select("q", "prev_x")
    exp = {r.q: (r.rn, r.prev_x) for r in ref.collect()}
    rn = {r.q: r.rn for r in got_rn.collect()}
    lag = {r.q: r.prev_x for r in got_lag.collect()}
    assert {q: (rn[q], lag[q]) for q in exp} == exp


@SET
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 9)), min_size=1, max_size=30))
def test_latest_per_key_matches_brute_force(spark, rows):
    from strata.operators.dedup import latest_per_key

    df = spark.createDataFrame(rows, "k int, t int, v int")
    got = {(r.k, r.t, r.v) for r in latest_per_key(df, ["k"], ["t desc"], tie_break=["v desc"]).collect()}
    exp = set()
    for k in {r[0] for r in rows}:
        grp = [r for r in rows if r[0] == k]
        # t descending with NULLs last, then v descending
        exp.add(max(grp, key=lambda r: (r[1] is not None, r[1] if r[1] is not None else 0, r[2])))
    assert got == exp


@SET
@given(
    st.dictionaries(st.integers(0, 6), st.sampled_from("abc"), max_size=7),
    st.dictionaries(st.integers(0, 6), st.sampled_from("abc"), max_size=7),
)
def test_diff_matches_brute_force(spark, old, new):
    from strata.operators.load import diff

    o = spark.createDataFrame(list(old.items()), "id int, v string")
    n = spark.createDataFrame(list(new.items()), "id int, v string")
    got = {r.id: (r._change, r.v) for r in diff(o, n, ["id"]).collect()}
    exp = {}
    for k in set(old) | set(new):
        if k not in old:
            exp[k] = ("insert", new[k])
        elif k not in new:
            exp[k] = ("delete", old[k])
        else:
            exp[k] = ("same" if old[k] == new[k] else "update", new[k])
    assert got == exp
