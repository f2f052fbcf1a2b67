"""Versioned tables and the merges, windows and schema changes stored on them."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.operators import bucketed as B
from strata.sources import versioned as V

D = dt.datetime


def files(path):
    out = {}
    for folder, _, names in os.walk(path):
        if "_commits" in folder:
            continue
        for n in names:
            if n.endswith(".parquet"):
                f = os.path.join(folder, n)
                out[os.path.relpath(f, path)] = open(f, "rb").read()
    return out


def rows(spark, path, **kw):
    return sorted(map(tuple, V.read_version(spark, path, **kw).collect()), key=repr)


def live(spark, path):
    return V.load_version(spark, path).directories


# --------------------------------------------------------------------------- commits
def test_replace_keeps_older_versions_readable(spark, scratch):
    p = f"{scratch}/t"
    assert V.load_version(spark, p) is None
    with pytest.raises(FileNotFoundError):
        V.read_version(spark, p)
    first = V.replace_table(spark.range(3), p)
    before = files(p)
    V.replace_table(spark.range(5), p)
    assert rows(spark, p) == [(i,) for i in range(5)] and rows(spark, p, version=first) == [(i,) for i in range(3)]
    assert before.items() <= files(p).items()  # nothing of the first version was moved or changed


@pytest.mark.parametrize("stop_at", ["stage", "commit"])
def test_a_write_that_stops_leaves_the_table_as_it_was(spark, scratch, monkeypatch, stop_at):
    p = f"{scratch}/t"
    V.replace_table(spark.range(3), p)

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        if stop_at == "stage":  # after the new files were written
            real = V.stage
            m.setattr(V, "stage", lambda df, path: (real(df, path), stop()))
        else:
            m.setattr(V, "commit", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            V.replace_table(spark.range(9), p)
    assert rows(spark, p) == [(0,), (1,), (2,)]
    assert V.vacuum(spark, p, older_than=0) and rows(spark, p) == [(0,), (1,), (2,)]  # what the stopped write left
    V.replace_table(spark.range(4), p)
    assert len(rows(spark, p)) == 4


def test_of_two_writers_one_commits(spark, scratch):
    p = f"{scratch}/t"
    base = V.replace_table(spark.range(3), p)
    part = F.lit("all")
    V.write_parts(spark.range(4).withColumn(V.PART, part), p, base, replaced=None)
    with pytest.raises(V.CommitConflict):
        V.write_parts(spark.range(5).withColumn(V.PART, part), p, base, replaced=None)
    assert len(rows(spark, p)) == 4
    assert not [n for n in os.listdir(f"{p}/_commits") if n.endswith(".tmp")]


def test_vacuum_spares_the_kept_versions_and_young_directories(spark, scratch):
    p = f"{scratch}/t"
    for n in (1, 2, 3):
        V.replace_table(spark.range(n), p)
    assert V.vacuum(spark, p, keep=2, older_than=3600) == []
    V.replace_table(spark.range(4), p)
    assert len(V.vacuum(spark, p, keep=2, older_than=0)) >= 1
    assert len(rows(spark, p)) == 4 and len(rows(spark, p, version=V.load_version(spark, p, 3))) == 3
    assert V.load_version(spark, p, 1) is None


def test_empty_tables_and_odd_part_names(spark, scratch):
    p = f"{scratch}/t"
    V.replace_table(spark.range(0), p)
    assert rows(spark, p) == []
    V.replace_table(spark.createDataFrame([(1, "a b/c=ü%"), (2, "x")], "id int, p string"), p, F.col("p"))
    assert rows(spark, p) == [(1, "a b/c=ü%"), (2, "x")] and rows(spark, p, parts=["a b/c=ü%"]) == [(1, "a b/c=ü%")]


# --------------------------------------------------------------------------- merge
def table(spark, ids, v):
    return spark.createDataFrame([(i, v) for i in ids], "id bigint, v string")


@pytest.mark.parametrize("layout", ["hash", "range"])
def test_a_one_percent_merge_rewrites_in_proportion(spark, scratch, layout):
    p = f"{scratch}/t"
    part = B.hash_part(["id"], 64) if layout == "hash" else B.range_part("id", 100)
    B.merge_parts(table(spark, range(10_000), "a"), p, ["id"], part)
    before, dirs = files(p), set(live(spark, p))
    some = range(500, 600) if layout == "range" else range(500, 501)
    c = B.merge_parts(table(spark, some, "b"), p, ["id"], part)
    assert (c.inserted, c.updated, c.deleted) == (0, len(some), 0)
    assert before.items() <= files(p).items()
    new = set(live(spark, p)) - dirs
    assert len(new) == 1 and len(dirs - set(live(spark, p))) == 1 and len(dirs) >= 60
    assert V.read_version(spark, p).where("v = 'b'").count() == len(some) and V.read_version(spark, p).count() == 10_000
    again = B.merge_parts(table(spark, some, "b"), p, ["id"], part)
    assert not again.any and again.version.number == 2  # a repeated merge commits nothing


def test_merge_with_deletes_nulls_new_columns_and_feed(spark, scratch):
    p = f"{scratch}/t"
    part = B.hash_part(["id"], 4)
    s = "id int, v string"
    B.merge_parts(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (4, None)], s), p, ["id"], part)
    src = spark.createDataFrame([(1, "A", 9), (None, "N", None), (4, None, None), (5, "e", 7)], s + ", w int")
    c = B.merge_parts(src, p, ["id"], part, deletes=spark.createDataFrame([(2,), (77,), (5,)], "id int"))
    assert rows(spark, p) == sorted([(1, "A", 9), (None, "N", None), (4, None, None), (5, "e", 7)], key=repr)
    assert (c.inserted, c.updated, c.deleted) == (1, 2, 1)
    feed = {r["id"]: (r["_old"] and r["_old"]["v"], r["_new"] and r["_new"]["v"]) for r in c.rows.collect()}
    assert feed == {1: ("a", "A"), None: ("n", "N"), 2: ("b", None), 5: (None, "e")}
    with pytest.raises(ValueError, match="not unique"):
        B.merge_parts(spark.createDataFrame([(1, "x"), (1, "y")], s), p, ["id"], part)
    B.merge_parts(spark.createDataFrame([(1, "x"), (1, "y")], s), p, ["id"], part, dedupe_order=["v desc"])
    assert (1, "y", None) in rows(spark, p)


def test_a_key_that_moves_rewrites_its_two_partitions(spark, scratch):
    p = f"{scratch}/t"
    s = "id int, day date, v string"
    data = [(m * 10 + i, dt.date(2024, m, 5), "a") for m in range(1, 13) for i in range(5)] + [(999, None, "a")]
    part = B.time_part("day")
    B.merge_parts(spark.createDataFrame(data, s), p, ["id"], part, part_of_key=False)
    before = V.load_version(spark, p).parts
    c = B.merge_parts(spark.createDataFrame([(20, dt.date(2024, 7, 1), "b"), (999, dt.date(2024, 7, 2), "b")], s), p, ["id"], part, part_of_key=False)
    after = V.load_version(spark, p).parts
    assert {q for q in {*before, *after} if before.get(q) != after.get(q)} == {"202402", "202407", B.NO_DATE}
    assert c.updated == 2 and B.NO_DATE not in after
    assert V.read_version(spark, p, parts=["202407"]).count() == 7 and V.read_version(spark, p).count() == 61


def test_full_refresh_forgets(spark, scratch):
    p = f"{scratch}/t"
    part = B.hash_part(["id"], 4)
    B.merge_parts(table(spark, range(5), "a"), p, ["id"], part)
    B.merge_parts(table(spark, range(2), "b"), p, ["id"], part, full_refresh=True)
    assert rows(spark, p) == [(0, "b"), (1, "b")]


# --------------------------------------------------------------------------- windows
def test_replace_window_leaves_other_parts_alone(spark, scratch):
    p, s = f"{scratch}/t", "id int, ts timestamp_ntz, v string"
    data = [(d, D(2024, 1, 1) + dt.timedelta(days=7 * d), "a") for d in range(20)] + [(99, None, "a")]
    V.replace_table(spark.createDataFrame(data, s), p, B.time_part("ts"))
    before = V.load_version(spark, p).parts
    src = spark.createDataFrame([(i, t, "b") for i, t, _ in data], s)
    B.replace_window(src, p, "ts", D(2024, 2, 10), D(2024, 3, 10))
    after = V.load_version(spark, p).parts
    assert {q for q in before if before[q] != after.get(q)} == {"202402", "202403"}
    want = [(i, t, "b" if t and D(2024, 2, 10) <= t < D(2024, 3, 10) else "a") for i, t, _ in data]
    assert rows(spark, p) == sorted(want, key=repr)


def test_lookback_touches_its_window_and_rows_without_a_time(spark, scratch):
    p, s = f"{scratch}/t", "id int, ts timestamp_ntz, v string"
    data = [(d, D(2024, 1, 1) + dt.timedelta(days=d), "a") for d in range(20)] + [(50, None, "a")]
    V.replace_table(spark.createDataFrame(data, s), p, B.time_part("ts", "yyyyMMdd"))
    before = V.load_version(spark, p).parts
    src = spark.createDataFrame([(d, D(2024, 1, 1) + dt.timedelta(days=d), "b") for d in range(22)] + [(50, None, "b"), (51, None, "b"), (3, D(2024, 1, 19, 5), "late")][0:2], s)
    B.lookback_parts(src, p, "ts", ["id"], "3 days")
    after = V.load_version(spark, p).parts
    assert all(after[q] == before[q] for q in before if q != B.NO_DATE and q < "20240118")
    want = [(i, t, "b" if t is None or i > 16 else "a") for i, t, _ in data]
    want = [(i, t, v) for i, t, v in want if i not in (50,)] + [(20, D(2024, 1, 21), "b"), (21, D(2024, 1, 22), "b"), (50, None, "b"), (51, None, "b")]
    want = [(i, t, "a" if i == 16 else v) for i, t, v in want]
    assert rows(spark, p) == sorted(want, key=repr)


# --------------------------------------------------------------------------- schema changes
def test_four_modes_with_added_dropped_and_retyped_columns(spark, scratch):
    old = spark.createDataFrame([(1, 10, "x"), (2, 20, "y")], "id int, n int, gone string")
    new = spark.createDataFrame([(3, "30", True), (4, "no number", False)], "id int, n string, added boolean")
    want = {
        "ignore": (["id", "n", "gone"], [(1, 10, "x"), (2, 20, "y"), (3, 30, None), (4, None, None)]),
        "append_new_columns": (["id", "n", "gone", "added"], [(1, 10, "x", None), (2, 20, "y", None), (3, 30, None, True), (4, None, None, False)]),
        "sync_all_columns": (["id", "n", "added"], [(1, "10", None), (2, "20", None), (3, "30", True), (4, "no number", False)]),
    }
    for mode, (cols, data) in want.items():
        p = f"{scratch}/{mode}"
        B.sync_table(old, p, mode)
        before = files(p)
        B.sync_table(new, p, mode)
        assert V.read_version(spark, p).columns == cols and rows(spark, p) == data, mode
        assert before.items() <= files(p).items()  # nothing was rewritten
        B.compact(spark, p)
        assert rows(spark, p) == data and len(live(spark, p)) == 1
        assert B.compact(spark, p).number == 3  # nothing left to do
    p = f"{scratch}/fail"
    B.sync_table(old, p, "fail")
    with pytest.raises(ValueError, match="schema changed"):
        B.sync_table(new, p, "fail")
    B.sync_table(old, p, "fail")
    assert len(rows(spark, p)) == 4


# --------------------------------------------------------------------------- change detection, clones, older forms
def test_digests_find_only_buckets_that_differ(spark):
    old = spark.createDataFrame([(i, "a") for i in range(500)] + [(None, "n")], "id int, v string")
    new = spark.createDataFrame([(i, "b" if i == 7 else "a") for i in range(1, 501)] + [(None, "n")], "id int, v string")
    got = sorted((r["id"], r["_change"], r["v"]) for r in B.diff_by_digest(old, new, ["id"], buckets=64).collect())
    assert got == [(0, "delete", "a"), (7, "update", "b"), (500, "insert", "a")]
    kept = B.digests(old, ["id"], 64).cache()
    broken = old.withColumn("v", F.raise_error(F.lit("was read")).cast("string"))
    assert B.diff_by_digest(broken, old, ["id"], buckets=64, old_digests=kept).collect() == []  # equal: the old extract is not read
    null = spark.createDataFrame([(None, "N"), (3, "a")], "id int, v string")
    assert [tuple(r) for r in B.diff_by_digest(null, null.replace("N", "M"), ["id"]).collect()] == [(None, "update", "M")]


def test_null_keys_match_in_change_detection(spark):
    from strata.operators.load import diff, only_changed

    df = spark.createDataFrame([(None, "a"), (1, "b")], "id int, v string")
    assert {r["_change"] for r in diff(df, df, ["id"]).collect()} == {"same"} and only_changed(df, df, ["id"]).count() == 0


def test_stored_sync_of_a_retyped_column(spark, scratch):
    from strata.operators.load import append_table

    p, t = f"{scratch}/t", dt.datetime(2024, 1, 1)
    append_table(spark.createDataFrame([(1, t)], "n int, ts timestamp_ntz"), p, "ts")
    append_table(spark.createDataFrame([("x", t + dt.timedelta(1))], "n string, ts timestamp_ntz"), p, "ts", on_schema_change="sync_all_columns")
    assert sorted(r["n"] for r in spark.read.parquet(p).collect()) == ["1", "x"]


def test_a_linked_sample_keeps_every_reference(spark, scratch):
    from strata.operators import clone as C

    tables = {
        ("silver", "c"): spark.createDataFrame([(i, f"city {i}") for i in range(200)], "cid int, city string"),
        ("silver", "o"): spark.createDataFrame([(i, i % 200 if i % 50 else None, "pii?") for i in range(600)], "oid int, cid int, shipping_address string").withColumn("_sensitivity_tag", F.lit("confidential")),
        ("silver", "i"): spark.createDataFrame([(i, i % 600, i % 37) for i in range(2000)], "iid int, oid int, pid int"),
        ("silver", "p"): spark.createDataFrame([(i,) for i in range(80)], "pid int"),
        ("silver", "x"): spark.range(5),
    }
    links = [C.Reference("o", "c", "cid"), C.Reference("i", "o", "oid"), C.Reference("i", "p", "pid")]
    said = C.clone_for_ci(spark, tables, scratch, "PR_1", pct=20, by_key=("c", "cid"), references=links)
    assert "5 tables" in said
    got = {t: spark.read.parquet(f"{scratch}/PR_1/{C.clone_name('silver', t)}") for t in "coipx"}
    assert 10 < got["c"].count() < 80 and got["x"].count() == 5
    for r in links:
        child = got[r.child].where(F.col(r.column).isNotNull())
        assert child.count() > 0 and child.join(got[r.parent], r.column, "left_anti").count() == 0, r
    assert got["o"].where("cid is null").count() == 12  # they refer to nobody
    assert got["p"].count() <= 37
    assert {len(r["shipping_address"]) for r in got["o"].collect()} == {64}  # masked, though not tagged pii
    with pytest.raises(ValueError, match="unknown tables"):
        C.sample_with_references({"c": tables["silver", "c"]}, "c", "cid", 5, links)


def test_a_merge_stores_what_changed_and_can_forget_it(spark, scratch):
    """Before, all rows of the touched parts lay under the checkpoint directory, and stayed there."""
    import os

    root = f"{B.materialize.__globals__['ensure_checkpoint_dir'](spark).removeprefix('file:').rstrip('/')}/strata_tables"
    names = lambda: {d for d in (os.listdir(root) if os.path.isdir(root) else ()) if d.startswith("merge_")}
    p, part, had = f"{scratch}/t", B.range_part("id", 1000), names()
    make = lambda lo, hi, v: spark.range(lo, hi).selectExpr("id", f"'{v}' AS v")
    B.merge_parts(make(0, 1000, "a"), p, ["id"], part).forget()
    c = B.merge_parts(make(990, 1010, "b"), p, ["id"], part, deletes=make(5, 7, "").select("id"))
    assert (c.inserted, c.updated, c.deleted) == (10, 10, 2)
    (left,) = names() - had
    assert spark.read.parquet(f"{root}/{left}").count() == 22
    c.forget()
    assert names() == had
    got = {r["id"]: r["v"] for r in V.read_version(spark, p).collect()}
    assert got == {i: "a" if i < 990 else "b" for i in range(1010) if i not in (5, 6)}
