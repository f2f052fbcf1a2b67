"""Cases that ordinary data lacks: NULLs that move, missing times, ties, partition moves, failed runs."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import clone as C
from strata.operators import load as L
from strata.operators import scd2 as S
from strata.operators.sequence import bucketed_lag, bucketed_row_number
from strata.plans.entities import ENTITIES
from strata.sources import tables as T

B = "2024-02-01 00:00:00"


def test_values_that_move_between_nullable_columns_are_updates(spark):
    old = spark.createDataFrame([(1, "x", None), (2, "a", "b")], "id int, p string, q string")
    new = spark.createDataFrame([(1, None, "x"), (2, "a", "b")], "id int, p string, q string")
    assert {r["id"]: r["_change"] for r in L.diff(old, new, ["id"]).collect()} == {1: "update", 2: "same"}
    assert [r["id"] for r in L.only_changed(new, old, ["id"]).collect()] == [1]
    hist = S.snapshot_check(None, old, "id", None, "2024-01-01 00:00:00")
    out = S.snapshot_check(hist, new, "id", None, B)
    assert out.where("id = 1").count() == 2 and out.where("id = 2").count() == 1


def test_missing_updated_at_keeps_every_current_row(spark):
    schema = "id int, v string, updated_at timestamp_ntz"
    t = dt.datetime(2024, 1, 1)
    hist = S.snapshot_timestamp(None, spark.createDataFrame([(1, "a", None), (2, "b", t), (3, "c", t), (4, "d", None)], schema), "id", "updated_at", "2024-01-02 00:00:00")
    src = spark.createDataFrame([(1, "a2", t), (2, "b2", None), (3, "c", t), (4, "d2", None)], schema)
    out = S.snapshot_timestamp(hist, src, "id", "updated_at", B)
    current = {r["id"]: r["v"] for r in out.where(F.col(S.VALID_TO).isNull()).collect()}
    assert current == {1: "a2", 2: "b", 3: "c", 4: "d"}
    assert out.where(F.col(S.VALID_FROM).isNull()).isEmpty()


def test_merge_source_must_be_unique(spark, scratch):
    src = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    with pytest.raises(ValueError):
        L.merge_upsert(src.limit(1), src, ["id"])
    with pytest.raises(ValueError):
        L.merge_table(src, f"{scratch}/t", ["id"])


def test_partitioned_merge_moves_keys_and_keeps_null_partitions(spark, scratch):
    schema, path = "id int, v string, p string", f"{scratch}/t"
    L.merge_table(spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "c", None), (4, "d", "y")], schema), path, ["id"], partition_by=["p"])
    L.merge_table(spark.createDataFrame([(2, "b2", None)], schema), path, ["id"], partition_by=["p"])
    rows = lambda: sorted((r["id"], r["v"], r["p"]) for r in spark.read.parquet(path).collect())
    assert rows() == [(1, "a", "x"), (2, "b2", None), (3, "c", None), (4, "d", "y")]
    L.merge_table(spark.createDataFrame([(1, "a2", "y"), (3, "c2", "z")], schema), path, ["id"], partition_by=["p"])
    assert rows() == [(1, "a2", "y"), (2, "b2", None), (3, "c2", "z"), (4, "d", "y")]


def test_stored_sync_keeps_rows_of_partitioned_tables(spark, scratch):
    path = f"{scratch}/t"
    t = dt.datetime(2024, 1, 1)
    L.append_table(spark.createDataFrame([(1, t, "x")], "id int, ts timestamp_ntz, p string"), path, "ts", partition_by=["p"])
    L.append_table(spark.createDataFrame([(2, t + dt.timedelta(1), "y", "new")], "id int, ts timestamp_ntz, p string, extra string"), path, "ts", partition_by=["p"], on_schema_change="sync_all_columns")
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2]


def test_marks_of_other_types(spark, scratch):
    ids = spark.createDataFrame([(1,), (2,)], "id bigint")
    assert L.new_rows_since(ids, ids.limit(0), "id").count() == 2
    assert L.new_rows_since(ids, ids.where("id = 1"), "id").count() == 1
    zoned = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS ts UNION ALL SELECT timestamp'2024-01-01 01:00:00'")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert L.new_rows_since(zoned, zoned.orderBy("ts").limit(1), "ts").count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("entity", sorted(ENTITIES))
def test_dedupe_does_not_depend_on_the_order_of_rows(spark, entity):
    """Rows of one key with equal times that differ in any one column: the same one is kept however they come."""
    from strata.plans import zones as Z
    from strata.sources.seeds import SEED_SCHEMAS

    e, schema = ENTITIES[entity], SEED_SCHEMAS[entity]
    plain = {"string": "a", "timestamp_ntz": dt.datetime(2024, 1, 1), "date": dt.date(2024, 1, 1), "boolean": False}
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    first = {c: plain.get(k, Decimal(1) if k.startswith("decimal") else 1) for c, k in kinds.items()}
    other = {"string": "b", "boolean": True}
    rows = [first] + [{**first, c: other.get(kinds[c], None)} for c in e.columns if c not in (e.key, "created_at", "updated_at")]
    kept = []
    for some in (rows, rows[::-1]):
        df = spark.createDataFrame([tuple(r[c] for c in schema.names) for r in some], schema).coalesce(1)
        trn = Z.transient(df, entity, "b", "2024-02-01 06:00:00").withColumn("_is_valid", F.lit(True))
        kept.append([tuple(r) for r in Z.silver_validated(Z.bronze(trn, entity, "2024-02-01 06:00:00"), entity, "2024-02-01 06:00:00").collect()])
    assert len(kept[0]) == 1 and kept[0] == kept[1]


def test_interrupted_swap_is_put_back(spark, scratch):
    path = f"{scratch}/t"
    T.write_table(spark.range(3), path)
    fs, p = T._jvm_path(spark, path)
    fs.rename(p, T._jvm_path(spark, f"{path}.__old_x")[1])
    assert T.table_exists(spark, path) and spark.read.parquet(path).count() == 3


def test_clone_names_and_masks(spark, scratch):
    df = spark.createDataFrame([(1, "a@b.c")], "id int, email string")
    with pytest.raises(ValueError):
        C.drop_ci_schema(spark, scratch, "PR_1/../silver")
    with pytest.raises(ValueError):
        C.clone_for_ci(spark, {("gold", "t"): df}, scratch, "PR_1", table_list="gold.missing")
    with pytest.raises(ValueError):
        C.clone_for_ci(spark, {("gold", "t"): df}, scratch, "PR_1", masks={"other": {"email": "null"}})
    C.clone_for_ci(spark, {("gold", "T"): df}, scratch, "PR_1", masks={"t": {"email": "null"}})
    assert spark.read.parquet(f"{scratch}/PR_1/{C.clone_name('gold', 'T')}").first()["email"] is None


def test_null_groups_in_buckets(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (None, 3)], "g string, t int")
    out = bucketed_lag(df, ["g"], ["t"], F.col("t") % 2, ["t"]).count()
    assert out == 3
    rows = bucketed_row_number(df, ["g"], ["t"], F.col("t"), "n").orderBy("t").collect()
    assert [r["n"] for r in rows] == [1, 2, 3]
    lags = bucketed_lag(df, ["g"], ["t"], F.col("t"), ["t"]).orderBy("t").collect()
    assert [r["prev_t"] for r in lags] == [None, 1, 2]
