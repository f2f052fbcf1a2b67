"""Streams into versioned tables: repeated epochs, late rows, bounded state."""

from __future__ import annotations

import datetime as dt

import pytest

from strata.sources import versioned as V
from strata.streaming import epochs as E

S = "id int, ts timestamp_ntz, v string"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def land(spark, folder, rows):
    spark.createDataFrame(rows, S).coalesce(1).write.mode("append").parquet(folder)


def test_late_rows_are_set_aside_and_the_state_forgets(spark, scratch, monkeypatch):
    names = {n: f"{scratch}/{n}" for n in ("landing", "sink", "late", "state", "checkpoint")}
    schema = spark.createDataFrame([], S).schema

    def run():
        E.dedupe_epochs(spark, names["landing"], schema, ["id"], "ts", names["sink"], names["late"], names["state"], names["checkpoint"], "3 days", max_files_per_trigger=1)

    def ids(table):
        return sorted((r["id"] for r in V.read_version(spark, names[table]).collect()), key=repr)

    land(spark, names["landing"], [(1, at(1), "a"), (1, at(1), "again"), (2, at(2), "b"), (None, at(2), "n")])
    land(spark, names["landing"], [(2, at(2), "copy"), (None, at(3), "copy"), (3, at(9), "c"), (9, None, "no time")])
    run()
    assert ids("sink") == sorted([1, 2, 3, None], key=repr) and ids("late") == [9]
    assert sorted(V.load_version(spark, names["state"]).parts) == ["20240109"]  # days before the 6th are forgotten
    land(spark, names["landing"], [(1, at(1), "late"), (4, at(5, 23), "late"), (5, at(6), "on the mark"), (3, at(9), "copy")])
    # the run stops after the sink was written and is repeated
    real = V.write_parts

    def stop_before_state(df, path, *a, **k):
        if path == names["state"]:
            raise RuntimeError("stopped")
        return real(df, path, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(E, "write_parts", stop_before_state)
        with pytest.raises(Exception, match="stopped"):
            run()
    run()
    assert ids("sink") == sorted([1, 2, 3, 5, None], key=repr) and ids("late") == [1, 4, 9]
    assert {r["_reason"]: r["n"] for r in E.late_counts(spark, names["late"]).collect()} == {"late": 2, "untimed": 1}
    run()  # nothing new
    assert len(ids("sink")) == 5


def test_an_ingest_epoch_that_is_repeated_leaves_one_copy(spark, scratch, monkeypatch):
    from strata.sources.seeds import SEED_SCHEMAS, read_entity
    from tests.conftest import SEEDS

    orders = read_entity(spark, "dev", "orders", seeds_dir=SEEDS)
    for part in (orders.where("order_id < 104"), orders.where("order_id >= 104")):
        part.coalesce(1).write.mode("append").parquet(f"{scratch}/landing")
    args = (spark, f"{scratch}/landing", SEED_SCHEMAS["orders"], "orders", f"{scratch}/brz", f"{scratch}/rej", f"{scratch}/ckpt", "s", "2024-02-01 06:00:00", 1)
    real = V.write_parts

    def stop_at_rejects(df, path, *a, **k):
        if path.endswith("/rej") and V.load_version(spark, f"{scratch}/rej") is not None:
            raise RuntimeError("stopped")
        return real(df, path, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(E, "write_parts", stop_at_rejects)
        with pytest.raises(Exception, match="stopped"):
            E.ingest_epochs(*args)
    E.ingest_epochs(*args)
    got = sorted(r["order_id"] for r in V.read_version(spark, f"{scratch}/brz").collect())
    assert len(got) == len(set(got)) == orders.count() - 1
    assert [r["order_id"] for r in V.read_version(spark, f"{scratch}/rej").collect()] == [107]


def test_an_epoch_of_many_files_is_written_by_many_tasks(spark, scratch):
    """Rows of one part met in one partition before, whatever their number."""
    from pyspark.sql import functions as F

    from strata.sources.seeds import SEED_SCHEMAS, read_entity
    from tests.conftest import SEEDS

    def filled(folder):
        return spark.read.parquet(folder).select(F.input_file_name()).distinct().count()

    orders = read_entity(spark, "dev", "orders", seeds_dir=SEEDS)
    orders.repartition(4).write.parquet(f"{scratch}/landing")
    E.ingest_epochs(spark, f"{scratch}/landing", SEED_SCHEMAS["orders"], "orders", f"{scratch}/brz", f"{scratch}/rej", f"{scratch}/ckpt", "s", "2024-02-01 06:00:00")
    (made,) = V.load_version(spark, f"{scratch}/brz").directories
    assert filled(f"{scratch}/brz/{made}") > 1
    V.replace_table(orders.repartition(4), f"{scratch}/whole")
    (made,) = V.load_version(spark, f"{scratch}/whole").directories
    assert filled(f"{scratch}/whole/{made}") > 1 and V.read_version(spark, f"{scratch}/whole").count() == orders.count()


def test_a_load_lands_in_many_files_and_is_one_epoch(spark, scratch):
    import glob

    from strata.plans import stored

    load = spark.range(1000, numPartitions=4).select("id")
    seen = []

    def run(root):
        E._run(spark, f"{root}/landing", load.schema, f"{root}/checkpoint", lambda batch, epoch: seen.append((epoch, batch.count())), None)

    root = stored._landed(spark, "t", [load, load.where("id < 10")], run)
    assert seen == [(0, 1000), (1, 10)]
    assert len(glob.glob(f"{root.removeprefix('file:')}/landing/part-*.parquet")) > 2
