from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators import checks as chk
from strata.operators import runlog as R
from strata.operators.clone import sample_by_key
from strata.plans import declared as D
from strata.plans.pipeline import Batch, run_pipeline
from strata.sources.seeds import read_entity
from strata.streaming import dedupe_stream_to_table
from tests.conftest import SEEDS

NAMES = ("customers", "orders", "order_items", "products")


class _Any(dict):
    def __missing__(self, key):
        return None


def test_every_declared_test_is_there():
    t = _Any()
    suites = {"transient": D.transient_suite(), "bronze": D.bronze_suite(), "silver": D.silver_suite(t), "gold": D.gold_suite(t), "gold_analytics": D.analytics_suite()}
    assert {z: sum(map(len, s.values())) for z, s in suites.items()} == {"transient": 25, "bronze": 19, "silver": 35, "gold": 43, "gold_analytics": 28}
    assert all(c.severity == "error" for s in suites.values() for checks in s.values() for c in checks)
    assert Counter(c.kind for checks in suites["gold"].values() for c in checks) == {"not_null": 22, "between": 13, "unique": 3, "relationships": 2, "accepted_values": 2, "match_regex": 1}


def test_job_runs_all_zones_and_tags_the_run(spark, scratch):
    raws = {e: read_entity(spark, "dev", e, seeds_dir=SEEDS) for e in NAMES}
    log = f"{scratch}/log"
    r = run_pipeline(spark, raws, f"{scratch}/lake", batch=Batch("b1", "2024-02-01 06:00:00", "scheduled__1"), log_path=log)
    assert {z: len(rows) for z, rows in r.zone_checks.items()} == {"transient": 25, "bronze": 19, "silver": 35, "gold": 43, "gold_analytics": 28}
    parsed = R.parse_log(spark.read.parquet(log))
    assert R.run_in_order(parsed, "scheduled__1").count() == parsed.count() > 0
    assert R.run_failures(parsed, "scheduled__1").first().failures == 0
    assert R.run_failures(parsed, "unknown").first().failures == 0
    detail = R.invocation_detail(parsed, "b1").collect()
    assert [x.event_sequence for x in detail] == list(range(1, len(detail) + 1)) and len(detail) == parsed.count()
    assert R.recent(parsed, "2000-01-01 00:00:00").count() == parsed.count()
    assert R.recent(parsed, "2100-01-01 00:00:00").count() == 0


def test_relationships_with_hot_and_null_keys(spark):
    child = spark.createDataFrame([(1,)] * 5 + [(None,)] * 4 + [(9,)] * 3, "k int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    row = chk.run_checks(child, "t", [chk.Check("relationships", "k", to=parent, field_="k")]).first()
    assert (row.row_count, row.failures, row.status) == (12, 3, "error")
    none = chk.run_checks(child.limit(0), "t", [chk.Check("relationships", "k", to=parent, field_="k")]).first()
    assert (none.row_count, none.failures, none.status) == (0, 0, "pass")


def test_stream_keeps_one_row_per_key_however_late(spark, scratch):
    schema = "id int, ts timestamp, v string"
    land = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    import datetime as dt

    old, new = dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 1)
    land([(1, new, "a"), (1, new, "a"), (None, new, "n")])
    args = (spark, f"{scratch}/in", spark.createDataFrame([], schema).schema, ["id"], f"{scratch}/sink", f"{scratch}/ckpt")
    assert dedupe_stream_to_table(*args).count() == 2
    land([(1, new, "a"), (2, old, "late"), (None, old, "n")])  # years behind: still kept
    out = dedupe_stream_to_table(*args)
    assert sorted((r.id or 0, r.v) for r in out.collect()) == [(0, "n"), (1, "a"), (2, "late")]


def test_sample_by_key_is_stable_and_whole(spark):
    df = spark.range(20_000).select((F.col("id") % 5_000).alias("k"), "id")
    a, b = sample_by_key(df, "k", 10, seed=1), sample_by_key(df.repartition(7), "k", 10, seed=1)
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in b.collect())
    assert {r.n for r in a.groupBy("k").agg(F.count("*").alias("n")).collect()} == {4} and 350 < a.select("k").distinct().count() < 650
    assert sample_by_key(df, "k", 0).count() == 20_000 and sample_by_key(df, "k", 100).count() == 20_000
    with pytest.raises(ValueError):
        sample_by_key(df, "k", 101)
