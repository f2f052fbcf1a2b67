from __future__ import annotations

from pyspark.sql import functions as F

from strata.plans import zones as Z
from strata.sources.seeds import SEED_SCHEMAS, read_entity
from strata.streaming import dedupe_within_watermark, ingest_bronze
from tests.conftest import SEEDS


def test_stream_ingest_matches_batch_and_resumes(spark, scratch):
    orders = read_entity(spark, "dev", "orders", seeds_dir=SEEDS)
    landing = f"{scratch}/landing"
    orders.where("order_id < 104").write.parquet(f"{landing}/part1")
    args = dict(
        landing_path=f"{landing}/*", schema=SEED_SCHEMAS["orders"], entity="orders",
        bronze_path=f"{scratch}/brz", rejects_path=f"{scratch}/rej", checkpoint_path=f"{scratch}/ckpt",
        run_id="s", clock="2024-02-01 06:00:00",
    )
    ingest_bronze(spark, **args)
    assert spark.read.parquet(f"{scratch}/brz").count() == 3
    orders.where("order_id >= 104").write.parquet(f"{landing}/part2")
    ingest_bronze(spark, **args)  # only the new file is read: the checkpoint is the high-water mark
    brz = spark.read.parquet(f"{scratch}/brz")
    batch = Z.bronze(Z.transient(orders, "orders", "x", "2024-02-01 06:00:00"), "orders", "2024-02-01 06:00:00")
    assert sorted(r.order_id for r in brz.collect()) == sorted(r.order_id for r in batch.collect())
    assert [r.order_id for r in spark.read.parquet(f"{scratch}/rej").collect()] == [107]


def test_dedupe_within_watermark_batch_and_stream(spark, scratch):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    dup = ev.unionByName(ev.where("event_id % 5 = 0"))
    assert dedupe_within_watermark(dup, ["event_id"], "ts").count() == ev.count()
    src = f"{scratch}/ev"
    dup.write.parquet(src)
    stream = spark.readStream.schema(dup.schema).parquet(src)
    out = dedupe_within_watermark(stream, ["event_id"], "ts", "3 days")
    q = out.writeStream.format("memory").queryName("dedup_ev").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("dedup_ev").select(F.countDistinct("event_id")).first()[0] == spark.table("dedup_ev").count() == ev.count()
