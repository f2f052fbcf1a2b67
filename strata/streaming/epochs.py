"""Streams into versioned tables: each epoch is one part, committed whole, replaced when it is repeated."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.bucketed import time_part
from strata.plans import zones as Z
from strata.sources.tables import materialize
from strata.sources.versioned import PART, load_version, read_version, write_parts


def _run(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str, per_epoch: Callable[[DataFrame, int], None], max_files: int | None) -> None:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    q = reader.parquet(path).writeStream.foreachBatch(per_epoch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def _part_of(epoch: int) -> str:
    return f"e{epoch:010d}"


# --------------------------------------------------------------------------- ingest
def ingest_epochs(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    entity: str,
    bronze: str,
    rejects: str,
    checkpoint: str,
    run_id: str,
    clock: dt.datetime | str,
    max_files_per_trigger: int | None = None,
) -> None:
    """New raw files into a bronze and a rejects table, a part of each for every epoch.

    An epoch's rows are read and checked once: they are written by the validity flag, and bronze
    and rejects are made from the two halves. Both commits replace the epoch's own part, so an
    epoch that is repeated after a stop leaves one copy.
    """

    def per_epoch(batch: DataFrame, epoch: int) -> None:
        name, part = f"{run_id}-{epoch}", _part_of(epoch)
        flagged = materialize(Z.transient(batch, entity, name, clock), f"epoch_{entity}", partition_by=["_is_valid"])
        write_parts(Z.bronze(flagged, entity, clock), bronze, load_version(spark, bronze), replaced=[part], one_part=part)
        bad = Z.transient_rejects(flagged.where(~F.col("_is_valid")), entity, name, clock)
        write_parts(bad, rejects, load_version(spark, rejects), replaced=[part], one_part=part)

    _run(spark, landing, schema, checkpoint, per_epoch, max_files_per_trigger)


# --------------------------------------------------------------------------- de-duplication
LATE, UNTIMED = "late", "untimed"


def dedupe_epochs(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    keys: list[str],
    event_time: str,
    sink: str,
    late: str,
    state: str,
    checkpoint: str,
    delay: str = "3 days",
    max_files_per_trigger: int | None = None,
) -> None:
    """One row for each key within ``delay`` of event time; nothing is dropped unseen.

    The state is a table of the keys seen, by day of their event time. Days before the
    watermark (the newest time of earlier epochs less ``delay``) leave it, so it is bounded by
    the delay; an epoch reads the state's live days, never the sink. Rows older than the
    watermark, whose copies may be forgotten already, and rows without a time go to the table
    ``late`` with the reason and the epoch, where they can be counted or merged in later.
    NULL keys match each other.

    Sink and late rows of an epoch replace that epoch's part; the state is committed last and
    names the epoch, so a repeated epoch is either done already or done again in full.
    """
    kind = schema[event_time].dataType

    def per_epoch(batch: DataFrame, epoch: int) -> None:
        base = load_version(spark, state)
        if base is not None and base.meta["epoch"] >= epoch:
            return
        newest = base.meta["newest"] if base else None
        mark = F.lit(newest).cast(kind) - F.expr(f"INTERVAL {delay}") if newest else F.lit(None).cast(kind)
        t = F.col(event_time)
        reason = F.when(t.isNull(), UNTIMED).when(t < mark, LATE)
        rows = materialize(batch.withColumn("_reason", reason), "epoch_rows")  # the epoch's rows are read once
        part = _part_of(epoch)
        aside = rows.where("_reason is not null").withColumn("_epoch", F.lit(epoch).cast("bigint"))
        fresh = rows.where("_reason is null").drop("_reason").dropDuplicates(keys)
        if base is not None:
            seen = read_version(spark, state, base).select(*[F.col(k).alias(f"_s_{k}") for k in keys])
            fresh = fresh.join(seen, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]), "left_anti")
        fresh = materialize(fresh, "epoch_fresh")
        write_parts(fresh, sink, load_version(spark, sink), replaced=[part], one_part=part)
        write_parts(aside, late, load_version(spark, late), replaced=[part], one_part=part)
        top = rows.agg(F.max(event_time).cast("string")).first()[0]
        newest = max(x for x in (newest, top, "") if x is not None) or None
        gone = []
        if newest and base is not None:
            day = spark.range(1).select(F.date_format(F.lit(newest).cast(kind) - F.expr(f"INTERVAL {delay}"), "yyyyMMdd")).first()[0]
            gone = [p for p in base.parts if p < day]
        # NULL times never get here; a day's keys gain a directory for each epoch that had some
        write_parts(fresh.select(*keys, time_part(event_time, "yyyyMMdd").alias(PART)), state, base, replaced=gone, meta={"epoch": epoch, "newest": newest})

    _run(spark, landing, schema, checkpoint, per_epoch, max_files_per_trigger)


def late_counts(spark: SparkSession, late: str) -> DataFrame:
    """Rows set aside by reason: _reason, n."""
    return read_version(spark, late).groupBy("_reason").agg(F.count(F.lit(1)).alias("n"))
