"""Bronze ingest as a Structured Streaming job.

The stream's checkpoint takes over the high-water mark: each new file of the
raw landing directory is read exactly once. Every micro-batch runs the same
DataFrame functions as the batch path (technical tags → bronze tags) inside
``foreachBatch`` and writes the batch into its own ``_batch_id`` partition with
dynamic partition overwrite, so a retried epoch replaces its own output
instead of duplicating it. ``trigger(availableNow=True)`` processes whatever
has landed and stops, which is the scheduled-job shape of the reference's
incremental bronze models.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import zones as Z
from strata.sources.tables import table_exists


def ingest_bronze(
    spark: SparkSession,
    landing_path: str,
    schema: T.StructType,
    entity: str,
    bronze_path: str,
    rejects_path: str,
    checkpoint_path: str,
    run_id: str,
    clock: dt.datetime | str,
    max_files_per_trigger: int | None = None,
) -> None:
    """Process every raw parquet file not yet seen into bronze (+ technical rejects)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.parquet(landing_path)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        batch_id = f"{run_id}-{epoch_id}"
        trn = Z.transient(batch, entity, batch_id, clock)
        brz = Z.bronze(trn, entity, clock)
        (brz.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch_id").parquet(bronze_path))
        rej = Z.transient_rejects(batch, entity, batch_id, clock)
        (rej.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch_id").parquet(rejects_path))

    q = (
        raw.writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced by awaitTermination already
        raise RuntimeError(str(q.exception()))


def dedupe_within_watermark(df: DataFrame, keys: list[str], event_time: str, delay: str = "3 days") -> DataFrame:
    """Streaming de-duplication of late re-deliveries: state is kept only for ``delay``.

    Works on batch DataFrames too (then it is a plain ``dropDuplicates``).
    """
    if not df.isStreaming:
        return df.dropDuplicates(keys)
    if isinstance(df.schema[event_time].dataType, T.TimestampNTZType):
        # watermarks need an instant: watermark on a (session time zone) copy
        wm = df.withColumn("__event_time", F.col(event_time).cast("timestamp"))
        return wm.withWatermark("__event_time", delay).dropDuplicatesWithinWatermark(keys).drop("__event_time")
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def dedupe_stream_to_table(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    keys: list[str],
    sink_path: str,
    checkpoint_path: str,
    file_glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Run a file-source stream into a parquet sink that holds one row for each key, however late a re-delivery is.

    ``source_path`` is a directory; ``file_glob`` picks its files (e.g. one table).
    No watermark is set, so no row is dropped for its time: a batch keeps the keys that no
    earlier epoch wrote (NULL keys match each other). An epoch owns its folder, so a
    repeated one replaces its own rows. Per batch, the sink is read for its key columns only.
    Returns the sink as a batch DataFrame.
    """
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stored = T.StructType([*schema.fields, T.StructField("_epoch", T.LongType())])

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        fresh = batch.dropDuplicates(keys)
        if table_exists(batch.sparkSession, sink_path):
            done = batch.sparkSession.read.schema(stored).parquet(sink_path).where(F.col("_epoch") < epoch_id)
            done = done.select(*[F.col(k).alias(f"__seen_{k}") for k in keys])
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__seen_{k}")) for k in keys])
            fresh = fresh.join(done, same, "left_anti")
        fresh = fresh.withColumn("_epoch", F.lit(epoch_id).cast("bigint"))
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_epoch").parquet(sink_path)

    q = (
        reader.parquet(source_path)
        .writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if not table_exists(spark, sink_path):  # nothing has landed yet
        return spark.createDataFrame([], schema)
    return spark.read.schema(stored).parquet(sink_path).drop("_epoch")
