"""Run log: structured job/model tags, log rows, the parsed log view and reports.

A log row carries a JSON ``query_tag`` (invocation, job, env, model, schema,
materialisation, orchestrator run id) plus timing, status and row counts.
``parse_log`` turns tags into columns (bad JSON → NULL, never an error),
keeps write-type statements of tagged models and numbers the models of each
invocation in start order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.metadata import ts_literal
from strata.operators.dedup import sequence_in_group
from strata.operators.sequence import bucketed_lag, bucketed_row_number

# Statement types that count as a model write.
WRITE_QUERY_TYPES = ("CREATE_TABLE_AS_SELECT", "MERGE", "INSERT", "UPDATE", "DELETE")

TAG_FIELDS = ("invocation_id", "job", "env", "model", "schema", "materialized", "airflow_run_id")

LOG_SCHEMA = T.StructType(
    [
        T.StructField("query_tag", T.StringType()),
        T.StructField("query_id", T.StringType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("end_time", T.TimestampNTZType()),
        T.StructField("execution_time_ms", T.LongType()),
        T.StructField("execution_status", T.StringType()),
        T.StructField("error_code", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("rows_updated", T.LongType()),
        T.StructField("rows_deleted", T.LongType()),
        T.StructField("rows_produced", T.LongType()),
        T.StructField("query_type", T.StringType()),
    ]
)


def job_tag(invocation_id: Column, job: Column, env: Column, airflow_run_id: Column, github_run_id: Column | None = None) -> Column:
    """Job-level tag as JSON text (properly escaped, unlike string concatenation)."""
    fields = [invocation_id.alias("invocation_id"), job.alias("job"), env.alias("env"), airflow_run_id.alias("airflow_run_id")]
    if github_run_id is not None:
        fields.append(github_run_id.alias("github_run_id"))
    return F.to_json(F.struct(*fields))


def model_tag(invocation_id: Column, job: Column, env: Column, model: Column, schema: Column, materialized: Column, airflow_run_id: Column) -> Column:
    """Model-level tag: the job fields plus model, schema and materialisation."""
    return F.to_json(
        F.struct(
            invocation_id.alias("invocation_id"), job.alias("job"), env.alias("env"), model.alias("model"),
            schema.alias("schema"), materialized.alias("materialized"), airflow_run_id.alias("airflow_run_id"),
        )
    )


def tag_text(**fields: str) -> str:
    """Driver-side tag for ``SparkContext.setJobDescription`` / log rows."""
    import json

    return json.dumps({k: v for k, v in fields.items() if v is not None}, sort_keys=False)


def log_entry(
    spark: SparkSession,
    tag: str,
    query_id: str,
    start: dt.datetime,
    end: dt.datetime,
    status: str,
    rows_inserted: int | None = None,
    rows_updated: int | None = None,
    rows_deleted: int | None = None,
    query_type: str = "CREATE_TABLE_AS_SELECT",
    error_code: str | None = None,
    error_message: str | None = None,
) -> DataFrame:
    """One log row written by the job after a model write (append it to the log table)."""
    ms = int((end - start).total_seconds() * 1000)
    row = (tag, query_id, start, end, ms, status, error_code, error_message, rows_inserted, rows_updated, rows_deleted, rows_inserted, query_type)
    return spark.createDataFrame([row], LOG_SCHEMA)


_TAG_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in TAG_FIELDS])


def parse_log(log: DataFrame, sequence_bucket: Column | None = None) -> DataFrame:
    """Tag → columns; keep tagged write statements; ``event_sequence`` per invocation.

    ``from_json`` in PERMISSIVE mode yields NULL fields for malformed text, so a
    bad tag drops out by the invocation/model filter instead of failing the job.
    ``sequence_bucket`` switches the numbering to the skew-safe bucketed form.
    """
    tag = F.from_json(F.col("query_tag"), _TAG_SCHEMA, {"mode": "PERMISSIVE"})
    parsed = log.withColumn("__tag", tag).select(
        F.col("__tag.invocation_id").alias("invocation_id"),
        F.col("__tag.job").alias("job"),
        F.col("__tag.env").alias("env"),
        F.col("__tag.model").alias("model"),
        F.col("__tag.schema").alias("model_schema"),
        F.col("__tag.materialized").alias("materialized"),
        F.col("__tag.airflow_run_id").alias("airflow_run_id"),
        "query_id",
        "start_time",
        "end_time",
        F.round(F.col("execution_time_ms") / F.lit(1000.0), 2).cast("double").alias("duration_seconds"),
        F.col("execution_status").alias("status"),
        "error_code",
        "error_message",
        "rows_inserted",
        "rows_updated",
        "rows_deleted",
        "rows_produced",
        "query_type",
    )
    kept = parsed.where(
        F.col("invocation_id").isNotNull() & F.col("model").isNotNull() & F.col("query_type").isin(*WRITE_QUERY_TYPES)
    )
    if sequence_bucket is not None:
        return bucketed_row_number(kept, ["invocation_id"], ["start_time", "query_id"], sequence_bucket, "event_sequence")
    return sequence_in_group(kept, ["invocation_id"], ["start_time", "query_id"], "event_sequence")


# --------------------------------------------------------------------------- reports
def run_in_order(log: DataFrame, airflow_run_id: str) -> DataFrame:
    """All models of one orchestrator run, in execution order."""
    return (
        log.where(F.col("airflow_run_id") == airflow_run_id)
        .select("invocation_id", "event_sequence", "model", "model_schema", "materialized", "duration_seconds", "status", "rows_inserted", "error_message")
        .orderBy("invocation_id", "event_sequence")
    )


def slowest_models(log: DataFrame, now: dt.datetime | str, env: str = "prod", days: int = 30) -> DataFrame:
    """Average/max duration and run count per model over successful runs of the last ``days``."""
    since = ts_literal(now) - F.make_dt_interval(F.lit(days))
    return (
        log.where((F.col("env") == env) & (F.col("status") == "SUCCESS") & (F.col("start_time") >= since))
        .groupBy("model")
        .agg(
            F.round(F.avg("duration_seconds"), 1).alias("avg_seconds"),
            F.max("duration_seconds").alias("max_seconds"),
            F.count(F.lit(1)).alias("run_count"),
        )
        .orderBy(F.col("avg_seconds").desc())
    )


def failures(log: DataFrame, now: dt.datetime | str, days: int = 7) -> DataFrame:
    since = ts_literal(now) - F.make_dt_interval(F.lit(days))
    return (
        log.where((F.col("status") == "FAIL") & (F.col("start_time") >= since))
        .select("invocation_id", "model", "error_message", "start_time")
        .orderBy(F.col("start_time").desc())
    )


def run_failures(log: DataFrame, airflow_run_id: str) -> DataFrame:
    """One row: how many model writes of one orchestrator run failed (0 for a run without any, or unknown)."""
    return log.where(F.col("airflow_run_id") == airflow_run_id).agg(F.count_if(F.col("status") == "FAIL").alias("failures"))


def recent(log: DataFrame, now: dt.datetime | str, days: int = 7) -> DataFrame:
    """The log of the last ``days``: every row of them, no row limit."""
    return log.where(F.col("start_time") >= ts_literal(now) - F.make_dt_interval(F.lit(days)))


def invocation_detail(log: DataFrame, invocation_id: str) -> DataFrame:
    """One invocation, a row for each model write, in execution order."""
    return (
        log.where(F.col("invocation_id") == invocation_id)
        .select("event_sequence", "model", "model_schema", "materialized", "start_time", "end_time", "duration_seconds", "status",
                "rows_inserted", "rows_updated", "rows_deleted", "error_message")
        .orderBy("event_sequence")
    )


def row_trend(log: DataFrame, model: str, env: str = "prod", limit: int = 30) -> DataFrame:
    """Latest ``limit`` runs of a model (top-k: the limit is the feature)."""
    return (
        log.where((F.col("model") == model) & (F.col("env") == env))
        .orderBy(F.col("start_time").desc(), F.col("query_id").desc())
        .limit(limit)
        .select(F.col("start_time").cast("date").alias("run_date"), "start_time", "query_id", "rows_inserted", "duration_seconds")
    )


def invocation_summary(log: DataFrame) -> DataFrame:
    """Per invocation: start, end, models run, failures, rows written."""
    return log.groupBy("invocation_id").agg(
        F.min("start_time").alias("started_at"),
        F.max("end_time").alias("ended_at"),
        F.count(F.lit(1)).alias("models_run"),
        F.count_if(F.col("status") == "FAIL").alias("models_failed"),
        F.sum("rows_inserted").alias("rows_inserted"),
    )


def trend_monitor(
    log: DataFrame,
    group: Sequence[str] = ("model", "env"),
    bucket: Column | None = None,
    spike: float = 2.0,
    drop: float = 0.5,
    slower: float = 1.5,
) -> DataFrame:
    """Each run against the previous run of the same model: duration growth, row spikes/drops.

    Uses the bucketed lag so that one very frequent model does not become one task.
    """
    bucket = bucket if bucket is not None else F.date_trunc("day", F.col("start_time"))
    with_prev = bucketed_lag(log, list(group), ["start_time", "query_id"], bucket, ["duration_seconds", "rows_inserted"])
    ratio = F.when(F.col("prev_rows_inserted") > 0, F.col("rows_inserted") / F.col("prev_rows_inserted"))
    flag = (
        F.when(F.col("prev_rows_inserted").isNull(), "first")
        .when(ratio > spike, "spike")
        .when(ratio < drop, "drop")
        .otherwise("ok")
    )
    growth = F.when(F.col("prev_duration_seconds") > 0, F.col("duration_seconds") / F.col("prev_duration_seconds"))
    return with_prev.select(
        *group, "query_id", "start_time", "duration_seconds",
        F.col("prev_duration_seconds"), "rows_inserted", "prev_rows_inserted",
        ratio.alias("row_change_ratio"), flag.alias("row_flag"),
        growth.alias("duration_ratio"), F.coalesce(growth > slower, F.lit(False)).alias("is_slower"),
    )
