"""Transient, bronze and silver models as DataFrame → DataFrame functions.

Every timestamp is a job-supplied literal (``batch_ts``); the functions are
pure, the writes live in ``strata.plans.pipeline``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import row_hash, surrogate_key
from strata.functions.text import clean_columns
from strata.operators.dedup import latest_per_key
from strata.operators.load import new_rows_since
from strata.operators.metadata import ts_literal, with_batch, with_bronze_tags
from strata.operators.rules import business_rules, tag_rules, technical_rules, valid_expr
from strata.plans.entities import ENTITIES

GOVERNANCE = ("_source_system", "_domain", "_sensitivity_tag")


# --------------------------------------------------------------------------- transient
def transient(raw: DataFrame, entity: str, batch_id: str, batch_ts: dt.datetime | str) -> DataFrame:
    """All raw rows, technical flag ``_is_valid``, ``_loaded_at``, ``_batch_id``."""
    e = ENTITIES[entity]
    tagged = raw.select(*e.columns).withColumn("_is_valid", valid_expr(technical_rules(entity)))
    return with_batch(tagged, batch_id, batch_ts)


def transient_rejects(raw: DataFrame, entity: str, batch_id: str, batch_ts: dt.datetime | str) -> DataFrame:
    """Rows failing a technical rule, with the first reason and a reject key."""
    e = ENTITIES[entity]
    tagged = tag_rules(raw.select(*e.columns), technical_rules(entity), "_is_valid", "_reject_reason")
    return (
        tagged.where(~F.col("_is_valid"))
        .drop("_is_valid")
        .withColumns(
            {
                "_rejected_at": ts_literal(batch_ts),
                "_batch_id": F.lit(batch_id),
                "_reject_id": surrogate_key(*e.transient_reject_key),
            }
        )
    )


# --------------------------------------------------------------------------- bronze
def bronze(trn: DataFrame, entity: str, batch_ts: dt.datetime | str, target: DataFrame | None = None) -> DataFrame:
    """Valid transient rows newer than the target's ``_loaded_at`` high-water mark, tagged."""
    e = ENTITIES[entity]
    src = trn.where(F.col("_is_valid"))
    if target is not None:
        src = new_rows_since(src, target, "_loaded_at")
    src = src.select(*e.columns, "_loaded_at", "_batch_id")
    return with_bronze_tags(src, entity, e.key, batch_ts)


# --------------------------------------------------------------------------- silver
def silver_validated(brz: DataFrame, entity: str, batch_ts: dt.datetime | str) -> DataFrame:
    """Latest row per key, standardised, with ``_is_business_valid`` and the reason."""
    e = ENTITIES[entity]
    order = ["_bronze_inserted_at desc", *e.dedupe_order]
    # one number makes the order total: the values themselves are neither shuffled nor sorted for it
    latest = latest_per_key(brz, [e.key], order, tie_break=[row_hash(*e.columns).desc()])
    std = clean_columns(latest, e.silver_spec, keep=GOVERNANCE).withColumn("_silver_processed_at", ts_literal(batch_ts))
    return tag_rules(std, business_rules(entity), "_is_business_valid", "_reject_reason")


def silver_columns(entity: str) -> list[str]:
    e = ENTITIES[entity]
    outs = [s[2] if len(s) > 2 else s[0] for s in e.silver_spec]
    return [*outs, *GOVERNANCE, "_silver_processed_at"]


def silver_clean(validated: DataFrame, entity: str) -> DataFrame:
    return validated.where(F.col("_is_business_valid")).select(*silver_columns(entity))


def silver_rejects(validated: DataFrame, entity: str, batch_ts: dt.datetime | str) -> DataFrame:
    e = ENTITIES[entity]
    return validated.where(~F.col("_is_business_valid")).select(
        *e.silver_reject_columns,
        "_reject_reason",
        "_silver_processed_at",
        ts_literal(batch_ts).alias("_rejected_at"),
        surrogate_key(*e.silver_reject_key).alias("_reject_id"),
    )


def silver_from_raw(raw: DataFrame, entity: str, batch_id: str, batch_ts: dt.datetime | str) -> DataFrame:
    """raw → transient → bronze → silver clean, for a single batch (no history)."""
    trn = transient(raw, entity, batch_id, batch_ts)
    brz = bronze(trn, entity, batch_ts)
    return silver_clean(silver_validated(brz, entity, batch_ts), entity)
