"""Governance and batch columns (lineage, ownership, sensitivity).

Times are always passed in by the job (one batch timestamp per run) rather
than ``current_timestamp()``, so reruns and tests are deterministic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import surrogate_key

# Governance tags of the four entities (source system, domain,
# sensitivity) as the bronze zone stamps them.
ENTITY_TAGS = {
    "customers": ("fivetran", "customer", "pii"),
    "orders": ("fivetran", "order", "confidential"),
    "order_items": ("fivetran", "order", "confidential"),
    "products": ("fivetran", "product", "public"),
}


def ts_literal(ts: dt.datetime | str) -> Column:
    """A timestamp_ntz literal (Spark's default literal type is the LTZ one)."""
    if isinstance(ts, dt.datetime):
        ts = ts.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(ts).cast("timestamp_ntz")


def with_batch(df: DataFrame, batch_id: str, loaded_at: dt.datetime | str, loaded_col: str = "_loaded_at") -> DataFrame:
    """Add ``_loaded_at`` and ``_batch_id``."""
    return df.withColumns({loaded_col: ts_literal(loaded_at), "_batch_id": F.lit(batch_id)})


def with_metadata(
    df: DataFrame,
    source_system: str,
    domain: str,
    sensitivity: str,
    processed_at: dt.datetime | str,
    batch_id: str,
) -> DataFrame:
    """The five generic tag columns: system, domain, sensitivity, processed time, batch."""
    return df.withColumns(
        {
            "_source_system": F.lit(source_system),
            "_domain": F.lit(domain),
            "_sensitivity_tag": F.lit(sensitivity),
            "_processed_at": ts_literal(processed_at),
            "_batch_id": F.lit(batch_id),
        }
    )


def with_bronze_tags(df: DataFrame, entity: str, key: str, inserted_at: dt.datetime | str) -> DataFrame:
    """Bronze tags: governance literals, insert time, and ``hash(key, _batch_id)``."""
    system, domain, sensitivity = ENTITY_TAGS[entity]
    return df.withColumns(
        {
            "_source_system": F.lit(system),
            "_domain": F.lit(domain),
            "_sensitivity_tag": F.lit(sensitivity),
            "_bronze_inserted_at": ts_literal(inserted_at),
            "_bronze_sk": surrogate_key(key, "_batch_id"),
        }
    )
