"""The corpus pipeline: documents through five of the operators in strata.llm.

Each stage gets what its predecessor kept, written as Parquet and read again, so a lost
executor costs one stage's tasks at most. All stages but the last return the columns of
documents; secret scans change texts, the filtering stages drop rows.

Null and empty texts, repeated rows, NULL ids, empty tables and further columns are
treated as the operators' docstrings say; a repeated row leaves with the copies in the
second stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe, decontaminate, secrets, simhash, toxicity
from strata.llm.common import materialize, ship, small_batches, table


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    small_batches(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    ship(spark)
    small_batches(spark)
    return simhash.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    return secrets.redact(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text encoded and decoded again, as digests: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    ship(spark)
    small_batches(spark)
    return bpe.digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_documents),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", benchmark_passages),
    ("secret_scans", secret_strings),
    ("bpe_tokens", token_ids),
]

# A classifier, connected components and BPE are beyond SQL: the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
