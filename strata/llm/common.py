"""Shared pieces of the training-data operators: inputs, row identity, components."""

from __future__ import annotations

import ctypes
import os
import shutil
import string
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.joins import broadcast_if_small
from strata.sources.tables import drop_path, ensure_checkpoint_dir, materialize


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once a session), where they do not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_strata_shipped", False):
        return
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="strata-"), "strata"), "zip", home, "strata")
    sc.addPyFile(made)  # Spark's own file server hands it out
    sc._strata_shipped = True


BATCH_BYTES = "4m"  # of texts that go to a Python worker at once, where the session does not say


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of Arrow batches: texts may be long, and both ends of a worker's pipe hold whole batches."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, BATCH_BYTES)


def let_go() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks and lie next to the executor's heap."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata_llm/{name}-{uuid.uuid4().hex}"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def text_key(text: Column) -> Column:
    """With the document id, the identity of a row: repeated rows share it, other texts do not."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def drop_rows(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` without the rows whose (doc_id, text) is in ``rejected`` (doc_id, text_key); NULLs match NULLs.

    The rejected keys are written once, so the anti join has their true size: small ones
    are broadcast, others are shuffled.
    """
    keys = materialize(rejected.select(F.col("doc_id").alias("_rid"), F.col("text_key").alias("_rkey")).distinct(), "rejected")
    small = broadcast_if_small(keys)
    cond = docs["doc_id"].eqNullSafe(small["_rid"]) & (text_key(docs["text"]) == small["_rkey"])
    return docs.join(small, cond, "left_anti")


def one_of_repeated(docs: DataFrame) -> DataFrame:
    """One row of each group of rows that agree on (doc_id, text); the full rows are only shuffled for such groups."""
    key = docs.select(F.col("doc_id").alias("_rid"), text_key(docs["text"]).alias("_rkey"))
    twice = materialize(key.groupBy("_rid", "_rkey").count().where("count > 1").drop("count"), "repeated")
    if twice.isEmpty():
        return docs
    small = broadcast_if_small(twice)
    cond = docs["doc_id"].eqNullSafe(small["_rid"]) & (text_key(docs["text"]) == small["_rkey"])
    return docs.join(small, cond, "left_anti").unionByName(docs.join(small, cond, "left_semi").dropDuplicates(["doc_id", "text"]))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of an undirected graph; ``component`` is the smallest node reachable.

    ``edges`` has two BIGINT columns ``a`` and ``b``. Alternating large-star and
    small-star steps (each a groupBy-min and an equi-join over the edge list) end
    after O(log n) rounds when every edge points at its component's smallest node.
    A hub's neighbours are reduced by a partial ``min`` before the shuffle and AQE
    splits its join partition. Every round is written to the shared checkpoint
    folder, so lineage stays one round long; the previous round's files go.
    Nodes without an edge to another node have no row.
    """
    spark = edges.sparkSession
    cur = _round(edges.select(F.least("a", "b").alias("hi"), F.greatest("a", "b").alias("lo")).where("a <> b").select(F.col("lo").alias("u"), F.col("hi").alias("v")).distinct())
    size = -1
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node links to the smallest of its neighbourhood
        both = cur.select("u", "v").unionAll(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a node's smaller neighbours and the node itself link to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        nxt = _round(small.where("u <> v").distinct())
        row = nxt.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.hash("u", "v").cast("long")), F.lit(0))).first()
        state = (row[0], row[1])
        if state == size:
            break
        size, cur = state, nxt
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return nxt.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _round(df: DataFrame) -> DataFrame:
    return materialize(df, "components")


__all__ = ["ascii_lower", "connected_components", "drop_path", "drop_rows", "ensure_checkpoint_dir", "let_go", "materialize", "one_of_repeated", "shared_path", "ship", "small_batches", "table", "text_key"]
