"""Zone routing, table existence, staged (swap-on-commit) writes, lineage cuts.

Tables are parquet directories under ``<root>/<zone>/<table>``. Spark cannot
overwrite a path it is reading from, so every rewrite of an existing table
(merge, SCD2, delete+insert) writes a staging directory next to the target
and swaps it in with two renames on the Hadoop FileSystem; readers never see
a half-written table.

Lineage is cut with ``DataFrame.checkpoint`` into the directory the cluster
names in ``spark.checkpoint.dir`` (shared storage); only when it is unset
(tests, local runs) do we set one of our own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# The five zones in flow order, and the CI flattening rule.
ZONES = ("transient", "bronze", "silver", "gold", "gold_analytics")


def zone_path(root: str, env: str, zone: str, table: str, ci_schema: str | None = None) -> str:
    """CI → one flat schema per pull request; otherwise the zone's own schema."""
    root = root.rstrip("/")
    if env == "ci":
        if not ci_schema:
            raise ValueError("ci environment needs ci_schema")
        return f"{root}/{ci_schema}/{table}"
    zone = (zone or "").strip()
    return f"{root}/{zone or 'default'}/{table}"


def _jvm_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def read_table(spark: SparkSession, path: str, flags: Sequence[str] = (), schema=None) -> DataFrame:
    """Parquet table; ``flags`` are boolean partition columns (partition discovery
    infers them as strings). Filters on them still prune partitions.

    Pass the ``schema`` it was written with when the table may be empty: an empty
    partitioned write leaves no data file to infer a schema from.
    """
    from pyspark.sql import functions as F

    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    df = spark.read.parquet(path)
    return df.withColumns({f: F.col(f).cast("boolean") for f in flags}) if flags else df


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose DataFrames as temporary views (query-on-read, like a view model)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession, zone_dir: str) -> list[str]:
    """Table directories directly under a zone directory (hidden / staging ones skipped)."""
    fs, p = _jvm_path(spark, zone_dir)
    if not fs.exists(p):
        return []
    names = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and not name.startswith(("_", ".")) and ".__" not in name:
            names.append(name)
    return sorted(names)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the table is there; one that a stopped swap left aside is put back first, so no run takes it for missing."""
    fs, p = _jvm_path(spark, path)
    if fs.exists(p):
        return True
    parent = p.getParent()
    if parent is None or not fs.exists(parent):
        return False
    aside = [st for st in fs.listStatus(parent) if st.getPath().getName().startswith(f"{p.getName()}.__old_")]
    if not aside:
        return False
    return bool(fs.rename(max(aside, key=lambda st: st.getModificationTime()).getPath(), p))


def drop_path(spark: SparkSession, path: str) -> None:
    """Recursive delete (``DROP ... CASCADE`` for a path-based zone)."""
    fs, p = _jvm_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    staged: bool = True,
) -> None:
    """Write parquet. ``overwrite`` goes to a staging dir first and is swapped in.

    ``append`` writes directly (new files only, safe while readers run).
    """
    spark = df.sparkSession
    writer_mode = "overwrite" if mode == "overwrite" else mode
    if mode != "overwrite" or not staged:
        w = df.write.mode(writer_mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        return
    stage = f"{path.rstrip('/')}.__staging_{uuid.uuid4().hex}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(stage)
    swap_in(spark, stage, path)


def swap_in(spark: SparkSession, stage: str, path: str) -> None:
    fs, target = _jvm_path(spark, path)
    _, staged = _jvm_path(spark, stage)
    old = None
    if fs.exists(target):
        _, old = _jvm_path(spark, f"{path.rstrip('/')}.__old_{uuid.uuid4().hex}")
        if not fs.rename(target, old):
            raise OSError(f"could not move {path} aside")
    if not fs.rename(staged, target):
        if old is not None:
            fs.rename(old, target)
        raise OSError(f"could not swap {stage} into {path}")
    if old is not None:
        fs.delete(old, True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint dir; set a local one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.startswith("local"):
            configured = tempfile.mkdtemp(prefix="strata-ckpt-")
        else:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a parquet table under the checkpoint directory and read it back.

    Like ``cut_lineage`` (the result depends only on files in shared storage) but
    columnar: later readers prune columns and push filters, and the write is one
    pass without row serialisation. ``partition_by`` columns let readers prune.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/strata_tables/{name}-{uuid.uuid4().hex}"
    if partition_by:
        df.write.partitionBy(*partition_by).parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
    else:
        df.write.parquet(path)
        out = spark.read.parquet(path)
    out._strata_path = path
    return out


def forget(*made: DataFrame | None) -> None:
    """Delete the files of tables that ``materialize`` returned; nothing may read them any more."""
    for df in made:
        path = None if df is None else vars(df).get("_strata_path")
        if path:
            drop_path(df.sparkSession, path)


@contextmanager
def shuffles_end_with_queries(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark deletes a query's shuffle files when the query ends; by default they lie until the driver's garbage collection finds them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
