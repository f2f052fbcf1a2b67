"""Operator 13: WARC archives by a deterministic sharded writer.

Records are ordered by (page_id, rank, copy) and cut into shards of a fixed number of
bytes by sums over that order, so neither the cluster nor the run decides what a shard
holds: the same pages give the same files, byte for byte. A shard is sorted in one task and
written as files that roll at a compressed size; each record is a gzip member of its own
with headers and digests made anew.

A task writes under a temporary name and reports it; only names that Spark commits with
the task reach the list of files. These are then renamed, and the manifest appears last,
by one rename. Readers take files from the manifest alone, so whatever stopped, repeated
or late tasks have left is never read.

Of records with equal payloads of at least ``revisit_from`` bytes the first is a response
and the others revisit it without payload, so only one copy of a payload is shuffled and
written.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import materialize, shared_path
from strata.operators.joins import broadcast_if_small
from strata.sources.tables import _jvm_path, drop_path

REVISIT_FROM = 100  # bytes of a payload from which copies are revisits
SHARD_BYTES = 32 << 20  # of payloads and headers in a shard
MAX_SHARDS = 50_000  # beyond, shards grow: their bounds are broadcast
ROLL_BYTES = 8 << 20  # of a file, compressed
DATE = "2024-01-01T00:00:00Z"  # a parameter, not the clock: files must not differ between runs
OVERHEAD = 600  # bytes that a record's headers take, about
COPIES = 4096  # copies of a row that are made in one step
LEVEL = 6  # of compression
READ_ROWS = 256  # records of a batch when reading
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --------------------------------------------------------------------------- records
def record_id(page_id: int | None, rank: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id}|{rank}|{copy}'.encode()).digest()[:16], version=5)}>"


def header_text(value: str) -> str:
    """White space, control and non-ASCII characters percent-encoded: a URL is one header line."""
    return "".join(c if 0x21 <= ord(c) <= 0x7E else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in value)


def record(headers: list[tuple[str, str]], block: bytes, level: int = LEVEL) -> bytes:
    """One record as a gzip member without time and name."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def page_record(row: dict, date: str, level: int = LEVEL) -> bytes:
    payload = row["payload"] or b""
    head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", record_id(row["page_id"], row["rank"], row["copy"])), ("WARC-Date", date)]
    if row["url"] is not None:
        head.append(("WARC-Target-URI", header_text(row["url"])))
    if row["page_id"] is not None:
        head.append(("X-Page-Id", str(row["page_id"])))
    head += [("X-Payload-Length", str(row["payload_bytes"])), ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"), ("Content-Type", "application/http;msgtype=response")]
    if row["record_type"] == "revisit":
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(row["refers_to"], row["refers_rank"], 1)), ("WARC-Refers-To-Date", date)]
        if row["refers_to"] is not None:
            head.append(("X-Refers-To-Page-Id", str(row["refers_to"])))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html;charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    return record(head, http + payload, level)


def info_record(name: str, date: str, level: int = LEVEL) -> bytes:
    head = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name, 0)), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
    return record(head, b"format: WARC File Format 1.1\r\nconformsTo: http://iipc.github.io/warc-specifications/specifications/warc-format/warc-1.1/\r\n", level)


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of every record of a file; block digests are checked."""
    with gzip.GzipFile(fileobj=stream) as f:
        while line := f.readline():
            if line in (b"\r\n", b"\n"):
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no WARC record: {line[:40]!r}")
            headers: dict[str, str] = {}
            while (line := f.readline()) not in (b"\r\n", b"\n"):
                name, colon, value = line.decode().partition(":")
                if not colon:
                    raise ValueError("record ends inside its headers")
                headers[name.strip().lower()] = value.strip()
            size = int(headers["content-length"])
            block = f.read(size)
            if len(block) != size:
                raise ValueError("record ends inside its block")
            said = headers.get("warc-block-digest", "")
            if said.startswith("sha256:") and said[7:] != hashlib.sha256(block).hexdigest():
                raise ValueError(f"block digest differs: {headers.get('warc-record-id')}")
            yield headers, block


# --------------------------------------------------------------------------- files
def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a folder as tasks reach it: a shared mount, or a store that Arrow knows by its scheme."""
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pyarrow.fs.LocalFileSystem(), uri
    return pyarrow.fs.FileSystem.from_uri(uri)


class _File:
    """One archive file under a temporary name."""

    def __init__(self, store, folder: str, shard: int, part: int, date: str, level: int):
        self.name, self.shard, self.part = f"{shard:06d}-{part:04d}.warc.gz", shard, part
        self.temporary = f"{self.name}.{uuid.uuid4().hex}"
        self.out = store.open_output_stream(f"{folder}/_temporary/{self.temporary}", compression=None)
        self.size, self.count, self.sha = 0, 0, hashlib.sha256()
        self._put(info_record(self.name, date, level))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)
        self.sha.update(data)

    def add(self, data: bytes) -> None:
        self._put(data)
        self.count += 1

    def close(self) -> dict:
        self.out.close()
        return {"shard": self.shard, "part": self.part, "name": self.name, "temporary": self.temporary, "n_records": self.count, "bytes": self.size, "sha256": self.sha.hexdigest()}


FILES = "shard int, part int, name string, temporary string, n_records bigint, bytes bigint, sha256 string"


def _write_task(out: str, roll_bytes: int, date: str, level: int):
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = file_system(out)
        store.create_dir(f"{folder}/_temporary", recursive=True)
        now, done = None, []
        for batch in batches:
            names = batch.schema.names
            for at in range(batch.num_rows):  # a row at a time: payloads are as large as pages are
                row = {n: batch.column(i)[at].as_py() for i, n in enumerate(names)}
                if now is not None and (now.shard != row["shard"] or now.size >= roll_bytes):
                    done.append(now.close())
                    now = _File(store, folder, row["shard"], now.part + 1 if now.shard == row["shard"] else 0, date, level)
                if now is None:
                    now = _File(store, folder, row["shard"], 0, date, level)
                now.add(page_record(row, date, level))
        if now is not None:
            done.append(now.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in zip(done[0], kinds, strict=True)], names=list(done[0]))

    return run


def _rename_task(out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = file_system(out)
        for batch in batches:
            for name, temporary, size in zip(*(batch.column(c).to_pylist() for c in ("name", "temporary", "bytes")), strict=True):
                at, to = f"{folder}/_temporary/{temporary}", f"{folder}/{name}"
                here, there = store.get_file_info([at, to])
                if here.type != pyarrow.fs.FileType.NotFound:
                    store.move(at, to)
                elif there.type == pyarrow.fs.FileType.NotFound or there.size != size:  # else an earlier attempt has renamed it
                    raise FileNotFoundError(f"{name}: written file is gone")
            yield batch.select(["shard", "part", "name", "n_records", "bytes", "sha256"])

    return run


# --------------------------------------------------------------------------- the plan of an archive
def _keyed(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary")).alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("bigint")})
    # with page_id, what a row is; rows that share it are the same
    return rows.withColumn("rank", F.substring(F.sha2(F.concat(F.coalesce(F.concat(F.lit("u"), "url"), F.lit("n")), F.lit(" "), "payload_digest"), 256), 1, 32))


def _order() -> list[Column]:
    return [F.col("page_id").asc_nulls_last(), F.col("rank").asc()]


def _rows_once(keyed: DataFrame, revisit_from: int) -> DataFrame:
    """Distinct rows without payload (short ones excepted) and how often they occur."""
    short = F.when(F.col("payload_bytes") < revisit_from, F.col("payload")).alias("short")
    return keyed.select("page_id", "url", "rank", "payload_digest", "payload_bytes", short).groupBy("page_id", "url", "rank", "payload_digest", "payload_bytes", "short").agg(F.count(F.lit(1)).alias("n"))


def _shared_payloads(once: DataFrame, revisit_from: int) -> DataFrame:
    """(_digest, first_id, first_rank, again): payloads of several records, which of them is the response, whether that row itself is repeated."""
    key = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "rank", "n")
    found = once.where(F.col("payload_bytes") >= revisit_from).groupBy("payload_digest").agg(F.min(key).alias("first"), F.sum("n").alias("rows"))
    found = found.where("rows > 1")
    return found.select(F.col("payload_digest").alias("_digest"), F.col("first.page_id").alias("first_id"), F.col("first.rank").alias("first_rank"), (F.col("first.n") > 1).alias("again"))


def _is_first() -> Column:
    return F.col("_digest").isNull() | (F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("rank") == F.col("first_rank")))


def _starts(plan: DataFrame) -> DataFrame:
    """``plan`` with the bytes of all records before each row's first: sums inside ranges of the order, and over the ranges."""
    rows = materialize(plan.repartitionByRange(*_order()).withColumn("_range", F.spark_partition_id()), "warc_ranges")
    totals = rows.groupBy("_range").agg(F.sum("_weight").alias("_sum"))  # one row for each partition
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*_order()).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("_weight").over(inside), F.lit(0))
    return rows.withColumn("_own", own).join(F.broadcast(totals), "_range").withColumn("_start", F.col("_own") + F.col("_before")).drop("_own", "_before", "_range")


def _shard_of(bounds: list[tuple]) -> Column:
    """The shard of (page_id, rank): that of the last bound not behind it."""
    keys, shards = [b[:3] for b in bounds], [b[3] for b in bounds]

    def run(ids: pa.Array, ranks: pa.Array) -> pa.Array:
        found = [shards[bisect.bisect_right(keys, (i is None, i or 0, r)) - 1] for i, r in zip(ids.to_pylist(), ranks.to_pylist(), strict=True)]
        return pa.array(found, pa.int32())

    run.__annotations__ = {"ids": pa.Array, "ranks": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "int")("page_id", "rank")


def write_warc(
    pages: DataFrame, out: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    date: str = DATE, revisit_from: int = REVISIT_FROM, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, level: int = LEVEL,
) -> None:
    """Write one record per row of ``pages`` to the folder ``out``, which tasks and driver share and no archive uses yet.

    Records are in ascending page_id order (NULL ids last, rows of one id by a hash of URL and
    payload). NULL payloads are empty; a NULL URL leaves its header out; repeated rows are
    records of their own, the first of them a response; rows with NULL id that revisit one
    another refer by record id alone. Very long payloads are held one at a time. An empty
    table gives a manifest without files; further columns are ignored, whatever their names.
    """
    spark = pages.sparkSession
    keyed = _keyed(pages, id_col, url_col, payload_col)
    once = materialize(_rows_once(keyed, revisit_from), "warc_rows")
    shared = broadcast_if_small(materialize(_shared_payloads(once, revisit_from), "warc_shared"))
    plan = once.join(shared, once["payload_digest"] == shared["_digest"], "left").withColumn("_first", _is_first())
    short = F.col("short").isNotNull()
    first_weight = F.when(F.col("_first"), F.col("payload_bytes")).otherwise(0) + OVERHEAD
    next_weight = F.when(short, F.col("payload_bytes")).otherwise(0) + OVERHEAD
    plan = plan.withColumns({"_one": first_weight, "_next": next_weight}).withColumn("_weight", F.col("_one") + (F.col("n") - 1) * F.col("_next"))
    plan = materialize(_starts(plan), "warc_plan")
    total = plan.agg(F.coalesce(F.sum("_weight"), F.lit(0))).first()[0]
    target = max(shard_bytes, -(-total // MAX_SHARDS))
    shard = F.floor(F.col("_start") / F.lit(target)).cast("int")
    bounds = plan.groupBy(shard.alias("shard")).agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), F.coalesce("page_id", F.lit(0)).alias("page_id"), "rank")).alias("key"))
    bounds = sorted((*r["key"], r["shard"]) for r in bounds.collect())  # MAX_SHARDS rows at most

    columns = ["page_id", "rank", "copy", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "refers_rank", "payload"]
    # payloads are read from the pages where they are written, once each
    long_rows = keyed.where(F.col("payload_bytes") >= revisit_from)
    long_rows = long_rows.join(shared, long_rows["payload_digest"] == shared["_digest"], "left").where(_is_first())
    responses = long_rows.where(~F.coalesce("again", F.lit(False)))
    if not shared.where("again").isEmpty():
        responses = responses.unionByName(long_rows.where("again").dropDuplicates(["page_id", "rank"]))
    none = F.lit(None).cast("string")
    responses = responses.withColumns({"copy": F.lit(1).cast("bigint"), "record_type": F.lit("response"), "refers_to": F.lit(None).cast("bigint"), "refers_rank": none})
    responses = responses.select(_shard_of(bounds or [(False, 0, "", 0)]).alias("shard"), *columns)
    # all other records carry no payload, or a short one
    skip = F.when(F.col("_first") & ~short, 1).otherwise(0)
    rest = plan.withColumn("_skip", skip.cast("bigint")).where(F.col("n") > F.col("_skip"))
    rest = rest.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {COPIES}"))))
    many = rest.where(F.col("n") > COPIES).repartition("page_id", "rank", "_step")
    rest = rest.where(F.col("n") <= COPIES).unionByName(many)
    rest = rest.withColumn("copy", F.explode(F.sequence(F.greatest(F.col("_step") * COPIES, F.col("_skip")) + 1, F.least((F.col("_step") + 1) * COPIES, F.col("n")))))
    before = F.when(F.col("copy") == 1, 0).otherwise(F.col("_one") + (F.col("copy") - 2) * F.col("_next"))
    rest = rest.withColumns({"shard": F.floor((F.col("_start") + before) / F.lit(target)).cast("int"), "record_type": F.when(short, "response").otherwise("revisit"), "payload": F.col("short")})
    rest = rest.withColumns({"refers_to": F.when(~short, F.col("first_id")), "refers_rank": F.when(~short, F.col("first_rank"))})
    rows = responses.unionByName(rest.select("shard", *columns))
    shards = max(1, -(-total // target))
    rows = rows.repartitionById(shards, "shard").sortWithinPartitions("shard", *_order(), "copy")

    written = f"{out}/_written"
    rows.mapInArrow(_write_task(out, roll_bytes, date, level), FILES).write.parquet(written)  # Spark commits one attempt of each task
    files = spark.read.schema(FILES).parquet(written)
    files.mapInArrow(_rename_task(out), "shard int, part int, name string, n_records bigint, bytes bigint, sha256 string").write.parquet(f"{out}/_manifest")
    fs, made = _jvm_path(spark, f"{out}/_manifest")
    if not fs.rename(made, _jvm_path(spark, f"{out}/manifest")[1]):
        raise OSError(f"could not commit the manifest of {out}")
    drop_path(spark, written)
    drop_path(spark, f"{out}/_temporary")


MANIFEST = "shard int, part int, name string, n_records bigint, bytes bigint, sha256 string"


def manifest(spark: SparkSession, out: str) -> DataFrame:
    """The files of a committed archive: shard, part, name, n_records, bytes, sha256."""
    return spark.read.schema(MANIFEST).parquet(f"{out}/manifest")


def read_warc(spark: SparkSession, out: str, payloads: bool = True) -> DataFrame:
    """The page records of a committed archive, read file by file and record by record.

    page_id, record_id, record_type, target_uri, date, payload_bytes, payload_digest, refers_to
    (page_id), refers_to_id (record id), payload (NULL for revisits and without ``payloads``).
    Block and payload digests are taken anew from the bytes; a difference, or a file that has
    not the manifest's number of records, is an error.
    """
    schema = "page_id bigint, record_id string, record_type string, target_uri string, date string, payload_bytes bigint, payload_digest string, refers_to bigint, refers_to_id string, payload binary"
    kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in schema.split(", ")]

    def described(headers: dict[str, str], block: bytes) -> tuple:
        kind, said = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:")
        payload, size = None, int(headers["x-payload-length"])
        if kind == "response":
            payload = block[block.index(b"\r\n\r\n") + 4 :]
            size = len(payload)
            if hashlib.sha256(payload).hexdigest() != said:
                raise ValueError(f"payload digest differs: {headers['warc-record-id']}")
        number = lambda k: int(headers[k]) if k in headers else None
        return number("x-page-id"), headers["warc-record-id"], kind, headers.get("warc-target-uri"), headers["warc-date"], size, said, number("x-refers-to-page-id"), headers.get("warc-refers-to"), payload if payloads else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = file_system(out)
        for batch in batches:
            for name, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held, seen, size = [], 0, 0
                with store.open_input_stream(f"{folder}/{name}", compression=None, buffer_size=1 << 16) as stream:
                    for headers, block in records(stream):
                        if headers["warc-type"] == "warcinfo":
                            continue
                        seen += 1
                        held.append(described(headers, block))
                        size += len(block) if payloads else 0
                        if len(held) == READ_ROWS or size > 1 << 23:
                            yield made(held)
                            held, size = [], 0
                if seen != n:
                    raise ValueError(f"{name} holds {seen} records, the manifest says {n}")
                if held:
                    yield made(held)

    def made(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    files = manifest(spark, out).select("name", "n_records")
    return files.repartition(max(1, files.count())).mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as an archive in the shared folder, read it back and describe each record."""
    spark = pages.sparkSession
    out = shared_path(spark, "warc")
    write_warc(pages, out)
    return read_warc(spark, out, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle_sql(revisit_from: int = REVISIT_FROM) -> str:
    return f"""WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
          f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= {revisit_from} AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= {revisit_from} AND page_id <> first_id THEN first_id END AS refers_to
        FROM f"""


__all__ = ["file_system", "manifest", "oracle_sql", "read_warc", "record", "records", "round_trip", "write_warc"]
