from __future__ import annotations

import gzip
import hashlib
import io
import os
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import queries as Q
from strata.llm import warc as W
from tests.llm.conftest import SF001

SCHEMA = "page_id bigint, url string, html string"
LONG = "x" * 99 + "é"  # 101 bytes


def expected(rows):
    """Rows in order; the first of equal payloads of 100 bytes is the response."""
    def payload(r):
        return (r[2] or "").encode()

    firsts: dict = {}
    out = []
    for r in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        p = payload(r)
        if len(p) >= W.REVISIT_FROM and p in firsts:
            out.append((r[0], len(p), hashlib.sha256(p).hexdigest(), "revisit", firsts[p]))
        else:
            firsts.setdefault(p, r[0])
            out.append((r[0], len(p), hashlib.sha256(p).hexdigest(), "response", None))
    return sorted(out, key=repr)


def told(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


ROWS = [
    (5, "http://a/5", LONG), (3, "http://a/3", LONG), (9, "http://a/9", LONG), (3, "http://b/3", LONG), (3, "http://a/3", LONG),
    (1, None, None), (2, "http://a/ü b\r\nX-Evil: 1", ""), (4, "", "short"), (6, "u", "short"), (6, "u", "short"), (6, "u", "short"),
    (None, "n1", LONG), (None, "n2", "no id " * 40), (None, "n2", "no id " * 40), (None, None, "no id " * 40), (7, "z", "WARC/1.1\r\n\r\n" * 30), (8, "z", "y" * 100), (10, "z", "y" * 100), (11, "w", "y" * 99), (12, "w", "y" * 99),
    (-20, "big", "big page " * 40000), (20, "big", "big page " * 40000),
]


@pytest.fixture()
def pages(spark, docs_of):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


def test_query_on_the_small_tables(spark, docs_of):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF001}/pages.parquet')")
    assert told(Q.op13_warc(spark, SF001)) == sorted(con.execute(W.oracle_sql()).fetchall(), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 3000, "roll_bytes": 700}])
def test_defined_cases(spark, pages, scratch, sizes):
    df = pages(ROWS).withColumns({c: F.lit("x") for c in ["rank", "payload", "copy", "shard", "n", "again", "_first"]})
    W.write_warc(df, f"{scratch}/a", **sizes)
    got = W.read_warc(spark, f"{scratch}/a")
    assert told(got) == expected(ROWS)
    assert sorted(r[0] for r in got.where("record_type = 'response'").select(F.decode("payload", "utf-8")).collect()) == sorted(
        [(r[2] or "") for r in ROWS if len((r[2] or "").encode()) < 100] + list({r[2] for r in ROWS if len((r[2] or "").encode()) >= 100})
    )
    ids = {r["record_id"]: r for r in got.collect()}
    assert len(ids) == len(ROWS)
    for r in ids.values():
        if r["record_type"] == "revisit":  # whatever page ids repeat, the record id leads to the response
            assert ids[r["refers_to_id"]]["payload_digest"] == r["payload_digest"] and ids[r["refers_to_id"]]["record_type"] == "response"
    uri = next(r["target_uri"] for r in ids.values() if r["page_id"] == 2)
    assert uri == "http://a/%C3%BC%20b%0D%0AX-Evil:%201"
    assert not os.path.exists(f"{scratch}/a/_temporary")


def test_empty_table(spark, pages, scratch):
    W.write_warc(pages([]), f"{scratch}/a")
    assert W.read_warc(spark, f"{scratch}/a").collect() == [] and W.manifest(spark, f"{scratch}/a").collect() == []


def files(folder):
    return {n: open(f"{folder}/{n}", "rb").read() for n in sorted(os.listdir(folder)) if n.endswith(".warc.gz")}


def test_same_pages_give_the_same_files_however_they_are_dealt(spark, pages, scratch):
    W.write_warc(pages(ROWS * 3).repartition(7), f"{scratch}/a", shard_bytes=20_000, roll_bytes=1500)
    W.write_warc(pages(list(reversed(ROWS * 3))).coalesce(1), f"{scratch}/b", shard_bytes=20_000, roll_bytes=1500)
    a, b = files(f"{scratch}/a"), files(f"{scratch}/b")
    assert a == b and len(a) > 8
    said = {r["name"]: r for r in W.manifest(spark, f"{scratch}/a").collect()}
    assert {n: hashlib.sha256(x).hexdigest() for n, x in a.items()} == {n: r["sha256"] for n, r in said.items()}


def test_files_roll_by_compressed_size_and_hold_one_member_a_record(spark, pages, scratch):
    rows = [(i, f"u{i}", hashlib.sha256(str(i).encode()).hexdigest() * 20) for i in range(300)]
    W.write_warc(pages(rows), f"{scratch}/a", roll_bytes=20_000)
    order = []
    for name, raw in files(f"{scratch}/a").items():
        members, rest = [], raw
        while rest:
            d = zlib.decompressobj(31)
            members.append(d.decompress(rest))
            rest = d.unused_data
        assert members[0].startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and all(m.endswith(b"\r\n\r\n") for m in members)
        order += [int(m.split(b"X-Page-Id: ")[1].split(b"\r\n")[0]) for m in members[1:]]
        assert len(raw) < 20_000 + 2_000
    assert order == list(range(300)) and len(files(f"{scratch}/a")) > 5


def test_many_copies_of_a_row_are_dealt_out(spark, pages, scratch, monkeypatch):
    monkeypatch.setattr(W, "COPIES", 16)
    rows = [(1, "u", LONG)] * 200 + [(2, "u", "s")] * 100 + [(3, "u", LONG)] * 70
    W.write_warc(pages(rows), f"{scratch}/a", shard_bytes=10_000)
    assert told(W.read_warc(spark, f"{scratch}/a")) == expected(rows)
    assert W.manifest(spark, f"{scratch}/a").select("shard").distinct().count() > 10


def test_left_over_files_are_never_read_and_damage_is_found(spark, pages, scratch):
    out = f"{scratch}/a"
    os.makedirs(f"{out}/_temporary")
    open(f"{out}/_temporary/000000-0000.warc.gz.dead", "wb").write(b"half a fi")  # of an attempt that was lost
    W.write_warc(pages(ROWS), out)
    open(f"{out}/000009-0000.warc.gz", "wb").write(b"not in the manifest")
    assert told(W.read_warc(spark, out)) == expected(ROWS)
    name, raw = next(iter(files(out).items()))
    text = gzip.decompress(raw).replace(b"short", b"shirt", 1)
    with pytest.raises(ValueError, match="digest differs"):
        list(W.records(io.BytesIO(gzip.compress(text))))
    open(f"{out}/{name}", "wb").write(b"".join(W.record([("WARC-Type", "warcinfo")], b"") for _ in range(2)))
    with pytest.raises(Exception, match="the manifest says"):
        W.read_warc(spark, out).collect()


def test_a_repeated_rename_task_changes_nothing(scratch):
    import pyarrow as pa

    store, folder = W.file_system(scratch)
    store.create_dir(f"{folder}/_temporary")
    f = W._File(store, folder, 0, 0, W.DATE, 6)
    f.add(W.record([("WARC-Type", "metadata")], b"x"))
    said = f.close()
    batch = pa.RecordBatch.from_pylist([said])
    run = W._rename_task(scratch)
    first, again = list(run(iter([batch]))), list(run(iter([batch])))
    assert first == again and files(scratch)[said["name"]]
    with pytest.raises(FileNotFoundError):
        list(run(iter([pa.RecordBatch.from_pylist([{**said, "name": "gone", "temporary": "gone.1"}])])))
