from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from strata.llm import queries as Q
from strata.llm import token_files as T
from strata.llm.common import shared_path
from strata.llm.pretokens import default_vocabulary
from tests.llm.conftest import SF001


def expected(docs):
    t, start, out = Tokenizer.from_file(default_vocabulary()), 0, []
    for i, text in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_on_the_small_tables(spark, documents):
    docs = sorted(tuple(r) for r in documents.select("doc_id", "text").collect())
    assert sorted(tuple(r) for r in Q.op3_token_files(spark, SF001).collect()) == expected(docs)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000, 40000])
def test_blocks_come_back(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 50257, n), rng.zipf(1.3, n) % 50257, np.full(n, 50256), np.tile(np.arange(7), n)[:n]):
        block = T.encode_block(ids.astype(np.uint32), 50257)
        assert (T.decode_block(block, 50257) == ids).all()


def test_predictable_ids_shrink():
    ids = np.tile(np.random.default_rng(1).integers(0, 50257, 300), 400).astype(np.uint32)
    assert len(T.encode_block(ids, 50257)) < len(ids) // 2


def test_every_decision_mixes_all_contexts():
    """One context's opinion changes the probability of the other's candidate, and the weights learn from the error."""
    m, a, b = T._Models(100), np.array([3]), np.array([5])
    m.expect(a, b)
    m.next1[m.at1], m.next2[m.at2] = 7, 9
    _, _, two, one = m.expect(a, b)
    m.sure1[m.at1] = 5000
    assert m.expect(a, b)[2] < two and m.expect(a, b)[3] > one  # order 1 is sure of another id
    m.next1[m.at1] = 9
    agreed = m.expect(a, b)[2]
    assert agreed > two  # both say the same
    m.freq[9] += 500
    assert m.expect(a, b)[2] > agreed  # and order 0 knows it well
    before = [w.copy() for w in m.weights]
    for _ in range(50):
        m.expect(a, b)
        m.learn(np.array([9]), np.array([1]), np.array([1]))
    assert any((x != y).any() for x, y in zip(before, m.weights, strict=True))


def test_logarithms_are_close_and_whole():
    x = np.array([1, 2, 3, 24, 1000, 50257, 10**12])
    assert T._log(x).dtype == np.int64 and np.abs(T._log(x) / 1024 - np.log(x)).max() < 0.07


def test_damage_is_found():
    block = T.encode_block(np.arange(5000, dtype=np.uint32), 50257)
    for at in (0, 5, 13, 20, len(block) // 2):
        bad = bytearray(block)
        bad[at] ^= 0x41
        with pytest.raises(ValueError):
            T.decode_block(bytes(bad), 50257)
    with pytest.raises(ValueError):
        T.decode_block(block[:-4], 50257)
    with pytest.raises(ValueError):
        T.encode_block(np.array([50257], np.uint32), 50257)


def test_joined_checksums():
    a, b = b"some bytes", bytes(range(256)) * 41
    assert T.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert T.crc32_joined(zlib.crc32(a), zlib.crc32(b""), 0) == zlib.crc32(a)


def test_defined_cases(spark, docs_of, monkeypatch):
    docs = [(5, "b"), (5, "a"), (5, "a"), (None, "first"), (7, None), (6, ""), (-3, "x " * 700000), (9, "<|endoftext|>!")]
    out = shared_path(spark, "files")
    T.write_token_files(docs_of(docs, clashing=True), out)
    files = spark.read.schema(T.FILE_SCHEMA).parquet(out)
    got = sorted((tuple(r) for r in T.read_documents(files, 50257).collect()), key=lambda r: r[1])
    assert got == expected(sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")))
    assert files.where("doc_ids[0] = -3").count() > 1  # one document over several blocks
    pieces = T.read_token_files(files, 50257).collect()
    assert sum(len(r["ids"]) // 4 for r in pieces) == sum(r[2] for r in got)


def test_empty_table(spark, docs_of):
    out = shared_path(spark, "files")
    T.write_token_files(docs_of([]), out)
    assert T.read_documents(spark.read.schema(T.FILE_SCHEMA).parquet(out), 50257).collect() == []
