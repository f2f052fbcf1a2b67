"""Operator 3: token ids in a compressed binary format.

A block is coded by itself: header, states, words. Lanes are equal runs of the block's ids
that are coded side by side, one id of each lane a step, so a step works on arrays; all
lanes of a block share its models, which start empty in every block.

An id is coded by decisions: is it the id that followed last time after the two ids before
it (order 2), else, is it the one that followed after the one before it (order 1), else,
which id (by adaptive order-0 frequencies). The probability of each yes or no mixes all
three contexts: its logit is a weighted sum of what order 2, order 1 and order 0 say for or
against the candidate, and the weights learn from the coding error after every step. All
arithmetic is on integers (floats hold whole numbers exactly), so any machine decodes what
another wrote.

Decisions and ids become bits by a range variant of asymmetric numeral systems: each lane is
one 63-bit state. Its coder runs from the last step to the first, so that the reader goes
forward; whenever states run low, the reader gives the next words to those lanes in order.

Layout (little-endian): magic 'TKB2', ids (u4), lanes (u4), crc32 of the ids as u4 (u4),
state of each lane (u8 each), then the words (u4 each). A wrong checksum is an error.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import shared_path, text_key
from strata.llm.pretokens import default_vocabulary, load_vocabulary
from strata.llm.token_counts import library_encoder

MAGIC = b"TKB2"
BLOCK_IDS = 5 << 16  # ids of a block at most
MAX_LANES = 4096
STEP_IDS = 64  # ids of a lane at least, where the block has as many
U = np.uint64
LOW32 = U(0xFFFFFFFF)
LEAST = 1 << 31  # of a lane's state between steps
ID_BITS = 24  # scale of the order-0 sums


def _log(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of positive integers in 1/1024, the same on every machine (straight between powers of two)."""
    # a double's exponent and the first ten bits of its fraction
    return ((np.asarray(x, np.float64).view(np.int64) >> 42) - (1023 << 10)) * 710 >> 10


class _Models:
    """What coder and decoder learn alike, step by step."""

    ONE = 1 << 15  # probabilities of the decisions
    # 1 / (1 + e^-x) for x in 1/64 from -12 to 12, never quite 0 or ONE
    SQUASH = np.array([min(max(round(32768 / (1 + math.exp(-i / 64))), 32), 32768 - 96) for i in range(-768, 769)], np.int32)
    RENEW = 2, 16  # the order-0 sums are renewed when the steps grew by half, after 16 steps at most

    def __init__(self, alphabet: int):
        if alphabet > 1 << ID_BITS - 2:
            raise ValueError("alphabet too large for the scale of its sums")
        self.freq = np.ones(alphabet, np.int32)
        # by context: the id that followed, and how sure that is (log odds, 1/1024), side by side
        self.pairs = [np.full(size, np.array([0, -2048], np.int32).view(np.int64)[0]) for size in (1 << 18, 1 << 16)]
        (self.next2, self.sure2), (self.next1, self.sure1) = ((p.view(np.int32)[::2], p.view(np.int32)[1::2]) for p in self.pairs)
        # weights (1/1024) of: always, order 2, order 1, order 0; for the decision on order 2's id and for that on order 1's
        self.weights = np.array([[0, 700, 300, 40], [0, 100, 700, 40]], np.int64)
        self.steps = self.due = 0
        self._renew()

    def _renew(self) -> None:
        sums = np.zeros(len(self.freq) + 1, np.int64)
        np.cumsum(self.freq, out=sums[1:])
        if sums[-1] > 1 << ID_BITS - 1:
            self.freq += 1
            self.freq >>= 1
            np.cumsum(self.freq, out=sums[1:])
        total = int(sums[-1])
        self.total = int(_log(np.array([total]))[0]) + 127 * 710  # with the bias of a float's exponent
        sums *= (1 << 2 * ID_BITS) // total  # 1 << ID_BITS + 1 or more: no id's share is empty
        sums >>= ID_BITS
        sums[-1] = 1 << ID_BITS
        self.sums = sums.astype(np.int32)
        part, most = self.RENEW
        self.due = self.steps + min(self.steps // part, most - 1)

    def expect(self, a: np.ndarray, b: np.ndarray):
        """For ids ``a`` before ``b`` before the next: (order-2 id, order-1 id, and their shares of ONE)."""
        n = len(a)
        self.at1 = b & 0xFFFF
        self.at2 = (a * 0x9E3779B1 + b * 0x85EBCA6B >> 14) & 0x3FFFF
        # two rows everywhere: the decision on order 2's id, that on order 1's
        self.by, self.sure = by, sure = np.empty((2, n), np.int32), np.empty((2, n), np.int32)
        for d, at in enumerate((self.at2, self.at1)):
            pair = self.pairs[d].take(at).view(np.int32)
            by[d], sure[d] = pair[::2], pair[1::2]
        self.same = by[1] == by[0]
        # a context speaks for its own id, and, where it is sure, against the other's
        self.seen = seen = np.empty((3, 2, n), np.int32)
        against = np.negative(np.maximum(sure, 0))
        seen[0, 0], seen[0, 1] = sure[0], against[0]
        seen[1, 0], seen[1, 1] = against[1] + (sure[1] - against[1]) * self.same, sure[1]
        # _log of the frequencies, which a float holds exactly
        often = self.freq.take(by).astype(np.float32).view(np.int32)
        often >>= 13
        often *= 710
        often >>= 10
        np.subtract(often, self.total, out=seen[2])
        w = self.weights.astype(np.int32)[:, :, None]
        x = seen[0] * w[:, 1]
        x += seen[1] * w[:, 2]
        x += seen[2] * w[:, 3]
        x += (w[:, 0] << 10) + (768 << 14)
        x >>= 14
        self.p = self.SQUASH.take(x, mode="clip")
        two = self.p[0]
        left = self.ONE - two
        one = left * self.p[1]
        one >>= 15
        one *= ~self.same
        np.maximum(one, 16, out=one)
        left -= 32
        np.minimum(one, left, out=one)
        return by[0], by[1], two, one

    def shares(self, two: np.ndarray, one: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, size) in ONE of each lane's outcome: 0 for order 2's id, 1 for order 1's, 2 for neither."""
        n = len(two)
        bounds = np.zeros((4, n), np.int32)
        bounds[1], bounds[3] = two, self.ONE
        np.add(two, one, out=bounds[2])
        at = which * n
        at += np.arange(n)
        begin = bounds.take(at)
        at += n
        return begin, bounds.take(at) - begin

    def find(self, value: np.ndarray) -> np.ndarray:
        """Ids whose order-0 share holds each value; in ascending order, as neighbours are found faster."""
        keyed = value.astype(np.int64) << 32
        keyed |= np.arange(len(value))
        keyed.sort()
        found = np.empty(len(value), np.int64)
        found[keyed & 0xFFFFFFFF] = np.searchsorted(self.sums, (keyed >> 32).astype(np.int32), side="right") - 1
        return found

    def learn(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        hit = np.array([hit2, hit1], np.int32)
        off = (hit << 15) - self.p  # the coding error, 1/32768
        off[1] *= (hit[0] == 0) & ~self.same  # the second decision is not always taken
        seen, off = self.seen.astype(np.float64), off.astype(np.float64)  # whole numbers below 2^53: exact in any order
        sums = np.empty((2, 4))
        sums[:, 0], sums[:, 1:] = 1024 * off.sum(axis=1), np.vecdot(seen, off).T
        self.weights += sums.astype(np.int64) >> 20 + len(ids).bit_length()
        np.minimum(self.weights, 4096, out=self.weights)
        np.maximum(self.weights, -4096, out=self.weights)
        hit *= 560
        hit -= 160
        hit += self.sure
        np.clip(hit, -6000, 6000, out=hit)
        pair = np.empty((2, len(ids), 2), np.int32)
        now = ids.astype(np.int32)
        kept = self.by - now
        kept *= self.sure > 1024  # a sure context keeps its id once
        np.add(kept, now, out=pair[:, :, 0])
        pair[:, :, 1] = hit
        pair = pair.view(np.int64)[:, :, 0]
        self.pairs[0][self.at2], self.pairs[1][self.at1] = pair[0], pair[1]
        np.add.at(self.freq, ids, np.int32(24))
        self.steps += 1
        if self.steps > self.due:
            self._renew()


def _shape(n: int) -> tuple[int, int]:
    lanes = max(1, min(MAX_LANES, n // STEP_IDS))
    return lanes, -(-n // lanes)


def encode_block(ids: np.ndarray, alphabet: int) -> bytes:
    """Bytes of one block of ids below ``alphabet`` (any number of them, none included)."""
    ids = np.ascontiguousarray(ids, "<u4")
    lanes, steps = _shape(len(ids))
    if len(ids) and int(ids.max()) >= alphabet:
        raise ValueError("id beyond the alphabet")
    grid = np.zeros(lanes * steps, np.int32)
    grid[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    models = _Models(alphabet)
    shares: list[tuple] = []  # (begin, size) of each step's decisions; lanes without a hit, and (begin, size) of their ids
    a = b = np.zeros(lanes, np.int64)
    for row in grid:
        ids_now = row.astype(np.int64)
        by2, by1, two, one = models.expect(a, b)
        hit2, hit1 = ids_now == by2, ids_now == by1
        miss = ~(hit2 | hit1)
        rest = np.flatnonzero(miss)
        x = ids_now[rest]
        begin = models.sums.take(x)
        shares.append((*models.shares(two, one, np.add(~hit2, miss, dtype=np.int64)), rest, begin, models.sums.take(x + 1) - begin))
        models.learn(ids_now, hit2, hit1)
        a, b = b, ids_now
    words: list[np.ndarray] = []

    def put(state: np.ndarray, begin: np.ndarray, size: np.ndarray, bits: int) -> np.ndarray:
        size = size.astype(U)
        full = np.flatnonzero(state >= size << U(63 - bits))
        over = state[full]
        words.append((over & LOW32).astype("<u4"))
        state[full] = over >> U(32)
        times = state // size
        return (times << U(bits)) + (state - times * size) + begin.astype(U)

    state = np.full(lanes, LEAST, U)
    for first, size, rest, begin, share in reversed(shares):
        if len(rest):
            state[rest] = put(state[rest], begin, share, ID_BITS)
        state = put(state, first, size, 15)
    words.append(state.astype("<u8").view("<u4"))
    return MAGIC + struct.pack("<III", len(ids), lanes, zlib.crc32(ids.tobytes())) + np.concatenate(words[::-1]).tobytes()


def decode_block(block: bytes, alphabet: int) -> np.ndarray:
    """Ids of a block; ValueError if the block is damaged."""
    if len(block) < 16 or block[:4] != MAGIC:
        raise ValueError("no token block")
    n, lanes, crc = struct.unpack_from("<III", block, 4)
    if (lanes, -(-n // max(lanes, 1))) != _shape(n) or len(block) < 16 + 8 * lanes:
        raise ValueError("token block: wrong header")
    if len(block) % 4:
        raise ValueError("token block: wrong length")
    steps = _shape(n)[1]
    state = np.frombuffer(block, "<u8", lanes, 16).astype(np.int64)
    words, at = np.frombuffer(block, "<u4", -1, 16 + 8 * lanes).astype(np.int64), 0
    models = _Models(alphabet)

    def fill(state: np.ndarray) -> None:
        nonlocal at
        low = np.flatnonzero(state < LEAST)
        if at + len(low) > len(words):
            raise ValueError("token block: wrong length")
        state[low] = state[low] << 32 | words[at : at + len(low)]
        at += len(low)

    a = b = np.zeros(lanes, np.int64)
    out = np.zeros((steps, lanes), "<u4")
    for row in out:
        by2, by1, two, one = models.expect(a, b)
        value = (state & (models.ONE - 1)).astype(np.int32)
        hit2, miss = value < two, value >= two + one
        first, size = models.shares(two, one, np.add(~hit2, miss, dtype=np.int64))
        state >>= 15
        state *= size
        state += value - first
        fill(state)
        ids_now = (by1 + (by2 - by1) * hit2).astype(np.int64)
        rest = np.flatnonzero(miss)
        if len(rest):
            some = state[rest]
            value = (some & ((1 << ID_BITS) - 1)).astype(np.int32)
            x = models.find(value)
            begin = models.sums.take(x)
            some >>= ID_BITS
            some *= models.sums.take(x + 1) - begin
            some += value - begin
            fill(some)
            state[rest] = some
            ids_now[rest] = x
        row[:] = ids_now
        models.learn(ids_now, hit2, ids_now == by1)
        a, b = b, ids_now
    ids = np.ascontiguousarray(out.T.reshape(-1)[:n], "<u4")
    if zlib.crc32(ids.tobytes()) != crc or at != len(words):
        raise ValueError("token block: wrong checksum")
    return ids


# ---------------------------------------------------------------- Spark
# A file row is one block: its place (file, block), and the documents' pieces in it, in order.
FILE_SCHEMA = "file int, block int, n_ids bigint, payload binary, doc_ids array<bigint>, sizes array<bigint>, last array<boolean>"


def alphabet_of(path: str) -> int:
    vocab, _, special = load_vocabulary(path)
    return max([*vocab.values(), *special.values()]) + 1


def write_token_files(docs: DataFrame, out: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, path: str | None = None) -> None:
    """Encode every whole text, append ``end_id``, and write blocks to ``out`` in ascending id order.

    Files hold ranges of ids in order, blocks the ids of a file in order; a long document spans
    blocks. NULL texts are empty; rows with one id (or none) follow each other by the text's first
    characters and its hash, and may fill many files; NULL ids come first; other columns are
    ignored; an empty table writes no block.
    """
    path = path or default_vocabulary()
    alphabet = alphabet_of(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        file, block = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        pieces: list[tuple] = []  # (doc_id, ids, whether the document ends)
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, pieces, size, block
            ids = np.concatenate(held) if held else np.zeros(0, np.uint32)
            row = [file, block, len(ids), encode_block(ids, alphabet), *(list(c) for c in zip(*pieces, strict=True))]
            held, pieces, size, block = [], [], 0, block + 1
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_())]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=["file", "block", "n_ids", "payload", "doc_ids", "sizes", "last"])

        def documents(batch: pa.RecordBatch) -> Iterator[tuple]:
            names = iter(batch.column(0).to_pylist())
            for ids, ends in library_encoder(path).slices(batch.column(1)):
                for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
                    yield next(names), np.append(ids[a:b], np.uint32(end_id)).astype(np.uint32)

        for batch in batches:
            for doc, own in documents(batch):
                at = 0
                while at < len(own):
                    part = own[at : at + BLOCK_IDS - size]
                    at += len(part)
                    held.append(part)
                    pieces.append((doc, len(part), at == len(own)))
                    size += len(part)
                    if size == BLOCK_IDS:
                        yield flush()
        if size:
            yield flush()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # rows that agree in all but the last are the same, so any order of these gives the same files
    order = ["doc_id", "_begin", "_key", "_row"]
    rows = rows.withColumns({"_begin": F.substring("text", 1, 64), "_key": text_key(F.col("text")), "_row": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    rows.mapInArrow(run, FILE_SCHEMA).write.parquet(out)


def read_token_files(files: DataFrame, alphabet: int) -> DataFrame:
    """(file, block, piece, doc_id, last, ids): the documents' pieces in the blocks; ids are packed u4."""
    return files.mapInArrow(_pieces(alphabet, lambda ids: ids.tobytes(), pa.binary()), "file int, block int, piece int, doc_id bigint, last boolean, at bigint, size bigint, ids binary").drop("at", "size")


def _pieces(alphabet: int, describe, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = decode_block(r["payload"], alphabet)
                ends = np.cumsum(np.array(r["sizes"], np.int64))
                if ends[-1] != len(ids):
                    raise ValueError("token block: index and ids differ")
                n, begins = len(ends), np.append(0, ends[:-1])
                said = [describe(ids[x:y]) for x, y in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["file"]] * n, pa.int32()), pa.array([r["block"]] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(r["doc_ids"], pa.int64()), pa.array(r["last"], pa.bool_()), pa.array(begins), pa.array(r["sizes"], pa.int64()), pa.array(said, kind)],
                    names=["file", "block", "piece", "doc_id", "last", "at", "size", "said"],
                )

    return run


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC-32 polynomial (lowest power in the highest bit)."""
    out = 0
    while a:
        if a >> 31:
            out ^= b
        a = a << 1 & 0xFFFFFFFF
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def crc32_joined(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two strings together, from the crc32 of each and the second's length."""
    shift, power = 1 << 31, 1 << 23  # 1 and x^8
    while second_bytes:
        if second_bytes & 1:
            shift = _times(shift, power)
        power, second_bytes = _times(power, power), second_bytes >> 1
    return _times(shift, first) ^ second


def read_documents(files: DataFrame, alphabet: int) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Blocks are decoded where they are read; only a small row for each piece of a document
    moves. A document that spans blocks is put together from its pieces' checksums.
    """
    # ids before each block: one small row a block, summed inside files, then over files
    blocks = files.select("file", "block", "n_ids")
    per_file = blocks.groupBy("file").agg(F.sum("n_ids").alias("_n"))  # a row for each file
    per_file = per_file.select("file", F.coalesce(F.sum("_n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_own", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(per_file, "file").select("file", "block", (F.col("_own") + F.col("_before")).alias("block_start"))
    pieces = files.mapInArrow(_pieces(alphabet, lambda ids: zlib.crc32(ids), pa.int64()), "file int, block int, piece int, doc_id bigint, last boolean, at bigint, size bigint, crc bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []  # (start, ids, crc) of the document at hand
        for batch in batches:
            for begin, doc, size, last, crc in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                now = (begin, size, crc) if now is None else (now[0], now[1] + size, crc32_joined(now[2], crc, 4 * size))
                if last:
                    out.append((doc, *now))
                    now = None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                out = []

    rows = pieces.join(starts, ["file", "block"]).withColumn("begin", F.col("block_start") + F.col("at"))
    rows = rows.repartition("file").sortWithinPartitions("file", "block", "piece")
    return rows.select("begin", "doc_id", "size", "last", "crc").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the documents' ids as files in the shared folder, read them back and describe each document."""
    path = path or default_vocabulary()
    out = shared_path(docs.sparkSession, "token_files")
    write_token_files(docs, out, path=path)
    return read_documents(docs.sparkSession.read.schema(FILE_SCHEMA).parquet(out), alphabet_of(path))


__all__ = ["crc32_joined", "decode_block", "encode_block", "read_documents", "read_token_files", "round_trip", "write_token_files"]
