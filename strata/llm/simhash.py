"""Operator 10: SimHash near-duplicates by pigeonhole blocks.

A text's fingerprint takes the majority, bit by bit, over the XXH64 values of its
word shingles. Two fingerprints that differ in at most ``d`` of 64 bits, cut into
``d + 2`` or more blocks, agree on all but ``d`` blocks; joining on every choice of
blocks that may agree therefore meets every close pair. Candidates that meet are
verified by Hamming distance.

Many texts on one template agree in most bits and would meet in one bucket. A bucket of
more than ``SPLIT`` fingerprints is dealt out again before its rows are shuffled, by the
same rule: the bits that vary in it are cut into blocks, and every choice of these that
may agree joins the bucket's mask.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import connected_components, let_go, materialize, ship, text_key
from strata.operators.joins import broadcast_if_small

SPLIT = 1 << 15  # fingerprints of a bucket that one task compares; more are dealt out by further blocks
SEEN = 512  # fingerprints of a bucket of SPLIT that the look for large buckets sees on average


def _fingerprint(text: str | None, shingle: int, seed: int) -> int:
    words = [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z, \x20 and \x09-\x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begin = np.empty_like(ends)
    begin[0], begin[1:] = 0, ends[:-1]
    n = len(words) - shingle + 1
    cuts = zip(begin[:n].tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)
    counts, chunk = np.zeros(64, np.int64), []
    for a, b in cuts:
        chunk.append(digest(joined[a:b], seed))
        if len(chunk) == 1 << 16:  # bounded memory for very long texts
            counts += _bit_counts(chunk)
            chunk = []
    counts += _bit_counts(chunk)
    bits = (counts * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _bit_counts(hashes: list[int]) -> np.ndarray:
    if not hashes:
        return np.zeros(64, np.int64)
    raw = np.array(hashes, np.uint64).astype("<u8").view(np.uint8).reshape(len(hashes), 8)
    return np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def simhash(text: Column, shingle: int = 4, seed: int = 42) -> Column:
    """64-bit fingerprint (BIGINT, the unsigned value's bits) of a text column.

    Lower-cases A-Z, splits at ASCII white space, hashes every run of ``shingle`` words
    (repeats count; fewer words: all of them as one; none or NULL: fingerprint 0).
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                got = np.fromiter((_fingerprint(t.as_py(), shingle, seed) for t in texts), np.uint64, len(texts))
                yield pa.array(got.view(np.int64))
        finally:
            let_go()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "bigint")(text)


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """Bit masks of every choice of ``blocks - max_bits`` of ``blocks`` near-equal blocks of 64 bits."""
    if not 0 < max_bits < blocks <= 64:
        raise ValueError("need 0 < max_bits < blocks <= 64")
    return _choices(list(range(64)), blocks, max_bits)


def _choices(bits: list[int], blocks: int, max_bits: int) -> list[int]:
    edges = [len(bits) * i // blocks for i in range(blocks + 1)]
    one = [sum(1 << b for b in bits[edges[i] : edges[i + 1]]) for i in range(blocks)]
    return [sum(c) for c in combinations(one, blocks - max_bits)]


def finer_masks(mask: int, varying: int, max_bits: int) -> list[int]:
    """Masks that split a bucket of ``mask``: every close pair of the bucket still agrees on one of them.

    The bits of ``varying`` are cut into ``max_bits + 2`` blocks; two fingerprints that
    differ in at most ``max_bits`` bits differ in at most as many blocks. Bits outside
    ``varying`` are left free, so ``varying`` may be any part of the bits that vary. None
    where it has no more than ``max_bits`` bits: no choice of blocks is sure to agree then.
    """
    bits = [b for b in range(64) if varying >> b & 1 and not mask >> b & 1]
    blocks = min(max_bits + 2, len(bits))
    return [mask | c for c in _choices(bits, blocks, max_bits)] if blocks > max_bits else []


def _signed(m: int) -> int:
    return m - (1 << 64) if m >> 63 else m


def blocks_for(rows: int, max_bits: int) -> int:
    """Blocks whose joint key has at least log2(rows) + 2 bits, so that chance meetings stay below a constant per row.

    More blocks mean longer keys and more choices of blocks; every choice finds every close pair.
    """
    blocks = max_bits + 1
    while 64 * (blocks - max_bits) // blocks < max(rows, 2).bit_length() + 2 and blocks < max_bits + 6:
        blocks += 1
    return blocks


def _links_in_buckets(max_bits: int):
    """Edges (a, b) that connect exactly what lies within ``max_bits`` inside each bucket of equal (mask_id, key).

    Input partitions are sorted by bucket. A bucket yields a spanning forest, not all of
    its pairs: from each unvisited fingerprint, breadth first over those not yet reached.
    """

    def small(fp: np.ndarray, start: np.ndarray, size: np.ndarray):
        """All buckets of few rows at once: each row against the d-th next of its bucket."""
        left = np.repeat(start + size, size) - np.arange(len(fp)) - 1  # rows after this one in its bucket
        for d in range(1, int(size.max())):
            at = np.flatnonzero(left >= d)
            near = np.bitwise_count(fp[at] ^ fp[at + d]) <= max_bits
            yield fp[at[near]], fp[at[near] + d]

    def large(fp: np.ndarray):
        rest, out_a, out_b = fp, [], []
        while len(rest):
            queue, rest = [rest[0]], rest[1:]
            while queue and len(rest):
                x = queue.pop()
                near = np.bitwise_count(rest ^ x) <= max_bits
                if near.any():
                    hit = rest[near]
                    out_a.append(np.full(len(hit), x))
                    out_b.append(hit)
                    queue.extend(hit)
                    rest = rest[~near]
        none = np.zeros(0, np.uint64)
        return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (none, none)

    def edges(mask: np.ndarray, key: np.ndarray, fp: np.ndarray):
        new = np.ones(len(fp), bool)
        new[1:] = (key[1:] != key[:-1]) | (mask[1:] != mask[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(fp)))
        few = np.repeat(size <= 32, size)
        if few.any():
            kept = size[size <= 32]
            yield from small(fp[few], np.cumsum(kept) - kept, kept)
        for s, n in zip(start[size > 32], size[size > 32], strict=True):
            yield large(fp[s : s + n])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last bucket so far: it may go on in the next batch
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = last[-1] + 1 if len(last) else 0
            held = [c[cut:] for c in cols]
            if cut:
                yield from out(edges(*(c[:cut] for c in cols[:2]), cols[2][:cut].view(np.uint64)))
        if held is not None:
            yield from out(edges(held[0], held[1], held[2].view(np.uint64)))

    def out(pairs) -> Iterator[pa.RecordBatch]:
        for a, b in pairs:
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return run


def _large_buckets(met: DataFrame, max_bits: int, split: int) -> DataFrame:
    """(mask, key, finer): the buckets to split, with the masks that split them.

    A seeded sample of the rows names the buckets; it decides where rows are compared,
    never whether: a large bucket that it misses is compared whole.
    """
    part = min(1.0, SEEN / split)
    seen = met.sample(part, seed=7).groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"), F.bit_or("fp").alias("some"), F.bit_and("fp").alias("all"))

    def run(masks: pa.Array, varying: pa.Array) -> pa.Array:
        pairs = zip(masks.to_pylist(), varying.to_pylist(), strict=True)
        return pa.array([[_signed(m) for m in finer_masks(x % (1 << 64), v % (1 << 64), max_bits)] for x, v in pairs], pa.list_(pa.int64()))

    run.__annotations__ = {"masks": pa.Array, "varying": pa.Array, "return": pa.Array}
    finer = F.arrow_udf(run, "array<bigint>")(F.col("mask"), F.col("some").bitwiseXOR(F.col("all")))
    large = seen.where(F.col("n") > split * part / 2).select("mask", "key", finer.alias("finer"))
    return materialize(large.where(F.size("finer") > 0), "simhash_large")


def _met(rows: DataFrame, masks: Column) -> DataFrame:
    """(mask, key, fp): each fingerprint in its bucket of each mask."""
    return rows.select("fp", F.explode(masks).alias("mask")).select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def _bucket_links(prints: DataFrame, masks: list[int], rows: int, max_bits: int, split: int) -> DataFrame:
    """(a, b): links that connect what lies within ``max_bits`` bits of each other; no bucket much above ``split`` rows is held by one task."""
    met, found = _met(prints, F.array(*[F.lit(_signed(m)) for m in masks])), []
    large = _large_buckets(met, max_bits, split) if rows > split else None
    while large is not None and not large.isEmpty():
        few = broadcast_if_small(large)
        found.append(_compared(met.join(few, ["mask", "key"], "left_anti"), max_bits))
        # masks of several buckets may coincide: a fingerprint is one row of the common bucket
        met = materialize(_met(met.join(few, ["mask", "key"]), F.col("finer")).distinct(), "simhash_split")
        large = _large_buckets(met, max_bits, split)
    links = _compared(met, max_bits)
    for part in found:
        links = links.unionAll(part)
    return links


def _compared(met: DataFrame, max_bits: int) -> DataFrame:
    return met.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInArrow(_links_in_buckets(max_bits), "a bigint, b bigint")


def hamming_components(prints: DataFrame, max_bits: int = 4, blocks: int | None = None, split: int = SPLIT) -> DataFrame:
    """(fp, component) for distinct BIGINT fingerprints ``fp`` that have a link; links join fingerprints within ``max_bits`` bits.

    ``prints`` is read several times: give a written table. Buckets of more than about
    ``split`` fingerprints are split by further blocks, on Spark, until none is left.
    """
    ship(prints.sparkSession)
    rows = prints.count()
    masks = block_masks(blocks or blocks_for(rows, max_bits), max_bits)
    found = connected_components(_bucket_links(prints, masks, rows, max_bits, split))
    return found.select(F.col("node").alias("fp"), "component")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4, seed: int = 42, blocks: int | None = None) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, text_key.

    Rows whose fingerprints differ in at most ``max_bits`` bits are linked; component_id is
    the smallest id reachable over links, the row's own included. Equal fingerprints are one
    node of the graph, so copies cost one row each and no pairs.

    Defined cases: NULL and empty texts have fingerprint 0 and link like any other; repeated
    rows give repeated result rows; NULL ids are linked, but never smallest unless all of a
    component's ids are NULL; an empty table gives an empty result; other columns of the
    input are ignored, whatever their names.
    """
    rows = _with_first(docs, id_col, text_col, shingle, max_bits, seed, blocks)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first.doc_id").alias("component_id"), "text_key")


def _with_first(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, seed: int, blocks: int | None) -> DataFrame:
    """A row per row: doc_id, fp, text_key, first (none, doc_id, text_key): the smallest (doc_id, text_key) of its component, NULL ids last."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.select("doc_id", simhash(F.col("text"), shingle, seed).alias("fp"), text_key(F.col("text")).alias("text_key"))
    rows = materialize(rows, "simhash_rows")
    nodes = materialize(rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")), "simhash_prints")
    found = hamming_components(nodes.select("fp"), max_bits, blocks)
    node = nodes.join(found, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    least = node.groupBy("component").agg(F.min("first").alias("first"))
    comp = node.drop("first").join(least, "component").select("fp", "first")
    return rows.join(comp, "fp")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` (columns doc_id, text and others) with one row of each near-duplicate group: the smallest id's.

    Of several texts under that id, or of texts without id where none of the group has one,
    the one with the smallest text_key stays; ids may repeat within and across groups.
    """
    from strata.llm.common import drop_rows, one_of_repeated

    found = _with_first(docs, "doc_id", "text", shingle, max_bits, 42, None)
    chosen = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    return one_of_repeated(drop_rows(docs, found.where(~chosen)))
