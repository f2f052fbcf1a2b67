"""Operator 11: cross-tokenizer alignment by divide and conquer at shared cuts.

Two tokenizers split the same bytes. Where tokens of both end at the same byte the text
can be cut; between neighbouring cuts lies a group, the smallest piece that both spell
with whole tokens. To find the cuts, an interval is split at a common end near its
middle (each end of the one side is looked up by bisection in the other's) and both halves
are treated in the same way; an interval without common end inside is a group. All
intervals of a batch of texts take a step together.

Links are the pairs of an A and a B token occurrence of one group. How many documents
hold an id pair linked is counted over the whole corpus.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize
from strata.llm.pretokens import WordIds, default_vocabulary, row_slices, split_words, token_bytes

PIECES = "piece_bpe_32k.model"  # of the public tokenizer files
NEAR = 8  # ends tried around the middle before whole stretches are looked up
MEMO_WORDS = 150_000  # words of each side a worker remembers in a task, with 8 characters each
SLICE_BYTES = 1 << 20  # of texts that are worked on at once (a longer row alone)
LINKS = 1 << 21  # links that are worked on at once
FREQUENT = 1 << 19  # id pairs at most that are broadcast: those in most documents


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECES)


# --------------------------------------------------------------------------- the two tokenizers
def split_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(units of all rows, units of each row): a run of spaces and what follows up to the next space.

    No piece of the model holds a space behind another character, so no merge crosses a unit's end.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    if offsets[0] == offsets[-1]:
        return pa.array([], pa.large_string()), np.zeros(len(texts), np.int64)
    body = texts.buffers()[2][int(offsets[0]) : int(offsets[-1])]
    blank = np.frombuffer(body, np.uint8) == 0x20
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    bounds = offsets - offsets[0]
    begins[bounds[:-1][np.diff(bounds) > 0]] = True
    starts = np.flatnonzero(begins)
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(np.append(starts, len(blank)).astype(np.int64)), body])
    return words, np.diff(np.searchsorted(starts, bounds))


class SpelledIds(WordIds):
    """Ids of words; a word that its tokens do not spell byte by byte has none, so its row comes out short."""

    def __init__(self, spelled: list[bytes], encode, split):
        super().__init__(encode, split, MEMO_WORDS, 8 * MEMO_WORDS, SLICE_BYTES)
        self.labels = pa.array(spelled, pa.large_binary())

    def _learn(self, words: list[str]) -> None:
        at, before = len(self.size), len(self.pool)
        super()._learn(words)
        new, sizes = self.pool[before:], self.size[at:]
        text = self.labels.take(pa.array(new))
        ends = np.append(0, np.frombuffer(text.buffers()[1], np.int64)[text.offset + 1 : text.offset + len(new) + 1])[np.cumsum(sizes)]
        raws = [w.encode() for w in words]
        want = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)))
        got = bytes(text.buffers()[2] or b"") if len(new) else b""
        if (ends == want).all() and got[: want[-1]] == b"".join(raws):
            return
        begins = np.append(0, ends[:-1])
        wrong = [i for i, (a, b, raw) in enumerate(zip(begins.tolist(), ends.tolist(), raws, strict=True)) if got[a:b] != raw]
        self.size[at + np.array(wrong, np.int64)] = 0


class Tokens:
    """One side: what each id spells, and the ids of texts that begin with a space."""

    def __init__(self, spelled: list[bytes], encode, split):
        self.spelled = spelled
        self.size = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.words = SpelledIds(spelled, encode, split)

    def slices(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return self.words.slices(texts)


@lru_cache(maxsize=2)
def byte_level(path: str) -> Tokens:
    """Side A: byte-level BPE; strings of special tokens are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return Tokens(token_bytes(path), lambda words: [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)], partial(split_words, specials=False))


@lru_cache(maxsize=2)
def pieces(path: str) -> Tokens:
    """Side B: sentence pieces with byte fallback; the model itself puts the space before a text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    mark = "▁"
    if any(mark in n.lstrip(mark) for n in names):
        raise ValueError("pieces cross words: texts cannot be encoded word by word")
    spelled = [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace(mark, " ").encode() for i, n in enumerate(names)]
    alone = [model.piece_to_id(mark)]

    def encode(units: list[str]) -> list[list[int]]:
        got = model.encode([u[1:] for u in units], num_threads=1)
        return [ids if len(u) > 1 else alone for u, ids in zip(units, got, strict=True)]

    return Tokens(spelled, encode, split_units)


# --------------------------------------------------------------------------- cuts
def _near_middle(a_ends: np.ndarray, b_ends: np.ndarray, al: int, ah: int, bl: int, bh: int) -> tuple[int, int]:
    """(place in A, place in B) of the common end nearest to the middle of one interval, or (-1, -1)."""
    first, last = al, ah - 2  # the interval's own end is no cut inside it
    mid, reach = (first + last) // 2, NEAR
    inner = b_ends[bl : bh - 1]
    while True:
        lo, hi = max(first, mid - reach), min(last, mid + reach)
        ends = a_ends[lo : hi + 1]
        at = np.minimum(np.searchsorted(inner, ends), len(inner) - 1)
        hit = np.flatnonzero(inner[at] == ends)
        if len(hit):
            best = hit[np.argmin(np.abs(lo + hit - mid))]
            return lo + int(best), bl + int(at[best])
        if lo == first and hi == last:
            return -1, -1
        reach *= 4


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, a_rows: np.ndarray, b_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Last A and last B token of every group, in order.

    ``a_ends`` and ``b_ends`` are the byte ends of all rows' tokens, ascending over all rows;
    ``a_rows`` and ``b_rows`` say how many tokens lie before each row's end. Rows agree on
    their bytes, so a row's end is common to both.
    """
    some = np.diff(a_rows, prepend=0) > 0
    ah, bh = a_rows[some].astype(np.int64), b_rows[some].astype(np.int64)
    al, bl = np.append(0, ah[:-1])[: len(ah)], np.append(0, bh[:-1])[: len(bh)]
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(ah):
        leaf = (ah - al == 1) | (bh - bl == 1)
        done.append((ah[leaf], bh[leaf]))
        al, ah, bl, bh = al[~leaf], ah[~leaf], bl[~leaf], bh[~leaf]
        cut_a, cut_b = np.full(len(ah), -1), np.full(len(ah), -1)
        open_, mid = np.arange(len(ah)), (al + ah - 2) // 2
        for k in range(NEAR):
            c = mid[open_] + ((k + 1) // 2 if k % 2 else -(k // 2))
            inside = (c >= al[open_]) & (c <= ah[open_] - 2)
            ends = a_ends[np.where(inside, c, 0)]
            at = np.searchsorted(b_ends, ends)
            hit = inside & (b_ends[np.minimum(at, len(b_ends) - 1)] == ends)
            cut_a[open_[hit]], cut_b[open_[hit]] = c[hit], at[hit]
            open_ = open_[~hit]
            if not len(open_):
                break
        wide = ah[open_] - al[open_] - 1 >= NEAR  # shorter intervals have been looked through
        for i in open_[wide].tolist():
            cut_a[i], cut_b[i] = _near_middle(a_ends, b_ends, int(al[i]), int(ah[i]), int(bl[i]), int(bh[i]))
        cut = cut_a >= 0
        done.append((ah[~cut], bh[~cut]))
        ca, cb = cut_a[cut] + 1, cut_b[cut] + 1
        al, ah, bl, bh = np.append(al[cut], ca), np.append(ca, ah[cut]), np.append(bl[cut], cb), np.append(cb, bh[cut])
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(a)
    return a[order], b[order]


@dataclass
class Aligned:
    """Tokens of a run of rows and the groups' ends among them; the rows' ends count tokens and groups."""

    a: np.ndarray
    b: np.ndarray
    a_rows: np.ndarray
    b_rows: np.ndarray
    a_groups: np.ndarray
    b_groups: np.ndarray
    group_rows: np.ndarray


def _kept(ids: np.ndarray, ends: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(ends, prepend=0)
    return (ids, ends) if ok.all() else (ids[np.repeat(ok, n)], np.cumsum(np.where(ok, n, 0)))


def align_texts(texts: pa.Array, a: Tokens, b: Tokens) -> Iterator[Aligned]:
    """Groups of one run of rows after the other, each text with a space before it.

    NULL and empty texts, and those that one of the tokenizers does not spell byte by byte, have no tokens.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
    sizes = np.asarray(pc.binary_length(texts), np.int64)
    at = 0
    for (a_ids, a_rows), (b_ids, b_rows) in zip(a.slices(texts), b.slices(texts), strict=True):
        own = sizes[at : at + len(a_rows)]
        at += len(a_rows)
        a_ends, b_ends = np.cumsum(a.size[a_ids]), np.cumsum(b.size[b_ids])
        total = lambda ends, rows: np.diff(np.append(0, ends)[rows], prepend=0)
        ok = (total(a_ends, a_rows) == own) & (total(b_ends, b_rows) == own)
        if not ok.all():
            (a_ids, a_rows), (b_ids, b_rows) = _kept(a_ids, a_rows, ok), _kept(b_ids, b_rows, ok)
            a_ends, b_ends = np.cumsum(a.size[a_ids]), np.cumsum(b.size[b_ids])
        a_groups, b_groups = shared_cuts(a_ends, b_ends, a_rows, b_rows)
        yield Aligned(a_ids, b_ids, a_rows, b_rows, a_groups, b_groups, np.searchsorted(a_groups, a_rows, side="right"))


# --------------------------------------------------------------------------- groups as text, links
@lru_cache(maxsize=2)
def _decimals(a_size: int, b_size: int) -> pa.Array:
    """Every A id before ',' and '|', then every B id before ',', ';' and nothing."""
    return pa.array([f"{i}{s}" for i in range(a_size) for s in ",|"] + [f"{i}{s}" for i in range(b_size) for s in (",", ";", "")], pa.large_string())


def render(x: Aligned, a_size: int, b_size: int) -> Iterator[memoryview]:
    """``a1,a2|b1;a3|b2,b3`` of each row."""
    n_a, n_b = len(x.a), len(x.b)
    if not n_a:
        yield from [memoryview(b"")] * len(x.a_rows)
        return
    last_a, last_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
    last_a[x.a_groups - 1] = 1
    last_b[x.b_groups - 1] = 1
    last_b[x.b_rows[x.b_rows > 0] - 1] = 2
    na, nb = np.diff(x.a_groups, prepend=0), np.diff(x.b_groups, prepend=0)
    code = np.empty(n_a + n_b, np.int64)
    code[np.arange(n_a) + np.repeat(x.b_groups - nb, na)] = x.a * np.int64(2) + last_a
    code[np.arange(n_b) + np.repeat(x.a_groups, nb)] = 2 * a_size + x.b * np.int64(3) + last_b
    text = _decimals(a_size, b_size).take(pa.array(code))
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(code) + 1][np.append(0, x.a_rows + x.b_rows)].tolist()
    body = memoryview(text.buffers()[2])
    for begin, end in zip(ends[:-1], ends[1:], strict=True):
        yield body[begin:end]


def linked_pairs(x: Aligned, b_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, its links, end of each row): the distinct id pairs of every row, as a * b_size + b, ascending."""
    na, nb = np.diff(x.a_groups, prepend=0), np.diff(x.b_groups, prepend=0)
    group = np.repeat(np.arange(len(na)), na)  # of each A token
    per = nb[group]
    row = np.repeat(np.arange(len(x.a_rows)), np.diff(x.a_rows, prepend=0))
    b_first = (x.b_groups - nb)[group]
    found: list[tuple[np.ndarray, ...]] = []
    for lo, hi in row_slices(per, LINKS):
        n = per[lo:hi]
        ends = np.cumsum(n)
        b = x.b[np.repeat(b_first[lo:hi] - (ends - n), n) + np.arange(ends[-1])].astype(np.int64)
        pair = np.repeat(x.a[lo:hi].astype(np.int64) * b_size, n) + b
        found.append(_distinct(np.repeat(row[lo:hi], n), pair, np.ones(len(pair), np.int64)))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(x.a_rows), np.int64)
    rows, pair, links = (np.concatenate(c) for c in zip(*found, strict=True))
    if len(found) > 1:
        rows, pair, links = _distinct(rows, pair, links)
    return pair, links, np.searchsorted(rows, np.arange(len(x.a_rows)), side="right")


def _distinct(row: np.ndarray, pair: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    span = int(pair.max()) + 1
    if len(row) and int(row[-1] - row[0] + 1) * span < 1 << 62:
        key = (row - row[0]) * span + pair
        order = np.argsort(key, kind="stable") if links.max() > 1 else None
        key = np.sort(key) if order is None else key[order]
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        summed = np.diff(np.append(new, len(key))) if order is None else np.add.reduceat(links[order], new)
        return key[new] // span + row[0], key[new] % span, summed
    order = np.lexsort((pair, row))
    row, pair, links = row[order], pair[order], links[order]
    new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (pair[1:] != pair[:-1])))
    return row[new], pair[new], np.add.reduceat(links, new)


# --------------------------------------------------------------------------- over tables
def _map(docs: DataFrame, id_col: str, text_col: str, a_path: str, b_path: str, schema: str, columns) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(a_path), pieces(b_path)
        try:
            for batch in batches:
                at = 0
                for x in align_texts(batch.column(1), a, b):
                    n = len(x.a_rows)
                    made = {"doc_id": batch.column(0).slice(at, n), **columns(x, len(a.size), len(b.size))}
                    at += n
                    yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))
        finally:  # workers are used again by other stages
            a.words.forget()
            b.words.forget()

    return rows.mapInArrow(run, f"doc_id {kind}, {schema}")


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(values.astype(kind.to_pandas_dtype())))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row per row: doc_id, a_ids, b_ids (ARRAY<INT>), a_ends, b_ends (tokens of each side up to each group's end).

    NULL and empty texts, and texts that a tokenizer does not give back byte by byte, have
    empty arrays; a space is put before every text. Repeated rows and NULL ids give rows like
    any other, an empty table an empty result; further columns are ignored, whatever their names.
    """

    def columns(x: Aligned, a_size: int, b_size: int) -> dict[str, pa.Array]:
        def inside(groups: np.ndarray, rows: np.ndarray) -> np.ndarray:
            return groups - np.repeat(rows - np.diff(rows, prepend=0), np.diff(x.group_rows, prepend=0))

        return {
            "a_ids": _lists(x.a, x.a_rows, pa.int32()),
            "b_ids": _lists(x.b, x.b_rows, pa.int32()),
            "a_ends": _lists(inside(x.a_groups, x.a_rows), x.group_rows, pa.int32()),
            "b_ends": _lists(inside(x.b_groups, x.b_rows), x.group_rows, pa.int32()),
        }

    ints = "array<int>"
    return _map(docs, id_col, text_col, a_path or default_vocabulary(), b_path or default_pieces(), f"a_ids {ints}, b_ids {ints}, a_ends {ints}, b_ends {ints}", columns)


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row per row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, held (distinct pairs a * b_size + b with their links)."""

    def columns(x: Aligned, a_size: int, b_size: int) -> dict[str, pa.Array]:
        count = lambda ends: pa.array(np.diff(ends, prepend=0).astype(np.int64))
        links = np.append(0, np.cumsum(np.diff(x.a_groups, prepend=0) * np.diff(x.b_groups, prepend=0)))[x.group_rows]
        sha = [hashlib.sha256(s).hexdigest() if len(s) else "" for s in render(x, a_size, b_size)]
        pair, n, ends = linked_pairs(x, b_size)
        held = pa.StructArray.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "links"])
        return {"n_a": count(x.a_rows), "n_b": count(x.b_rows), "n_groups": count(x.group_rows), "n_links": count(links), "groups_sha256": pa.array(sha, pa.string()), "held": pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), held)}

    return _map(docs, id_col, text_col, a_path or default_vocabulary(), b_path or default_pieces(), "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, held array<struct<pair:bigint,links:bigint>>", columns)


def pair_counts(rows: DataFrame, b_size: int) -> DataFrame:
    """(pair, n_docs, best): in how many rows each pair is linked, and whether no pair of its A id is in more."""
    counts = materialize(rows.select(F.explode("held.pair").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs")), "pair_counts")
    counts = counts.withColumn("a_id", F.expr(f"pair div {b_size}"))
    most = counts.groupBy("a_id").agg(F.max("n_docs").alias("most"))
    return counts.join(F.broadcast(most), "a_id").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))  # a row for each id of the vocabulary at most


def alignment_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """``described`` without ``held``, with n_best and count_sum over the row's links.

    The pairs that are in most documents, ``frequent`` of them at most, are broadcast, so no
    hot pair is ever a join key in a shuffle; the others are joined by a shuffle. Both ways
    give every pair its exact count. The texts are encoded once: what is known of a row is
    written, and read for the counts and again for the sums.
    """
    b_path = b_path or default_pieces()
    b_size = len(pieces(b_path).size)
    rows = described(docs, id_col, text_col, a_path, b_path).withColumn("_row", F.monotonically_increasing_id())
    rows = materialize(rows, "alignment")
    counts = materialize(pair_counts(rows, b_size), "pair_counts")
    level = F.floor(F.log2("n_docs")).cast("int")
    levels = sorted(((r[0], r[1]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)  # one row for each power of two
    kept, total = None, 0
    for at, n in levels:
        total += n
        if total > frequent:
            break
        kept = at
    held = rows.select("_row", F.inline("held"))
    hot = counts.where(level >= kept) if kept is not None else counts.where("false")
    known = held.join(F.broadcast(hot), "pair")
    if total > frequent:
        known = known.unionByName(held.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(counts.where(level < kept) if kept is not None else counts, "pair"))
    sums = known.groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("n_docs")).alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    out = rows.drop("held").join(sums, "_row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


__all__ = ["align", "alignment_counts", "described", "pair_counts", "shared_cuts"]
