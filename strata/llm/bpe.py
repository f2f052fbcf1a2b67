"""Operator 5: BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens and accepts exactly the correct tokenizations. It starts as one
state with a loop for each byte. Each merge (u, v) -> z, in order, inserts a gadget: every
state with an arc u gets an arc z to where u and then v led, and the state behind arc u is
copied without its arc v, so u and v never again stand side by side. All arcs of one
token lead to one state, so a state is named by the token that entered it.

The whole transition table would hold vocabulary squared entries. Since a gadget copies
arcs, an entry follows from the two tokens' origins: ``follows`` walks back through the
gadgets and remembers the answer, so the table fills as arcs are first taken.

Encoding runs over a pre-split word's bytes: after each byte exactly one arc into the
position continues an accepted path; the arcs back from the end are the tokens. Decoding
emits the arc labels.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import let_go
from strata.llm.pretokens import END_OF_TEXT, WordIds, byte_alphabet, default_vocabulary, id_lists, load_vocabulary, row_slices, token_bytes

MEMO_ARCS = 500_000  # arcs a worker remembers, and words and characters in a task
MEMO_WORDS, MEMO_CHARS = 150_000, 2_000_000
SLICE_BYTES = 1 << 20  # of texts that are worked on at once (a longer row alone)
TOGETHER = 64  # bytes of the longest word that is encoded with others


class Automaton:
    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int]):
        back = {c: b for b, c in enumerate(byte_alphabet())}
        self.ids = {bytes(back[c] for c in t): i for t, i in vocab.items() if all(c in back for c in t)}
        size = max(vocab.values()) + 1
        self.born = array("q", [0]) * size  # number of the gadget that made a token; bytes: 0
        self.left, self.right = array("q", range(size)), array("q", range(size))
        self.cut: dict[int, int] = {}  # arc (u, v) -> number of the gadget that removed it
        for t, (a, b) in enumerate(merges, 1):
            self._gadget(t, vocab[a], vocab[b], vocab[a + b])
        self.special = {s: [i] for s, i in special.items()}
        self.arcs: dict[int, bool] = {}
        self.spell: dict[int, int] = {}  # (node, byte) -> node of the tokens' prefix tree
        self.token_at = array("q", [-1])
        for raw, i in self.ids.items():
            node = 0
            for byte in raw:
                at = node << 8 | byte
                if at not in self.spell:
                    self.spell[at] = len(self.token_at)
                    self.token_at.append(-1)
                node = self.spell[at]
            self.token_at[node] = i
        # the same as arrays, for many words at once
        self.spell_keys = np.array(sorted(self.spell), np.int64)
        self.spell_to = np.array([self.spell[k] for k in self.spell_keys.tolist()], np.int64)
        self.tokens = np.array(self.token_at, np.int64)
        self.arc_keys, self.arc_open = np.zeros(0, np.int64), np.zeros(0, bool)

    def _gadget(self, t: int, u: int, v: int, z: int) -> None:
        if self.born[z]:
            raise ValueError("a token has two merges: the automaton needs one for each")
        self.born[z], self.left[z], self.right[z] = t, u, v
        self.cut[u << 32 | v] = t
        if u == v:  # of u u u the first two merge: u is never followed by z
            self.cut[u << 32 | z] = t

    def follows(self, x: int, y: int) -> bool:
        """Whether the state entered by ``x`` has an arc ``y``."""
        key = x << 32 | y
        got = self.arcs.get(key)
        if got is None:
            if len(self.arcs) >= MEMO_ARCS:
                self.arcs.clear()
            got = self.arcs[key] = self._derive(x, y)
        return got

    def _derive(self, x: int, y: int) -> bool:
        before, born, cut = 1 << 62, self.born, self.cut
        while True:
            if cut.get(x << 32 | y, before) < before:
                return False
            if not born[x] and not born[y]:
                return True
            if born[x] > born[y]:  # x's state was copied from that of its right part
                before, x = born[x], self.right[x]
            else:  # arc y was made beside the arc of its left part
                before, y = born[y], self.left[y]

    def encode_word(self, word: str) -> list[int]:
        if word in self.special:
            return self.special[word]
        raw = word.encode("utf-8", "surrogatepass")
        whole = self.ids.get(raw)
        if whole is not None:  # one arc: the start state lost none
            return [whole]
        spell, arcs, follows = self.spell, self.arcs, self.follows
        n = len(raw)
        last, back = [-1] * (n + 1), [0] * (n + 1)  # the arc into each position and where it starts
        for start in range(n):
            state, node = last[start], 0
            for end in range(start + 1, n + 1):
                node = spell.get(node << 8 | raw[end - 1], -1)
                if node < 0:
                    break
                token = self.token_at[node]
                if token >= 0 and last[end] < 0:
                    ok = state < 0
                    if not ok:
                        ok = arcs.get(state << 32 | token)
                        if ok is None:
                            ok = follows(state, token)
                    if ok:
                        last[end], back[end] = token, start
        if last[n] < 0:
            raise ValueError("no path: the vocabulary lacks a byte")
        out, end = [], n
        while end:
            out.append(last[end])
            end = back[end]
        return out[::-1]

    def encode(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word; words of ordinary length step through the tables together."""
        out: list = [None] * len(words)
        at, raws = [], []
        for i, word in enumerate(words):
            raw = word.encode("utf-8", "surrogatepass")
            one = self.special.get(word) or ([self.ids[raw]] if raw in self.ids else None)
            if one is not None:  # one arc: the start state lost none
                out[i] = np.array(one, np.uint32)
            elif len(raw) > TOGETHER:
                out[i] = np.array(self.encode_word(word), np.uint32)
            else:
                at.append(i)
                raws.append(raw)
        if at:
            for i, ids in zip(at, self._encode_together(raws), strict=True):
                out[i] = ids
        return out

    def _encode_together(self, raws: list[bytes]) -> list[np.ndarray]:
        size = np.fromiter(map(len, raws), np.int64, len(raws))
        data = np.frombuffer(b"".join(raws), np.uint8)
        word = np.repeat(np.arange(len(raws)), size)
        first = np.cumsum(size) - size
        inside = np.arange(len(data)) - first[word]  # place in the word
        left = size[word] - inside
        # every arc of the prefix tree from every place, one byte further a step
        here, node, arcs, step = np.arange(len(data)), np.zeros(len(data), np.int64), [], 0
        while len(here):
            key = node << 8 | data[here + step]
            to = np.minimum(np.searchsorted(self.spell_keys, key), len(self.spell_keys) - 1)
            on = self.spell_keys[to] == key
            here, node = here[on], self.spell_to[to[on]]
            token = self.tokens[node]
            arc = token >= 0
            arcs.append((here[arc], np.full(int(arc.sum()), step + 1), token[arc]))
            step += 1
            more = left[here] > step
            here, node = here[more], node[more]
        begin, length, token = (np.concatenate(x) for x in zip(*arcs, strict=True))
        # places between bytes: a word of n bytes has n + 1
        place = begin + word[begin]
        last, back = np.full(len(data) + len(raws), -1, np.int64), np.zeros(len(data) + len(raws), np.int64)
        order = np.argsort(inside[begin], kind="stable")
        bounds = np.searchsorted(inside[begin][order], np.arange(int(size.max()) + 1))
        for p in range(len(bounds) - 1):
            some = order[bounds[p] : bounds[p + 1]]
            here, to, tok = place[some], place[some] + length[some], token[some]
            if p:
                open_ = (last[here] >= 0) & (last[to] < 0)
                here, to, tok = here[open_], to[open_], tok[open_]
                ok = self._follow_all(last[here] << 32 | tok)
                here, to, tok = here[ok], to[ok], tok[ok]
            last[to], back[to] = tok, here
        start = first + np.arange(len(raws))
        now, who, found = start + size, np.arange(len(raws)), []
        while len(who):
            if (last[now] < 0).any():
                raise ValueError("no path: the vocabulary lacks a byte")
            found.append((who, last[now]))
            now = back[now]
            more = now > start[who]
            who, now = who[more], now[more]
        who, ids = (np.concatenate(x[::-1]) for x in zip(*found, strict=True))  # last tokens first, so turned round
        turned = np.argsort(who, kind="stable")
        ends = np.cumsum(np.bincount(who, minlength=len(raws)))
        ids = ids[turned].astype(np.uint32)
        return [ids[a:b] for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True)]

    def _follow_all(self, arcs: np.ndarray) -> np.ndarray:
        asked, where = np.unique(arcs, return_inverse=True)
        to = np.minimum(np.searchsorted(self.arc_keys, asked), max(len(self.arc_keys) - 1, 0))
        known = self.arc_keys[to] == asked if len(self.arc_keys) else np.zeros(len(asked), bool)
        out = np.zeros(len(asked), bool)
        out[known] = self.arc_open[to[known]]
        new = asked[~known]
        if len(new):
            got = np.fromiter((self._derive(a >> 32, a & 0xFFFFFFFF) for a in new.tolist()), bool, len(new))
            out[~known] = got
            if len(self.arc_keys) + len(new) > MEMO_ARCS:
                self.arc_keys, self.arc_open = new, got
            else:
                keys = np.concatenate([self.arc_keys, new])
                order = np.argsort(keys, kind="stable")
                self.arc_keys, self.arc_open = keys[order], np.concatenate([self.arc_open, got])[order]
        return out[where]


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordIds:
    """One automaton and memo for each worker process."""
    return WordIds(Automaton(*load_vocabulary(path)).encode, memo_words=MEMO_WORDS, memo_chars=MEMO_CHARS, slice_bytes=SLICE_BYTES)


def _slices(batches: Iterator[pa.Array], path: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and row ends of all batches; a task's words are forgotten with it."""
    encoder = _encoder(path)
    try:
        for texts in batches:
            yield from encoder.slices(texts)
    finally:
        encoder.forget()
        let_go()


def encode(text: Column, path: str | None = None) -> Column:
    """Ids of each whole text (BINARY, little-endian unsigned 32-bit); NULL and empty texts have none."""
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for ids, ends in _slices(batches, path):
            yield id_lists(ids, ends)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "binary")(text)


@lru_cache(maxsize=2)
def _labels(path: str) -> pa.Array:
    return pa.array(token_bytes(path), pa.large_binary())


def decode_array(packed: pa.Array, path: str) -> pa.Array:
    labels = _labels(path)
    rows = packed.cast(pa.large_binary()).fill_null(b"")
    sizes = np.asarray(pa.compute.binary_length(rows), np.int64) // 4
    ids = np.frombuffer(b"".join(rows.to_pylist()), "<u4")
    spelled = labels.take(pa.array(np.where(ids < len(labels), ids, 0)))  # emits the arcs' labels side by side
    offsets = np.frombuffer(spelled.buffers()[1], np.int64)[spelled.offset : spelled.offset + len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
    ends = offsets[np.concatenate([[0], np.cumsum(sizes)])]
    joined = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(ends.copy()), spelled.buffers()[2] if len(ids) else pa.py_buffer(b"")])
    try:
        return joined.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:  # ids that do not come from a text
        return pa.array([b.decode("utf-8", "replace") for b in joined.to_pylist()], pa.string())


def decode(ids: Column, path: str | None = None) -> Column:
    """Text of packed ids, special tokens included; bytes that are no UTF-8 become U+FFFD. Ids outside the vocabulary must not occur."""
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for packed in batches:
            sizes = np.asarray(pa.compute.binary_length(packed).fill_null(0), np.int64) // 4
            for a, b in row_slices(sizes):
                yield decode_array(packed.slice(a, b - a), path)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string")(ids)


def _both(text: Column, path: str) -> Column:
    """struct(ids, decoded) in one pass through one worker: what is decoded are the packed ids."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for ids, ends in _slices(batches, path):
            packed = id_lists(ids, ends)
            yield pa.StructArray.from_arrays([packed, decode_array(packed, path)], names=["ids", "decoded"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<ids:binary,decoded:string>")(text)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per row: doc_id, ids (packed), n_tokens, decoded.

    Repeated rows and NULL ids give rows like any other; an empty table gives an empty
    result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), _both(F.col(text_col), path or default_vocabulary()).alias("both"))
    return rows.select("doc_id", "both.ids", (F.octet_length("both.ids") / 4).cast("bigint").alias("n_tokens"), "both.decoded")


def digests(docs: DataFrame) -> DataFrame:
    """The round trip as digests: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return round_trip(docs).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


__all__ = ["END_OF_TEXT", "Automaton", "decode", "digests", "encode", "round_trip"]
