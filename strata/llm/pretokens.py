"""Words that byte-level BPE merges never cross, and their ids by batch.

A task sees Arrow batches of texts. Array arithmetic over a batch's characters finds where
the published split pattern's words begin; each distinct word is encoded once (remembered
within bounds) and ids are expanded by index arithmetic.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex

VOCABULARY = "byte_bpe_50k.json"  # of the public tokenizer files
MEMO_WORDS = 250_000  # words a worker remembers; beyond, it starts anew

# White space as the tokenizer's split pattern means it (Unicode White_Space), and the endings that
# the pattern takes together with the apostrophe before them.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
ENDINGS_1 = "stmd"
ENDINGS_2 = ("re", "ve", "ll")
END_OF_TEXT = "<|endoftext|>"  # no word of the split pattern equals it


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: visible ones for themselves, the others from U+0100 on in order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


def load_vocabulary(path: str) -> tuple[dict[str, int], list[tuple[str, str]], dict[str, int]]:
    """(ids by token, merges in order, special tokens) of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    return spec["model"]["vocab"], merges, {t["content"]: t["id"] for t in spec["added_tokens"]}


SPACE, LETTER, NUMBER, OTHER = range(4)


@lru_cache(maxsize=1)
def character_kinds() -> np.ndarray:
    """Kind of each code point: white space, letter, number or other, as the tokenizers library sees it.

    Characters that are newer than Python's own tables are looked up in the library.
    """
    from tokenizers import pre_tokenizers

    kinds, table, unknown = {"L": LETTER, "N": NUMBER}, np.full(0x110000, OTHER, np.uint8), []
    for c in range(0x110000):
        category = unicodedata.category(chr(c))
        if category[0] in kinds:
            table[c] = kinds[category[0]]
        elif category == "Cn":
            unknown.append(chr(c))
    split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    for c in regex.findall(r"[\p{L}\p{N}]", "".join(unknown)):
        pieces = split(f"a{c}1")
        table[ord(c)] = OTHER if len(pieces) == 3 else LETTER if pieces[0][1] == (0, 2) else NUMBER
    table[list(WHITE_SPACE)] = SPACE
    return table


@lru_cache(maxsize=1)
def _byte_kinds() -> bytes:
    """Kind of each one-byte character, as a translation of bytes; OTHER + 1 for all other bytes."""
    return character_kinds()[:0x80].tobytes() + bytes([OTHER + 1]) * 0x80


def _specials(body: bytes, ends: np.ndarray) -> list[tuple[int, int]]:
    """Places of special-token strings that lie inside one row."""
    found = [m.span() for m in re.finditer(re.escape(END_OF_TEXT.encode()), body)]
    return [(a, b) for a, b in found if np.searchsorted(ends, a, side="right") == np.searchsorted(ends, b - 1, side="right")]


def split_words(texts: pa.Array, specials: bool = True) -> tuple[pa.Array, np.ndarray]:
    """(words of all rows, words of each row); NULL and empty texts have none. ``specials=False``: special-token strings are plain text.

    Words are maximal runs of letters, of numbers, of white space or of other characters, but: a
    blank before another run belongs to that run; other white space before it is a word of its own;
    an apostrophe that begins a word takes a listed ending with it; special-token strings are words.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    if offsets[0] == offsets[-1]:
        return pa.array([], pa.large_string()), np.zeros(len(texts), np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    body = raw.tobytes()
    try:
        chars = raw if body.isascii() else np.frombuffer(body.decode().encode("utf-32-le"), "<u4")
    except UnicodeDecodeError:  # what is no UTF-8 becomes U+FFFD
        return split_words(pa.array([t.decode("utf-8", "replace") for t in texts.cast(pa.large_binary()).to_pylist()], pa.large_string()), specials)
    n, bounds = len(chars), offsets - offsets[0]
    kind = np.frombuffer(body.translate(_byte_kinds()), np.uint8)
    if n == len(raw):
        lead = np.arange(n)  # byte where each character begins
    else:
        lead = np.flatnonzero((raw & 0xC0) != 0x80)
        kind = kind.take(lead)
        wide = np.flatnonzero(kind > OTHER)
        kind[wide] = character_kinds()[chars[wide]]
    special = _specials(body, bounds[1:]) if specials else []
    fresh = np.zeros(n + 1, bool)  # characters before which nothing is seen: of rows, of special tokens and after them
    fresh[np.searchsorted(lead, bounds)] = True
    fresh[np.searchsorted(lead, [x for ab in special for x in ab])] = True
    begins = np.ones(n + 1, bool)
    begins[1:n] = (kind[1:] != kind[:-1]) | fresh[1:n]
    # a run after white space, in sight of it
    after = np.flatnonzero(begins[:n] & (kind != SPACE) & ~fresh[:n])
    after = after[kind[after - 1] == SPACE]
    begins[after - 1] = True
    begins[after[chars[after - 1] == 0x20]] = False
    # apostrophes that begin a word; what lies past the end, or out of sight, is no letter
    quote = np.flatnonzero((chars == 0x27) & begins[:n])
    seen = lambda at, ok: np.where(ok, chars[np.minimum(at, n - 1)], 0)
    near = ~fresh[quote + 1]
    far = near & ~fresh[np.minimum(quote + 2, n)]
    one, two = seen(quote + 1, near), seen(quote + 2, far)
    short = np.isin(one, [ord(c) for c in ENDINGS_1])
    long = np.any([(one == ord(a)) & (two == ord(b)) for a, b in ENDINGS_2], axis=0)
    for some, size in ((quote[short], 2), (quote[long], 3)):
        begins[some + 1] = False
        begins[some + size] = True
    for a, b in special:
        at = np.searchsorted(lead, [a, b])
        begins[at[0] + 1 : at[1]] = False
    starts = lead[np.flatnonzero(begins[:n])]
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(body)])
    return words, np.diff(np.searchsorted(starts, bounds))


SLICE_BYTES = 1 << 21  # of texts that are split at once (a longer row alone)
SLICE_IDS = 1 << 18  # ids that are worked on at once (a longer row alone)


def row_slices(sizes: np.ndarray, limit: int = SLICE_IDS) -> Iterator[tuple[int, int]]:
    """Runs of rows whose sizes add up to ``limit`` at most, one row at least; none for no rows."""
    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right"))
        yield at, max(upto, at + 1)
        at = max(upto, at + 1)


class WordIds:
    """Ids of words, remembered up to ``memo_words`` and ``memo_chars``; ``encode(words) -> [ids]`` is asked for unknown ones only."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], split: Callable[[pa.Array], tuple[pa.Array, np.ndarray]] = split_words, memo_words: int = MEMO_WORDS, memo_chars: int = 1 << 62, slice_bytes: int = SLICE_BYTES):
        self.encode, self.split = encode, split
        self.memo_words, self.memo_chars, self.slice_bytes = memo_words, memo_chars, slice_bytes
        self.forget()

    def forget(self) -> None:
        self.chars = 0
        self.memo: dict[str, int] = {}  # word -> its place in what follows
        self.start, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, words: list[str]) -> None:
        ids = self.encode(words)
        self.chars += sum(map(len, words))
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        self.memo.update(zip(words, range(len(self.memo), len(self.memo) + len(words)), strict=True))
        self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))])

    def slices(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(all ids, end of each row in them) for one run of rows after the other."""
        for a, b in row_slices(np.asarray(pa.compute.binary_length(texts).fill_null(0), np.int64), self.slice_bytes):
            words, sizes = self.split(texts.slice(a, b - a))
            yield self._ids(words, np.cumsum(sizes))

    def _ids(self, flat: pa.Array, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(flat):
            return np.zeros(0, np.uint32), rows
        coded = flat.dictionary_encode()
        words = coded.dictionary.to_pylist()
        at = np.fromiter((self.memo.get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(new) and (len(self.memo) + len(new) > self.memo_words or self.chars > self.memo_chars):
            self.forget()
            new = np.arange(len(words))
        if len(new):
            at[new] = len(self.memo) + np.arange(len(new))
            self._learn([words[i] for i in new.tolist()])
        place = at[coded.indices.to_numpy(zero_copy_only=False)]
        n = self.size[place]
        ends = np.cumsum(n)
        at = np.repeat(self.start[place] - (ends - n), n) + np.arange(ends[-1])
        return self.pool[at], np.concatenate([[0], ends])[rows]


class ShortWords:
    """Numbers 0, 1, ... of words of up to 15 bytes, in the order they came; found by array arithmetic.

    A word is two integers, its bytes and its length, so equal integers are equal words. An
    open-addressing table leads from their hash to the number.
    """

    BYTES = 15

    def __init__(self, most: int):
        self.bits = (2 * most - 1).bit_length()
        self.most, self.size = most, 0
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.low, self.high = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.uint64)

    @classmethod
    def keys(cls, body: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both integers of the words in ``body``; of no meaning for longer words."""
        eight = np.ndarray((len(body) + 9,), "<u8", body + bytes(16), strides=(1,))  # the eight bytes from each place
        low, high = (np.array([(1 << 8 * min(max(n - skip, 0), 8)) - 1 for n in range(cls.BYTES + 1)], np.uint64).take(sizes, mode="clip") for skip in (0, 8))
        low &= eight[starts]
        high &= eight[starts + 8]
        high |= sizes.astype(np.uint64) << np.uint64(56)
        return low, high

    def _hash(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low * np.uint64(0x9E3779B97F4A7C15)) ^ (high * np.uint64(0xC2B2AE3D27D4EB4F))
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Numbers of the words; -1 for unknown ones."""
        at = self._hash(low, high)
        found = self.slots.take(at)
        held = found.astype(np.int64)
        open_ = np.flatnonzero((held >= 0) & ((self.low.take(held, mode="clip") != low) | (self.high.take(held, mode="clip") != high)))
        at = at[open_]
        while len(open_):  # another word's place: the next one
            at = (at + 1) & (len(self.slots) - 1)
            held = self.slots[at]
            found[open_] = held
            more = (held >= 0) & ((self.low[held] != low[open_]) | (self.high[held] != high[open_]))
            open_, at = open_[more], at[more]
        return found

    def add(self, low: np.ndarray, high: np.ndarray) -> None:
        """Give different, unknown words the next numbers."""
        before, self.size = self.size, self.size + len(low)
        self.low, self.high = room(self.low, self.size), room(self.high, self.size)
        self.low[before : self.size], self.high[before : self.size] = low, high
        at, new = self._hash(low, high), np.arange(before, self.size, dtype=np.int32)
        while len(new):
            free = self.slots[at] < 0
            self.slots[at[free]] = new[free]  # one of those that want a place gets it
            more = self.slots[at] != new
            at, new = (at[more] + 1) & (len(self.slots) - 1), new[more]


def room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, or a longer copy, with ``size`` places at least."""
    if size <= len(array):
        return array
    out = np.zeros(max(size, len(array) * 3 // 2), array.dtype)
    out[: len(array)] = array
    return out


class ManyWordIds(WordIds):
    """Like ``WordIds`` for texts with many different words: short ones are found without a Python object for each.

    ``encode_flat(words) -> (all ids, ids of each word)``; words that are not short go the plain way.
    """

    def __init__(self, encode, encode_flat: Callable[[list[str], np.ndarray], tuple[np.ndarray, np.ndarray]], short_words: int, memo_words: int, memo_chars: int):
        self.encode_flat, self.short_words = encode_flat, short_words
        self.long = WordIds(encode, memo_words=memo_words, memo_chars=memo_chars)  # forgets by itself
        super().__init__(encode)

    def forget(self) -> None:
        self.long.forget()
        self.forget_short()

    def forget_short(self, least: int = 0) -> None:
        self.short = ShortWords(max(self.short_words, least))
        self.short_ends, self.short_pool = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.uint32)  # a word's ids lie between two ends

    def _learn_short(self, words: pa.DictionaryArray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Numbers of words that are all unknown; they may repeat."""
        index = words.indices.to_numpy(zero_copy_only=False)
        one = np.empty(len(words.dictionary), np.int64)
        one[index] = np.arange(len(index))
        begin = self.short.size
        ids, sizes = self.encode_flat(words.dictionary.to_pylist(), np.asarray(pa.compute.binary_length(words.dictionary), np.int64))
        self.short.add(low[one], high[one])
        used = int(self.short_ends[begin])
        self.short_ends = room(self.short_ends, self.short.size + 1)
        self.short_ends[begin + 1 : self.short.size + 1] = used + np.cumsum(sizes)
        self.short_pool = room(self.short_pool, used + len(ids))
        self.short_pool[used : used + len(ids)] = ids
        return begin + index

    def _ids(self, flat: pa.Array, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(flat):
            return np.zeros(0, np.uint32), rows
        bounds = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
        starts, sizes = bounds[:-1], np.diff(bounds)
        low, high = ShortWords.keys(flat.buffers()[2].to_pybytes(), starts, sizes)
        long = np.flatnonzero(sizes > ShortWords.BYTES)
        place = self.short.find(low, high)
        place[long] = 0
        new = np.flatnonzero(place < 0)
        if len(new):
            words = flat.take(pa.array(new)).dictionary_encode()
            if self.short.size + len(words.dictionary) > self.short.most:
                new = np.flatnonzero(sizes <= ShortWords.BYTES)
                words = flat.take(pa.array(new)).dictionary_encode()
                self.forget_short(len(words.dictionary))
            place[new] = self._learn_short(words, low[new], high[new])
        begin = self.short_ends.take(place)
        n = self.short_ends.take(place + 1) - begin
        if len(long):
            ids, ends = self.long._ids(flat.take(pa.array(long)), np.arange(1, len(long) + 1))
            n[long] = np.diff(ends, prepend=0)
        ends = np.cumsum(n)
        begin -= ends
        begin += n
        at = np.repeat(begin, n)
        at += np.arange(len(at))
        out = self.short_pool.take(at, mode="clip")
        if len(long):
            own = n[long]
            out[np.repeat(ends[long] - np.cumsum(own), own) + np.arange(len(ids))] = ids
        return out, np.concatenate([[0], ends])[rows]


def id_lists(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary column: each row's ids as little-endian unsigned 32-bit integers."""
    offsets = np.concatenate([[0], ends]).astype(np.int64) * 4
    data = pa.py_buffer(np.ascontiguousarray(ids, "<u4"))
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), data]).cast(pa.binary())


def token_bytes(path: str) -> list[bytes]:
    """What each id spells; ids that are no token spell nothing."""
    vocab, _, special = load_vocabulary(path)
    back = {c: b for b, c in enumerate(byte_alphabet())}
    out = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for t, i in [*vocab.items(), *special.items()]:
        out[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
    return out
