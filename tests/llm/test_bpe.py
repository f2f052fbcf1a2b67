from __future__ import annotations

import hashlib
import random
import struct

import pytest
from tokenizers import Tokenizer

from strata.llm import bpe, pretokens
from strata.llm import queries as Q
from tests.llm.conftest import SF001

TEXTS = [
    None, "", " ", "  a", "a  ", "it's we'll 'Tis I'd  x\n\n y", "\t\x0b\x1c\x85　x", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b  <|endoftext|>", "<|endoftext", "!!<|endoftext|>!!", "日本語 テキスト １２３ ½²", "😀👍🏽 é́", "a" * 5000, "!?" * 700,
    "ab " * 20000, "x" + " " * 3000 + "y", "  z", "ſ's ’s", "\x00\x01\x7f", "ﬀ K Å",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(pretokens.default_vocabulary())


def expected(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_query_on_the_small_tables(spark, documents, tokenizer):
    docs = {r[0]: r[1] for r in documents.select("doc_id", "text").collect()}
    got = Q.op5_bpe(spark, SF001).collect()
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r)[1:] == expected(tokenizer, docs[r["doc_id"]])


def test_defined_cases(docs_of, tokenizer):
    rows = [*enumerate(TEXTS), (None, "no id"), (1, "again"), (1, "again")]
    got = sorted((tuple(r) for r in bpe.digests(docs_of(rows, clashing=True)).collect()), key=repr)
    assert got == sorted(((i, *expected(tokenizer, t)) for i, t in rows), key=repr)
    assert bpe.digests(docs_of([])).collect() == []


def test_words_together_and_alone_and_the_library_agree(tokenizer):
    rng = random.Random(3)
    machine = bpe.Automaton(*pretokens.load_vocabulary(pretokens.default_vocabulary()))
    words = ["".join(rng.choice("aaabehinorst tionñéß") for _ in range(rng.randint(1, 40))).replace(" ", "") or "a" for _ in range(2000)]
    together = [x.tolist() for x in machine.encode(words)]
    assert together == [machine.encode_word(w) for w in words] == [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]


def test_automaton_accepts_only_correct_tokenizations():
    vocab = {c: i for i, c in enumerate(pretokens.byte_alphabet())}
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("aa", "aa")]
    for a, b in merges:
        vocab[a + b] = len(vocab)
    machine = bpe.Automaton(vocab, merges, {})

    def by_rank(word):
        parts = list(word)
        for a, b in merges:
            i = 0
            while i + 1 < len(parts):
                if parts[i] == a and parts[i + 1] == b:
                    parts[i : i + 2] = [a + b]
                i += 1
        return [vocab[p] for p in parts]

    for n in range(1, 10):
        for k in range(2**n):
            word = "".join("ab"[k >> i & 1] for i in range(n))
            assert machine.encode_word(word) == by_rank(word), word


def test_ids_that_are_no_text(spark):
    import pyarrow as pa

    got = bpe.decode_array(pa.array([struct.pack("<I", 220), struct.pack("<II", 161, 162), b"", None]), pretokens.default_vocabulary()).to_pylist()
    t = Tokenizer.from_file(pretokens.default_vocabulary())
    assert got == [t.decode([220], skip_special_tokens=False), t.decode([161, 162], skip_special_tokens=False), "", ""]


def test_words_are_those_of_the_library(tokenizer):
    split = tokenizer.pre_tokenizer.pre_tokenize_str

    def words(text):
        out = []
        for i, part in enumerate(text.split(pretokens.END_OF_TEXT)):
            out += [pretokens.END_OF_TEXT] * (i > 0) + [part[a:b] for _, (a, b) in split(part)]
        return out

    rng = random.Random(5)
    alphabet = [*"aab1  'strevlldm'!\n\té日½<|>", "\u3000", "\xa0", "'s", "'re", "<|endoftext|>", "<|endof", "text|>"]
    rows = [None, "", *("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(4000))]
    rows += ["".join(f"a{chr(c)}a1{chr(c)}1!{chr(c)}!" for c in range(at, at + 2048) if not 0xD800 <= c < 0xE000) for at in range(0, 0x20000, 2048)]  # every character
    import pyarrow as pa

    got, sizes = pretokens.split_words(pa.array(rows).slice(1))
    got, at = got.to_pylist(), 0
    for row, n in zip(rows[1:], sizes.tolist(), strict=True):
        assert got[at : at + n] == words(row)
        at += n
    assert at == len(got)
    invalid = pa.array([b"a b", b"x\xff y"]).cast(pa.binary()).view(pa.string())
    assert pretokens.split_words(invalid)[0].to_pylist() == ["a", " b", "x", "\ufffd", " y"]
    assert pretokens.split_words(pa.array([], pa.string()))[1].tolist() == []
