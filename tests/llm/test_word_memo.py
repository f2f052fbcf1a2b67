from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strata.llm import pretokens as P
from strata.llm import token_counts as N
from strata.llm import token_files as T

PATH = P.default_vocabulary()
MADE = "abcdefgh  \n\t\0\0é漢\U0001f600‍'sre019_-<|endoftext|>"
EDGES = [None, "", "<|endoftext|>", "a\0", "a", "\0", "\0\0", "abcdefgh", "abcdefgh\0", "x" * 15, "x" * 16, "x" * 14 + "é"]


def encoded(encoder, texts):
    got = []
    for ids, ends in encoder.slices(pa.array(texts, pa.string())):
        got += [x.tolist() for x in np.split(ids, ends[:-1])]
    return got


@pytest.mark.parametrize("short, long, chars", [(1 << 20, 50_000, 4_000_000), (50, 10, 100)])
def test_ids_are_the_librarys(short, long, chars):
    """Also where words come in again after the memo of short or of long ones began anew."""
    library, made, rnd = N.library_encoder(PATH), Tokenizer.from_file(PATH), random.Random(5)
    encoder = P.ManyWordIds(library.encode, library.encode_flat, short, long, chars)
    encoder.slice_bytes = 300
    for _ in range(12):
        texts = [*EDGES, *("".join(rnd.choice(MADE) for _ in range(rnd.randrange(200))) for _ in range(20)), " ".join(str(rnd.randrange(10**6)) for _ in range(150))]
        assert encoded(encoder, texts) == [made.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_the_library_gets_a_word_once():
    """300,000 different words fit the memo: when the texts come again, none is encoded again."""
    library, asked = N.library_encoder(PATH), []

    def flat(words, sizes):
        asked.extend(words)
        return library.encode_flat(words, sizes)

    encoder = P.ManyWordIds(library.encode, flat, N.SHORT_WORDS, N.LONG_WORDS, N.LONG_CHARS)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(letters[i // 26**k % 26] for k in range(5)) for i in range(300_000)]
    texts = [" ".join(words[a : a + 1000]) for a in range(0, len(words), 1000)]
    first = encoded(encoder, texts)
    once = len(asked)
    assert once == len(set(asked)) >= 300_000
    assert encoded(encoder, texts) == first and len(asked) == once


@pytest.mark.parametrize("alphabet, n", [(1, 5000), (2, 9000), (200_000, 300_000), (50257, 900_000)])
def test_blocks_of_any_alphabet_and_size(alphabet, n):
    """One id only, ids beyond two bytes, and so many that the order-0 counts are halved."""
    ids = np.random.default_rng(n).zipf(1.2, n) % alphabet
    block = T.encode_block(ids.astype(np.uint32), alphabet)
    assert (T.decode_block(block, alphabet) == ids).all()


def test_a_block_is_coded_in_few_steps():
    """Lanes are wide enough that calls on arrays cost little next to the work on their items."""
    assert T._shape(T.BLOCK_IDS)[1] <= 80
    ids = (np.random.default_rng(2).geometric(0.004, T.BLOCK_IDS) % 50257).astype(np.uint32)  # 9.4 bits of entropy
    assert len(T.encode_block(ids, 50257)) * 8 / len(ids) < 10.6
