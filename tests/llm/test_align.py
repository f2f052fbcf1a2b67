from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from strata.llm import align
from strata.llm import queries as Q
from strata.llm.pretokens import default_vocabulary, token_bytes
from tests.llm.conftest import SF001

TEXTS = [
    None, "", " ", "  ", "a ", " a  ", "it's  we'll\n\nx", "<|endoftext|> </s><s> x", "x▁y", "日本語 テキスト １２３ ½²", "😀👍🏽 é́", "a" * 3000, " " * 2000, "the " * 3000, "\x00\x01 \x7f", "Fuß und Über", "aa bb aa bb",
    "x" + "=" * 777 + "日" * 501, "\t\x0b\x85　x",
]


class Plain:
    """Whole texts through both libraries, cuts by set intersection, links by pairing everything in a group."""

    def __init__(self):
        self.a = Tokenizer.from_file(default_vocabulary())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=align.default_pieces())
        self.spell_a = token_bytes(default_vocabulary())

    def spell_b(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        raw_a, raw_b = [self.spell_a[i] for i in a], [self.spell_b(i) for i in b]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            return []
        ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        out, i, j = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
            out.append((a[i:x], b[j:y]))
            i, j = x, y
        return out

    def rows(self, texts):
        groups = [self.groups(t) for t in texts]
        links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
        docs = Counter(p for c in links for p in c)
        most: dict = {}
        for (a, _), n in docs.items():
            most[a] = max(n, most.get(a, 0))
        for g, c in zip(groups, links, strict=True):
            said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            sha = hashlib.sha256(said.encode()).hexdigest() if said else ""
            yield sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()), sum(n for p, n in c.items() if docs[p] == most[p[0]]), sum(n * docs[p] for p, n in c.items()), sha


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    return Plain()


def test_query_on_the_small_tables(spark, documents, plain):
    docs = sorted((r[0], r[1]) for r in documents.select("doc_id", "text").collect())
    got = sorted((r["doc_id"], *[r[c] for c in COLUMNS]) for r in Q.op11_alignment(spark, SF001).collect())
    assert got == [(i, *x) for (i, _), x in zip(docs, plain.rows([t for _, t in docs]), strict=True)]


@pytest.mark.parametrize("frequent", [align.FREQUENT, 40, 0])
def test_defined_cases_with_pairs_broadcast_or_joined(docs_of, plain, frequent):
    rows = [*enumerate(TEXTS), (None, "no id"), (1, "again and again"), (1, "again and again")]
    got = sorted(((r["doc_id"], *[r[c] for c in COLUMNS]) for r in align.alignment_counts(docs_of(rows, clashing=True), frequent=frequent).collect()), key=repr)
    assert got == sorted(((i, *x) for (i, _), x in zip(rows, plain.rows([t for _, t in rows]), strict=True)), key=repr)


def test_empty_table(docs_of):
    assert align.alignment_counts(docs_of([])).collect() == []
    assert align.align(docs_of([])).collect() == []


def test_groups_as_arrays(docs_of, plain):
    got = {r["doc_id"]: r for r in align.align(docs_of(list(enumerate(TEXTS)))).collect()}
    for i, text in enumerate(TEXTS):
        r = got[i]
        groups, a, b = [], 0, 0
        for x, y in zip(r["a_ends"], r["b_ends"], strict=True):
            groups.append((r["a_ids"][a:x], r["b_ids"][b:y]))
            a, b = x, y
        assert groups == plain.groups(text), text


def test_cuts_equal_the_common_ends_of_random_rows():
    rng = random.Random(2)
    for case in range(300):
        rows = []
        for _ in range(rng.randint(0, 5)):
            n = rng.choice([0, 1, 2, 5, 60, 3000])
            rate = rng.choice([0.02, 0.3, 0.9])
            rows.append([sorted({i for i in range(1, n) if rng.random() < rate} | ({n} if n else set())) for _ in range(2)])
        ends, bounds, at = ([], []), ([], []), 0
        for pair in rows:
            for side in range(2):
                ends[side].extend(at + e for e in pair[side])
                bounds[side].append(len(ends[side]))
            at += pair[0][-1] if pair[0] else 0
        a, b = (np.array(x, np.int64) for x in ends)
        got = align.shared_cuts(a, b, np.array(bounds[0], np.int64), np.array(bounds[1], np.int64))
        common = np.intersect1d(a, b)
        assert a[got[0] - 1].tolist() == b[got[1] - 1].tolist() == common.tolist(), case


def test_texts_of_very_many_links_in_a_group():
    """One group of 3000 by 2000 tokens: worked on in parts, counted whole."""
    a, b = np.arange(3000, dtype=np.uint32) % 7, np.arange(2000, dtype=np.uint32) % 5
    x = align.Aligned(a, b, np.array([3000]), np.array([2000]), np.array([3000]), np.array([2000]), np.array([1]))
    pair, links, ends = align.linked_pairs(x, 10)
    want = Counter(int(p) * 10 + int(q) for p, n in Counter(a.tolist()).items() for q in range(5) for _ in range(1))
    assert pair.tolist() == sorted(want) and ends.tolist() == [len(want)]
    ca, cb = Counter(a.tolist()), Counter(b.tolist())
    assert links.tolist() == [ca[p // 10] * cb[p % 10] for p in pair.tolist()]
