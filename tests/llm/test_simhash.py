from __future__ import annotations

import random

import numpy as np
import pytest
from tests.llm.brute import components, simhash

from strata.llm import queries as Q
from strata.llm import simhash as S
from tests.llm.conftest import SF001


def expected(docs, bits=4):
    prints = [simhash(t) for _, t in docs]
    comp = components([i for i, _ in docs], lambda a, b: (prints[a] ^ prints[b]).bit_count() <= bits)
    return sorted(((i, f"{p:016x}", c) for (i, _), p, c in zip(docs, prints, comp, strict=True)), key=repr)


def test_query_on_the_small_tables(spark, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in Q.op10_simhash(spark, SF001).collect()), key=repr)
    assert got == expected(docs)


@pytest.mark.parametrize("blocks", [5, 6, 8])
def test_links_of_planted_prints(spark, blocks):
    rng = random.Random(blocks)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints)[:30]:
        for _ in range(rng.randint(0, 60)):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                p ^= 1 << b
            prints.add(p)
    prints = sorted(np.array(sorted(prints), np.uint64).view(np.int64).tolist())
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    got = {r[0]: r[1] for r in S.hamming_components(df, 4, blocks).collect()}
    want = components(prints, lambda a, b: ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count() <= 4)
    assert [got.get(p, p) for p in prints] == want


def test_defined_cases(docs_of):
    docs = [(1, None), (2, ""), (None, " \t"), (3, "A b"), (4, "a B"), (4, "a B"), (None, "one two three four five"), (None, "ONE two three four five"), (7, "É é"), (8, "x y " * 40000)]
    got = S.simhash_components(docs_of(docs, clashing=True)).drop("text_key")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(docs)
    assert S.simhash_components(docs_of([])).collect() == []


def test_one_of_each_group_stays(docs_of):
    docs = docs_of([(5, "a b c d e"), (2, "A b c d e"), (2, "a B c d e"), (2, "other words are here now"), (2, "other words are here now"), (None, "z"), (None, "z")], clashing=True)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((tuple(r)[:2] for r in kept.collect()), key=repr)
    assert len([r for r in got if r[1].lower().startswith("a b")]) >= 1 and all(r[0] != 5 for r in got)
    assert got.count((2, "other words are here now")) == 1 and got.count((None, "z")) == 1


def test_exactly_one_of_each_group_stays(docs_of):
    """Also where ids repeat within a group, are the smallest of several groups, or are all NULL."""
    same = ["a b c d e", "A b c d e", "a B c d e", "a b C d e"]
    hot = [(2, t) for t in same] + [(5, same[0])]
    other = [(2, "other words are here now"), (2, "OTHER words are here now"), (9, "other words are here NOW")]
    none = [(None, t) for t in ("no id at all here", "No id at all here", "NO id at all here", "no id at all here")]
    mixed = [(None, "some have an id"), (7, "Some have an id"), (7, "SOME have an id")]
    kept = S.keep_one(docs_of(hot + other + none + mixed, clashing=True)).collect()
    assert sorted(((r["doc_id"], r["text"].lower()) for r in kept), key=repr) == sorted([(2, "a b c d e"), (2, "other words are here now"), (None, "no id at all here"), (7, "some have an id")], key=repr)
    assert S.keep_one(docs_of([])).collect() == []


def test_every_choice_of_blocks_finds_close_pairs():
    for blocks in range(5, 10):
        masks = S.block_masks(blocks, 4)
        rng = random.Random(blocks)
        for _ in range(200):
            diff = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(diff & m == 0 for m in masks)


def test_finer_masks_keep_every_close_pair():
    rng = random.Random(3)
    for n in (5, 6, 9, 30):
        bits = rng.sample(range(64), 30 + n)
        mask, varying = sum(1 << b for b in bits[:30]), sum(1 << b for b in bits[30:])
        masks = S.finer_masks(mask, varying | mask, 4)
        assert all(m & mask == mask and m != mask and (m & ~mask) & ~varying == 0 for m in masks)
        free = [b for b in range(64) if not mask >> b & 1]
        for _ in range(200):
            diff = sum(1 << b for b in rng.sample(free, 4))
            assert any(diff & m == 0 for m in masks)
    assert S.finer_masks(0, 0b1111, 4) == [] and S.finer_masks(7, 0b1111111, 4) == []


@pytest.mark.parametrize("split", [40, 600])
def test_fingerprints_on_one_template_are_split(spark, monkeypatch, split):
    """Most fingerprints share the upper 38 bits, so that they meet in one bucket of several masks."""
    rng = random.Random(split)
    free, base = range(26), rng.getrandbits(64)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for _ in range(700):
        p = base
        for b in free:
            p ^= rng.getrandbits(1) << b
        prints.add(p)
    for p in rng.sample(sorted(prints), 200):
        for _ in range(rng.randint(1, 3)):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                p ^= 1 << b
            prints.add(p)
    prints = sorted(np.array(sorted(prints), np.uint64).view(np.int64).tolist())
    sizes, compared = [], S._compared

    def watched(met, bits):
        sizes.append(met.groupBy("mask", "key").count().agg({"count": "max"}).first()[0] or 0)
        return compared(met, bits)

    monkeypatch.setattr(S, "_compared", watched)
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    got = {r[0]: r[1] for r in S.hamming_components(df, 4, 6, split).collect()}
    want = components(prints, lambda a, b: ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count() <= 4)
    assert [got.get(p, p) for p in prints] == want and len(set(want)) < len(want)
    assert len(sizes) >= 2 and max(sizes) <= 2 * split
