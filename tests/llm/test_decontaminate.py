from __future__ import annotations

import random

import pytest
from tests.llm.brute import contamination as brute
from pyspark.sql import functions as F

from strata.llm import decontaminate as D
from strata.llm import queries as Q
from tests.llm.conftest import SF001


def rows_of(df):
    out = df.select("doc_id", F.col("n_words").cast("bigint"), F.col("n_hit").cast("bigint"), F.size("items").cast("bigint"), F.sha2(F.array_join("items", ","), 256), (F.col("n_hit") > 0), "n_rows")
    return sorted((tuple(r)[:6] for r in out.collect() for _ in range(r[6])), key=repr)


def bench_of(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_query_on_the_small_tables(spark, documents):
    bench = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in Q.op1_decontaminate(spark, SF001).collect()), key=repr)
    assert got == brute(docs, bench)
    assert any(r[5] for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_from_few_words(spark, docs_of, seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("ab") + rng.choice("xy") * rng.randint(0, 1) for _ in range(n))
    bench = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(12)] + [(None, text(12)), (3, text(14))]
    docs = [(i, text(rng.choice([0, 1, 5, 9, 10, 30, 60]))) for i in range(30)]
    got = rows_of(D.contamination(docs_of(docs), bench_of(spark, bench)))
    assert got == brute(docs, bench)


def test_shuffled_form_equals_broadcast_form(spark, docs_of, monkeypatch):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    bench = [(i, text(rng.choice([2, 10, 20]))) for i in range(10)]
    docs = [(i % 7 or None, text(rng.choice([0, 12, 80]))) for i in range(20)]
    a = rows_of(D.contamination(docs_of(docs), bench_of(spark, bench)))
    monkeypatch.setattr(D, "DEFAULT_MAX_BROADCAST", 0)
    assert rows_of(D.contamination(docs_of(docs), bench_of(spark, bench))) == a == brute(docs, bench)


def test_defined_cases(spark, docs_of):
    w = " ".join(f"w{i}" for i in range(12))
    docs = [(1, None), (2, ""), (3, "!!"), (None, w.upper()), (4, w), (4, w), (4, "other " + w), (5, "É " + w + " Ü"), (6, ("x " * 30000) + w)]
    for bench in ([(1, w)], [(1, w), (1, w), (2, None), (3, "")], []):
        got = rows_of(D.contamination(docs_of(docs, clashing=True), bench_of(spark, bench)))
        assert got == brute(docs, bench)
    assert rows_of(D.contamination(docs_of([]), bench_of(spark, [(1, w)]))) == []


def test_kept_rows(spark, docs_of):
    w = " ".join(f"w{i}" for i in range(12))
    docs = docs_of([(1, w), (1, "clean"), (2, "clean"), (2, "clean"), (None, w), (None, None)], clashing=True)
    kept = D.drop_contaminated(docs, bench_of(spark, [(1, w)]))
    assert kept.columns == docs.columns
    assert sorted((tuple(r)[:2] for r in kept.collect()), key=repr) == sorted([(1, "clean"), (2, "clean"), (2, "clean"), (None, None)], key=repr)


def test_long_items_take_time_with_their_length(spark, docs_of):
    import random
    import time

    rng = random.Random(2)
    words = [f"w{rng.randrange(10**6)}" for _ in range(100_000)]
    words[50_000] = "changed"
    item = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    words[50_000] = "other"
    began = time.time()
    got = D.contamination(docs_of([(1, "before " + " ".join(words) + " after")]), item).select("n_words", "n_hit").first()
    assert tuple(got) == (100_002, 99_999)
    assert time.time() - began < 200


def test_a_repeating_item_and_document(spark, docs_of):
    """One word over and over: every diagonal hits, each only near its run."""
    item = spark.createDataFrame([(1, "a " * 300), (2, "a b " * 40)], "item_id bigint, text string")
    rows = [(1, "a " * 500), (2, "x " + "a b " * 9 + "y"), (3, "a " * 9), (4, "a " * 10)]
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in D.contamination(docs_of(rows), item).collect())
    assert got == [(1, 500, 500, ["1"]), (2, 20, 18, ["2"]), (3, 9, 0, []), (4, 10, 10, ["1"])]
