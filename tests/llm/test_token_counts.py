from __future__ import annotations

from collections import Counter

from tokenizers import Tokenizer

from strata.llm import queries as Q
from strata.llm import token_counts as N
from strata.llm.pretokens import default_vocabulary
from tests.llm.conftest import SF001


def lengths(texts):
    t = Tokenizer.from_file(default_vocabulary())
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


def check(rows, ls):
    count, n = Counter(ls), len(ls)
    assert len(rows) == len(count)
    for r in rows:
        x = r["length"]
        beyond = [v for v in ls if v >= x]
        assert (r["n_docs"], r["tokens"], r["docs_from"], r["tokens_from"]) == (count[x], x * count[x], len(beyond), sum(beyond))
        assert (r["docs_total"], r["tokens_total"], r["truncated_total"]) == (n, sum(ls), sum(min(v, x) for v in ls))
        assert r["share_within"] == sum(v <= x for v in ls) / n


def test_query_on_the_small_tables(spark, documents):
    check(Q.op7_token_counts(spark, SF001).collect(), lengths([r[0] for r in documents.select("text").collect()]))


def test_defined_cases(spark, docs_of):
    texts = [None, "", "", "a", "a b", "a b", "<|endoftext|>", "y " * 3000, "z" * 5000, "word " * 1030]
    docs = docs_of([*enumerate(texts), (None, "a"), (0, "a")], clashing=True)
    ls = lengths([*texts, "a", "a"])
    sums = N.token_statistics(docs).cache()
    check(sums.collect(), ls)
    limits = [0, 1, 2, 1000, 1031, 10**9]
    assert sorted(tuple(r) for r in N.at_limits(sums, limits).collect()) == [(x, sum(v > x for v in ls), sum(min(v, x) for v in ls)) for x in limits]
    got = dict(tuple(r) for r in N.quantiles(sums, [0.0, 0.5, 0.9, 1.0]).collect())
    assert got == {s: min(x for x in ls if sum(v <= x for v in ls) / len(ls) >= s) for s in (0.0, 0.5, 0.9, 1.0)}
    assert N.token_statistics(docs_of([])).collect() == []
