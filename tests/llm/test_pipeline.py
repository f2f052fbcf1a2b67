"""The pipeline against plain re-statements of its stages, each on what its predecessor kept."""

from __future__ import annotations

from tokenizers import Tokenizer

import corpus_pipeline as P
from strata.llm import toxicity
from strata.llm.common import materialize, table
from strata.llm.pretokens import default_vocabulary
from tests.llm import brute
from tests.llm.conftest import SF001
from tests.llm.test_bpe import expected


def test_run_against_brute_force(spark, documents):
    bench = [tuple(r) for r in table(spark, SF001, "benchmark").select("item_id", "text").collect()]
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(documents, table(spark, SF001, "labels")).collect()}
    docs, kept = documents, []
    for name, stage in P.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF001), f"test_{name}")
        assert docs.columns == documents.columns
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    all_texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert set(kept[0]) == {i for i in all_texts if scores[i] < 0.5}
    ids = sorted(kept[0])
    prints = [brute.simhash(kept[0][i]) for i in ids]
    comp = brute.components(ids, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert set(kept[1]) == {i for i, c in zip(ids, comp, strict=True) if i == c}
    assert set(kept[2]) == {r[0] for r in brute.contamination(sorted(kept[1].items()), bench) if not r[5]}
    assert set(kept[3]) == set(kept[2])
    for i, text in kept[3].items():
        assert not brute.base_secrets(text)
        if "[SECRET]" not in text:
            assert text == kept[2][i]
    t = Tokenizer.from_file(default_vocabulary())
    assert sorted(tuple(r) for r in P.run(spark, SF001).collect()) == sorted((i, *expected(t, x)) for i, x in kept[3].items())


def _tables(spark, folder, docs, labels=(), bench=()):
    from pyspark.sql import functions as F

    d = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    d = d.withColumns({c: F.lit("x") for c in ("words", "fp", "key", "component", "hash", "text_key", "_rid", "secret_spans", "ids")})
    d.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(bench), "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return d.columns


def test_defined_cases(spark, tmp_path):
    import random

    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    one, unnamed, twice, long, passage = text(40), text(40), text(40), text(60_000), text(30)
    docs = [
        (1, one), (2, one), (None, unnamed), (None, unnamed), (3, None), (4, ""), (5, long), (8, twice), (8, twice),
        (6, f"{text(20)} {passage} {text(20)}"), (7, f'{text(20)} token="abcdEFGH1234567890" {text(20)}'),
    ]
    columns = _tables(spark, tmp_path, docs, bench=[(1, passage), (2, None), (None, "")])
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        kept = materialize(stage(spark, kept, str(tmp_path)), f"case_{name}")
        assert kept.columns == columns
    texts = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    redacted = next(t for i, t in docs if i == 7).replace('token="abcdEFGH1234567890', "[SECRET]")
    assert [i for i, _ in texts] == sorted([1, None, 3, 5, 7, 8], key=repr)
    assert dict(texts)[1] == one and dict(texts)[5] == long and dict(texts)[3] is None and "abcdEFGH" not in dict(texts)[7] and dict(texts)[7].split("[SECRET]")[0] == redacted.split("[SECRET]")[0]
    t = Tokenizer.from_file(default_vocabulary())
    assert sorted((tuple(r) for r in P.run(spark, str(tmp_path)).collect()), key=repr) == sorted(((i, *expected(t, x)) for i, x in texts), key=repr)


def test_empty_tables(spark, tmp_path):
    _tables(spark, tmp_path, [])
    assert P.run(spark, str(tmp_path)).collect() == []
