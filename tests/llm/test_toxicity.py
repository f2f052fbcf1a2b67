from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from strata.llm import queries as Q
from strata.llm import toxicity as X
from strata.llm.common import table

SF01 = "/root/testdata/sf0.1"
SF001 = "/root/testdata/sf0.001"


def test_held_out_labels(spark):
    got = Q.op6_toxicity(spark, SF01).join(table(spark, SF01, "labels").select("doc_id", "toxic"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    test = [r for r in got if r["held_out"] and r["toxic"] is not None]
    toxic, clean = [r["score"] for r in test if r["toxic"]], [r["score"] for r in test if not r["toxic"]]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert auc > 0.97
    assert np.mean([r["predicted"] == r["toxic"] for r in test]) > 0.95


def test_labels_of_held_out_rows_change_nothing(spark, docs_of):
    words = ["calm", "river", "stone", "light", "cloud", "tree"]
    docs = docs_of([(i, " ".join(words[(i * k) % 6] for k in range(1, 9)) + (" horrid" if i % 3 == 0 else "")) for i in range(200)])
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    small = X.Settings(l1=1.0)
    a = X.score_documents(docs, labels, small).orderBy("doc_id").collect()
    turned = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert X.score_documents(docs, turned, small).orderBy("doc_id").collect() == a
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 == 0) for r in a]) > 0.97
    kept = X.drop_toxic(docs, labels, small)
    assert kept.columns == docs.columns and {r[0] for r in kept.collect()} == {r["doc_id"] for r in a if r["score"] < 0.5}


def test_defined_cases(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (None, "a b"), (3, "x"), (3, "x"), (4, "y " * 50000)], clashing=True)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    odd = spark.createDataFrame([(1, 1, None), (None, 0, 1), (99, 0, 1), (3, 1, 0), (3, 1, 1)], "doc_id bigint, quality int, toxic int")
    for labels in (none, odd):
        got = X.score_documents(docs, labels).collect()
        assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in X.score_documents(docs, none).collect()} == {0.5}
    assert X.score_documents(docs_of([]), odd).collect() == []


def test_sample_is_bounded_and_seeded(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    s = X.Settings(max_rows=500)
    a, b = X.fit(docs, labels, settings=s), X.fit(docs.repartition(7), labels.repartition(3), settings=s)
    assert a.bias == b.bias and (a.features == b.features).all() and (a.weights == b.weights).all()


def test_nothing_goes_without_evidence(spark, docs_of):
    """Empty labels, only NULLs, only held-out ids, ids without document: every row stays."""
    docs = docs_of([(i, f"calm river {i}") for i in range(1, 30)] + [(None, "a b"), (3, None), (4, "")], clashing=True)
    kind = "doc_id bigint, quality int, toxic int"
    out = [i for i in range(1, 30) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert out
    for rows in ([], [(1, 1, None), (None, 0, 1)], [(i, 0, 1) for i in out], [(999, 0, 1)]):
        kept = X.drop_toxic(docs, spark.createDataFrame(rows, kind))
        assert kept.columns == docs.columns and kept.count() == 32


def test_the_fit_sees_one_text_for_each_sampled_id(spark, docs_of, monkeypatch):
    """A repeated id is one row of the sample, and labels without document take no place in it."""
    seen = spark.sparkContext.accumulator(0)
    real = X._fit_task

    def counting(settings):
        run = real(settings)

        def counted(batches):
            def each():
                for b in batches:
                    seen.add(b.num_rows)
                    yield b

            yield from run(each())

        return counted

    monkeypatch.setattr(X, "_fit_task", counting)
    docs = docs_of([(1, f"hot text {i}") for i in range(300)] + [(1, "hot text 1")] * 50 + [(i, f"text {i}") for i in range(2, 12)])
    labels = spark.createDataFrame([(i, i % 2) for i in [*range(1, 12), *range(1000, 1500)]], "doc_id bigint, toxic int")
    X.fit(docs, labels, settings=X.Settings(max_rows=11))
    assert seen.value == 11


# --------------------------------------------------------------------------- the fit, number by number
def plain_features(text, bits):
    """Words, neighbours and skipped pairs, hashed one by one in Python integers."""
    import zlib

    wide = (1 << 64) - 1
    words = [zlib.crc32(w.strip(".,;:!?()[]{}\"'«»¡¿…-*_").encode("utf-8", "surrogatepass")) for w in (text or "").lower().split()]
    mixed = [w * 0x9E3779B97F4A7C15 & wide for w in words]
    out = list(mixed)
    out += [(mixed[i] ^ (words[i + 1] + 0x5BD1)) * 0xC2B2AE3D27D4EB4F & wide for i in range(len(words) - 1)]
    out += [(mixed[i] ^ (words[i + 2] + 0xA5A5A5)) * 0x165667B19E3779F9 & wide for i in range(len(words) - 2)]
    return sorted({x >> (40 - bits // 2) & ((1 << bits) - 1) for x in out})


def plain_ftrl(rows, s):
    """FTRL-proximal, a coordinate at a time."""
    import math

    import numpy as np

    z, n = {}, {}

    def weight(f):
        if abs(z.get(f, 0.0)) <= s.l1:
            return 0.0
        return -(z[f] - math.copysign(s.l1, z[f])) / ((s.beta + math.sqrt(n[f])) / s.alpha + s.l2)

    share = (sum(y for _, y in rows) + 1) / (len(rows) + 2)
    bias, bias_n = math.log(share / (1 - share)), 1.0
    order = np.random.default_rng(s.seed)
    for _ in range(s.epochs):
        for i in order.permutation(len(rows)):
            features, y = rows[i]
            g = 1 / (1 + math.exp(-max(-35, min(35, bias + sum(map(weight, features)))))) - y
            for f in features:
                w = weight(f)
                rate = (math.sqrt(n.get(f, 0.0) + g * g) - math.sqrt(n.get(f, 0.0))) / s.alpha
                z[f] = z.get(f, 0.0) + g - rate * w
                n[f] = n.get(f, 0.0) + g * g
            bias_n += g * g
            bias -= s.alpha * g / math.sqrt(bias_n)
    return bias, {f: weight(f) for f in z if weight(f)}


def test_fit_and_scores_equal_a_plain_ftrl(spark, documents):
    import math

    from strata.llm import toxicity as X
    from strata.llm.common import table

    s = X.Settings(bits=16, epochs=2, l1=0.5)
    labels = table(spark, SF001, "labels")
    toxic = {r["doc_id"]: int(r["toxic"]) for r in labels.collect() if r["toxic"] is not None}
    docs = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
    rows = [(plain_features(docs[i], s.bits), toxic[i]) for i in sorted(set(toxic) & set(docs))]  # rows reach the fit by id
    bias, weights = plain_ftrl(rows, s)
    model = X.fit(documents, labels, settings=s)
    assert abs(model.bias - bias) < 1e-9 and len(weights) > 50
    got = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    assert set(got) == set(weights) and max(abs(got[f] - w) for f, w in weights.items()) < 1e-9
    scores = {r["doc_id"]: r["s"] for r in documents.select("doc_id", X.score(model, documents["text"]).alias("s")).collect()}
    for i, text in docs.items():
        logit = bias + sum(weights.get(f, 0.0) for f in plain_features(text, s.bits))
        assert abs(scores[i] - 1 / (1 + math.exp(-max(-35, min(35, logit))))) < 1e-9
