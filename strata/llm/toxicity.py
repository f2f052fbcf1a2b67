"""Operator 6: toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Per-coordinate learning rates and an L1 term leave few non-zero weights, which are sent
to every task. The fit takes a bounded, seeded sample of labelled rows (``max_rows``);
every text is scored whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import let_go, materialize, text_key


@dataclass(frozen=True)
class Settings:
    bits: int = 20  # hashed features: 2**bits
    max_rows: int = 16_000  # labelled rows the fit takes at most
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 1.0
    epochs: int = 3
    seed: int = 7


MEMO_WORDS = 150_000  # words a worker remembers; beyond, it starts anew


class _Words(dict):
    """Raw word -> hash of its lower-cased letters and digits (outer punctuation gone)."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        core = word.strip(".,;:!?()[]{}\"'«»¡¿…-*_")
        got = self[word] = zlib.crc32(core.encode("utf-8", "surrogatepass"))
        return got


_WORDS = _Words()


def features(text: str | None, bits: int) -> np.ndarray:
    """Hashed words, pairs of neighbours, and pairs with one word between (repeats kept)."""
    words = [] if text is None else text.lower().split()
    ids = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    mask, spread = np.uint64((1 << bits) - 1), np.uint64(40 - bits // 2)
    mixed = ids * np.uint64(0x9E3779B97F4A7C15)
    pair = (mixed[:-1] ^ (ids[1:] + np.uint64(0x5BD1))) * np.uint64(0xC2B2AE3D27D4EB4F)
    skip = (mixed[:-2] ^ (ids[2:] + np.uint64(0xA5A5A5))) * np.uint64(0x165667B19E3779F9)
    return (np.concatenate([mixed, pair, skip]) >> spread) & mask


def _weights(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0)
    return -shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)


def ftrl(rows: list[tuple[np.ndarray, int]], s: Settings) -> tuple[float, np.ndarray, np.ndarray]:
    """(bias, feature numbers, weights) fitted to (distinct features, label) rows, in a seeded order per epoch.

    A feature's value is 1 whatever its count; the bias has no penalty.
    """
    z, n = np.zeros(1 << s.bits), np.zeros(1 << s.bits)
    share = (sum(y for _, y in rows) + 1) / (len(rows) + 2)
    bias, bias_n = float(np.log(share / (1 - share))), 1.0
    order = np.random.default_rng(s.seed)
    for _ in range(s.epochs):
        for i in order.permutation(len(rows)):
            f, y = rows[i]
            w = _weights(z[f], n[f], s)
            g = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -35, 35))) - y
            rate = (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / s.alpha
            z[f] += g - rate * w
            n[f] += g * g
            bias_n += g * g
            bias -= s.alpha * g / np.sqrt(bias_n)
    w = _weights(z, n, s)
    kept = np.flatnonzero(w)
    return bias, kept, w[kept]


@dataclass(frozen=True)
class Model:
    bits: int
    bias: float
    features: np.ndarray = field(repr=False)
    weights: np.ndarray = field(repr=False)
    fitted: bool = True  # False: no labelled row was there to fit


def fit(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, settings: Settings = Settings()) -> Model:
    """Fit on labelled rows (``labels``: doc_id, toxic) that ``held_out`` (over doc_id) does not name.

    At most ``settings.max_rows`` texts, one for each id, chosen by a hash of doc_id. Labels
    that are NULL or without document are ignored; of several labels of a document the
    largest counts; of several texts under one id the one with the smallest text_key.
    Without labelled rows every score is the prior, one half.
    """
    named = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    if held_out is not None:
        named = named.where(~held_out)
    named = named.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = docs.select("doc_id").where("doc_id is not null").distinct()  # partly distinct before the shuffle: a repeated id is one row a task
    named = named.join(known, "doc_id", "left_semi")
    named = named.orderBy(F.xxhash64("doc_id", F.lit(settings.seed)), "doc_id").limit(settings.max_rows)  # top-k: each task keeps max_rows at most
    named = materialize(named, "toxicity_sample")  # max_rows rows of two numbers
    key = text_key(F.col("text")).alias("text_key")
    firsts = docs.select("doc_id", key).join(F.broadcast(named), "doc_id").groupBy("doc_id", "toxic", "text_key").agg(F.count(F.lit(1)).alias("n"))
    firsts = firsts.groupBy("doc_id", "toxic").agg(F.min(F.struct("text_key", "n")).alias("first")).select("doc_id", "toxic", "first.text_key", "first.n")
    firsts = materialize(firsts, "toxicity_texts")
    texts = docs.select("doc_id", "text", key).join(F.broadcast(firsts), ["doc_id", "text_key"])
    # features are made where the texts are; one task then sees the bounded sample's distinct feature numbers
    rows = texts.select("doc_id", "toxic", _distinct_features(F.col("text"), settings.bits).alias("f"))
    if not firsts.where("n > 1").isEmpty():  # equal texts of an id become one row; only such samples are shuffled for it
        rows = rows.groupBy("doc_id", "toxic").agg(F.min("f").alias("f"))
    found = rows.repartition(1).sortWithinPartitions("doc_id", "f").mapInArrow(_fit_task(settings), "feature bigint, weight double").collect()
    if not found:
        return Model(settings.bits, 0.0, np.zeros(0, np.int64), np.zeros(0), fitted=False)
    pairs = sorted((r[0], r[1]) for r in found)  # the bias stands at -1; at most 2**bits weights
    return Model(settings.bits, pairs[0][1], np.array([p[0] for p in pairs[1:]], np.int64), np.array([p[1] for p in pairs[1:]]))


def _distinct_features(text: Column, bits: int) -> Column:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                yield pa.array([np.unique(features(t.as_py(), bits)).astype("<u4").tobytes() for t in texts], pa.binary())
        finally:
            _WORDS.clear()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "binary")(text)


def _fit_task(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.frombuffer(f, "<u4"), y) for b in batches for y, f in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
        if rows:
            bias, kept, w = ftrl(rows, settings)
            del rows
            let_go()
            yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, kept).astype(np.int64)), pa.array(np.append(bias, w))], names=["feature", "weight"])

    return run


def score(model: Model, text: Column) -> Column:
    """Toxicity of each whole text, 0 to 1; NULL and empty texts get the bias's score."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w = np.zeros(1 << model.bits)
        w[model.features] = model.weights
        on = w != 0
        try:
            for texts in batches:
                sums = np.full(len(texts), model.bias)
                for i, t in enumerate(texts):
                    f = features(t.as_py(), model.bits)
                    sums[i] += w[np.unique(f[on[f]])].sum()
                yield pa.array(1 / (1 + np.exp(-np.clip(sums, -35, 35))))
        finally:  # the worker lives on: other stages need the memory
            _WORDS.clear()
            del w, on
            let_go()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "double")(text)


def held_out(doc_id: Column) -> Column:
    """A fifth of all ids, by crc32 of the id as text; a NULL id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 from one half on).

    The fit never sees held-out labels; scores depend on texts alone. Repeated rows give
    repeated results, NULL ids are scored, an empty table gives an empty result and other
    columns are ignored.
    """
    model = fit(docs, labels, held_out(F.col("doc_id")), settings)
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(model, F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the rows that score one half or more; the columns stay.

    Without a labelled row to fit (no labels, only NULLs, only held-out ids or ids without
    document) nothing is known against any text, and every row stays. NULL and empty texts
    have no feature: they stay or go by the fitted bias.
    """
    model = fit(docs, labels, held_out(F.col("doc_id")), settings)
    if not model.fitted:
        return docs
    return docs.where(score(model, F.col("text")) < 0.5)
