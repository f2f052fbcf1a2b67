"""Operator 7: token counts from an exact histogram of encoded lengths.

Documents are reduced to (length, documents) before anything is sorted, so everything
after the encoding works on as many rows as there are different lengths. Suffix sums
over the histogram then answer, for every context limit, how many documents and tokens
lie beyond it and how many tokens remain when texts are cut there.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialize
from strata.llm.pretokens import ManyWordIds, byte_alphabet, default_vocabulary, token_bytes

BUCKET = 1024  # lengths of a bucket; suffix sums run inside buckets and over bucket totals


SHORT_WORDS = 1 << 21  # short words a worker remembers (some 40 bytes each); beyond, it starts anew
TOGETHER = 1 << 12  # words that the library gets at once
LONG_WORDS, LONG_CHARS = 50_000, 4_000_000  # other words, and their characters


@lru_cache(maxsize=2)
def library_encoder(path: str) -> ManyWordIds:
    """One tokenizer and memo for each worker process; it gets words that are split already."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    tokenizer, joined = Tokenizer.from_file(path), Tokenizer.from_file(path)
    tokenizer.pre_tokenizer = bytewise
    joined.pre_tokenizer = pre_tokenizers.Sequence([bytewise, pre_tokenizers.CharDelimiterSplit(byte_alphabet()[0])])
    spelled = np.fromiter(map(len, token_bytes(path)), np.int64)

    def encode(words: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def encode_flat(words: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Many words as one text, which the library splits at NUL and does not merge across; a word's ids spell its bytes."""
        if len(words) > TOGETHER:
            parts = [encode_flat(words[a : a + TOGETHER], sizes[a : a + TOGETHER]) for a in range(0, len(words), TOGETHER)]
            return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
        text = "\0".join(words)
        if text.count("\0") < len(words):
            ids = np.array(joined.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends, want = np.cumsum(spelled[ids]), np.cumsum(sizes)
            at = np.searchsorted(ends, want)
            if len(ends) and ends[-1] == want[-1] and (ends[at] == want).all():
                return ids, np.diff(at, prepend=-1)
        lists = encode(words)  # words with NUL, or a vocabulary that does not spell every byte
        return np.array([i for own in lists for i in own], np.uint32), np.fromiter(map(len, lists), np.int64, len(lists))

    return ManyWordIds(encode, encode_flat, SHORT_WORDS, LONG_WORDS, LONG_CHARS)


def token_count(text: Column, path: str | None = None) -> Column:
    """Tokens of each whole text (BIGINT); NULL and empty texts have none."""
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for _, ends in library_encoder(path).slices(texts):
                yield pa.array(np.diff(ends, prepend=0).astype(np.int64))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "bigint")(text)


def length_histogram(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """(length, n_docs), one row for each length that occurs; every row of ``docs`` counts, repeated ones too."""
    rows = docs.select(token_count(F.col(text_col), path).alias("length"))
    return rows.groupBy("length").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per length, read as a context limit: n_docs, tokens, docs_from and tokens_from (documents at least that long),
    docs_total, tokens_total, truncated_total (tokens left when texts are cut at the limit), share_within (of documents that fit).

    An empty histogram gives an empty result.
    """
    h = histogram.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("tokens"), F.floor(F.col("length") / BUCKET).alias("bucket"))
    totals = h.groupBy("bucket").agg(F.sum("n_docs").alias("_d"), F.sum("tokens").alias("_t"))
    # one row for each BUCKET lengths: a single ordered pass over a fraction of the histogram
    beyond = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select("bucket", F.coalesce(F.sum("_d").over(beyond), F.lit(0)).alias("_dx"), F.coalesce(F.sum("_t").over(beyond), F.lit(0)).alias("_tx"), F.sum("_d").over(whole).alias("docs_total"), F.sum("_t").over(whole).alias("tokens_total"))
    inside = Window.partitionBy("bucket").orderBy(F.desc("length"))
    out = h.withColumn("_di", F.sum("n_docs").over(inside)).withColumn("_ti", F.sum("tokens").over(inside)).join(totals, "bucket")
    out = out.withColumn("docs_from", F.col("_di") + F.col("_dx")).withColumn("tokens_from", F.col("_ti") + F.col("_tx"))
    cut = F.col("tokens_total") - F.col("tokens_from") + F.col("docs_from") * F.col("length")
    share = (F.col("docs_total") - F.col("docs_from") + F.col("n_docs")) / F.col("docs_total")
    return out.select("length", "n_docs", "tokens", "docs_from", "tokens_from", "docs_total", "tokens_total", cut.alias("truncated_total"), share.alias("share_within"))


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(limit, docs_beyond, truncated_total) for any context limits, whether a text has that length or not."""
    spark = sums.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in limits], "limit bigint")
    beyond = sums.join(F.broadcast(asked), F.col("length") > F.col("limit"))  # limits are a parameter
    first = beyond.groupBy("limit").agg(F.min_by(F.struct("docs_from", "tokens_from"), "length").alias("x"))
    total = sums.agg(F.coalesce(F.max("tokens_total"), F.lit(0)).alias("tokens_total"))
    out = asked.join(first, "limit", "left").join(F.broadcast(total))  # one row
    docs, tokens = F.coalesce("x.docs_from", F.lit(0)), F.coalesce("x.tokens_from", F.lit(0))
    return out.select("limit", docs.alias("docs_beyond"), (F.col("tokens_total") - tokens + docs * F.col("limit")).alias("truncated_total"))


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length): the smallest length within which at least that share of the documents lies."""
    asked = sums.sparkSession.createDataFrame([(float(x),) for x in shares], "share double")
    met = sums.join(F.broadcast(asked), F.col("share_within") >= F.col("share"))  # shares are a parameter
    return met.groupBy("share").agg(F.min("length").alias("length"))


def token_statistics(docs: DataFrame) -> DataFrame:
    """``suffix_sums`` over the documents' histogram; the histogram is written once, as it is read twice."""
    return suffix_sums(materialize(length_histogram(docs), "length_histogram"))
