"""Operator 1: benchmark decontamination by winnowing (DataFrame functions only).

Both sides hash every run of ``k`` words and keep, of each ``w`` consecutive hashes,
the smallest (the first of equal ones). A span of ``w + k - 1`` words or more that a
document shares with an item holds the same window on both sides, hence the same kept
hash at the same place. The kept hashes are joined; each hit is extended both ways, word by
word, as far as a window that holds its run can reach, which also removes hash collisions.
Windows of neighbouring hits overlap, so a long shared span comes out whole, and the work
grows with the hits, not with a hit times the length of its item.

Items shorter than the guaranteed span use their own length as ``k`` and a window of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, drop_rows, materialize, text_key
from strata.operators.joins import DEFAULT_MAX_BROADCAST, estimated_bytes

# Fixed value: everything that separates words (the complement of the word class in the contract).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
POS_BITS = 28  # of a packed fingerprint; a text may have 2^28 words


def with_words(rows: DataFrame) -> DataFrame:
    """Adds ``words``, the lower-cased words of ``text`` (NULL has none); each step is a projection of its own, so nothing is split twice."""
    rows = rows.withColumn("words", F.split(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), SEPARATORS))
    # only the first and the last part can be empty
    begin = F.when(F.get("words", F.lit(0)) == "", 2).otherwise(1)
    end = F.size("words") - F.when(F.element_at("words", -1) == "", 1).otherwise(0)
    return rows.withColumn("words", F.slice("words", begin, F.greatest(end - begin + 1, F.lit(0))))


def _gram_hashes(rows: DataFrame, k: int) -> DataFrame:
    """Adds ``grams``: the hash of each run of ``k`` words, built from runs of half the length."""
    rows = rows.withColumn("_g1", F.transform("words", lambda x: F.xxhash64(x)))
    have, total = {1: "_g1"}, 1
    steps = []
    while total * 2 <= k:
        steps.append((total * 2, total, total))
        total *= 2
    rest, at = k - total, total
    for size, a, shift in steps:
        rows = rows.withColumn(f"_g{size}", _pair(have[a], have[a], shift, F.size("words") - size + 1))
        have[size] = f"_g{size}"
    if rest:  # the last part may overlap the first: a run is still told by its words alone
        rows = rows.withColumn("grams", _pair(have[at], have[at], rest, F.size("words") - k + 1))
    else:
        rows = rows.withColumn("grams", F.col(have[at]))
    return rows.drop(*have.values())


def _pair(a: str, b: str, shift: int, n: Column) -> Column:
    n = F.greatest(n, F.lit(0))
    return F.zip_with(F.slice(F.col(a), F.lit(1), n), F.slice(F.col(b), F.lit(shift + 1), n), lambda x, y: F.xxhash64(x, y))


def fingerprints(rows: DataFrame, k: int, w: int, mark_rows: bool = False) -> DataFrame:
    """One row per kept hash: ``rows``' columns, ``hash`` and ``pos`` (word number, from 0).

    ``rows`` has ``words``. Hash and position are packed into one BIGINT, so the smallest
    of a window also tells the first of equal hashes. Every window's smallest is kept once.
    With ``mark_rows``, each input row yields one more row, with NULL hash.
    """
    cols = rows.columns
    low = (1 << POS_BITS) - 1
    rows = _gram_hashes(rows, k)
    packed = F.transform("grams", lambda h, i: h.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("bigint")))
    too_long = F.raise_error(F.lit(f"a text has more than 2^{POS_BITS} words")).cast("array<bigint>")
    rows = rows.withColumn("_p", F.when(F.size("grams") <= low, packed).otherwise(too_long)).drop("grams")
    # never empty; the outer form keeps the optimizer from testing the array beforehand, which would build it twice
    each = rows.select(*cols, "_p", F.posexplode_outer(F.concat(F.array(F.lit(None).cast("bigint")), F.col("_p"))).alias("_i", "_own"))
    at = lambda d: F.get("_p", F.col("_i") - 1 + d)  # noqa: E731  NULL outside; least() skips NULLs
    if w > 1:
        smallest = F.least(F.col("_own"), *[at(d) for d in range(1, w)])
        before = F.least(*[at(d) for d in range(-1, w - 1)])
        kept = (F.col("_i") <= F.size("_p") - w + 1) & ((F.col("_i") == 1) | (smallest != before))
    else:
        smallest, kept = F.col("_own"), F.lit(True)
    each = each.where(F.when(F.col("_i") == 0, F.lit(mark_rows)).otherwise(kept))
    each = each.withColumn("_m", F.when(F.col("_i") > 0, smallest))
    return each.select(*cols, F.shiftright("_m", POS_BITS).alias("hash"), F.col("_m").bitwiseAND(F.lit(low)).cast("int").alias("pos"))


def _hit_positions(seg: Column, item_seg: Column, begin: Column, span: Column) -> Column:
    """Document word numbers inside a run of ``span`` or more equal words; ``seg`` starts at word ``begin`` and faces ``item_seg``."""
    same = F.zip_with(seg, item_seg, lambda a, b: a == b)
    breaks = F.filter(F.transform(same, lambda x, i: F.when(~x, i)), lambda i: i.isNotNull())
    before, after = F.concat(F.array(F.lit(-1)), breaks), F.concat(breaks, F.array(F.size(seg)))
    runs = F.filter(F.zip_with(before, after, lambda b, e: F.struct(b.alias("b"), e.alias("e"))), lambda r: r["e"] - r["b"] - 1 >= span)
    return F.flatten(F.transform(runs, lambda r: F.sequence(begin + r["b"] + 1, begin + r["e"] - 1)))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", span: int = 10, k: int = 4) -> DataFrame:
    """One row per (id, text): doc_id, text_key, n_words, n_rows, n_hit, items (sorted ids as strings), hits (word numbers).

    A window is ``span`` consecutive words of an item, or all words of a shorter item that
    has any. Defined cases: NULL, empty and wordless texts have no words and no hits; rows
    that agree on id and text are one result row (``n_rows`` counts them); rows with one id
    and other texts, or without id, stay apart; an item with NULL id has the id ''; equal items
    each count; an empty benchmark hits nothing; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = with_words(rows.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))).drop("text")
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item_id"), F.col(item_text_col).alias("text"))
    items = with_words(items).drop("text").where(F.size("words") > 0).withColumn("item_key", F.xxhash64("item_id", "words")).dropDuplicates(["item_key"])
    items = materialize(items, "benchmark_words")
    short = sorted(r[0] for r in items.select(F.size("words").alias("n")).where(F.col("n") < span).distinct().collect())  # at most span - 1 numbers
    small = 16 * estimated_bytes(items) <= DEFAULT_MAX_BROADCAST  # two numbers for each kept hash, and the words
    main = items.where(F.size("words") >= span)
    k = min(k, span)
    every = _met(rows, main, k, span - k + 1, span, True) if small else _met_shuffled(rows, main, k, span - k + 1, span, True)
    for n in short:
        of_n = items.where(F.size("words") == n)
        every = every.unionByName(_met(rows, of_n, n, 1, span, False) if small else _met_shuffled(rows, of_n, n, 1, span, False))
    out = every.groupBy("doc_id", "text_key").agg(F.max("n_words").alias("n_words"), F.count("n_words").alias("n_rows"), F.array_sort(F.collect_set("item_id")).alias("items"), F.array_distinct(F.flatten(F.collect_set("_at"))).alias("hits"))
    return out.withColumn("n_hit", F.size("hits"))


def _extended(met: DataFrame, span: int, k: int) -> DataFrame:
    """(doc_id, text_key, n_words, item_id, _at) from hits of ``k`` words with both sides' words; rows without item pass.

    Every window of an item holds a kept run, so from each run only the words that share a window with it are compared.
    """
    own = F.least(F.lit(span), F.size("item_words"))
    reach = own - k  # words of a window before or after the run
    back = F.least(reach, F.col("pos"), F.col("item_pos"))
    begin, skip = F.col("pos") - back, F.col("item_pos") - back
    length = F.least(back + k + reach, F.size("item_words") - skip, F.size("words") - begin)
    met = met.select("doc_id", "text_key", "n_words", "item_id", own.alias("_span"), begin.alias("_from"), F.when(F.col("item_words").isNotNull(), F.slice("words", begin + 1, length)).alias("_seg"), F.slice("item_words", skip + 1, length).alias("_iseg"))
    met = met.withColumn("_at", F.when(F.col("_iseg").isNotNull(), _hit_positions(F.col("_seg"), F.col("_iseg"), F.col("_from"), F.col("_span")))).drop("_seg", "_iseg", "_from", "_span")
    found = F.size("_at") > 0
    return met.select("doc_id", "text_key", "n_words", F.when(found, F.col("item_id")).alias("item_id"), F.when(found, F.col("_at")).alias("_at"))


def _met(rows: DataFrame, items: DataFrame, k: int, w: int, span: int, mark_rows: bool) -> DataFrame:
    """Hits in one pass over the documents: the checked-size item sides are broadcast, so a document's words never move."""
    own = fingerprints(items.select("item_key", "words"), k, w).select("item_key", "hash", F.col("pos").alias("item_pos"))
    kept = fingerprints(rows, k, w, mark_rows)
    met = kept.join(F.broadcast(own), "hash", "left" if mark_rows else "inner").where(F.col("item_key").isNotNull() | F.col("hash").isNull())
    met = met.join(F.broadcast(items.select("item_key", "item_id", F.col("words").alias("item_words"))), "item_key", "left")
    return _extended(met.withColumn("n_words", F.when(F.col("hash").isNull(), F.size("words"))), span, k)


def _met_shuffled(rows: DataFrame, items: DataFrame, k: int, w: int, span: int, mark_rows: bool) -> DataFrame:
    """The same for large benchmarks: narrow fingerprints meet by shuffle, then both sides' words are fetched for what met."""
    own = fingerprints(items.select("item_key", "words"), k, w).select("item_key", "hash", F.col("pos").alias("item_pos"))
    kept = fingerprints(rows, k, w).select("doc_id", "text_key", "hash", "pos")
    met = kept.join(own, "hash").select("doc_id", "text_key", "item_key", "pos", "item_pos").distinct()
    met = met.join(items.select("item_key", "item_id", F.col("words").alias("item_words")), "item_key")
    one = rows.dropDuplicates(["doc_id", "text_key"]).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "words")
    met = met.join(one, met["doc_id"].eqNullSafe(one["_id"]) & (met["text_key"] == one["_key"]))
    found = _extended(met.withColumn("n_words", F.lit(None).cast("int")), span, k)
    if not mark_rows:
        return found
    base = rows.select("doc_id", "text_key", F.size("words").alias("n_words"), F.lit(None).cast("string").alias("item_id"), F.lit(None).cast("array<int>").alias("_at"))
    return base.unionByName(found)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = 10) -> DataFrame:
    """``docs`` without the rows that hold a window of any item."""
    return drop_rows(docs, contamination(docs, benchmark, span=span).where("n_hit > 0"))
