"""Operator 4: secret scans (DataFrame functions only).

Three base patterns plus an entropy scan: over every candidate string, a window slides
one character at a time; the Shannon entropy of its characters follows from the counts
of the one character that leaves and the one that enters. Strings of a character class
whose window entropy reaches the class's threshold are spans of that class, unless an
allow-list pattern names them or placeholders make up half of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base kinds in their order, with pattern, the group whose length counts, and that length.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
# What finds the texts and the matches of the base patterns that can pass. A hex run and what follows
# AKIA are taken whole, so asking for the length in the pattern gives the same matches; an assignment's
# match may be too short and still use up its text, so its pattern stays as it is.
LONG_ENOUGH = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
HINT = {"assign": r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", "access": r"AKIA[A-Z0-9]{14}", "hex": r"[0-9a-f]{16}"}

# Entropy classes, in order of kind: (kind, candidate pattern, window, bits a character needs on average in some window).
ENTROPY = (
    ("hexrun", r"(?<![0-9A-Za-z])(?:[0-9a-f]{20,}|[0-9A-F]{20,})(?![0-9A-Za-z])", 20, 2.8),
    ("base64", r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{24,}", 24, 3.9),
    # issuers' prefixes name a token, so hex digits' entropy is enough
    ("prefixed", r"(?<![A-Za-z0-9])(?:gh[pousr]_|github_pat_|[srp]k_(?:live|test)_|sk-|xox[abeoprs]-|glpat-|npm_|pypi-|hf_)[A-Za-z0-9_-]{20,}", 20, 2.8),
)
# A segment of a path or dashed word that is a plain word (camel case too, a short number after it) or a short number.
_WORD = r"(?:(?:[A-Z]{1,15}|[A-Z]?[a-z]{1,15}(?:[A-Z][a-z]{2,14}){0,3})[0-9]{0,4}|[0-9]{1,8})(?![A-Za-z0-9])"
# Strings that look random and are not secrets.
ALLOW = (
    r"^[0-9]+$",  # numbers
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUIDs
    r"^[A-Za-z0-9+/]{1,30}EXAMPLE(?:KEY)?$",  # keys that vendors' manuals mark as examples
    r"^(?:sha(?:1|256|512))[-:]",  # integrity digests
    rf"^(?=[A-Za-z]){_WORD}(?:[-_/]{_WORD})++$",  # paths and dashed words of plain words only; possessive, so long ones need no stack
)
# Strings of which these make up half or more are no secrets either.
PLACEHOLDER = r"(?i)example|sample|placeholder|dummy|changeme|x{4,}|0123456789|abcdefgh(?:ijklmnop)?(?:qrstuvwxyz)?"


PIECE = 256  # characters of a candidate that are slid over at once
MATCHES = 128  # of a block of matches


def _spans(text: Column, pattern: str) -> Column:
    """Matches of ``pattern`` as structs (begin, word), begin in code points: the pieces between matches give the places."""
    words = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    lengths = F.transform(words, lambda m: F.length(m))
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(words)), lengths, lambda g, n: F.struct(g.alias("g"), n.alias("n")))
    # a match begins after all gaps up to its own and all earlier matches; sums run inside blocks of matches, then over the blocks
    zero = F.struct(F.lit(0).alias("upto"), F.array().cast("array<int>").alias("begins"))
    walk = lambda acc, x: F.struct((acc["upto"] + x["g"] + x["n"]).alias("upto"), F.concat(acc["begins"], F.array(acc["upto"] + x["g"])).alias("begins"))
    n = F.size(steps)
    numbers = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / MATCHES).cast("int"))).otherwise(F.array().cast("array<int>"))
    inside = F.transform(numbers, lambda b: F.aggregate(F.slice(steps, b * MATCHES + 1, F.lit(MATCHES)), zero, walk))
    none = F.struct(F.lit(0).alias("upto"), F.array().cast("array<array<int>>").alias("parts"))
    joined = lambda acc, r: F.struct((acc["upto"] + r["upto"]).alias("upto"), F.concat(acc["parts"], F.array(F.transform(r["begins"], lambda x: x + acc["upto"]))).alias("parts"))
    begins = F.flatten(F.aggregate(inside, none, joined, lambda acc: acc["parts"]))
    return F.arrays_zip(begins.alias("begin"), words.alias("word"))


def _contribution(c: Column) -> Column:
    """c log2 c, 0 for 0."""
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def window_entropy(word: Column, window: int) -> Column:
    """Largest Shannon entropy, in bits a character, of any ``window`` consecutive characters; 0 for shorter words.

    A long word is slid over in pieces that overlap by a window less one character, since to reach a
    character of a string takes time with its place.
    """
    pieces = F.regexp_extract_all(word, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    more = F.concat(F.slice(pieces, F.lit(2), F.size(pieces)), F.array(F.lit("")))
    lapped = F.zip_with(pieces, more, lambda a, b: F.concat(a, F.substring(b, 1, window - 1)))
    whole = F.length(word) <= PIECE
    return F.array_max(F.transform(F.when(whole, F.array(word)).otherwise(lapped), lambda x: _slid(x, window)))


def _slid(word: Column, window: int) -> Column:
    """``window_entropy`` of a short word.

    The sum of c log2 c over a window's counts c is carried along: one character leaves,
    one enters, and only their two counts change.
    """
    count = lambda part, ch: F.length(part) - F.length(F.replace(part, ch, F.lit("")))
    at = lambda i, n: F.substring(word, i, n)
    first = F.aggregate(F.array_distinct(F.split(at(F.lit(1), F.lit(window)), "")), F.lit(0.0), lambda acc, ch: acc + F.when(ch == "", F.lit(0.0)).otherwise(_contribution(count(at(F.lit(1), F.lit(window)), ch))))
    begin = F.struct(first.alias("sum"), first.alias("least"))

    def step(acc: Column, i: Column) -> Column:
        out, into, middle = at(i, F.lit(1)), at(i + window, F.lit(1)), at(i + 1, F.lit(window - 1))
        left, came = count(middle, out), count(middle, into)  # counts in what both windows share
        total = acc["sum"] - _contribution(left + 1) + _contribution(left) - _contribution(came) + _contribution(came + 1)
        return F.struct(total.alias("sum"), F.least(acc["least"], total).alias("least"))

    n = F.length(word) - window
    slides = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    least = F.aggregate(slides, begin, step, lambda acc: acc["least"])
    return F.when(n >= 0, F.lit(math.log2(window)) - least / window).otherwise(F.lit(0.0))


def _none() -> Column:
    return F.array().cast("array<struct<begin:int,word:string>>")


def find_secrets(docs: DataFrame, text_col: str = "text", entropy=ENTROPY, allow=ALLOW, out: str = "secret_spans") -> DataFrame:
    """Adds ``out``: array of (begin, end, rank, kind, base) sorted by begin, then kind.

    Places are code points, end exclusive. Base spans always stay; the entropy scan adds
    spans of its own kinds. NULL and empty texts have no spans. The input's other columns
    pass through; one named ``out`` is replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    cols = [c for c in docs.columns if c != out]
    spans = []
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        found = F.when(F.regexp_like(text, F.lit(HINT[kind])), _spans(text, LONG_ENOUGH.get(kind, pattern))).otherwise(_none())
        if group:
            found = F.filter(found, _long_enough(pattern, group, least))
        spans.append(F.transform(found, _span(rank, kind, True)))
    for rank, (kind, pattern, window, bits) in enumerate(entropy, len(BASE)):
        found = F.when(F.regexp_like(text, F.lit(pattern)), _spans(text, pattern)).otherwise(_none())
        spans.append(F.transform(F.filter(found, _random(allow, window, bits)), _span(rank, kind, False)))
    return docs.select(*cols, F.array_sort(F.concat(*spans)).alias(out))


def _long_enough(pattern: str, group: int, least: int):
    return lambda s: F.length(F.regexp_extract(s["word"], pattern, group)) >= least


def _random(allow, window: int, bits: float):
    allowed = "|".join(f"(?:{x})" for x in allow)
    own = lambda s: 2 * F.length(F.regexp_replace(s["word"], PLACEHOLDER, "")) > F.length(s["word"])
    return lambda s: (~F.regexp_like(s["word"], F.lit(allowed)) & own(s) if allowed else F.lit(True)) & (window_entropy(s["word"], window) >= bits)


def _span(rank: int, kind: str, base: bool):
    return lambda s: F.struct(s["begin"].alias("begin"), F.lit(rank).alias("rank"), (s["begin"] + F.length(s["word"])).alias("end"), F.lit(kind).alias("kind"), F.lit(base).alias("base"))


def render(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``mark`` (overlapping spans by one) and ``n_chars`` set anew; all rows stay, texts without spans as they are."""
    cols = docs.columns
    rows = find_secrets(docs, out="_secret_spans")
    # merged: spans in order of begin; one that starts inside the last extends it
    zero = F.struct(F.lit("").alias("done"), F.lit(0).alias("upto"))

    def step(acc: Column, s: Column) -> Column:
        inside = (s["begin"] < acc["upto"]) & (acc["upto"] > 0)
        between = F.substring(F.col("text"), acc["upto"] + 1, s["begin"] - acc["upto"])
        return F.struct(F.when(inside, acc["done"]).otherwise(F.concat(acc["done"], between, F.lit(mark))).alias("done"), F.greatest(acc["upto"], s["end"]).alias("upto"))

    whole = F.aggregate("_secret_spans", zero, step, lambda acc: F.concat(acc["done"], F.substring(F.col("text"), acc["upto"] + 1, F.length("text"))))
    rows = rows.withColumn("text", F.when(F.size("_secret_spans") > 0, whole).otherwise(F.col("text")))
    if "n_chars" in cols:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.size("_secret_spans") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.select(*cols)
