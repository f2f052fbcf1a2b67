"""Operator 2: licence scans (DataFrame functions only).

Units of a text (its lines, and the text as a whole) and licence templates are
normalised to words; both are bags of word bigrams (the k-th occurrence meets the k-th).
A unit is a licence when its Dice coefficient 2|A∩B| / (|A| + |B|) with a template reaches
the threshold t, which bounds the sizes: t / (2 - t) <= |A| / |B| <= (2 - t) / t. A bag's size
is the number of words less one, so units outside the bounds of every template go before
any bigram is built, and the others only meet templates inside them.

Runs of consecutive words are units too where ``runs`` names templates for them: notices
inside a line or across lines. A run may begin and end at any bigram it shares with the
template, within the size bounds, so a matching run holds t / (2 - t) of the template's
bigrams at least. Hence only texts with one of a few anchor words can have one, and only
texts that hold that many of a template's bigrams are searched for its runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.license_texts import TEXTS

# Customary notices of common licences (licence, notice).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "All rights reserved."),
)
# Sought as runs: the notices above, whole texts, header variants, and the titles and openings of long licences.
RUNS = (
    *TEMPLATES,
    *TEXTS,
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
)
THRESHOLD = 0.8
SEPARATORS = r"[^\p{L}\p{N}\n]+"


def _normal(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), SEPARATORS, " ")


def _bigram_rows(units: DataFrame, words: str) -> DataFrame:
    """A row for each bigram of the unit's ``words``; one row (NULL) for NULL words. Where ``_l`` has each word's line, with its place ``_at``."""
    each = units.select("*", F.posexplode_outer(words).alias("_i", "_x"))
    each = each.withColumn("bigram", F.concat(F.col("_x"), F.lit(" "), F.get(words, F.col("_i") + 1)))
    if "_l" in units.columns:
        line = lambda i: F.get("_l", i)
        each = each.withColumn("_at", F.when(F.col("_l").isNotNull(), F.struct(F.col("_i").alias("pos"), line(F.col("_i")).alias("line"), line(F.col("_i") + 1).alias("line2"))))
    return each.where(F.col("bigram").isNotNull() | F.col("_i").isNull()).drop("_i", "_x", "_l", words)


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(template, license, size, bigram, times): each template's bag of bigrams."""
    rows = spark.createDataFrame([(i, a, t) for i, (a, t) in enumerate(templates)], "template int, license string, text string")
    rows = rows.select("template", "license", F.split(F.trim(F.regexp_replace(_normal(F.col("text")), "\n", " ")), " +").alias("words"))
    rows = rows.withColumn("size", F.size("words") - 1).where("size > 0")
    return _bigram_rows(rows, "words").groupBy("template", "license", "size", "bigram").agg(F.count(F.lit(1)).alias("times"))


def anchor_words(bags: dict[int, dict[str, int]], share: float) -> list[str]:
    """Words of which every run that holds ``share`` of a template's bigrams has one: the bigrams without any are fewer. Long words first."""
    chosen: set[str] = set()
    for bag in bags.values():
        while sum(n for g, n in bag.items() if not chosen & set(g.split(" "))) >= share * sum(bag.values()) - 1e-9:
            chosen.add(max((w for g in bag for w in g.split(" ") if w not in chosen), key=lambda w: (len(w), w)))
    return sorted(chosen)


def _runs(found: Column, size: Column, threshold: float, most: float) -> Column:
    """The best run from each shared bigram on, where it reaches the threshold: structs (begin, end, line, line2, dice), by begin.

    ``found`` holds a struct (times, at) for each shared bigram, ``at`` its places (pos, line, line2).
    An occurrence adds to a run unless the template's ``times`` are already in it.
    """
    prev = lambda x, at, k: F.when(k >= x["times"], F.get(at, k - x["times"])["pos"]).otherwise(F.lit(-1))
    places = lambda x: F.transform(F.array_sort(x["at"]), lambda p, k: F.struct(p["pos"].alias("pos"), prev(x, F.array_sort(x["at"]), k).alias("prev"), p["line"].alias("line"), p["line2"].alias("line2")))
    hits = F.array_sort(F.flatten(F.transform(found, places)))
    longest = F.floor(size * most + 1e-9).cast("int")

    def from_here(hits: Column, h: Column, i: Column) -> Column:
        zero = F.struct(F.lit(0).alias("shared"), F.lit(-1.0).alias("dice"), h["pos"].alias("end"), h["line2"].alias("line2"))

        def step(acc: Column, x: Column) -> Column:
            n = x["pos"] - h["pos"] + 1
            shared = acc["shared"] + F.when(x["prev"] < h["pos"], 1).otherwise(0)
            dice = 2.0 * shared / (n + size)
            better = (n <= longest) & (dice > acc["dice"])
            return F.struct(shared.alias("shared"), F.when(better, dice).otherwise(acc["dice"]).alias("dice"), F.when(better, x["pos"]).otherwise(acc["end"]).alias("end"), F.when(better, x["line2"]).otherwise(acc["line2"]).alias("line2"))

        return F.aggregate(F.slice(hits, i + 1, longest), zero, step, lambda acc: F.struct(h["pos"].alias("begin"), acc["end"].alias("end"), h["line"].alias("line"), acc["line2"].alias("line2"), acc["dice"].alias("dice")))

    best = F.transform(F.array(hits), lambda a: F.transform(a, lambda h, i: from_here(a, h, i)))  # the hits are made once
    return F.filter(best[0], lambda r: r["dice"] >= threshold - 1e-12)


def _places(runs: Column) -> Column:
    """Number of places of ``runs`` (sorted by begin): of overlapping ones the best stands for all."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("end"), F.lit(-1.0).alias("dice"))

    def step(acc: Column, r: Column) -> Column:
        new = r["begin"] > acc["end"]
        take = new | (r["dice"] > acc["dice"])
        return F.struct((acc["n"] + new.cast("int")).alias("n"), F.when(take, r["end"]).otherwise(acc["end"]).alias("end"), F.when(take, r["dice"]).otherwise(acc["dice"]).alias("dice"))

    return F.aggregate(runs, zero, step, lambda acc: acc["n"])


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD, runs=()) -> DataFrame:
    """One row per row: doc_id, n_units, licenses (sorted), best_dice.

    ``n_units`` counts matching units: lines, the whole of a text of several lines, and, for
    the templates that ``runs`` names, places of matching runs of words that touch no matching
    line in texts that do not match as a whole. NULL, empty and one-word texts match nothing; repeated
    rows and rows without id each have their result; other columns are ignored; an empty
    table gives an empty result, and no templates give no matches.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    spark, no_words = docs.sparkSession, F.lit(None).cast("array<string>")
    whole_units = template_table(spark, templates).withColumn("run", F.lit(False))
    known = whole_units.unionByName(template_table(spark, runs).withColumn("run", F.lit(True))) if runs else whole_units
    sizes = [r[0] for r in whole_units.select("size").distinct().collect()]  # at most one number for each template
    least, most = threshold / (2 - threshold), (2 - threshold) / threshold
    lo, hi = (min(sizes) * least - 1e-9, max(sizes) * most + 1e-9) if sizes else (1.0, 0.0)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), _normal(F.coalesce(text_col, F.lit(""))).alias("_t"))
    # unit 0 stands for the document, 1 for its runs, 2 for the whole of texts of several lines; then its lines
    words_of = lambda u: F.split(F.trim(u), " +")
    whole = F.when(F.contains("_t", F.lit("\n")), F.split(F.regexp_replace("_t", r"^[ \n]+|[ \n]+$", ""), r"[ \n]+"))
    lines = F.split("_t", "\n")
    line_words = F.transform(lines, lambda u: F.when(F.trim(u) == "", F.array().cast("array<string>")).otherwise(words_of(u)))
    running, line_of = no_words, F.lit(None).cast("array<int>")
    if runs:
        bags: dict[int, dict[str, int]] = {}
        for r in known.where("run").collect():  # the templates' bigrams
            bags.setdefault(r["template"], {})[r["bigram"]] = r["times"]
        may = F.arrays_overlap(F.split(F.translate("_t", "\n", " "), " "), F.array(*map(F.lit, anchor_words(bags, least))))
        running, line_of = F.when(may, F.flatten(line_words)), F.when(may, F.flatten(F.transform(line_words, lambda w, i: F.array_repeat(i, F.size(w)))))
    units = F.concat(F.array(no_words, running, whole), F.transform(lines, words_of))
    each = rows.select("row", "doc_id", line_of.alias("_l"), F.posexplode_outer(units).alias("unit", "_w"))
    is_run = F.col("unit") == 1
    each = each.withColumn("_l", F.when(is_run, F.col("_l"))).withColumn("_n", F.size("_w") - 1)
    each = each.where((F.col("unit") == 0) | (is_run & (F.col("_n") >= 1)) | (~is_run & F.col("_n").between(lo, hi)))
    pairs = _bigram_rows(each, "_w")
    parts = known.withColumnRenamed("bigram", "_bigram")
    inside = (F.col("_n") >= F.col("size") * least - 1e-9) & (F.col("run") | (F.col("_n") <= F.col("size") * most + 1e-9)) & (F.col("run") == is_run)
    met = pairs.join(F.broadcast(parts), (F.col("bigram") == F.col("_bigram")) & inside, "left")  # templates are a parameter of known size
    met = met.where((F.col("unit") == 0) | F.col("template").isNotNull())
    unit = ["row", "doc_id", "unit", "_n", "template", "license", "size"]
    per = met.groupBy(*unit, "bigram", "times").agg(F.count(F.lit(1)).alias("own"), F.collect_list(F.when(is_run, F.col("_at"))).alias("at"))
    shared = per.groupBy(*unit).agg(F.sum(F.least("own", "times")).alias("shared"), F.collect_list(F.when(is_run, F.struct("times", "at"))).alias("found"))
    dice = 2.0 * F.col("shared") / (F.col("_n") + F.col("size"))
    shared = shared.where(~is_run | (F.col("shared") >= F.col("size") * least - 1e-9))
    found = shared.withColumn("dice", F.when(F.col("unit") > 1, dice)).where((F.col("unit") < 2) | (F.col("dice") >= threshold - 1e-12))
    hit = F.col("unit") > 1
    found = found.withColumn("runs", F.when(is_run, _runs(F.col("found"), F.col("size"), threshold, most)))
    out = found.groupBy("row", "doc_id").agg(
        F.collect_set(F.when(hit, F.col("unit"))).alias("units"), F.collect_set(F.when(hit, F.col("license"))).alias("licenses"), F.max("dice").alias("best_dice"),
        F.collect_list(F.when(is_run, F.struct("license", "runs"))).alias("runs"),
    )
    taken = lambda r: F.array_contains("units", F.lit(2)) | F.array_contains("units", r["line"] + 3) | F.array_contains("units", r["line2"] + 3)
    flat = F.flatten(F.transform("runs", lambda x: F.transform(F.filter(x["runs"], lambda r: ~taken(r)), lambda r: F.struct(r["begin"].alias("begin"), r["end"].alias("end"), r["dice"].alias("dice"), x["license"].alias("license")))))
    out = out.withColumn("runs", F.array_sort(flat))
    return out.select(
        "doc_id", (F.size("units") + _places(F.col("runs"))).cast("bigint").alias("n_units"), F.array_sort(F.array_union("licenses", F.transform("runs", lambda r: r["license"]))).alias("licenses"),
        F.greatest("best_dice", F.array_max(F.transform("runs", lambda r: r["dice"]))).alias("best_dice"),
    )


def oracle_sql() -> str:
    """The same in DuckDB SQL, over whole tables."""
    values = ", ".join("({}, '{}', '{}')".format(i, a, t.replace("'", "''")) for i, (a, t) in enumerate(TEMPLATES))
    grams = "unnest(w[1:len(w) - 1]) || ' ' || unnest(w[2:len(w)]) AS bigram"
    normal = r"regexp_replace(lower({}), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
    least, most = THRESHOLD / (2 - THRESHOLD), (2 - THRESHOLD) / THRESHOLD
    nth = "row_number() OVER (PARTITION BY {}, bigram) AS nth"
    return f"""
    WITH tw AS (SELECT template, license, string_split_regex(trim(replace({normal.format('text')}, chr(10), ' ')), ' +') AS w FROM (VALUES {values}) AS t(template, license, text)),
    tb AS (SELECT *, {nth.format('template')} FROM (SELECT template, license, len(w) - 1 AS size, {grams} FROM tw)),
    d AS (SELECT row_number() OVER () AS r, doc_id, {normal.format("coalesce(text, '')")} AS t FROM documents),
    u AS (SELECT r, unnest(list_concat(string_split(t, chr(10)), CASE WHEN contains(t, chr(10)) THEN [replace(t, chr(10), ' ')] ELSE [] END)) AS u FROM d),
    un AS (SELECT row_number() OVER () AS unit, r, string_split_regex(trim(u, ' '), ' +') AS w FROM u),
    g AS (SELECT *, {nth.format('unit')} FROM (SELECT unit, r, len(w) - 1 AS n, {grams} FROM un WHERE len(w) - 1 BETWEEN (SELECT min(size) * {least} - 1e-9 FROM tb) AND (SELECT max(size) * {most} + 1e-9 FROM tb))),
    m AS (SELECT unit, r, n, template, license, size, count(*) AS shared FROM g JOIN tb USING (bigram, nth) GROUP BY ALL),
    f AS (SELECT *, CAST(2.0 AS DOUBLE) * shared / (n + size) AS dice FROM m WHERE CAST(2.0 AS DOUBLE) * shared / (n + size) >= {THRESHOLD} - 1e-12)
    SELECT d.doc_id, count(DISTINCT f.unit) AS n_units, coalesce(string_agg(DISTINCT f.license, ',' ORDER BY f.license), '') AS licenses, max(f.dice) AS best_dice
    FROM d LEFT JOIN f USING (r) GROUP BY d.r, d.doc_id"""
