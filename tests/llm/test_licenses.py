from __future__ import annotations

import re
from collections import Counter

import duckdb

import scripts.check_oracle as check
from strata.llm import licenses as L
from strata.llm import queries as Q
from tests.llm.conftest import SF001


def test_query_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    df = Q.op2_licenses(spark, SF001)
    res = con.execute(L.oracle_sql())
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(cols) == sorted(df.columns)
    assert check.digest(df.columns, [tuple(r) for r in df.collect()])[0] == check.digest(cols, want)[0]
    assert any(r[1] for r in want)


def brute(text, templates=L.TEMPLATES, threshold=L.THRESHOLD):
    def bag(unit):
        w = unit.split(" ") if unit else []
        return Counter(zip(w, w[1:], strict=False))

    def normal(t):
        return re.sub(r"[^\w\n]+|_", " ", t.lower())

    lines = normal(text or "").split("\n")
    units = [x.strip(" ") for x in lines] + ([" ".join(lines)] if len(lines) > 1 else [])
    units = [re.sub(" +", " ", u).strip() for u in units]
    found = []
    for u in units:
        a = bag(u)
        dice = [(2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values())), name) for name, t in templates for b in [bag(re.sub(" +", " ", normal(t)).strip())] if a]
        found.append([x for x in dice if x[0] >= threshold])
    hits = [x for f in found for x in f]
    return sum(map(bool, found)), sorted({n for _, n in hits}), max((d for d, _ in hits), default=None)


def test_defined_cases(docs_of):
    mit = "Released under the MIT License."
    texts = [None, "", "word", mit, mit.upper() + "\n\nother line here\n" + mit, "Released under the new MIT License", "Licensed under\nCC BY-NC 4.0.", "rights reserved all rights reserved all rights", "x y " * 50000 + "\n" + mit, "Licensed under CC BY 4.0. Licensed under CC BY 4.0."]
    rows = [*enumerate(texts), (None, mit), (3, mit)]
    got = L.find_licenses(docs_of(rows, clashing=True)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: (r["n_units"], r["licenses"], r["best_dice"]) for r in got}
    for i, t in rows:
        assert by[i] == brute(t), t
    assert L.find_licenses(docs_of([])).collect() == []
    assert all(r["n_units"] == 0 for r in L.find_licenses(docs_of(rows), templates=()).collect())


def brute_runs(text, threshold=L.THRESHOLD):
    """Licences of any run of words that reaches the threshold, and the best Dice: every begin and end."""
    words = re.sub(r"[\W_]+", " ", (text or "").lower()).split()
    pairs, best = [*zip(words, words[1:], strict=False)], {}
    for name, t in L.RUNS:
        w = re.sub(r"[\W_]+", " ", t.lower()).split()
        want = Counter(zip(w, w[1:], strict=False))
        size = sum(want.values())
        for i in range(len(pairs)):
            own, shared = Counter(), 0
            for n, p in enumerate(pairs[i : i + int(size * (2 - threshold) / threshold + 1e-9)], 1):
                own[p] += 1
                shared += own[p] <= want[p]
                dice = 2 * shared / (n + size)
                if dice >= threshold - 1e-12:
                    best[name] = max(best.get(name, 0), dice)
    return sorted(best), max(best.values(), default=None)


def test_notices_inside_and_across_lines(docs_of):
    mit, bsd = dict(L.TEXTS)["MIT"], dict(L.TEXTS)["BSD-3-Clause"]
    apache = "Licensed under the Apache License, Version 2.0"
    texts = [
        "Copyright (c) 2020 Acme Inc. All rights reserved.", "Licensed under the MIT license.", apache + ' (the "License"); you may not use this file except in compliance with the License.',
        "This is a long paragraph about something else. " * 3 + apache + ". And it goes on and on after that, with other words.", mit, "// file\n" + mit.replace(". ", ".\n") + "\n" + "code and more code here\n" * 40,
        "x = 1\n" * 30 + "# " + "\n# ".join(bsd.split(", ")) + "\ny = 2", "# Licensed under the\n# Apache License,\n# Version 2.0 " + "and other words " * 9, "Licensed under CC BY 4.0. Licensed under CC BY 4.0.",
        "plain words of no licence at all, all of the software and the license", None, "", "All rights", "All rights are reserved by all rights",
    ]
    got = {r["doc_id"]: r for r in L.find_licenses(docs_of([*enumerate(texts)], clashing=True), runs=L.RUNS).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        licenses, dice = brute_runs(t)
        assert (got[i]["licenses"], got[i]["best_dice"]) == (licenses, dice), t
    assert all(got[i]["n_units"] >= 1 for i in range(9)) and not any(got[i]["n_units"] for i in range(9, 14))
    assert got[8]["n_units"] == 2 and got[0]["licenses"] == ["proprietary"] and "MIT" in got[5]["licenses"] and "BSD-3-Clause" in got[6]["licenses"]


def test_runs_leave_matching_lines_as_they_are(docs_of):
    """What a line or the whole text matches is counted once, with its own Dice; a notice inside another line is added."""
    line, inner = "word Released under the MIT License.", "see the file (Copyright Acme, All rights reserved) for more"
    texts = [line, f"{line}\n{inner}", f"{inner}\n{inner}\nother"]
    plain = {r[0]: r for r in L.find_licenses(docs_of([*enumerate(texts)])).collect()}
    got = {r[0]: r for r in L.find_licenses(docs_of([*enumerate(texts)]), runs=L.RUNS).collect()}
    assert got[0] == plain[0] and plain[0]["n_units"] == 1
    assert (got[1]["n_units"], got[1]["licenses"]) == (2, ["MIT", "proprietary"])
    assert (got[2]["n_units"], got[2]["licenses"], plain[2]["n_units"]) == (2, ["proprietary"], 0)
