from __future__ import annotations

import hashlib
import math
import random
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import centroids as C
from strata.llm import queries as Q
from tests.llm.conftest import SF001


def plain(rows, k, rounds, dims, scale=256, seed=2):
    """Every vector against every centroid, in Python integers."""
    ok = [(i, [math.floor(Fraction(x) * scale) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    raw = {id(v): v for _, v in ok}
    named = sorted(ok, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), raw[id(r[1])]))
    points = [v for _, v in named[:k]]
    for _ in range(rounds):
        own = [[] for _ in points]
        for _, v in ok:
            own[min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), c) for c, p in enumerate(points))[1]].append(v)
        points = [[sum(x) // len(o) for x in zip(*o, strict=True)] if o else p for o, p in zip(own, points, strict=True)]
    out = []
    for i, v in ok:
        d, c = min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), c) for c, p in enumerate(points))
        out.append((i, c, min(d, C.LONGEST)))
    sums = {}
    for _, c, d in out:
        sums[c] = sums.get(c, 0) + d
    total = min(sum(sums.values()), C.LONGEST)
    sha = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted(((i, c, d, min(sums[c], C.LONGEST), total, sha[c]) for i, c, d in out), key=repr)


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")


def result(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def test_query_on_the_small_tables(spark):
    got = result(Q.op12_centroids(spark, SF001))
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    assert got == plain(rows, 40, 5, 64)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF001}/embeddings.parquet')")
    assert got == sorted(con.execute(C.oracle_sql()).fetchall(), key=repr)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(200)]
    rows += [(None, None), (1, None), (2, []), (3, [0.1, 0.2]), (4, [0.1, None, 0.2]), (5, [nan, 0.0, 0.0]), (6, [inf, 0.0, 0.0]), (7, [0.0, -inf, 0.0])]
    rows += [(None, [0.5, 0.25, -0.125]), (9, [0.0, 0.0, 0.0]), (9, [0.0, 0.0, 0.0]), (9, [1.0, 1.0, -1.0]), (10, [0.1, 0.2, 0.3, 0.4])]
    clash = vectors(spark, rows, "double").withColumns({c: F.lit("x") for c in ["cluster", "distance", "label", "part", "inertia"]})
    assert result(C.clustered(clash, k=7, rounds=3, dims=3)) == plain(rows, 7, 3, 3)


def test_ties_and_equal_centroids(spark):
    rows = [(i, [float(i % 3), 0.0]) for i in range(60)] + [(100 + i, [0.5, float(i % 2) - 0.5]) for i in range(20)]
    assert result(C.clustered(vectors(spark, rows), k=12, rounds=4, dims=2)) == plain(rows, 12, 4, 2)
    same = [(i, [0.25, -0.75]) for i in range(30)]
    assert result(C.clustered(vectors(spark, same), k=5, rounds=2, dims=2)) == plain(same, 5, 2, 2)


def test_very_large_components_stay_exact(spark):
    rows = [(i, [1e6 * i + 0.5, -3e5 * i]) for i in range(20)] + [(50, [1e300, 0.0]), (51, [-1e300, 1e307]), (52, [3e10, 1e12]), (53, [1.0, 2.0])]
    assert result(C.clustered(vectors(spark, rows, "double"), k=4, rounds=3, dims=2)) == plain(rows, 4, 3, 2)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (2, [0.25, 0.5])]])
def test_few_or_no_vectors(spark, rows):
    assert result(C.clustered(vectors(spark, rows), k=40, rounds=2, dims=2)) == plain(rows, 40, 2, 2)


def test_search_against_all_centroids():
    rng = np.random.default_rng(4)
    for k, dims, span in ((1, 1, 3), (2, 1, 2), (40, 2, 5), (40, 64, 100), (97, 5, 4), (60, 3, 1)):
        points = rng.integers(-span, span + 1, (k, dims))
        v = rng.integers(-span, span + 1, (500, dims))
        who, far = C.nearest(C.build_tree(points.tolist()), v)
        all_ = ((v[:, None] - points[None]) ** 2).sum(axis=2)
        assert who.tolist() == all_.argmin(axis=1).tolist() and far.tolist() == all_.min(axis=1).tolist()


def test_limbs_add_up():
    rng = random.Random(3)
    for _ in range(500):
        x = [rng.randint(-(2**b), 2**b) for b in rng.choices([1, 31, 32, 33, 63, 64, 200], k=4)]
        sums: dict[int, int] = {}
        for v in x:
            for j, part in enumerate(C.limbs(v)):
                assert -(2**63) <= part < 2**63
                sums[j] = sums.get(j, 0) + part
        assert sum(s << C.LIMB * j for j, s in sums.items()) == sum(x)
