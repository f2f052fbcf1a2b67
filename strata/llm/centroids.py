"""Operator 12: centroid clustering with a vantage-point tree over the centroids.

Vectors become integers (floor of ``scale`` times each component), so distances, sums and
centroids are exact. Each round builds a vantage-point tree over the centroids, broadcasts
it, and searches it for every vector best-first: the node with the smallest lower bound is
opened next, its distance is taken in integers, and the search of a vector ends when every
bound left lies beyond its best distance. The radius is inclusive, so centroids as near as
the best are met and the smaller number wins.

All vectors of a batch take a step together, each with its own queue of nodes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize

BATCH = 4096  # vectors that are searched together
SMALL = 1 << 26  # components up to this have distances that fit 64 bits at up to 2**9 components
LONGEST = (1 << 63) - 1
LIMB = 32  # bits of a limb of a sum


@dataclass(frozen=True)
class Tree:
    """Node i is a centroid: its two children lie at distances ``near`` .. ``far`` (inclusive) from it; -1: no child."""

    number: np.ndarray  # the centroid's number
    point: np.ndarray  # its components: int64, or Python integers where they are large
    child: np.ndarray  # (nodes, 2)
    near: np.ndarray  # (nodes, 2)
    far: np.ndarray


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(axis=-1)


def root(squares: np.ndarray) -> np.ndarray:
    """Distances as floating numbers; infinite where one is beyond them."""
    if squares.dtype != object:
        return np.sqrt(squares.astype(np.float64))
    return np.array([math.sqrt(x) if x < 1 << 1000 else float(y) if (y := math.isqrt(x)) < 1 << 1023 else np.inf for x in map(int, squares)])


def build_tree(points: list[list[int]]) -> Tree:
    """Each node's vantage point is its lowest-numbered centroid; the others are halved by their distance from it."""
    big = any(abs(x) > SMALL for p in points for x in p)
    at = np.array(points, object if big else np.int64).reshape(len(points), -1)
    child, near, far = np.full((len(points), 2), -1), np.zeros((len(points), 2)), np.zeros((len(points), 2))
    todo = [(list(range(len(points))), -1, 0)]
    while todo:
        members, parent, side = todo.pop()
        top, rest = members[0], members[1:]
        if parent >= 0:
            child[parent, side] = top
            own = root(squared(at[members], at[parent]))
            near[parent, side], far[parent, side] = own.min(), own.max()
        if rest:
            away = root(squared(at[rest], at[top]))
            order = np.argsort(away, kind="stable")
            half = (len(rest) + 1) // 2
            todo += [(sorted(rest[i] for i in part), top, s) for s, part in enumerate((order[:half], order[half:])) if len(part)]
    return Tree(np.arange(len(points)), at, child, near, far)


def nearest(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each vector's nearest centroid; of equally near ones the smallest number.

    Exact: distances are integers; bounds are floating and widened by more than their error.
    """
    n, nodes = len(vectors), len(tree.number)
    if tree.point.dtype == object or vectors.dtype == object:
        point, vectors = tree.point.astype(object), vectors.astype(object)
    else:
        point = tree.point
    best, who = np.empty(n, vectors.dtype), np.full(n, nodes)
    bound = np.full((n, nodes), np.inf)  # of nodes in a vector's queue
    bound[:, 0] = 0
    radius = np.full(n, np.inf)
    open_ = np.arange(n)
    while len(open_):
        node = np.argmin(bound[open_], axis=1)
        low = bound[open_, node]
        going = (low <= radius[open_]) & (low < np.inf)  # inclusive
        open_, node, low = open_[going], node[going], low[going]
        if not len(open_):
            break
        bound[open_, node] = np.inf
        square = squared(vectors[open_], point[node])
        first = who[open_] == nodes
        better = first.copy()
        better[~first] = (square[~first] < best[open_[~first]]) | ((square[~first] == best[open_[~first]]) & (node[~first] < who[open_[~first]]))
        at = open_[better]
        best[at], who[at] = square[better], node[better]
        away = root(square)
        radius[at] = away[better] * (1 + 1e-9)
        for side in range(2):
            to = tree.child[node, side]
            has = to >= 0
            i, v = open_[has], node[has]
            d = away[has]
            far = tree.far[v, side]
            known = np.isfinite(d) & np.isfinite(far)  # else nothing is known of the child
            d, far = np.where(known, d, 0), np.where(known, far, 0)
            gap = np.where(known, np.maximum(tree.near[v, side] - d, d - far) - 1e-9 * (d + far), 0)
            bound[i, to[has]] = np.maximum(np.maximum(gap, low[has]), 0)
    return tree.number[who], best


def integers(lists: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component: int64, or Python integers where one is large."""
    x = np.asarray(lists.flatten(), np.float64).reshape(len(lists), dims)
    y = np.floor(x * scale)
    if not len(y) or np.abs(y).max() <= SMALL:
        return y.astype(np.int64)
    return np.array([[math.floor(Fraction(v) * scale) for v in row] for row in x.tolist()], object)


def limbs(x: int) -> list[int]:
    """Signed number as limbs of LIMB bits, the last one signed; limbs of many numbers can be summed in 64 bits."""
    out = []
    while not -(1 << (LIMB - 1)) <= x < 1 << (LIMB - 1):
        out.append(x & ((1 << LIMB) - 1))
        x >>= LIMB
    return [*out, x]


def usable(vectors: DataFrame, dims: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors with ``dims`` components, none NULL or non-finite."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))

    def finite(x: Column) -> Column:
        return F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False))

    return rows.where((F.size("embedding") == dims) & F.forall("embedding", finite))


def first_centroids(rows: DataFrame, k: int, seed: int, dims: int, scale: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``; NULL ids come last, equal ids by their components."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = rows.orderBy(named.asc_nulls_last(), "embedding").limit(k)  # k is a parameter
    return [integers(pa.array([r["embedding"]], pa.list_(pa.float64())), dims, scale)[0].tolist() for r in chosen.collect()]


def _searched(batches: Iterator[pa.RecordBatch], tree: Tree, dims: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH):
            batch = whole.slice(at, BATCH)
            v = integers(batch.column(batch.num_columns - 1), dims, scale)
            yield batch, v, *nearest(tree, v)


def moved(rows: DataFrame, points: list[list[int]], dims: int, scale: int) -> list[list[int]]:
    """The centroids after one round: floor of the mean of the vectors nearest to each; without vectors they stay.

    Every task sums its vectors first, so what is shuffled are a few numbers for each centroid and component.
    """
    tree = rows.sparkSession.sparkContext.broadcast(build_tree(points))  # k centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(points), np.int64), [[0] * dims for _ in points]
        for _, v, number, _ in _searched(batches, tree.value, dims, scale):
            for c in np.unique(number).tolist():
                own = v[number == c]
                count[c] += len(own)
                total[c] = [a + int(b) for a, b in zip(total[c], own.sum(axis=0).tolist(), strict=True)]
        out = [(c, -1, 0, int(count[c])) for c in range(len(points)) if count[c]]
        out += [(c, i, j, x) for c in range(len(points)) if count[c] for i, s in enumerate(total[c]) for j, x in enumerate(limbs(s))]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(col, pa.int64()) for col in zip(*out, strict=True)], names=["cluster", "part", "limb", "value"])

    parts = rows.select("embedding").mapInArrow(run, "cluster bigint, part bigint, limb bigint, value bigint")
    sums: dict[tuple[int, int], int] = {}
    for c, i, j, x in parts.groupBy("cluster", "part", "limb").agg(F.sum("value")).collect():  # k * (dims + 1) numbers
        sums[c, i] = sums.get((c, i), 0) + (x << LIMB * j)
    tree.unpersist()
    return [[sums[c, i] // sums[c, -1] for i in range(dims)] if (c, -1) in sums else p for c, p in enumerate(points)]


def assign(rows: DataFrame, points: list[list[int]], dims: int, scale: int) -> DataFrame:
    """vec_id, cluster, distance of every row; a distance beyond BIGINT reads as its largest value."""
    tree = rows.sparkSession.sparkContext.broadcast(build_tree(points))
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, number, square in _searched(batches, tree.value, dims, scale):
            far = square if square.dtype != object else [min(int(d), LONGEST) for d in square]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, pa.int64()), pa.array(far, pa.int64())], names=["vec_id", "cluster", "distance"])

    return rows.select("vec_id", "embedding").mapInArrow(run, f"vec_id {kind}, cluster bigint, distance bigint")


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance of every usable vector; the final centroids).

    The usable vectors are written once and read in every round; a lost executor costs its tasks of one round.
    """
    rows = materialize(usable(vectors, dims, id_col, vector_col), "cluster_vectors")
    points = first_centroids(rows, k, seed, dims, scale)
    for _ in range(rounds if points else 0):
        points = moved(rows, points, dims, scale)
    if not points:  # no usable vector
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("cluster"), F.lit(0).cast("bigint").alias("distance")), points
    return assign(rows, points, dims, scale), points


def clustered(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Vectors that are NULL, of another length, or hold NULL or non-finite components have no
    row. Fewer than ``k`` usable vectors give as many centroids; equal centroids may stand
    side by side, then the smaller number gets all. Repeated rows and NULL ids are vectors
    like any other (NULL ids start no centroid while others can); an empty table gives an empty
    result; further columns are ignored, whatever their names. Distances and sums beyond
    BIGINT read as its largest value.
    """
    found, points = cluster(vectors, k, rounds, dims, scale, seed, id_col, vector_col)
    found = materialize(found, "clusters")
    spark = found.sparkSession
    sums = {r[0]: int(r[1]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}  # k rows at most
    total = min(sum(sums.values()), LONGEST)
    sha = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    known = spark.createDataFrame([(c, min(s, LONGEST), total, sha[c]) for c, s in sums.items()], "cluster bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows


def oracle_sql(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2) -> str:
    """The same in DuckDB SQL: every centroid against every vector, one pair of CTEs a round."""
    parts = [
        f"""kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = {dims}
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c, v AS p FROM kept ORDER BY sha256('{seed}:' || vec_id) LIMIT {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (
            SELECT r, c, d FROM (
              SELECT k.r, t.c, list_sum(list_transform(list_zip(k.v, t.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
              FROM kept AS k CROSS JOIN c{i} AS t)
            QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
        )
        if i < rounds:
            parts.append(
                f"""m{i} AS (
            SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (
              SELECT a.c, unnest(k.v) AS x, unnest(range({dims})) AS i FROM a{i} AS a JOIN kept AS k USING (r))
            GROUP BY c, i),
          c{i + 1} AS MATERIALIZED (
            SELECT t.c, coalesce(m.p, t.p) AS p FROM c{i} AS t LEFT JOIN (
              SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS p FROM m{i} GROUP BY c) AS m USING (c))"""
            )
    last = f"a{rounds}"
    return f"""WITH {', '.join(parts)},
          sums AS (SELECT c, sum(d)::BIGINT AS s FROM {last} GROUP BY c)
        SELECT k.vec_id, a.c::BIGINT AS cluster, a.d AS distance, sums.s AS cluster_inertia,
               (SELECT sum(d)::BIGINT FROM {last}) AS inertia, sha256(array_to_string(t.p, ',')) AS centroid_sha256
        FROM {last} AS a JOIN kept AS k USING (r) JOIN c{rounds} AS t USING (c) JOIN sums USING (c)"""


__all__ = ["assign", "build_tree", "cluster", "clustered", "first_centroids", "moved", "nearest", "oracle_sql"]
