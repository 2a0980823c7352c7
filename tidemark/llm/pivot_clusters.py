"""Centroid clustering of integer vectors with a pivot table.

Vectors are integers, so distances and centroids are exact and no result depends on the order of rows.
The distances of every vector to a few fixed pivots are stored once. In each round the driver finds the
pivots' distances to the centroids; by the triangle inequality the largest difference of the two bounds a
centroid's distance to a vector from below. The centroid with the smallest bound is measured first, and then
only those whose bound does not lie above that distance. Everything that is measured is measured in integers.

A round reads the stored table and sends one row per task and cluster; the driver gets centroids only.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, query, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMENSIONS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
PIVOTS = 12
SEED = 2
# Components are held to this size either way: squared distances then always fit in 64 bits.
LARGEST = 2**27
# Pairs of vector and centroid that are compared at once inside a task.
PAIRS = 1 << 16
# Distances are rounded roots of whole numbers. Bounds give way by more than their error, so that no tie is cut off.
SLACK = 1e-12


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v)`` of the rows whose ``embedding`` has that many components, none null, NaN or infinite.

    A component becomes ``floor(scale * x)``; beyond 2^27 in size it counts as 2^27 of its sign. Rows
    with null or equal ids are vectors like any other; other columns are not read.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))

    def whole(c):
        large = F.abs(c) * scale >= LARGEST
        return F.when(large, F.signum(c) * LARGEST).otherwise(F.floor(c * scale)).cast("int")

    return vectors.where((F.size(x) == dimensions) & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, whole).alias("v")
    )


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest hash of seed and id, in its order; equal ids by components, null ids last."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(mark.asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], np.int64)


def far_apart(points: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Pivots: of the points one after the other the one farthest from those taken; the first starts."""
    taken, nearest = [0], squared(points, points[0])
    while len(taken) < min(n, len(points)) and nearest.max() > 0:
        taken.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(points, points[taken[-1]]))
    return points[taken]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    difference = a - b
    return np.einsum("...i,...i->...", difference, difference)


@dataclass
class Nearest:
    """Nearest centroid of vectors, by bounds from their pivot distances; counts the distances it measures."""

    pivots: np.ndarray
    centroids: np.ndarray

    def __post_init__(self):
        self.to_pivots = np.sqrt(squared(self.centroids[:, None], self.pivots[None]).astype(float))
        self.measured = 0

    def of(self, v: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to the nearest centroid, of equally near ones the smallest number."""
        k = len(self.centroids)
        cluster, distance = np.empty(len(v), np.int64), np.empty(len(v), np.int64)
        for at in range(0, len(v), max(1, PAIRS // k)):
            rows = slice(at, at + max(1, PAIRS // k))
            cluster[rows], distance[rows] = self._block(v[rows], table[rows])
        return cluster, distance

    def _block(self, v: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bound = np.zeros((len(v), len(self.centroids)))
        for p in range(len(self.pivots)):
            own, theirs = table[:, p, None], self.to_pivots[:, p]
            np.maximum(bound, np.abs(own - theirs) - SLACK * (own + theirs), out=bound)
        first = bound.argmin(1)
        known = squared(v, self.centroids[first])
        rows, which = np.nonzero(bound <= np.sqrt(known.astype(float))[:, None] * (1 + SLACK))
        exact = np.full(bound.shape, np.iinfo(np.int64).max)
        exact[rows, which] = squared(v[rows], self.centroids[which])
        self.measured += len(rows)
        cluster = exact.argmin(1)
        return cluster, exact[np.arange(len(v)), cluster]


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The vectors with ``to_pivots``, their distances to the pivots, written once."""
    width = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1), width, np.int64)
            far = np.sqrt(np.stack([squared(v, p) for p in pivots], 1).astype(float))
            far = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * len(pivots), pa.int32()), pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, far], ["vec_id", "v", "to_pivots"])

    return materialise(vectors.mapInArrow(run, "vec_id long, v array<int>, to_pivots array<double>"), "pivots")


def next_centroids(rows: DataFrame, nearest: Nearest) -> np.ndarray:
    """Each centroid's vectors' mean, rounded down; a centroid without vectors stays.

    Tasks add up their own vectors, Spark the tasks' sums.
    """
    k, width = nearest.centroids.shape
    p = len(nearest.pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            v = _matrix(batch.column(0), width, np.int64)
            cluster, _ = nearest.of(v, _matrix(batch.column(1), p, float))
            n += np.bincount(cluster, minlength=k)
            np.add.at(sums, cluster, v)
        some = np.flatnonzero(n)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * width, pa.int32()), pa.array(sums[some].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), lists], ["cluster", "n", "sums"])

    parts = rows.select("v", "to_pivots").mapInArrow(run, "cluster long, n long, sums array<long>")
    total = parts.select("cluster", "n", F.posexplode("sums").alias("i", "s")).groupBy("cluster", "i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")
    )
    centroids = nearest.centroids.copy()
    for r in total.collect():
        centroids[r["cluster"], r["i"]] = int(r["s"]) // r["n"]
    return centroids


def assign(rows: DataFrame, nearest: Nearest) -> DataFrame:
    """``(vec_id, cluster, distance)`` with squared distances."""
    width, p = nearest.centroids.shape[1], len(nearest.pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1), width, np.int64)
            cluster, distance = nearest.of(v, _matrix(batch.column(2), p, float))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"]
            )

    return rows.select("vec_id", "v", "to_pivots").mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster_vectors(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, pivots: int = PIVOTS, seed: int = SEED
) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance)`` of integer vectors after some rounds, and the centroids.

    With fewer vectors than clusters each starts one; without any the result is empty.
    """
    centroids = first_centroids(vectors, clusters, seed)
    if not len(centroids):
        empty = vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty, np.empty((0, 0), np.int64)
    fixed = far_apart(centroids, pivots)
    rows = pivot_table(vectors, fixed)
    for _ in range(rounds):
        centroids = next_centroids(rows, Nearest(fixed, centroids))
    return assign(rows, Nearest(fixed, centroids)), centroids


# Rounds written out one by one: SQL has no loop over grouped steps.
def _sql(rounds: int) -> str:
    steps, scored = [], """
        select v.row_no, c.cluster,
               list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as distance
        from vectors v cross join c{i} c"""
    best = "select row_no, arg_min(cluster, (distance, cluster)) as cluster, min(distance) as distance from ({scored}) group by row_no"
    for i in range(rounds):
        near = best.format(scored=scored.format(i=i))
        steps.append(f"""
    near{i} as materialized ({near}),
    sums{i} as (
        select cluster, pos, sum(x)::hugeint as s, count(*)::hugeint as n
        from (select cluster, unnest(v) as x, unnest(range(1, {DIMENSIONS + 1})) as pos from near{i} join vectors using (row_no))
        group by cluster, pos),
    c{i + 1} as materialized (
        select c.cluster, coalesce(m.v, c.v) as v from c{i} c left join (
            select cluster, list((((s - ((s % n + n) % n)) // n))::bigint order by pos) as v from sums{i} group by cluster
        ) m using (cluster)),""")
    last = best.format(scored=scored.format(i=rounds))
    return f"""
with kept as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
    from embeddings
    where len(embedding) = {DIMENSIONS} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {DIMENSIONS}),
    vectors as materialized (select row_number() over (order by sha256('{SEED}:' || vec_id) nulls last, v) - 1 as row_no, vec_id, v from kept),
    c0 as materialized (select row_no as cluster, v from vectors where row_no < {CLUSTERS}),{"".join(steps)}
    nearest as materialized ({last})
select vec_id, cluster::int as cluster, distance,
       sum(distance) over (partition by cluster)::bigint as cluster_inertia,
       sum(distance) over ()::bigint as inertia,
       sha256(array_to_string(c.v, ',')) as centroid_sha256
from nearest join vectors using (row_no) join c{rounds} c using (cluster)
"""


@query("op12_pivot_clusters", _sql(ROUNDS))
def op12_pivot_clusters(spark, sf_dir):
    """All vectors of 64 finite components in 40 clusters after five rounds."""
    found, centroids = cluster_vectors(integer_vectors(table(spark, sf_dir, "embeddings")))
    found = materialise(found, "clusters")
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    facts = [
        (i, sums.get(i, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(centroids.tolist())
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # One row per centroid: forty at most.
    return found.join(F.broadcast(spark.createDataFrame(facts, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
