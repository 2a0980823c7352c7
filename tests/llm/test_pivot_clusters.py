"""Clusters against plain integers, and bounds that never cut off the nearest centroid."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import pivot_clusters as pc
from tidemark.llm.catalog import QUERIES


def brute(rows):
    """All of op12 with Python's integers."""
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == 64 and all(c is not None and math.isfinite(c) for c in x):
            kept.append((vec_id, [max(-pc.LARGEST, min(pc.LARGEST, math.floor(256 * c))) for c in x]))
    mark = lambda i: (i is None, "" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest())
    centroids = [v for _, v in sorted(kept, key=lambda r: (mark(r[0]), r[1]))[:40]]
    square = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    for k in range(6):
        near = [min((square(v, c), i) for i, c in enumerate(centroids)) for _, v in kept]
        if k == 5:
            break
        for i in range(len(centroids)):
            own = [v for (_, v), (_, j) in zip(kept, near) if i == j]
            if own:
                centroids[i] = [sum(c) // len(own) for c in zip(*own)]
    inertia = [sum(d for d, j in near if j == i) for i in range(len(centroids))]
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((-1 if i is None else i), j, d, inertia[j], sum(inertia), marks[j]) for (i, _), (d, j) in zip(kept, near)
    )


def found(df):
    rows = df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    return sorted(((-1 if r[0] is None else r[0]), *r[1:]) for r in rows)


@pytest.mark.parametrize("folder", ["given", "edges"])
def test_query(spark, edge_dir, folder):
    path = "/root/testdata/sf0.001" if folder == "given" else edge_dir
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert found(QUERIES["op12_pivot_clusters"](spark, path)) == brute(rows)


@pytest.mark.parametrize("n", [1, 39, 41])
def test_few_vectors(spark, tmp_path, n):
    rng = np.random.default_rng(n)
    rows = [(i, rng.normal(0, 0.01, 64).tolist()) for i in range(n)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert found(QUERIES["op12_pivot_clusters"](spark, str(tmp_path))) == brute(rows)


def test_ties_go_to_the_smaller_number(spark, tmp_path):
    # On a coarse grid most vectors are equally near to several centroids.
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(0, 2, 64) * (np.arange(64) < 5) / 256).tolist()) for i in range(300)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert found(QUERIES["op12_pivot_clusters"](spark, str(tmp_path))) == brute(rows)


@pytest.mark.parametrize("scale", [1, 300, pc.LARGEST])
def test_bounds_cut_off_no_nearest_centroid(scale):
    rng = np.random.default_rng(scale)
    points = rng.integers(-scale, scale + 1, (40, 64))
    v = np.concatenate([rng.integers(-scale, scale + 1, (500, 64)), (points[:20] + points[20:]) // 2, points])
    pivots = pc.far_apart(points)
    near = pc.Nearest(pivots, points)
    cluster, distance = near.of(v, np.sqrt(np.stack([pc.squared(v, p) for p in pivots], 1).astype(float)))
    every = pc.squared(v[:, None], points[None])
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_bounds_save_distances():
    rng = np.random.default_rng(9)
    centres = rng.integers(-3000, 3000, (40, 64))
    v = (centres[:, None] + rng.integers(-200, 200, (40, 50, 64))).reshape(-1, 64)
    pivots = pc.far_apart(centres)
    near = pc.Nearest(pivots, centres)
    near.of(v, np.sqrt(np.stack([pc.squared(v, p) for p in pivots], 1).astype(float)))
    assert near.measured < 0.2 * len(v) * 40


def test_extra_columns(spark):
    rows = [(i, [float(i % 7)] * 64) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    plain, _ = pc.cluster_vectors(pc.integer_vectors(df))
    clash, _ = pc.cluster_vectors(pc.integer_vectors(df.withColumns({c: F.lit("x") for c in ("v", "cluster", "to_pivots", "n")})))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, clash.collect()))
