"""Clusters against plain k-means on whole numbers, and edge rows."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from notemill.llm import centroids, queries


def plainly(rows, k, rounds, dim):
    """The same by definition, in Python's integers: (vec_id, cluster, distance, cluster_inertia, inertia, digest)."""
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    now = [v for _, v in order[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((far(v, c), j) for j, c in enumerate(now))
    for _ in range(rounds):
        members = [[] for _ in now]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        now = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, now)]
    found = [(i, *nearest(v)) for i, v in kept]
    own = [sum(d for _, d, j in found if j == c) for c in range(len(now))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return sorted(((i, j, d, own[j], sum(own), digests[j]) for i, d, j in found), key=repr)


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, "x", 3) for i, v in rows], "vec_id long, embedding array<double>, x string, cluster int").repartition(4)


def found(frame):
    return sorted(map(tuple, frame.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def near_groups(seed, count, dim, groups, width):
    rng = np.random.default_rng(seed)
    middle = rng.uniform(-1, 1, (groups, dim))
    return [(i, (middle[rng.integers(groups)] + rng.normal(0, width, dim)).tolist()) for i in range(count)]


@pytest.mark.parametrize("seed, width, dim, k", [(1, 0.02, 6, 5), (2, 0.3, 3, 12), (3, 1.0, 8, 20), (4, 0.001, 2, 9)])
def test_equals_plain_rounds(spark, seed, width, dim, k):
    rows = near_groups(seed, 400, dim, k, width)
    assert found(centroids.clusters(table_of(spark, rows), k, 5, dim)) == plainly(rows, k, 5, dim)


def test_bounds_spare_most_of_the_measuring(spark):
    """Far groups: later rounds measure few vectors against all centroids (two of the first ones share a group)."""
    rows = near_groups(7, 600, 8, 6, 0.01)
    vectors = centroids.whole_vectors(table_of(spark, rows), 8)
    history = [centroids.first_centroids(vectors, 6, F.sha2(F.col("vec_id").cast("string"), 256))]
    state, sums, stamps = vectors, centroids.Sums(6, 8), []
    for i in range(6):
        step = centroids._next if i else centroids._first
        state = centroids.materialise(state.mapInArrow(step(spark.sparkContext.broadcast(history)), centroids.STATE))
        sums.follow(state)
        history.append(sums.means(history[-1]))
        stamps.append(state.filter(F.col("stamp") == i).count())
    assert stamps[0] == 600 and stamps[-1] < 150


def test_a_bound_is_loosened_by_the_whole_displacement():
    """A centroid that went away and came back loosens nothing."""
    there, away = np.array([[0, 0], [100, 0]]), np.array([[0, 0], [0, 900]])
    assert centroids.displacements([there, away, there]).tolist() == [[0, 0], [0, 906], [0, 0]]


def test_edge_rows_ties_and_copies(spark):
    rng = random.Random(3)
    same = [0.5, -0.25, 0.125]
    rows = [(i, same) for i in range(60)] + [(i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(3)]) for i in range(50, 150)]
    rows += [(None, same), (None, [1.0, 1.0, 1.0]), (200, None), (201, []), (202, [1.0, 2.0]), (203, [1.0, None, 2.0]),
             (204, [1.0, float("nan"), 2.0]), (205, [float("inf"), 0.0, 0.0]), (206, [0.0, 0.0, 0.0]), (207, [-1e-9, 1e5, 7e4])]
    assert found(centroids.clusters(table_of(spark, rows), 7, 5, 3)) == plainly(rows, 7, 5, 3)
    assert found(centroids.clusters(table_of(spark, rows[:3]), 7, 5, 3)) == plainly(rows[:3], 7, 5, 3)
    assert found(centroids.clusters(table_of(spark, rows), 7, 0, 3)) == plainly(rows, 7, 0, 3)


def test_beyond_long_does_not_crash(spark):
    rows = [(i, [1e300 * (-1) ** i, float(i)]) for i in range(8)]
    out = centroids.clusters(table_of(spark, rows), 3, 2, 2).collect()
    assert len(out) == 8 and max(r["inertia"] for r in out) <= 2**63 - 1


def test_query_and_empty_table(spark, tmp_path):
    rows = near_groups(5, 120, 64, 50, 0.2) + [(500, [0.5] * 63), (501, None)]
    table_of(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert found(queries.op12_centroids(spark, str(tmp_path))) == plainly(rows, 40, 5, 64)
    table_of(spark, rows[-2:]).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert queries.op12_centroids(spark, f"{tmp_path}/none").collect() == []


def test_no_vector_is_whole(spark):
    """Without a vector that takes part there are no rows, but all columns."""
    for rows in ([], [(1, None), (2, [0.5]), (3, [0.5, float("nan")]), (4, [0.5, None])]):
        out = centroids.clusters(table_of(spark, rows), 3, 2, 2)
        assert out.collect() == []
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert centroids.clusters(table_of(spark, [(5, [0.5, 0.25])]), 3, 2, 2).count() == 1
