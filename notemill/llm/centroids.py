"""k-means on whole numbers with ns-bounds.

Every vector keeps a lower bound of its distance to each centroid, an upper bound of that to its own, and the round in
which these were measured. The centroids of all rounds are kept. A bound is loosened by how far its centroid is now
from where it was in the round of measuring: one norm of the total displacement, not a sum of steps. While the
upper bound stays below all lower ones the vector keeps its cluster without being measured; otherwise the
distance to its own centroid is measured first, and if that does not settle it, it is measured against all centroids.

All results are exact. Bounds are whole numbers rounded to the safe side, which keeps the state of a vector small.
Each round is one pass over the vectors, written to shared scratch; nothing is shuffled but k sums a task. Sums follow
the vectors that change their cluster. Driver and broadcasts hold rounds x k centroids, whatever the table's size.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.llm.blocks import given_back
from notemill.session import materialise

SCALE = 256
#: Up to this size of components a double holds every sum of squares of a vector exactly.
PLAIN = 1 << 20
MOST = 2**63 - 1
#: Relative room for the rounding of a square root.
ROOM = 1e-12

STATE = "vec_id long, x array<long>, cluster int, before int, upper long, lower array<long>, stamp int"
FOUND = "vec_id long, cluster int, distance long"


def whole_vectors(vectors: DataFrame, dim: int) -> DataFrame:
    """vec_id and x = floor(256 * component) of the vectors with ``dim`` components, none null or non-finite."""
    v = F.col("embedding")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding"))
    kept = kept.filter(v.isNotNull() & (F.size(v) == dim) & finite)
    return kept.select("vec_id", F.transform(v, lambda c: F.floor(F.lit(SCALE) * c).cast("long")).alias("x"))


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, exact: whole doubles where those are exact, Python's integers beyond."""
    if not len(x) or max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) <= PLAIN:
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)
    a, b = x.astype(object), centroids.astype(object)
    return np.stack([((a - c) ** 2).sum(axis=1) for c in b], axis=1)


def own_squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of each row to the centroid in the same row."""
    if not len(x) or max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) <= PLAIN:
        return ((x - centroids) ** 2).sum(axis=1)
    return ((x.astype(object) - centroids.astype(object)) ** 2).sum(axis=1)


def roots(values: np.ndarray) -> np.ndarray:
    return np.sqrt(np.asarray(values, dtype=np.float64))


def at_most(values: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(roots(values) * (1 - ROOM)), 2.0**62).astype(np.int64)


def at_least(values: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(roots(values) * (1 + ROOM)), 2.0**62).astype(np.int64)


def displacements(history: list[np.ndarray]) -> np.ndarray:
    """How far every centroid is now from where it was in each round, rounded up: (round, centroid)."""
    return np.stack([at_least(own_squared(history[-1], old)) for old in history])


def measured(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (the smaller number of equals), all squared distances, and that to the nearest."""
    distances = squared(x, centroids)
    cluster = distances.argmin(axis=1)
    return cluster, distances, distances[np.arange(len(x)), cluster]


def doubtful(x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, stamp: np.ndarray,
             moved: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Rows whose bounds, and then whose measured distance to their own centroid, do not settle their cluster."""
    rows = np.arange(len(x))
    loose = lower - moved[stamp]
    loose[rows, cluster] = np.iinfo(np.int64).max
    least = loose.min(axis=1)
    failed = np.flatnonzero(upper + moved[stamp, cluster] >= least)
    exact = at_least(own_squared(x[failed], centroids[cluster[failed]]))
    return failed[exact >= least[failed]]


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(rows, -1)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel()))


def _state(vec_id: pa.Array, x: np.ndarray, cluster, before, upper, lower, stamp) -> pa.RecordBatch:
    parts = [vec_id, _lists(x), *(pa.array(v.astype(np.int32)) for v in (cluster, before)), pa.array(upper), _lists(lower),
             pa.array(stamp.astype(np.int32))]
    return pa.RecordBatch.from_arrays(parts, names=["vec_id", "x", "cluster", "before", "upper", "lower", "stamp"])


def _first(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = shared.value[0]
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"), batch.num_rows)
                cluster, distances, own = measured(x, centroids)
                none = np.full(len(x), -1)
                yield _state(batch.column("vec_id"), x, cluster, none, at_least(own), at_most(distances), none + 1)
                given_back()
    return run


def _unpacked(batch: pa.RecordBatch):
    lists = [_matrix(batch.column(c), batch.num_rows) for c in ("x", "lower")]
    return *lists, *(batch.column(c).to_numpy().astype(np.int64) for c in ("cluster", "upper", "stamp"))


def _next(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history = shared.value
        moved, centroids, now = displacements(history), history[-1], len(history) - 1
        for batch in batches:
            if batch.num_rows:
                x, lower, before, upper, stamp = _unpacked(batch)
                rows = doubtful(x, before, upper, lower, stamp, moved, centroids)
                cluster, lower, upper, stamp = before.copy(), lower.copy(), upper.copy(), stamp.copy()
                cluster[rows], distances, own = measured(x[rows], centroids)
                lower[rows], upper[rows], stamp[rows] = at_most(distances), at_least(own), now
                yield _state(batch.column("vec_id"), x, cluster, before, upper, lower, stamp)
                given_back()
    return run


def _last(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history = shared.value
        moved, centroids = displacements(history), history[-1]
        for batch in batches:
            if batch.num_rows:
                x, lower, cluster, upper, stamp = _unpacked(batch)
                rows = doubtful(x, cluster, upper, lower, stamp, moved, centroids)
                cluster = cluster.copy()
                cluster[rows] = measured(x[rows], centroids)[0]
                distance = np.minimum(own_squared(x, centroids[cluster]), MOST).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                                 names=["vec_id", "cluster", "distance"])
    return run


def first_centroids(rows: DataFrame, k: int, order: Column) -> np.ndarray:
    """The k vectors that come first, equal ones by their components."""
    found = rows.select("x", order.alias("_order")).orderBy("_order", "x").limit(k).collect()
    return np.array([r["x"] for r in found], dtype=np.int64)


class Sums:
    """Component sums and sizes of the clusters, as Python's integers."""

    def __init__(self, k: int, dim: int):
        self.counts, self.totals = [0] * k, [[0] * dim for _ in range(k)]

    def follow(self, state: DataFrame) -> None:
        """Add the vectors that came to each cluster and take off those that left it."""
        moved = state.filter(F.col("cluster") != F.col("before"))
        came = moved.select("cluster", F.lit(1).alias("_sign"), "x")
        left = moved.filter(F.col("before") >= 0).select(F.col("before").alias("cluster"), F.lit(-1).alias("_sign"), "x")
        part = [F.sum((F.col("x")[i].cast("decimal(19,0)") * F.col("_sign"))).alias(f"_{i}") for i in range(len(self.totals[0]))]
        for row in came.unionAll(left).groupBy("cluster").agg(F.sum("_sign").alias("_n"), *part).collect():
            self.counts[row["cluster"]] += row["_n"]
            total = self.totals[row["cluster"]]
            for i in range(len(total)):
                total[i] += int(row[f"_{i}"])

    def means(self, old: np.ndarray) -> np.ndarray:
        """Floor of the mean of every cluster; an empty one keeps its centroid."""
        return np.array([[t // n for t in total] if n else c for n, total, c in zip(self.counts, self.totals, old.tolist())], dtype=np.int64)


def clusters(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, order: Column | None = None) -> DataFrame:
    """vec_id, cluster, squared distance, its sums per cluster and over all, and the digest of the cluster's centroid.

    ``vectors`` has vec_id and embedding; vectors that are null, of another length, or hold null or non-finite
    components take no part, other columns are not read. The first centroids are the k vectors that come first by ``order``
    (SHA-256 of ``2:<vec_id>`` if not given; a null id counts as no digits), or all, if fewer. Repeated ids and equal
    vectors stay rows of their own. Of equally near centroids the smaller number is taken. Without vectors there are no rows.
    Components beyond a long are taken as its bounds, results beyond it as its largest value.
    """
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, dim)
    order = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256) if order is None else order
    history = [first_centroids(rows, k, order)]
    if not len(history[0]):
        return spark.createDataFrame([], f"{FOUND}, cluster_inertia long, inertia long, centroid_sha256 string")
    state, sums = None, Sums(len(history[0]), dim)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(history)
        step = _first(shared) if state is None else _next(shared)
        state = materialise((rows if state is None else state).mapInArrow(step, STATE), "assigned")
        sums.follow(state)
        history = [*history, sums.means(history[-1])]
    shared = spark.sparkContext.broadcast(history)
    if state is None:
        state = materialise(rows.mapInArrow(_first(shared), STATE), "assigned")
    found = materialise(state.mapInArrow(_last(shared), FOUND), "clusters")
    totals = {r["cluster"]: int(r["total"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()}
    final, whole = history[-1], min(sum(totals.values()), MOST)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in final.tolist()]
    about = spark.createDataFrame([(j, min(t, MOST), whole, digests[j]) for j, t in totals.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
