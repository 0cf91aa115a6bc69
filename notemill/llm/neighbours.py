"""Nearest neighbours by cosine through a block matrix join of int8 codes.

Vectors are scaled to length one and coded in int8 with their own scale; the length of what the code leaves out
is kept. A tile is the product of a block of query codes and a block of candidate codes; with the lengths left out it gives
bounds of every cosine in it. Per query only candidates survive whose upper bound reaches the k-th largest lower
bound. Surviving pairs are computed again from the original vectors and merged by heaps. The result is exact.

Equal vectors are one candidate with its k + 1 smallest ids (one may be the query itself): no more of them can be among the
nearest, so that a vector that fills a third of the table costs as much as any other.
"""

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notemill.session import materialise

CANDIDATE_BLOCK, QUERY_BLOCK = 16384, 8192
EXACT_DIMENSIONS = 1024
SLACK = 1e-9

_CODE = "struct<dim int, codes binary, scale double, rest double>"


def _coded(vectors: pa.Array) -> pa.Array:
    rows = []
    for value in vectors:
        v = np.array(value.as_py(), dtype=np.float64)
        v /= np.abs(v).max()
        v /= math.sqrt(float((v * v).sum()))
        scale = float(np.abs(v).max()) / 127
        code = np.rint(v / scale).astype(np.int8)
        rows.append({"dim": len(v), "codes": code.tobytes(), "scale": scale, "rest": float(np.linalg.norm(v - scale * code))})
    return pa.array(rows, type=pa.struct([("dim", pa.int32()), ("codes", pa.binary()), ("scale", pa.float64()), ("rest", pa.float64())]))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of all rows; float32 holds them exactly for the dimensions of one step."""
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_DIMENSIONS):
        total += a[:, at:at + EXACT_DIMENSIONS].astype(np.float32) @ b[:, at:at + EXACT_DIMENSIONS].astype(np.float32).T
    return total


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), dtype=np.int8).reshape(table.num_rows, -1)
    return table.column("rep").to_numpy(), codes, table.column("scale").to_numpy(), table.column("rest").to_numpy()


_BOUNDS = pa.schema([("query", pa.int64()), ("rep", pa.int64()), ("lower", pa.float64()), ("upper", pa.float64())])


def _tile(k: int):
    def survivors(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return _BOUNDS.empty_table()
        q_ids, q, q_scale, q_rest = _matrix(queries)
        c_ids, c, c_scale, c_rest = _matrix(candidates)
        out = []
        for at in range(0, len(q), 256):
            near = product(q[at:at + 256], c) * q_scale[at:at + 256, None] * c_scale
            off = q_rest[at:at + 256, None] + (1 + q_rest[at:at + 256, None]) * c_rest + SLACK
            lower, upper = near - off, near + off
            if lower.shape[1] > k:
                limit = np.partition(lower, lower.shape[1] - k - 1, axis=1)[:, lower.shape[1] - k - 1]
                row, column = np.nonzero(upper >= limit[:, None])
            else:
                row, column = (x.ravel() for x in np.indices(lower.shape))
            out.append(pa.Table.from_arrays([pa.array(q_ids[at + row]), pa.array(c_ids[column]), pa.array(lower[row, column]),
                                             pa.array(upper[row, column])], schema=_BOUNDS))
        return pa.concat_tables(out)
    return survivors


def _cosines(left: pa.Array, right: pa.Array) -> pa.Array:
    """Sums run in the order of the components, in double precision."""
    out = np.zeros(len(left))
    sizes = np.diff(left.offsets.to_numpy())
    a, b = left.flatten().to_numpy(), right.flatten().to_numpy()
    ends = np.cumsum(sizes)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        at = (ends - sizes)[rows]
        dot, one, two = np.zeros(len(rows)), np.zeros(len(rows)), np.zeros(len(rows))
        for i in range(size):
            x, y = a[at + i], b[at + i]
            dot, one, two = dot + x * y, one + x * x, two + y * y
        out[rows] = dot / (np.sqrt(one) * np.sqrt(two))
    return pa.array(out)


def _heaps(k: int):
    def merge(batches):
        best: dict[int, list] = {}
        for batch in batches:
            for query, score, ids in zip(*(batch.column(c).to_pylist() for c in ("query", "score", "ids"))):
                heap = best.setdefault(query, [])
                for one in ids:
                    if len(heap) <= k:
                        heapq.heappush(heap, (score, -one))
                    else:
                        heapq.heappushpop(heap, (score, -one))
        rows = [{"query": q, "near": [{"vec_id": -i, "score": s} for s, i in sorted(heap, reverse=True)]} for q, heap in best.items()]
        for at in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_pylist(rows[at:at + 10_000], schema=pa.schema([("query", pa.int64()), ("near", pa.list_(
                pa.struct([("vec_id", pa.int64()), ("score", pa.float64())])))]))
    return merge


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, candidate_block: int = CANDIDATE_BLOCK,
            query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest by cosine of every query among all other ids.

    ``vectors`` has vec_id and embedding. Null ids and vectors that are null, empty, zero or hold null or
    non-finite components take no part. Of several vectors under one id the least counts. A vector is compared
    with those of its own length only. Ties go to the smaller id; with fewer than k others all are returned.
    """
    spark = vectors.sparkSession
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), is_query.alias("_asks"))
    valid = given.filter(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    rows = materialise(valid.groupBy("vec_id").agg(F.min("embedding").alias("embedding"), F.max("_asks").alias("_asks")), "vectors")

    order = Window.partitionBy("embedding").orderBy("vec_id")
    first = rows.select("vec_id", "embedding").withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1)
    classes = first.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    code = F.arrow_udf(_coded, _CODE)
    classes = materialise(classes.select(F.col("ids")[0].alias("rep"), "ids", "embedding", code("embedding").alias("code")), "vectors")
    asked = materialise(rows.filter("_asks").select("vec_id", "embedding").join(classes.select("embedding", "rep"), "embedding")
                        .select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query")), "queries")

    queries = asked.select(F.col("query").alias("rep")).distinct()
    slots = max(1, math.ceil(classes.count() / candidate_block))
    parts = max(1, math.ceil(queries.count() / query_block))
    coded = classes.select("rep", "code.*")
    q = (coded.join(queries, "rep").withColumn("part", F.pmod(F.xxhash64("rep"), F.lit(parts)).cast("int"))
         .withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))))
    c = (coded.withColumn("slot", F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(slots)).cast("int"))
         .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    q, c = q.toDF(*q.columns), c.toDF(*c.columns)          # columns of their own, as both come from one table
    bounds = materialise(q.groupBy("dim", "slot", "part").cogroup(c.groupBy("dim", "slot", "part")).applyInArrow(
        _tile(k), "query long, rep long, lower double, upper double"), "bounds")

    by_lower = Window.partitionBy("query").orderBy(F.desc("lower"))
    limits = (bounds.select("query", "lower").withColumn("_n", F.row_number().over(by_lower)).filter(F.col("_n") <= k + 1)
              .groupBy("query").agg(F.count("*").alias("_found"), F.min("lower").alias("_limit")))
    pairs = bounds.join(limits, "query").filter((F.col("_found") <= k) | (F.col("upper") >= F.col("_limit"))).select("query", "rep")
    left = pairs.join(classes.select(F.col("rep").alias("query"), F.col("embedding").alias("_a")), "query")
    both = left.join(classes.select("rep", "ids", F.col("embedding").alias("_b")), "rep")
    scored = both.select("query", F.arrow_udf(_cosines, "double")("_a", "_b").alias("score"), "ids")
    near = scored.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "query").mapInArrow(
        _heaps(k), "query long, near array<struct<vec_id long, score double>>")
    others = F.slice(F.filter("near", lambda n: n["vec_id"] != F.col("query_id")), 1, k)
    return (asked.join(near, "query").select("query_id", F.posexplode(others).alias("_at", "_near"))
            .select("query_id", (F.col("_at") + 1).alias("rank"), "_near.vec_id", "_near.score"))
