"""Centroid clustering whose nearest-centroid search is the threshold algorithm.

For every dimension the centroids are kept in a list sorted by their value
there. A vector starts at its own value in each list and walks outward,
nearest entry first, one list after the other. A centroid met for the first
time gets its exact squared distance. In each list the next entry not yet
walked is the frontier: a centroid not met so far is at least that far away
in that dimension, so its squared distance is at least the sum of the
squared frontier distances. The walk stops when this sum strictly exceeds
the best exact distance (a tie could still be won by a smaller number).

Vectors never move: a round is one pass over the written table. A task keeps
one sum and one count a centroid, and only those rows are shuffled; sums and
new centroids are exact whole numbers. What reaches the driver is ``k``
centroids, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.graph import saved, small_batches

SLICE = 4096  # vectors walked at once in a task
LARGEST = 1 << 61  # no squared distance may reach this


@dataclass(frozen=True)
class CentroidLists:
    """Centroids (k x d whole numbers) with one sorted list a dimension."""

    centroids: np.ndarray
    number: np.ndarray  # k x d: centroid at each place of a list
    value: np.ndarray   # k x d: its value there

    @classmethod
    def of(cls, centroids: np.ndarray) -> CentroidLists:
        number = np.argsort(centroids, axis=0, kind="stable")
        return cls(centroids, number, np.take_along_axis(centroids, number, axis=0))


def nearest(x: np.ndarray, lists: CentroidLists) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, squared distance, exact distances computed) for every row of ``x`` (n x d)."""
    c, k, d = lists.centroids, *lists.centroids.shape
    n = len(x)
    if n and d * float(max(np.abs(x.astype(float)).max(), np.abs(c.astype(float)).max()) * 2) ** 2 >= LARGEST:
        raise ArithmeticError("components are too large for whole-number squared distances")
    up = np.empty((n, d), np.int64)  # next place upwards in each list, k at its end
    for j in range(d):
        up[:, j] = np.searchsorted(lists.value[:, j], x[:, j])
    down = up - 1                    # next place downwards, -1 at its end
    dims = np.arange(d)

    def gaps(x, up, down, dim):
        """Distance to the next entry below and above; the other side's where one has ended."""
        above = np.where(up < k, lists.value[np.minimum(up, k - 1), dim] - x, -1)
        below = np.where(down >= 0, x - lists.value[np.maximum(down, 0), dim], -1)
        return np.where(below < 0, above, below), np.where(above < 0, below, above)

    below, above = gaps(x, up, down, dims)
    frontier = np.minimum(below, above)
    bound = (frontier ** 2).sum(axis=1)
    best, far = np.full(n, -1, np.int64), np.full(n, LARGEST, np.int64)
    met, exact = np.zeros((n, k), bool), np.zeros(n, np.int64)
    live, step = np.arange(n), 0
    while len(live):
        j = step % d
        step += 1
        xs, u, w = x[live, j], up[live, j], down[live, j]
        below, above = gaps(xs, u, w, j)
        rise = (w < 0) | ((u < k) & (above <= below))
        at = np.where(rise, u, w)
        ended = (u >= k) & (w < 0)  # a list walked to both ends has met every centroid
        who = lists.number[np.clip(at, 0, k - 1), j]
        up[live, j], down[live, j] = u + (rise & ~ended), w - (~rise & ~ended)
        fresh = ~met[live, who] & ~ended
        rows, new = live[fresh], who[fresh]
        met[rows, new] = True
        exact[rows] += 1
        distance = ((x[rows] - c[new]) ** 2).sum(axis=1)
        wins = (distance < far[rows]) | ((distance == far[rows]) & (new < best[rows]))
        best[rows[wins]], far[rows[wins]] = new[wins], distance[wins]
        below, above = gaps(xs, up[live, j], down[live, j], j)
        ahead = np.maximum(np.minimum(below, above), 0)
        bound[live] += ahead ** 2 - frontier[live, j] ** 2
        frontier[live, j] = ahead
        live = live[(bound[live] <= far[live]) & (exact[live] < k)]
    return best, far, exact


def _rows(column: pa.Array, d: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def whole_vectors(vectors: DataFrame, dim: int, scale: int, id_col: str = "vec_id",
                  vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(scale * x) of the vectors with ``dim`` finite components."""
    fit = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (vectors.select(F.col(id_col).cast("bigint").alias("vec_id"),
                           F.col(vector_col).cast("array<double>").alias("x"))
            .filter(F.coalesce((F.size("x") == dim) & fit, F.lit(False)))
            .select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v")))


def _assign(lists: CentroidLists):
    d = lists.centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                best, far, _ = nearest(_rows(part.column(1), d), lists)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(best, pa.int32()), pa.array(far)], names=["vec_id", "cluster", "distance"])
    return run


def _sums(lists: CentroidLists):
    k, d = lists.centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, d), np.int64)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                x = _rows(batch.column(1).slice(at, SLICE), d)
                best = nearest(x, lists)[0]
                for j in np.unique(best):
                    total[j] += x[best == j].sum(axis=0)
                count += np.bincount(best, minlength=k)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(count[some]),
             pa.array(list(total[some]), pa.list_(pa.int64()))], names=["cluster", "n", "total"])
    return run


def threshold_clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024,
                       seed: int = 3, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Cluster the vectors and return (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256).

    Components become floor(scale * x). The first centroids are the ``k``
    vectors with the smallest sha256 of ``<seed>:<vec_id>``, in that order.
    Each of ``rounds`` rounds assigns every vector to its nearest centroid
    (ties: smaller number) and moves a centroid with vectors to their floored
    mean; then vectors are assigned once more. ``distance`` is squared and
    summed over the cluster and over all; ``centroid_sha256`` is that of the
    final centroid's components joined by commas.

    Vectors that are null, not ``dim`` long, or hold a null or non-finite
    component are not returned. Rows without id are clustered and returned
    (id null) but start no centroid while another vector can. Rows that
    repeat an id count each; of two starts with one id the smaller vector
    comes first. Fewer vectors than ``k`` give as many centroids; none gives
    no rows. Components whose squared distances would not fit a long raise
    ArithmeticError. Other columns are not looked at, whatever their names.
    """
    spark = vectors.sparkSession
    data = saved(whole_vectors(small_batches(vectors), dim, scale, id_col, vector_col), "vectors")
    first = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = data.orderBy(first.asc_nulls_last(), "v").limit(k).collect()  # k rows
    shape = "vec_id bigint, cluster int, distance bigint"
    if not starts:
        return spark.createDataFrame([], f"{shape}, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    centroids = np.array([r["v"] for r in starts], np.int64)
    for _ in range(rounds):
        sums = (data.mapInArrow(_sums(CentroidLists.of(centroids)), "cluster int, n bigint, total array<bigint>")
                .select("cluster", "n", F.posexplode("total").alias("at", "total"))
                .groupBy("cluster", "at")
                .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
                .collect())  # k x dim rows
        centroids = centroids.copy()
        for r in sums:
            centroids[r["cluster"], r["at"]] = int(r["total"]) // r["n"]
    found = saved(data.mapInArrow(_assign(CentroidLists.of(centroids)), shape), "clusters")
    inertia = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    place = F.col("cluster") + 1
    return found.select(
        F.col("vec_id").alias(id_col), "cluster", "distance",
        F.element_at(F.array(*[F.lit(inertia.get(j, 0)).cast("bigint") for j in range(len(centroids))]), place).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        F.element_at(F.array(*[F.lit(x) for x in digest]), place).alias("centroid_sha256"))
