"""Exact top-k inner products by a Voronoi kNN join.

1. Vectors are grouped by their nearest pivot (``PIVOTS`` rows of smallest
   id hash). A summary of each cell holds its size and radius.
2. A cell is cut into chunks of about ``CHUNK`` rows by id hash. Every query
   is solved against the chunk it lies in: its k-th score there bounds its
   final k-th score from below.
3. For a query q and a vector x of the cell of pivot p, q.x <= q.p + |q|
   |x - p|. With the cell's radius this tells which cells can hold one of
   q's k best; q is sent to those only. The queries are the smaller side (a
   fiftieth of the rows here), so they are what is replicated; the vectors
   stay where they are. Inside a chunk the same bound with x's own distance
   drops the vectors that no query of the block needs.
4. Each (cell, chunk, block of queries) is solved in one task by a matrix
   product of bounded size, and a query's chunk winners are ranked.

Hot cells (a vector that a third of the rows share) become many chunks;
queries that meet in one cell are cut into blocks of about ``BLOCK``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.graph import saved, small_batches

PIVOTS = 64
CHUNK = 4096
BLOCK = 1024
SCALE = 256
SLACK = 1e-6  # of the bound, for rounding; scores themselves are exact


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, shorter ones filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    if n and (sizes == dim).all():
        return values[offsets[0]:offsets[-1]].reshape(n, dim)
    out = np.zeros((n, dim), np.int64)
    for i in range(n):
        out[i, :sizes[i]] = values[offsets[i]:offsets[i + 1]]
    return out


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2 ** 53:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    return q @ x.T


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, max(m.shape[1], 1))[:len(m) + 1], pa.int32()),
                                    pa.array(m.ravel(), pa.int64()))


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component as whole numbers, valid rows only."""
    x = F.col("x")
    valid = (F.col("id").isNotNull() & x.isNotNull() & (F.size("x") > 0)
             & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return (vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
            .filter(F.coalesce(valid, F.lit(False)))
            .select(F.col("id").alias("vec_id"), F.transform("x", lambda c: F.floor(c * scale)).alias("v")))


def top_products(vectors: DataFrame, k: int = 5, query_every: int = 50, id_col: str = "vec_id",
                 vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each query, ties to the smaller id.

    Queries are the rows whose id ``query_every`` divides; candidates are all
    rows of another id. Rows with a null id, a null or empty vector or a null
    or non-finite component take no part. A vector shorter than the longest
    counts as filled with zeros. Rows that repeat an id are candidates each;
    as queries they count once, with their smallest vector. Other columns
    are not looked at; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    data = quantised(small_batches(vectors), id_col, vector_col, scale)
    dim = data.agg(F.max(F.size("v"))).first()[0] or 1
    picked = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()
    seeds = sorted({tuple(r["v"]) + (0,) * (dim - len(r["v"])) for r in picked}) or [(0,) * dim]
    pivots = spark.sparkContext.broadcast(np.array(seeds, float))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            far = (x.astype(float) ** 2).sum(axis=1)[:, None] - 2 * x.astype(float) @ p.T + (p ** 2).sum(axis=1)
            cell = far.argmin(axis=1) if len(x) else np.zeros(0, np.int64)
            distance = np.sqrt(np.maximum(((x - p[cell]) ** 2).sum(axis=1), 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell, pa.int32()), pa.array(distance), _lists(x)],
                                             names=["vec_id", "cell", "distance", "v"])

    cells = saved(data.mapInArrow(place, "vec_id bigint, cell int, distance double, v array<bigint>"), "cells")
    summary = cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("r")).collect()  # a row a pivot
    radius = np.full(len(seeds), -np.inf)
    chunks = np.zeros(len(seeds), np.int64)
    for s in summary:
        radius[s["cell"]], chunks[s["cell"]] = s["r"], -(-s["n"] // CHUNK)
    of_cell = F.element_at(F.array(*[F.lit(int(max(c, 1))) for c in chunks]), F.col("cell") + 1)
    chunked = cells.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), of_cell).cast("int"))

    def first_bounds(table: pa.Table) -> pa.Table:
        ids, x = table.column("vec_id").to_numpy(), _matrix(table.column("v"), dim)
        asked = np.flatnonzero(ids % query_every == 0)
        low = np.full(len(asked), -np.inf)
        for lo in range(0, len(asked), BLOCK):
            part = asked[lo:lo + BLOCK]
            s = _products(x[part], x).astype(float)
            s[ids[part][:, None] == ids[None, :]] = -np.inf
            if len(ids) >= k:
                low[lo:lo + BLOCK] = np.partition(s, len(ids) - k, axis=1)[:, len(ids) - k]
        return pa.table({"query_id": ids[asked], "low": low, "q": _lists(x[asked])})

    asked = chunked.groupBy("cell", "chunk").applyInArrow(first_bounds, "query_id bigint, low double, q array<bigint>")
    queries = saved(asked.groupBy("query_id").agg(F.min(F.struct("q", "low")).alias("x"))
                    .select("query_id", "x.low", "x.q"), "queries")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        for batch in batches:
            q, low = _matrix(batch.column(2), dim), batch.column(1).to_numpy()
            bound = q.astype(float) @ p.T + np.sqrt((q.astype(float) ** 2).sum(axis=1))[:, None] * np.maximum(radius, 0)[None, :]
            bound += SLACK * (1 + np.abs(bound))
            row, cell = np.nonzero((bound >= low[:, None]) & (chunks > 0)[None, :])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), _lists(q[row]), pa.array(cell, pa.int32())],
                names=["query_id", "low", "q", "cell"])

    routed = queries.mapInArrow(route, "query_id bigint, low double, q array<bigint>, cell int")
    meets = {r["cell"]: -(-r["n"] // BLOCK) for r in routed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    blocks = F.element_at(F.array(*[F.lit(int(meets.get(c, 0))) for c in range(len(seeds))]), F.col("cell") + 1)
    left = (routed.withColumn("block", F.pmod(F.xxhash64("query_id"), blocks).cast("int"))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), of_cell - 1))))
    right = chunked.filter(blocks > 0).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if len(left) and len(right):
            q, x = _matrix(left.column("q"), dim), _matrix(right.column("v"), dim)
            low, names = left.column("low").to_numpy(), left.column("query_id").to_numpy()
            ids, distance = right.column("vec_id").to_numpy(), right.column("distance").to_numpy()
            p = pivots.value[left.column("cell")[0].as_py()]
            size = np.sqrt((q.astype(float) ** 2).sum(axis=1))
            base = q.astype(float) @ p
            need = np.where(size > 0, (low - base - SLACK * (1 + np.abs(low) + np.abs(base))) / np.maximum(size, 1e-300), -np.inf)
            keep = distance + SLACK * (1 + distance) >= need.min()
            ids, x = ids[keep], x[keep]
            s = _products(q, x)
            for i, name in enumerate(names):
                hit = np.flatnonzero((s[i] >= low[i]) & (ids != name))
                order = np.lexsort((ids[hit], -s[i, hit]))[:k]
                out += [(int(name), int(ids[j]), int(s[i, j])) for j in hit[order]]
        columns = list(zip(*out, strict=True)) or [[]] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    key = ["cell", "chunk", "block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(solve, "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
