"""Sums over all pairs of columns, in tiles.

The k x k matrices are cut into tiles of ``BLOCK`` x ``BLOCK`` columns. A task
holds as many tiles as fit ``TILE_BYTES``; further tiles take further passes,
each reading only the columns it needs, so memory does not grow with the
number of columns. A task leaves one row of arrays a tile. The rows of a tile
are added in two steps, by parts of the tasks and then all, and each adding
task streams them: it holds one tile, whatever the number of tasks.

Values are moved by their column's mean first, so large offsets do not
cancel. A missing value is a null, a NaN or an infinity: sums over a pair of
columns are over the rows where both are present.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import col

BLOCK = 128
TILE_BYTES = 64 << 20
PARTS = 64        # tasks whose rows of a tile are added in the first step: one in so many
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
NOISE = 1e-12     # a variance below this share of its sum of squares is rounding


def tile_side(columns: int, block: int = BLOCK) -> int:
    """Columns of a tile: fewer than ``block`` for a narrow table."""
    return max(1, min(block, columns))


def _columns(batch: pa.RecordBatch, names: Sequence[str], complete: bool = False) -> np.ndarray:
    """Rows of some columns (or of one column of equally long lists), missing
    values as NaN; only the rows without any, if ``complete``."""
    if pa.types.is_list(batch.schema.field(names[0]).type):
        rows = batch.column(names[0]).drop_null()
        x = rows.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), -1) if len(rows) else np.zeros((0, 1))
    else:
        x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names])
    x[~np.isfinite(x)] = np.nan
    return x[~np.isnan(x).any(axis=1)] if complete else x


def column_means(data: DataFrame, complete: bool = False) -> np.ndarray:
    """The mean of every column over its present values (in the complete rows), 0 where there is none: k numbers."""
    names = data.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean = np.zeros(len(names)), np.zeros(len(names))
        for batch in batches:
            x = _columns(batch, names, complete)
            here = ~np.isnan(x)
            more = here.sum(axis=0)
            with np.errstate(invalid="ignore", divide="ignore"):
                step = np.where(more > 0, np.where(here, x, 0.0).sum(axis=0) / np.maximum(more, 1) - mean, 0.0)
            n += more
            mean += step * (more / np.maximum(n, 1))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(names))), pa.array(n), pa.array(mean)], names=["i", "n", "m"])

    out = np.zeros(len(names))
    total = F.sum("n")
    for r in (data.mapInArrow(run, "i bigint, n double, m double").filter("n > 0").groupBy("i")
              .agg((F.sum(F.col("n") * F.col("m")) / total).alias("m")).collect()):
        out[r["i"]] = r["m"]
    return np.where(np.isfinite(out), out, 0.0)


def summed(data: DataFrame, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """``of`` added up over the complete rows of ``data`` (columns of
    doubles, or one column of equally long lists of them): it takes some rows and returns ``size`` numbers. One pass; a
    task adds up its own rows, and ``size`` numbers reach the driver."""
    names = data.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            x = _columns(batch, names, complete=True)
            if len(x):
                total += of(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["i", "s"])

    out = np.zeros(size)
    for r in data.mapInArrow(run, "i bigint, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():
        out[r["i"]] = r["s"]
    return out


def _tile_sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The six sums for all pairs of columns of two blocks of the same rows."""
    hx, hy = ~np.isnan(x), ~np.isnan(y)
    if hx.all() and hy.all():  # nothing missing: one product is enough
        k, m = x.shape[1], y.shape[1]
        wide = lambda v: np.broadcast_to(v[:, None], (k, m))
        tall = lambda v: np.broadcast_to(v[None, :], (k, m))
        return np.stack([np.full((k, m), float(len(x))), wide(x.sum(axis=0)), tall(y.sum(axis=0)),
                         wide((x * x).sum(axis=0)), tall((y * y).sum(axis=0)), x.T @ y])
    x, y, hx, hy = np.where(hx, x, 0.0), np.where(hy, y, 0.0), hx.astype(float), hy.astype(float)
    return np.stack([hx.T @ hy, x.T @ hy, hx.T @ y, (x * x).T @ hy, hx.T @ (y * y), x.T @ y])


_ROW = "i int, j int, part int, sums array<double>"


def _tile_rows(tiles: Sequence[tuple[int, int]], sums: dict, part: int) -> pa.RecordBatch:
    size = next(iter(sums.values())).size
    return pa.RecordBatch.from_arrays(
        [pa.array([t[0] for t in tiles], pa.int32()), pa.array([t[1] for t in tiles], pa.int32()),
         pa.array(np.full(len(tiles), part, np.int32)),
         pa.ListArray.from_arrays(pa.array(np.arange(len(tiles) + 1, dtype=np.int32) * size),
                                  pa.array(np.concatenate([sums[t].ravel() for t in tiles])))],
        names=["i", "j", "part", "sums"])


def _pass(data: DataFrame, means: np.ndarray, tiles: list[tuple[int, int]], block: int, complete: bool) -> DataFrame:
    """The tasks' rows of some tiles, from the columns these need (from all, to tell complete rows)."""
    k = len(data.columns)
    blocks = sorted({b for t in tiles for b in t})
    read = list(range(-(-k // block))) if complete else blocks
    names = [c for b in read for c in data.columns[b * block:(b + 1) * block]]
    starts = {b: i * block for i, b in enumerate(read)}  # only the last block can be shorter
    mean = np.concatenate([means[b * block:(b + 1) * block] for b in read])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            every = _columns(batch, names, complete) - mean
            if not len(every):
                continue
            x = {b: every[:, starts[b]:starts[b] + block] for b in blocks}
            for t in tiles:
                add = np.zeros((len(SUMS), block, block))
                s = _tile_sums(x[t[0]], x[t[1]])
                add[:, :s.shape[1], :s.shape[2]] = s
                sums[t] = sums[t] + add if t in sums else add
        for t in tiles:  # a tile a row batch
            if t in sums:
                yield _tile_rows([t], sums, TaskContext.get().partitionId())

    return data.select(*names).mapInArrow(run, _ROW)


def _add_up(rows: DataFrame, *key: str) -> DataFrame:
    """Rows of equal tile (and part) added; a task streams the rows dealt to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True))
            values = batch.column(3)
            for n, k in enumerate(keys):
                v = values[n].values.to_numpy()
                sums[k] = sums[k] + v if k in sums else v.copy()
        for k, v in sums.items():
            yield _tile_rows([k[:2]], {k[:2]: v}, k[2])
    return rows.repartition(*key).mapInArrow(run, _ROW)


def pair_sums(data: DataFrame, means: np.ndarray, block: int = BLOCK, tile_bytes: int = TILE_BYTES,
              complete: bool = False) -> DataFrame:
    """(i, j, sums): one row a tile i <= j with rows; sums holds ``SUMS`` as block x block arrays in a row.

    ``data``: columns of doubles. ``block``: see ``tile_side``. ``complete``:
    rows with a missing value in any column are left out."""
    k = len(data.columns)
    count = -(-k // block)
    tiles = [(i, j) for i in range(count) for j in range(i, count)]
    held = max(1, tile_bytes // (len(SUMS) * block * block * 8))
    rows = None
    for at in range(0, len(tiles), held):
        part = _pass(data, means, tiles[at:at + held], block, complete)
        rows = part if rows is None else rows.unionByName(part)
    first = _add_up(rows.withColumn("part", F.pmod("part", F.lit(PARTS)).cast("int")), "i", "j", "part")
    return _add_up(first.withColumn("part", F.lit(0)), "i", "j").select("i", "j", "sums")


def doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles named by their place."""
    return df.select(*[col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])


def tile_correlation(sums: np.ndarray) -> np.ndarray:
    """Pearson r from the six sums, within [-1, 1]; NaN for fewer than two rows or no variance."""
    n, sx, sy, sxx, syy, sxy = sums
    with np.errstate(all="ignore"):
        vx, vy = sxx - sx * sx / n, syy - sy * sy / n
        vx, vy = (np.where(v > NOISE * s, v, np.nan) for v, s in ((vx, sxx), (vy, syy)))
        r = (sxy - sx * sy / n) / np.sqrt(vx) / np.sqrt(vy)
        return np.where((n > 1) & np.isfinite(r), np.clip(r, -1.0, 1.0), np.nan)


@dataclass(frozen=True)
class Gram:
    """Rows, means, population covariance of some columns over their complete rows."""

    n: int
    mean: np.ndarray
    cov: np.ndarray


def gram(df: DataFrame, columns: Sequence[str], block: int = BLOCK, tile_bytes: int = TILE_BYTES) -> Gram:
    """Covariance of the rows where every column is present: k x k numbers on
    the driver, from one pass for the means and one (or more, see above) for
    the products."""
    data = doubles(df, columns)
    means = column_means(data, complete=True)
    k = len(columns)
    block = tile_side(k, block)
    size = -(-k // block) * block
    cov, shift, square, rows = np.zeros((size, size)), np.zeros(size), np.zeros(size), 0
    for r in pair_sums(data, means, block, tile_bytes, complete=True).toLocalIterator():  # a tile at a time
        n, sx, sy, sxx, _, sxy = np.array(r["sums"]).reshape(len(SUMS), block, block)
        rows = int(n[0, 0])
        a, b = slice(r["i"] * block, (r["i"] + 1) * block), slice(r["j"] * block, (r["j"] + 1) * block)
        cov[a, b] = (sxy - sx * sy / rows) / rows
        if r["i"] == r["j"]:
            shift[a], square[a] = np.diag(sx) / rows, np.diag(sxx) / rows
    cov, shift, square = cov[:k, :k], shift[:k], square[:k]
    live = np.diag(cov) > NOISE * square  # constant columns: no variance
    cov = np.triu(cov) + np.triu(cov, 1).T
    return Gram(rows, means + shift if rows else means, cov * np.outer(live, live))
