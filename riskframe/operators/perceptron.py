"""Multilayer perceptron, fitted by L-BFGS over the partitioned rows.

The network, its initial weights, its loss (mean cross-entropy) and the rule
that ends the fit are those of Spark ML's ``MultilayerPerceptronClassifier``,
and the fitted stage is Spark ML's own model; but the mean is over rows, not
over blocks of rows, and the line search is our own, so weights differ. Each
pass's tasks multiply blocks of their cached rows with numpy, where the JVM's plain
loops take about five times as long. A pass sends the weights out and
brings one sum a task back; the driver holds a few vectors of the weights'
size, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasSeed, HasTol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession

from ..functions.expressions import col
from ..session import ensure_checkpoint_dir
from ..sources.tables import remove_path
from .passes import settle_worker

BLOCK_ROWS = 256    # rows multiplied at once: their activations stay in a core's cache
HISTORY = 10        # pairs of steps and gradient changes kept
MEMORY = 20         # losses that must lie within the tolerance of each other
TRIES = 20          # passes of one line search
PASS_TASKS = 32     # tasks of a pass, or the cluster's cores if those are more
FLAT_TASKS = 256    # up to so many tasks their sums go straight to the driver


def _split(weights: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(matrix, offsets) of each layer, views in Spark ML's order: a layer's inputs by outputs, then its offsets."""
    out, at = [], 0
    for a, b in zip(layers, layers[1:]):
        out.append((weights[at:at + a * b].reshape(a, b), weights[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def loss_and_gradient(weights: np.ndarray, layers: Sequence[int], x: np.ndarray, y: np.ndarray,
                      held: dict | None = None) -> tuple[float, np.ndarray]:
    """Summed cross-entropy of the rows and its gradient: sigmoid hidden layers, softmax at the end.

    ``held`` keeps the arrays between calls, the returned gradient too: new
    ones of some 100 KB cost more than what is computed in them."""
    held = {} if held is None else held

    def array(name: str, i: int, *shape: int) -> np.ndarray:
        a = held.get((name, i))
        if a is None or a.shape != shape:
            a = held[name, i] = np.empty(shape)
        return a

    parts = _split(weights, layers)
    seen = [x]
    for i, (w, b) in enumerate(parts[:-1]):
        z = np.matmul(seen[-1], w, out=array("z", i, len(x), len(b)))
        z += b
        np.maximum(z, -700.0, out=z)
        np.negative(z, out=z)
        np.exp(z, out=z)
        z += 1.0
        seen.append(np.reciprocal(z, out=z))
    w, b = parts[-1]
    z = seen[-1] @ w + b
    z -= z.max(axis=1, keepdims=True)
    e = np.exp(z)
    total = e.sum(axis=1)
    at = np.arange(len(y))
    loss = float((np.log(total) - z[at, y]).sum())
    delta = e / total[:, None]
    delta[at, y] -= 1.0
    gradient = array("g", 0, len(weights))
    back = list(zip(_split(gradient, layers), parts, seen))
    for i in reversed(range(len(back))):
        (gw, gb), (w, _), a = back[i]
        np.matmul(a.T, delta, out=gw)
        delta.sum(axis=0, out=gb)
        if a is not x:
            delta = np.matmul(delta, w.T, out=array("d", i, *a.shape))
            delta *= a
            delta *= np.subtract(1.0, a, out=a)  # a is not needed any more
    return loss, gradient


def _wolfe(at: Callable[[float], tuple[float, float]], f0: float, d0: float, step: float) -> float | None:
    """A step that meets the strong Wolfe conditions (1e-4, 0.9), or the best one found that lowers the loss."""
    low, high, f_low, d_low = 0.0, None, f0, d0
    best = None
    for _ in range(TRIES):
        f, d = at(step)
        fine = np.isfinite(f) and f <= f0 + 1e-4 * step * d0
        if fine and (best is None or f < best[0]):
            best = (f, step)
        if not fine or (low > 0 and f >= f_low):
            high = step
        elif abs(d) <= 0.9 * abs(d0):
            return step
        else:
            if d * ((high if high is not None else np.inf) - low) >= 0:
                high = low
            low, f_low, d_low = step, f, d
        if high is None:
            step *= 2.0
            continue
        width = high - low
        # lowest point of the parabola through the better end, kept off both ends
        bend = 2.0 * (f - f_low - d_low * (step - low)) if np.isfinite(f) and step != low else 0.0
        guess = low - d_low * (step - low) ** 2 / bend if bend > 0 else low + width / 2
        inner, outer = sorted((low + 0.1 * width, high - 0.1 * width))
        step = min(max(guess, inner), outer)
        if abs(width) < 1e-12 * max(1.0, abs(low)):
            break
    return best[1] if best else None


def minimise(of: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, max_iter: int,
             tol: float) -> tuple[np.ndarray, list[float]]:
    """L-BFGS from ``start``: the weights and the loss after every step.

    Ends after ``max_iter`` steps, when the last ``MEMORY`` losses lie within
    ``tol`` of the first loss, when the gradient is below ``tol`` of the loss
    (or 1e-8), or when neither the history nor the plain gradient gives a
    step that lowers the loss."""
    x = start
    f, g = of(x)
    losses, pairs = [f], []
    while len(losses) <= max_iter:
        recent = losses[-MEMORY:]
        if (len(recent) > 1 and max(recent) - f <= tol * losses[0]) or np.linalg.norm(g) <= max(tol * f, 1e-8):
            break
        step = None
        for use in ([pairs, []] if pairs else [[]]):
            move, shares = -g, []
            for s, v, r in reversed(use):
                shares.append(r * (s @ move))
                move = move - shares[-1] * v
            if use:
                s, v, _ = use[-1]
                move = move * ((s @ v) / (v @ v))
            for (s, v, r), share in zip(use, reversed(shares)):
                move = move + (share - r * (v @ move)) * s
            slope = float(g @ move)
            if not slope < 0:
                continue
            found: dict[float, tuple[float, np.ndarray]] = {}

            def at(t: float) -> tuple[float, float]:
                found[t] = of(x + t * move)
                return found[t][0], float(found[t][1] @ move)

            step = _wolfe(at, f, slope, 1.0 if use else 1.0 / np.linalg.norm(move))
            if step is not None:
                break
        if step is None:
            break
        after, h = found[step]
        s, v = step * move, h - g
        pairs = (use + [(s, v, 1.0 / (s @ v))])[-HISTORY:] if s @ v > 0 else list(use)
        x, f, g = x + s, after, h
        losses.append(f)
    return x, losses


def _model(spark: SparkSession, layers: Sequence[int], **settings) -> MultilayerPerceptronClassificationModel:
    """Spark ML's model at its initial weights: the given ones, or those of the seed."""
    names = [settings.get("featuresCol", "features"), settings.get("labelCol", "label")]
    rows = spark.createDataFrame([(Vectors.dense([0.0] * layers[0]), float(k)) for k in range(layers[-1])], names)
    return MultilayerPerceptronClassifier(layers=list(layers), maxIter=0, **settings).fit(rows)


def fit_weights(data: DataFrame, features_col: str, label_col: str, layers: Sequence[int], start: np.ndarray,
                max_iter: int = 1000, tol: float = 1e-6) -> tuple[np.ndarray, list[float]]:
    """Weights that minimise the mean cross-entropy of ``data``'s rows, from ``start``, and the losses on the way.

    Labels are whole numbers from 0 below the last layer's width. The rows
    are held as blocks of numbers, on disk where memory is short, and cut from
    their lineage, which every task of every pass would read. A pass has
    no more tasks than can run at once, each over one or more of the held
    partitions: every task leaves a vector of the weights' size, and a shuffle
    of those in every pass would fill the disks."""
    layers = list(layers)
    rows = data.select(col(label_col).cast("double").alias("y"), vector_to_array(col(features_col)).alias("x"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            if len(y) and (not np.isfinite(y).all() or (y != np.floor(y)).any() or y.min() < 0 or y.max() >= layers[-1]):
                raise ValueError(f"labels must be whole numbers from 0 to {layers[-1] - 1}")
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(y), layers[0])
            both = np.column_stack([y, x])
            for lo in range(0, len(y), BLOCK_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array([both[lo:lo + BLOCK_ROWS].tobytes()], pa.binary())], names=["block"])

    def unpacked(rows: Iterator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for r in rows:
            both = np.frombuffer(r.block).reshape(-1, layers[0] + 1)
            yield both[:, 0].astype(np.int64), np.ascontiguousarray(both[:, 1:])

    ensure_checkpoint_dir(data.sparkSession)
    held = rows.mapInArrow(blocks, "block binary").rdd.mapPartitions(unpacked).persist(StorageLevel.MEMORY_AND_DISK)
    held.checkpoint()
    try:
        n = held.map(lambda b: len(b[0])).sum()
        if not n:
            raise ValueError("no rows to fit on")
        tasks = max(PASS_TASKS, held.context.defaultParallelism)
        dealt = held.coalesce(tasks) if held.getNumPartitions() > tasks else held
        deep = dealt.getNumPartitions() > FLAT_TASKS

        def of(weights: np.ndarray) -> tuple[float, np.ndarray]:
            def task(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
                total, arrays = np.zeros(len(weights) + 1), {}
                for y, x in parts:
                    loss, gradient = loss_and_gradient(weights, layers, x, y, arrays)
                    total[0] += loss
                    total[1:] += gradient
                settle_worker()
                yield total

            summed = dealt.mapPartitions(task)
            total = (summed.treeReduce(np.add) if deep else sum(summed.collect())) / n
            return float(total[0]), total[1:]

        return minimise(of, start, max_iter, tol)
    finally:
        held.unpersist()
        if path := held.getCheckpointFile():
            remove_path(data.sparkSession, path)


class PerceptronClassifier(Estimator, HasFeaturesCol, HasLabelCol, HasMaxIter, HasTol, HasSeed,
                           DefaultParamsReadable, DefaultParamsWritable):
    """``fit_weights`` as a pipeline stage; the fitted stage is Spark ML's
    ``MultilayerPerceptronClassificationModel`` with the weights found."""

    layers = Param(Params._dummy(), "layers", "widths, from the features to the classes", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", layers=None, maxIter=100, tol=1e-6, seed=None):
        super().__init__()
        self._setDefault(maxIter=100, tol=1e-6)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> MultilayerPerceptronClassificationModel:
        spark, layers = dataset.sparkSession, self.getOrDefault(self.layers)
        start = _model(spark, layers, seed=self.getSeed()).weights.toArray()
        weights, _ = fit_weights(dataset, self.getFeaturesCol(), self.getLabelCol(), layers, start,
                                 self.getMaxIter(), self.getTol())
        return _model(spark, layers, initialWeights=DenseVector(weights), featuresCol=self.getFeaturesCol(),
                      labelCol=self.getLabelCol())
