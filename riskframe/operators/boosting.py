"""Gradient boosted trees, grown from histograms of binned rows.

The method is that of Spark ML's ``GBTClassifier`` (logistic loss, variance
gain over at most ``maxBins`` bins a feature, a first tree on the labels, every
further one on the pseudo-residuals, its mean as a leaf's value), and the
fitted stage is Spark ML's own model. Spark finds the bins on a sample of
10,000 rows; here they come from all rows, exactly up to ``SUMMARY`` values a
feature, by ranks within n / ``SUMMARY`` a merge beyond that.

A level of a tree is one small job. Rows are held as blocks of bins (a byte a
feature), labels and margins, cut from their lineage, so a task reads neither
plans nor vectors before it starts; it leaves one histogram a node, feature and
bin. The driver holds one level's histograms, whatever the number of rows.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark import __version__ as SPARK_VERSION
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasSeed, HasStepSize
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import col
from ..session import ensure_checkpoint_dir, shared_path
from ..sources.tables import remove_path
from .passes import settle_worker

BLOCK_ROWS = 64 << 10   # rows of a block, and of a task as long as the cluster's cores suffice
PASS_TASKS = 32         # tasks of a level, or the cluster's cores if those are more
FLAT_BYTES = 64 << 20   # histograms that go straight to the driver; more are added up on the way
SUMMARY = 4096          # values kept a feature to place the cuts between bins
CHECKPOINT_ROUNDS = 10  # rounds between two checkpoints of the margins
PURE = np.finfo(float).eps  # a variance below this is none


# --- bins ------------------------------------------------------------------------

Counted = tuple[np.ndarray, np.ndarray]  # ascending values and how many rows each stands for


def _merged(parts: Sequence[Counted], size: int = SUMMARY) -> Counted:
    """The values of all parts; more than ``size`` are thinned to those at equal steps of rank and every one that is a step by itself."""
    values, at = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    counts = np.bincount(at, weights=np.concatenate([n for _, n in parts]), minlength=len(values))
    if len(values) <= size:
        return values, counts
    upto = np.cumsum(counts)
    step = np.floor(upto * ((size - 1) / 2) / upto[-1])
    heavy = counts * (size / 2) >= upto[-1]
    keep = heavy | np.append(step[1:] != step[:-1], True)
    keep[:-1] |= heavy[1:]  # a heavy value does not take its neighbour's rows
    keep[0] = True
    return values[keep], np.diff(upto[keep], prepend=0.0)


def _cuts(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between at most ``bins`` bins, placed as Spark ML places them."""
    middles = (values[:-1] + values[1:]) / 2.0
    if len(middles) < bins:
        return middles
    stride = counts.sum() / bins
    target, out = stride, []
    upto = np.cumsum(counts)
    for i in range(1, len(values)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append(middles[i - 1])
            target += stride
    return np.array(out)


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(labels, features) of a batch of a label and a list column."""
    y = batch.column(0).to_numpy(zero_copy_only=False)
    x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
    if not np.isin(y, (0.0, 1.0)).all():
        raise ValueError("labels must be 0 or 1")
    if np.isnan(x).any():
        raise ValueError("features with missing values")
    return y, x


def _find_cuts(rows: DataFrame, bins: int) -> tuple[int, list[np.ndarray]]:
    """The number of rows and each feature's cuts; one pass, a summary a task."""
    Summary = tuple[int, list[Counted]]

    def add(a: Summary, b: Summary) -> Summary:
        return a[0] + b[0], [_merged([p, q]) for p, q in zip(a[1], b[1])] if a[1] and b[1] else a[1] or b[1]

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Summary = (0, [])
        for batch in batches:
            if batch.num_rows:
                y, x = _rows(batch)
                total = add(total, (len(y), [_merged([(c, np.ones(len(c)))]) for c in x.T]))
        n = [len(v) for v, _ in total[1]]
        flat = [a for part in total[1] for a in part]
        yield pa.RecordBatch.from_arrays(
            [pa.array([total[0]], pa.int64()), pa.array([n], pa.list_(pa.int64())),
             pa.array([np.concatenate(flat).tobytes() if flat else b""], pa.binary())], names=["n", "sizes", "values"])

    def read(r) -> Summary:
        ends = np.cumsum([s for n in r.sizes for s in (n, n)])[:-1]
        parts = np.split(np.frombuffer(r["values"]), ends) if r.sizes else []
        return r.n, list(zip(parts[::2], parts[1::2]))

    total = rows.mapInArrow(summarise, "n bigint, sizes array<bigint>, values binary").rdd.map(read).treeReduce(add)
    return total[0], [_cuts(v, n, bins) for v, n in total[1]]


# --- trees -----------------------------------------------------------------------

@dataclass
class Tree:
    """Nodes in the order they were made, the two children of a node side by side; a leaf has feature -1."""
    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)       # the left child has the bins up to this one
    left: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    stats: list[np.ndarray] = field(default_factory=list)  # rows, sum, sum of squares

    def add(self, stats: np.ndarray) -> int:
        for column, v in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.gain, -1.0), (self.stats, stats)):
            column.append(v)
        return len(self.feature) - 1

    def values(self) -> np.ndarray:
        s = np.array(self.stats)
        return s[:, 1] / s[:, 0]


Block = tuple[np.ndarray, np.ndarray, np.ndarray]  # bins (feature x row), labels -1 and 1, margins


def _nodes(bins: np.ndarray, shape: tuple[np.ndarray, np.ndarray, np.ndarray], levels: int) -> np.ndarray:
    """The node of every row, so many levels down."""
    feature, cut, left = shape
    rows = np.arange(bins.shape[1])
    flat, node = bins.ravel(), np.zeros(len(rows), np.int64)
    for _ in range(levels):
        f = feature[node]
        inner = f >= 0
        if inner.all():
            node = left[node] + (flat[f * len(rows) + rows] > cut[node])
        elif inner.any():
            here = np.flatnonzero(inner)
            at = node[here]
            node[here] = left[at] + (flat[f[here] * len(rows) + here] > cut[at])
        else:
            break
    return node


def _histograms(blocks: Iterator[Block], first: bool, shape: tuple, levels: int, slots: np.ndarray,
                bins: int) -> np.ndarray:
    """(node, feature, bin) sums of rows, targets and squares, of the nodes that have a slot."""
    out, count = None, int(slots.max()) + 1
    for b, y, margin in blocks:
        slot = slots[_nodes(b, shape, levels)]
        r = y if first else 4.0 * y / (1.0 + np.exp(np.minimum(2.0 * y * margin, 700.0)))
        if not (slot >= 0).all():
            here = np.flatnonzero(slot >= 0)
            slot, r, b = slot[here], r[here], b[:, here]
        if out is None:
            out = np.zeros((3, len(b), count * bins))
        base, squares = slot * bins, r * r
        for i, c in enumerate(b):
            at = base + c
            out[0, i] += np.bincount(at, minlength=count * bins)
            out[1, i] += np.bincount(at, weights=r, minlength=count * bins)
            out[2, i] += np.bincount(at, weights=squares, minlength=count * bins)
    return out


def _variance(s: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(s[0] > 0, (s[2] - s[1] * s[1] / s[0]) / s[0], 0.0)


def _split(tree: Tree, active: Sequence[int], sums: np.ndarray, widths: np.ndarray) -> list[int]:
    """Split the active nodes where their histograms gain most; the children that are not pure.

    ``sums`` is (3, feature, node, bin); ties go to the first feature, then the first bin."""
    below = np.cumsum(sums, axis=3)
    whole = below[..., -1:]
    above = whole - below
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _variance(whole) - below[0] / whole[0] * _variance(below) - above[0] / whole[0] * _variance(above)
    gain[(below[0] < 1) | (above[0] < 1) | (np.arange(sums.shape[3]) >= widths[:, None, None])] = -np.inf
    by_node = gain.transpose(1, 0, 2).reshape(len(active), -1)
    children = []
    for k, best in enumerate(by_node.argmax(axis=1)):
        if not by_node[k, best] > 0:
            continue
        f, cut = divmod(int(best), sums.shape[3])
        node, left, right = active[k], below[:, f, k, cut], above[:, f, k, cut]
        tree.feature[node], tree.cut[node], tree.gain[node] = f, cut, float(by_node[k, best])
        tree.left[node] = tree.add(left)
        tree.add(right)
        children += [tree.left[node] + i for i, s in enumerate((left, right)) if _variance(s) >= PURE]
    return children


def _grow(held: RDD, first: bool, depth: int, features: int, widths: np.ndarray, bins: int) -> Tree:
    """One tree on the labels (``first``) or on the residuals of the margins; a job a level."""
    tree = Tree()
    active: list[int] = [tree.add(np.zeros(3))]
    for level in range(depth):
        if not active:
            break
        shape = (np.array(tree.feature), np.array(tree.cut), np.array(tree.left))
        slots = np.full(len(tree.feature), -1)
        slots[active] = np.arange(len(active))
        size = (3, features, len(active) * bins)

        def task(blocks: Iterator[Block], shape=shape, slots=slots, level=level) -> Iterator[np.ndarray]:
            sums = _histograms(blocks, first, shape, level, slots, bins)
            settle_worker()
            if sums is not None:
                yield sums

        parts = held.mapPartitions(task)
        deep = held.getNumPartitions() * 8 * int(np.prod(size)) > FLAT_BYTES
        sums = (parts.treeReduce(np.add) if deep else sum(parts.collect())).reshape(3, features, len(active), bins)
        if level == 0:
            tree.stats[0] = sums[:, 0, 0].sum(axis=1)
            if _variance(tree.stats[0]) < PURE:
                break
        active = _split(tree, active, sums, widths)
    return tree


def _levels(tree: Tree) -> int:
    depth = [0] * len(tree.feature)
    for i, f in enumerate(tree.feature):
        if f >= 0:
            depth[tree.left[i]] = depth[tree.left[i] + 1] = depth[i] + 1
    return max(depth)


def _moved(held: RDD, tree: Tree, rate: float) -> RDD:
    """The blocks with the tree added to their margins."""
    shape, values, levels = (np.array(tree.feature), np.array(tree.cut), np.array(tree.left)), rate * tree.values(), _levels(tree)

    def move(block: Block) -> Block:
        return block[0], block[1], block[2] + values[_nodes(block[0], shape, levels)]

    return held.map(move, preservesPartitioning=True)


def fit_trees(data: DataFrame, features_col: str, label_col: str, rounds: int, depth: int, rate: float,
              bins: int = 32) -> tuple[list[Tree], list[np.ndarray]]:
    """The trees (weights 1, rate, rate, ...) and the features' cuts. Labels are 0 and 1, features are present."""
    if not 2 <= bins <= 256:
        raise ValueError("2 to 256 bins")
    ensure_checkpoint_dir(data.sparkSession)
    rows = data.select(col(label_col).cast("double").alias("y"), vector_to_array(col(features_col)).alias("x"))
    n, cuts = _find_cuts(rows, bins)
    if not n:
        raise ValueError("no rows to fit on")

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                y, x = _rows(batch)
                b = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T)]).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([b.tobytes()], pa.binary()), pa.array([(2.0 * y - 1.0).tobytes()], pa.binary())],
                                                 names=["bins", "y"])

    def joined(parts: Iterator) -> Iterator[Block]:
        def block() -> Block:
            y = np.concatenate([a for _, a in waiting])
            return np.concatenate([b for b, _ in waiting], axis=1), y, np.zeros(len(y))

        waiting, size = [], 0
        for r in parts:
            y = np.frombuffer(r.y)
            if waiting and size + len(y) > BLOCK_ROWS:
                yield block()
                waiting, size = [], 0
            waiting.append((np.frombuffer(r.bins, np.uint8).reshape(len(cuts), -1), y))
            size += len(y)
        if waiting:
            yield block()

    packed = rows.mapInArrow(binned, "bins binary, y binary").rdd
    tasks = min(-(-n // BLOCK_ROWS), max(PASS_TASKS, packed.context.defaultParallelism))
    held = (packed.coalesce(tasks) if packed.getNumPartitions() > tasks else packed).mapPartitions(joined)
    widths, trees = np.array([len(c) for c in cuts]), []
    olds: list[RDD] = []     # held before the last one
    written: list[str] = []  # checkpoints, the last one in use
    try:
        for i in range(rounds):
            if i % CHECKPOINT_ROUNDS == 0:
                held = held.persist(StorageLevel.MEMORY_AND_DISK)
                held.checkpoint()
                held.count()
                written.append(held.getCheckpointFile())
                for path in written[:-1]:
                    remove_path(data.sparkSession, path)
                del written[:-1]
            trees.append(_grow(held, i == 0, depth, len(cuts), widths, bins))
            while olds:
                olds.pop().unpersist()
            olds = [held]
            if i + 1 < rounds:
                held = _moved(held, trees[-1], rate if i else 1.0).persist(StorageLevel.MEMORY_AND_DISK)
        return trees, cuts
    finally:
        for rdd in (*olds, held):
            rdd.unpersist()
        for path in written:
            remove_path(data.sparkSession, path)


# --- Spark ML's model -------------------------------------------------------------

_PREFIX = "org.apache.spark.ml."


def spark_model(spark: SparkSession, trees: Sequence[Tree], cuts: Sequence[np.ndarray], rate: float, uid: str,
                **params) -> GBTClassificationModel:
    """The trees as Spark ML's model, by its file format: built node by node through the gateway they would take minutes."""
    def metadata(kind: str, uid: str, params: dict, **more) -> str:
        return json.dumps({"class": _PREFIX + kind, "timestamp": int(time.time() * 1000), "sparkVersion": SPARK_VERSION,
                           "uid": uid, "paramMap": params, "defaultParamMap": {"impurity": "variance"}, **more})

    def nodes() -> pa.Table:
        of = lambda name, kind: pa.array([v for t in trees for v in getattr(t, name)], kind)
        stats = np.array([s for t in trees for s in t.stats])
        cut = [float(cuts[f][c]) if f >= 0 else None for t in trees for f, c in zip(t.feature, t.cut)]
        return pa.table({
            "treeID": pa.array([i for i, t in enumerate(trees) for _ in t.feature], pa.int32()),
            "id": pa.array([i for t in trees for i in range(len(t.feature))], pa.int32()),
            "n": stats[:, 0], "s": stats[:, 1], "q": stats[:, 2], "impurity": _variance(stats.T), "gain": of("gain", pa.float64()),
            "l": of("left", pa.int32()), "feature": of("feature", pa.int32()), "cut": pa.array(cut, pa.float64())})

    path = shared_path(spark, "boosted")
    inner = F.col("feature") >= 0
    data = spark.createDataFrame(nodes()).select("treeID", F.struct(
        "id", (F.col("s") / F.col("n")).alias("prediction"), "impurity", F.array("n", "s", "q").alias("impurityStats"),
        F.col("n").cast("long").alias("rawCount"), "gain", F.col("l").alias("leftChild"),
        F.when(inner, F.col("l") + 1).otherwise(-1).alias("rightChild"),
        F.struct(F.col("feature").alias("featureIndex"),
                 F.when(inner, F.array("cut")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
                 F.lit(-1).alias("numCategories")).alias("split")).alias("nodeData"))
    one = {k: v for k, v in params.items() if k in ("maxDepth", "seed")}
    members = [(i, metadata("regression.DecisionTreeRegressionModel", f"dtr_{uid}_{i}", one), rate if i else 1.0) for i in range(len(trees))]
    whole = metadata("classification.GBTClassificationModel", uid, params, numFeatures=len(cuts), numTrees=len(trees))
    try:
        data.coalesce(1).write.parquet(f"{path}/data")
        spark.createDataFrame(members, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        return GBTClassificationModel.load(path)
    finally:
        remove_path(spark, path)


class BoostedTreesClassifier(Estimator, HasFeaturesCol, HasLabelCol, HasMaxIter, HasStepSize, HasSeed,
                             DefaultParamsReadable, DefaultParamsWritable):
    """``fit_trees`` as a pipeline stage; the fitted stage is Spark ML's
    ``GBTClassificationModel``. Nothing is drawn, so the seed is only handed on."""

    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", maxIter=20, maxDepth=5, maxBins=32, stepSize=0.1, seed=None):
        super().__init__()
        self._setDefault(maxIter=20, maxDepth=5, maxBins=32, stepSize=0.1)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        get = self.getOrDefault
        trees, cuts = fit_trees(dataset, self.getFeaturesCol(), self.getLabelCol(), self.getMaxIter(), get(self.maxDepth),
                                self.getStepSize(), get(self.maxBins))
        return spark_model(dataset.sparkSession, trees, cuts, self.getStepSize(), self.uid,
                           featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), maxIter=self.getMaxIter(),
                           maxDepth=get(self.maxDepth), maxBins=get(self.maxBins), stepSize=self.getStepSize(), seed=self.getSeed())
