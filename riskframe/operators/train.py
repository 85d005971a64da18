"""Model training, persistence and choice.

Each registered model is one ``Pipeline``: [population scaler (LR and MLP
only, fitted on training rows: T4/K3)] -> VectorAssembler -> estimator.
Fitted, it is one ``PipelineModel`` saved with Spark ML's writer, so the
scaler can never be separated from its model.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..functions.constants import FEATURES_VEC
from ..functions.expressions import col, present
from ..session import ensure_checkpoint_dir
from ..sources.tables import path_exists
from .boosting import BoostedTreesClassifier
from .newton import NewtonLogisticRegression
from .perceptron import PerceptronClassifier
from .scale import PopulationStandardScaler
from .split import with_weights

# Every estimator pass runs one task per partition. Passes are bound by
# computation (a row of 100 bytes costs a network step 20 to 100 us), so sets
# of some thousand rows are already dealt out, to ``SPREAD`` tasks; larger
# sets get more tasks when each would hold more than a task's share in bytes.
TRAIN_PARTITION_BYTES = 4 << 20
SPREAD_BYTES = 128 << 10
SPREAD = 16
LABEL = "label"
WEIGHT = "weight"
# registered models fitted at the same time (as CrossValidator's parallelism)
FIT_PARALLELISM = 5


@dataclass(frozen=True)
class ModelSpec:
    key: str
    name: str
    needs_scaler: bool
    weighted: bool


# registry order matters: ties in the comparison and the fallback in
# ``load_model`` follow it. Settings are the reference's stated ones.
REGISTRY = OrderedDict((s.key, s) for s in (
    ModelSpec("logistic", "Logistic Regression", True, True),
    ModelSpec("random_forest", "Random Forest", False, True),
    ModelSpec("boosted_deep", "Boosted Trees (150 x depth 8)", False, False),
    ModelSpec("boosted_shallow", "Boosted Trees (100 x depth 5)", False, False),
    ModelSpec("mlp", "Neural Net (256-128-64)", True, False),
))
DEFAULT_MODEL = "boosted_shallow"


def _estimator(key: str, cols: Sequence[str], seed: int, max_iter_scale: float = 1.0):
    it = lambda n: max(1, int(round(n * max_iter_scale)))
    if key == "logistic":
        # 1/2 |b|^2 + C * sum of w * loss with C = 1
        return NewtonLogisticRegression(featureCols=list(cols), labelCol=LABEL, weightCol=WEIGHT,
                                        penalty=1.0, maxIter=it(2000))
    if key == "random_forest":
        # 150 deep trees: keep node ids on the executors instead of shipping
        # the growing forest with every level pass (measured faster)
        return RandomForestClassifier(featuresCol=FEATURES_VEC, labelCol=LABEL, weightCol=WEIGHT,
                                      numTrees=it(150), maxDepth=10, seed=seed,
                                      cacheNodeIds=True, checkpointInterval=10)
    if key == "boosted_deep":
        return BoostedTreesClassifier(featuresCol=FEATURES_VEC, labelCol=LABEL, maxIter=it(150),
                                      maxDepth=8, stepSize=0.05, seed=seed)
    if key == "boosted_shallow":
        return BoostedTreesClassifier(featuresCol=FEATURES_VEC, labelCol=LABEL, maxIter=it(100),
                                      maxDepth=5, stepSize=0.03, seed=seed)
    if key == "mlp":
        return PerceptronClassifier(featuresCol=FEATURES_VEC, labelCol=LABEL,
                                    layers=[len(cols), 256, 128, 64, 2],
                                    maxIter=it(1000), seed=seed)
    raise KeyError(f"unknown model {key!r}; known: {list(REGISTRY)}")


def build_pipeline(key: str, features: Sequence[str], seed: int = 42,
                   max_iter_scale: float = 1.0) -> Pipeline:
    spec = REGISTRY[key]
    stages = []
    cols = list(features)
    if spec.needs_scaler:
        scaled = [f"_z_{c}" for c in cols]
        stages.append(PopulationStandardScaler(inputCols=cols, outputCols=scaled))
        cols = scaled
    stages.append(VectorAssembler(inputCols=cols, outputCol=FEATURES_VEC, handleInvalid="keep"))
    stages.append(_estimator(key, cols, seed, max_iter_scale))
    return Pipeline(stages=stages)


def training_partitions(size: int) -> int:
    """Partitions of ``size`` bytes of training rows; by the size only, so that fits are the same on any cluster."""
    return max(1, min(SPREAD, -(-size // SPREAD_BYTES)), -(-size // TRAIN_PARTITION_BYTES))


def prepare_training(train: DataFrame, features: Sequence[str], label_col: str,
                     key_col: str | None = None) -> DataFrame:
    """T3 + T10: label as double, balanced weights, partitioned by size and
    cached once for all models (every estimator iterates over it). The rows
    are checkpointed first: every task of a fit's thousands of small jobs is
    sent its rows' whole lineage, cached or not, and reads it before it starts.

    Missing features (null or NaN) are refused with their counts per column;
    rows without label are left out. The hash layout depends on the rows
    only, so seeded fits do not change with the input's files. It is by
    ``key_col``, a unique key, which deals out rows of equal features too;
    without a key by the features, and equal rows go together."""
    key = [col(key_col).alias("_key")] if key_col else []
    data = (train.select(*key, *[col(c) for c in features], train[label_col].cast("double").alias(LABEL))
            .where(F.col(LABEL).isNotNull()))
    gaps = data.agg(*[F.count_if(present(col(c)).isNull()).alias(f"n{i}") for i, c in enumerate(features)]).first()
    missing = {c: gaps[f"n{i}"] for i, c in enumerate(features) if gaps[f"n{i}"]}
    if missing:
        raise ValueError(f"features with missing values, impute or drop them first: {missing}")
    data, _, rows = with_weights(data, LABEL, WEIGHT, with_rows=True)
    width = 8 * (len(features) + 2)
    target = training_partitions(rows * width)
    by = [F.col("_key")] if key_col else [col(c) for c in features]
    data = data.repartition(target, *by).sortWithinPartitions(*by)
    ensure_checkpoint_dir(data.sparkSession)
    return data.drop("_key").checkpoint().persist(StorageLevel.MEMORY_AND_DISK)


def train_models(train: DataFrame, features: Sequence[str], label_col: str,
                 keys: Sequence[str] | None = None, seed: int = 42,
                 max_iter_scale: float = 1.0,
                 parallelism: int = FIT_PARALLELISM,
                 key_col: str | None = None) -> dict[str, PipelineModel]:
    """Fit every registered model (or ``keys``) on one cached set.

    Each fit is a chain of small jobs (one per tree level, boosting round or
    optimiser step) whose tasks often do not fill the cluster, so up to
    ``parallelism`` fits are submitted at once from driver threads, as
    ``CrossValidator`` does; the scheduler interleaves their jobs. Results
    are independent of the order in which jobs run."""
    keys = list(keys or REGISTRY)
    data = prepare_training(train, features, label_col, key_col)
    spark = data.sparkSession

    def fit(key: str) -> PipelineModel:
        return build_pipeline(key, features, seed, max_iter_scale).fit(data)

    try:
        if parallelism <= 1 or len(keys) == 1:
            return {k: fit(k) for k in keys}
        with ThreadPoolExecutor(max_workers=min(parallelism, len(keys))) as pool:
            futures = {k: pool.submit(inheritable_thread_target(spark)(fit), k) for k in keys}
            return {k: futures[k].result() for k in keys}
    finally:
        data.unpersist()


def save_models(models: dict[str, PipelineModel], root: str) -> dict[str, str]:
    """One ``PipelineModel`` directory per registered key."""
    out = {}
    for key, m in models.items():
        path = f"{root.rstrip('/')}/{key}"
        m.write().overwrite().save(path)
        out[key] = path
    return out


def load_model(spark: SparkSession, root: str, key: str = DEFAULT_MODEL
               ) -> tuple[str, PipelineModel]:
    """K2: the requested model; unknown key -> KeyError; not saved -> the
    first saved one in registry order; none saved -> FileNotFoundError.
    Returns the key actually used."""
    if key not in REGISTRY:
        raise KeyError(f"unknown model {key!r}; known: {list(REGISTRY)}")
    for k in [key] + [k for k in REGISTRY if k != key]:
        path = f"{root.rstrip('/')}/{k}"
        if path_exists(spark, path):
            return k, PipelineModel.load(path)
    raise FileNotFoundError(f"no saved model under {root}")
