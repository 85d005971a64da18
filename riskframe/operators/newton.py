"""T5: weighted logistic regression by Newton steps.

Each step solves the weighted normal equations: one pass adds up the gradient
and the (k + 1) x (k + 1) curvature of the loss, and the step is their
quotient. A dozen steps reach the optimum to machine precision, where a
first-order optimiser needs a pass for each of hundreds. Only the sums leave
the tasks, so the driver holds k^2 numbers whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasMaxIter, HasTol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import col
from .gram import summed
from .score import LinearLogitScorer

HALVINGS = 30  # of a step that raises the loss


@dataclass(frozen=True)
class LogisticFit:
    coefficients: np.ndarray
    intercept: float
    loss: float       # sum of w * log loss + penalty / 2 * |b|^2
    steps: int        # passes that moved the coefficients
    converged: bool   # the last step was below the tolerance


def _sums(data: DataFrame, b: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(loss, gradient, curvature) of the complete rows (y, w, x...) at the coefficients b (intercept first)."""
    k = len(b)

    def of(rows: np.ndarray) -> np.ndarray:
        y, w = rows[:, 0], rows[:, 1]
        x = np.column_stack([np.ones(len(y)), rows[:, 2:]])
        z = x @ b
        p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
        return np.concatenate(([w @ (np.logaddexp(0.0, z) - y * z)], x.T @ (w * (p - y)),
                               (x.T @ (x * (w * p * (1 - p))[:, None])).ravel()))

    out = summed(data, of, 1 + k + k * k)
    return float(out[0]), out[1:1 + k], out[1 + k:].reshape(k, k)


def fit_logistic(df: DataFrame, features: Sequence[str], label_col: str, weight_col: str | None = None,
                 penalty: float = 1.0, max_steps: int = 50, tol: float = 1e-12) -> LogisticFit:
    """Minimise sum w * log loss + penalty / 2 * |b|^2 (the intercept is free).

    Rows with a missing value (null, NaN, infinity) are left out. Stops when a step no longer
    moves the coefficients (relative to their size) or ``max_steps`` is
    reached. Without penalty, separable classes have no finite optimum: the
    steps then end at ``max_steps`` or when the curvature vanishes, and
    ``converged`` is false."""
    weight = col(weight_col).cast("double") if weight_col else F.lit(1.0)
    data = df.select(col(label_col).cast("double").alias("y"), weight.alias("w"),
                     *[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    k = len(features) + 1
    ridge = np.full(k, float(penalty))
    ridge[0] = 0.0

    def at(b: np.ndarray):
        loss, g, h = _sums(data, b)
        return loss + 0.5 * float(ridge @ (b * b)), g + ridge * b, h + np.diag(ridge)

    b = np.zeros(k)
    loss, g, h = at(b)
    steps, converged = 0, not np.any(h)
    while steps < max_steps and not converged:
        if np.linalg.matrix_rank(h) < k and not np.any(h[1:, 1:]):
            break
        move = np.linalg.lstsq(h, -g, rcond=None)[0]
        for _ in range(HALVINGS):
            after = at(b + move)
            if after[0] <= loss + 1e-12 * abs(loss):
                break
            move /= 2
        else:
            break  # no step lowers the loss any more
        b, steps = b + move, steps + 1
        loss, g, h = after
        converged = bool(np.abs(move).max() <= tol * max(1.0, np.abs(b).max()))
    return LogisticFit(b[1:], float(b[0]), loss, steps, converged)


class NewtonLogisticRegression(Estimator, HasLabelCol, HasWeightCol, HasMaxIter, HasTol,
                               DefaultParamsReadable, DefaultParamsWritable):
    """``fit_logistic`` as a pipeline stage over named columns; the fitted
    stage is a ``LinearLogitScorer`` (one JVM expression, saved with Spark ML's writer)."""

    featureCols = Param(Params._dummy(), "featureCols", "feature columns", TypeConverters.toListString)
    penalty = Param(Params._dummy(), "penalty", "weight of |b|^2 / 2", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featureCols=None, labelCol="label", weightCol=None, penalty=1.0, maxIter=50, tol=1e-12):
        super().__init__()
        self._setDefault(labelCol="label", penalty=1.0, maxIter=50, tol=1e-12)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> LinearLogitScorer:
        features = self.getOrDefault(self.featureCols)
        weight = self.getWeightCol() if self.isDefined(self.weightCol) else None
        fit = fit_logistic(dataset, features, self.getLabelCol(), weight, self.getOrDefault(self.penalty),
                           self.getMaxIter(), self.getTol())
        return LinearLogitScorer(featureCols=features, coefficients=[float(c) for c in fit.coefficients],
                                   intercept=fit.intercept)
