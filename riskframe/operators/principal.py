"""F10 for wide tables: principal components from products with the rows.

``ml.feature.PCA`` brings the d x d covariance to the driver. Here a pass
multiplies the covariance with a block of ``BLOCK`` vectors instead, without
forming it: only d x ``BLOCK`` numbers leave the tasks. The products span a
growing subspace (block Lanczos), whose own small eigenproblem gives the
components; the search ends when they satisfy the eigenvalue equation to the
tolerance. The subspace is cut back to the best vectors when it reaches
``MOST`` of them, so the driver holds d x ``MOST`` numbers, whatever d.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import col
from .gram import summed

BLOCK = 8
MOST = 96


@dataclass(frozen=True)
class Components:
    vectors: np.ndarray    # d x k, of the standardised columns; largest loading positive
    explained: np.ndarray  # share of the total variance
    mean: np.ndarray
    std: np.ndarray        # sample deviation, 1 for a constant column
    passes: int


def _orthonormal(w: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal vectors of the part of w that lies outside ``against`` (orthonormal)."""
    for _ in range(2):
        w = w - against @ (against.T @ w)
    u, size, _ = np.linalg.svd(w, full_matrices=False)
    return u[:, size > 1e-10 * max(1.0, size.max(initial=0.0))]


def fit_components(df: DataFrame, vector_col: str, k: int = 2, tol: float = 1e-10, max_passes: int = 200,
                   seed: int = 42) -> Components:
    """The first ``k`` components of an array column of equally long vectors.

    Columns are centred and divided by their sample deviation (a constant one
    counts as 0). Vectors that are null, of another length than the longest,
    or hold a null, NaN or infinity are left out. Fewer than two vectors
    have no components: shares 0."""
    data = df.select(col(vector_col).cast("array<double>").alias("v"))
    d = data.agg(F.max(F.size("v"))).first()[0] or 0
    data = data.where(F.size("v") == d)
    if d <= 0:
        return Components(np.zeros((0, 0)), np.zeros(0), np.zeros(0), np.zeros(0), 0)
    first = summed(data, lambda x: np.append(x.sum(axis=0), len(x)), d + 1)
    n = first[-1]
    mean = first[:-1] / max(n, 1.0)
    square = summed(data, lambda x: ((x - mean) ** 2).sum(axis=0), d)
    std = np.sqrt(square / max(n - 1, 1.0))
    live = std > 1e-12 * np.maximum(1.0, np.abs(mean))
    std = np.where(live, std, 1.0)
    k = min(k, d)

    def product(v: np.ndarray) -> np.ndarray:
        def of(x: np.ndarray) -> np.ndarray:
            z = (x - mean) / std * live
            return (z.T @ (z @ v)).ravel()
        return summed(data, of, v.size).reshape(v.shape) / max(n - 1, 1.0)

    total = float(live.sum())
    if n < 2 or not total:
        return Components(np.eye(d)[:, :k], np.zeros(k), mean, std, 2)
    rng = np.random.default_rng(seed)
    new = _orthonormal(rng.normal(size=(d, min(d, max(BLOCK, k)))), np.zeros((d, 0)))
    basis, image, passes = np.zeros((d, 0)), np.zeros((d, 0)), 2
    while True:
        basis, image, passes = np.hstack([basis, new]), np.hstack([image, product(new)]), passes + 1
        small = basis.T @ image
        value, y = np.linalg.eigh((small + small.T) / 2)
        value, y = value[::-1], y[:, ::-1]
        rest = image @ y[:, :k] - basis @ y[:, :k] * value[:k]
        if np.linalg.norm(rest, axis=0).max() <= tol * max(value[0], 1e-300) or basis.shape[1] >= d or passes >= max_passes:
            break
        new = _orthonormal(image[:, -new.shape[1]:], basis)
        if not new.shape[1]:
            break  # the subspace holds its own products: nothing to add
        if basis.shape[1] + new.shape[1] > max(MOST, 2 * k):
            keep = y[:, :max(k, BLOCK) + BLOCK]
            basis, image = basis @ keep, image @ keep
            new = _orthonormal(rest, basis) if np.linalg.norm(rest) else new
    vectors = basis @ y[:, :k]
    size = np.abs(vectors)
    vectors = vectors * np.sign(vectors[(size >= size.max(axis=0) - 1e-9).argmax(axis=0), range(k)])
    return Components(vectors, np.maximum(value[:k], 0.0) / total, mean, std, passes)


def project(df: DataFrame, vector_col: str, fit: Components, keep: Sequence[str] = ()) -> DataFrame:
    """The kept columns and pc1, pc2, ...: one projection, JVM-side; null for vectors the fit leaves out."""
    v = col(vector_col).cast("array<double>")
    weight = fit.vectors / fit.std[:, None]
    whole = (F.size(v) == len(fit.mean)) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    out = []
    for j in range(weight.shape[1]):
        terms = F.zip_with(v, F.array(*[F.lit(float(w)) for w in weight[:, j]]), lambda x, w: x * w)
        score = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t) - F.lit(float(fit.mean @ weight[:, j]))
        out.append(F.when(whole, score).alias(f"pc{j + 1}"))
    return df.select(*[col(c) for c in keep], *out)


def variance_table(df: DataFrame, fit: Components) -> DataFrame:
    """(component, explained, cumulative)."""
    return df.sparkSession.createDataFrame(
        [(i + 1, float(e), float(c)) for i, (e, c) in enumerate(zip(fit.explained, np.cumsum(fit.explained)))],
        "component int, explained double, cumulative double")
