"""Feature construction and selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expressions import col, r6
from .gram import column_means, doubles, gram, summed


def bin_expr(c: Column, edges: Sequence[float]) -> Column:
    """Fixed-edge binning: bin i when edges[i-1] <= x < edges[i]; below the
    first edge 0, at or above the last edge len(edges). Null stays null."""
    expr = None
    for i, e in enumerate(edges):
        cond = c < F.lit(e)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return F.when(c.isNull(), F.lit(None).cast("int")).otherwise(
        expr.otherwise(F.lit(len(edges)))).cast("int")


def composite_features(df: DataFrame, spec: Mapping[str, Column], keep: Sequence[str] = ()
                       ) -> DataFrame:
    """a declarative list of named expressions (sums of flags, ANDs,
    products, bins) evaluated in one projection."""
    return df.select(*[col(k) for k in keep], *[e.alias(n) for n, e in spec.items()])


# --- F9, F11, S6 ------------------------------------------------------------------------

def combined_ranking(scores: Mapping[str, DataFrame], abs_scores: Sequence[str] = ()
                     ) -> DataFrame:
    """each score table ``(feature, <score>)`` ranked descending (ties
    share a rank; scores compared at 6 decimals so engines agree), the mean
    rank, and a final order by mean rank then feature name.

    All windows here run over k feature rows, never over data rows."""
    # one union + one groupBy (a single small shuffle) instead of a chain of
    # full outer joins
    parts = None
    for name, table in scores.items():
        s = F.col(name)
        s = F.abs(s) if name in abs_scores else s
        t = table.select("feature", F.lit(name).alias("_name"), r6(s).alias("_score"))
        parts = t if parts is None else parts.unionByName(t)
    joined = parts.groupBy("feature").agg(
        *[F.max(F.when(F.col("_name") == n, F.col("_score"))).alias(f"_{n}") for n in scores])
    w = Window.partitionBy()
    ranks = {f"{n}_rank": F.rank().over(w.orderBy(F.col(f"_{n}").desc_nulls_last()))
             for n in scores}
    ranked = joined.select("feature", *[e.alias(k) for k, e in ranks.items()])
    mean = sum((F.col(k) for k in ranks), F.lit(0)) / F.lit(float(len(ranks)))
    ranked = ranked.withColumn("mean_rank", r6(mean))
    return ranked.withColumn(
        "final_rank", F.row_number().over(w.orderBy("mean_rank", "feature")).cast("int"))


def recommend(ranking: DataFrame, top_n: int) -> DataFrame:
    """``(feature, final_rank, recommended)``: the first ``top_n``."""
    return ranking.select("feature", "final_rank",
                          (F.col("final_rank") <= F.lit(top_n)).alias("recommended"))


def recommended_table(df: DataFrame, recommendation: DataFrame, label_col: str,
                      keep: Sequence[str] = ()) -> DataFrame:
    """the recommended feature set as a table (kept columns, features in
    rank order, label). The feature names (k rows) come to the driver to
    build the projection."""
    names = [r["feature"] for r in recommendation.where("recommended")
             .orderBy("final_rank").collect()]
    return df.select(*[col(n) for n in [*keep, *names]], col(label_col))


def field_dictionary(spark: SparkSession, recommendation: DataFrame,
                     descriptions: Mapping[str, str]) -> DataFrame:
    """Each feature, its explanation and the recommended flag. The
    description spec is a small literal table (broadcast)."""
    spec = spark.createDataFrame(list(descriptions.items()), "feature string, description string")
    return recommendation.join(F.broadcast(spec), "feature", "left").select(
        "feature", "description", "recommended")


# --- F8 -----------------------------------------------------------------------------

def solve_lasso(corr: np.ndarray, c: np.ndarray, alpha: float, max_sweeps: int = 1_000_000,
                tol: float = 1e-12) -> np.ndarray:
    """Coordinate descent for 1/2 b'Rb - c'b + alpha |b|_1 on the k x k system
    (zero rows of R: constant features, coefficient 0). Sweeps over all
    features alternate with sweeps over the nonzero ones until they settle."""
    b, live = np.zeros(len(c)), np.flatnonzero(np.diag(corr) > 0)
    every = True
    for _ in range(max_sweeps):
        step = 0.0
        for j in live if every else live[b[live] != 0]:
            rho = c[j] - corr[j] @ b + corr[j, j] * b[j]
            new = np.sign(rho) * max(abs(rho) - alpha, 0.0) / corr[j, j]
            step = max(step, abs(new - b[j]))
            b[j] = new
        if step <= tol:
            if every:
                return b
            every = True  # settled on the nonzero ones: look at all again
        else:
            every = False
    raise ValueError(f"lasso did not converge in {max_sweeps} sweeps")


def lasso_selection(df: DataFrame, features: Sequence[str], label: Column,
                    alpha: float = 0.01, max_sweeps: int = 1_000_000,
                    tol: float = 1e-12) -> DataFrame:
    """F8: L1 linear regression on population-standardised features, the
    usual objective 1/(2n) RSS + alpha |b|_1 with an intercept; a zero
    coefficient drops the feature. Returns (feature, coefficient, lasso,
    selected); lasso is the coefficient's size.

    The objective depends on the data only through the covariances of the
    features and the label, so the rows are read for ``gram``'s tiles and
    never again: hundreds of features are one pass. Coordinate descent runs
    on the k x k system on the driver. Rows with a missing value (null, NaN
    or infinity) are left out; constant features and tables without rows get
    coefficient 0."""
    names = [f"x{i}" for i in range(len(features))]
    data = df.select(*[col(c).alias(n) for c, n in zip(features, names)], label.cast("double").alias("y"))
    g = gram(data, [*names, "y"])
    sd = np.sqrt(np.diag(g.cov)[:-1])
    scale = np.where(sd > 0, sd, 1.0)
    b = solve_lasso(g.cov[:-1, :-1] / np.outer(scale, scale), g.cov[:-1, -1] / scale, alpha, max_sweeps, tol)
    return df.sparkSession.createDataFrame(
        [(f, float(v), float(abs(v)), bool(v != 0.0)) for f, v in zip(features, b)],
        "feature string, coefficient double, lasso double, selected boolean")


def lasso_certificate(df: DataFrame, features: Sequence[str], label: Column, solution: DataFrame,
                      alpha: float = 0.01) -> DataFrame:
    """Proof that ``solution`` is the lasso's: (feature, coefficient, gradient, gap).

    ``gradient`` is the mean of standardised feature times residual, from the
    residuals of the rows themselves (three passes, no pair sums).
    Optimal means: equal to alpha with the coefficient's sign, or at most
    alpha in size where the coefficient is 0; ``gap`` is by how much it fails."""
    k, held = len(features), {r["feature"]: r["coefficient"] for r in solution.collect()}  # a row a feature
    b = np.array([held[c] for c in features])
    names = [f"x{i}" for i in range(k)]
    data = doubles(df.select(*[col(c).alias(n) for c, n in zip(features, names)], label.cast("double").alias("y")), [*names, "y"])
    mean = column_means(data, complete=True)
    squares = summed(data, lambda x: np.append(((x - mean) ** 2).sum(axis=0), len(x)), k + 2)
    rows = max(squares[-1], 1.0)
    sd = np.sqrt(squares[:k] / rows)
    scale = np.where(sd > 0, sd, 1.0)

    def of(x: np.ndarray) -> np.ndarray:
        z = (x[:, :k] - mean[:k]) / scale
        return z.T @ (x[:, k] - mean[k] - z @ b)

    g = summed(data, of, k) / rows
    gap = np.where(b != 0, np.abs(g - alpha * np.sign(b)), np.maximum(np.abs(g) - alpha, 0.0))
    return df.sparkSession.createDataFrame(
        [(c, float(v), float(t), float(e)) for c, v, t, e in zip(features, b, g, gap)],
        "feature string, coefficient double, gradient double, gap double")


# --- F10 ----------------------------------------------------------------------------

def pca_projection(df: DataFrame, vector_col: str, k: int = 2, key: str | None = None,
                   is_array: bool = True) -> tuple[DataFrame, DataFrame]:
    """centre + scale, then ``ml.feature.PCA`` (which does not centre
    by itself). Returns the k-d projection and ``(component, explained,
    cumulative)``. Each component's sign is fixed so its largest loading (the
    first of equally large ones) is positive (k x d numbers on the driver)."""
    src = df.select(*([col(key)] if key else []),
                    (array_to_vector(col(vector_col)) if is_array else col(vector_col)).alias("_v"))
    scaler = StandardScaler(inputCol="_v", outputCol="_z", withMean=True, withStd=True).fit(src)
    z = scaler.transform(src)
    model = PCA(k=k, inputCol="_z", outputCol="_pc").fit(z)
    pc = model.pc.toArray()
    size = np.abs(pc)
    signs = np.sign(pc[(size >= size.max(axis=0) - 1e-9).argmax(axis=0), range(pc.shape[1])])
    signs[signs == 0] = 1.0
    arr = vector_to_array(F.col("_pc"))
    proj = model.transform(z).select(*([col(key)] if key else []),
                    *[(arr[i] * F.lit(float(signs[i]))).alias(f"pc{i + 1}") for i in range(k)])
    ev = [float(v) for v in model.explainedVariance.toArray()]
    cum = list(np.cumsum(ev))
    spark = df.sparkSession
    variance = spark.createDataFrame(
        [(i + 1, ev[i], float(cum[i])) for i in range(k)],
        "component int, explained double, cumulative double")
    return proj, variance
