"""Standardisation with the population standard deviation.

``ml.feature.StandardScaler`` divides by the sample deviation; the
reference divides by the population one, so this is our own estimator.
Fit = one aggregate (map-side partial sums, a one-row result); apply =
literal arithmetic in one projection. Both are Spark ML stages, so a scaler
and a model save and load together as one ``PipelineModel``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import NUMERIC_COLUMNS
from ..functions.expressions import col, present


def check_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """A missing numeric column is a hard error naming all of them."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns to standardise are missing: {missing}")


class _ScalerParams(HasInputCols, HasOutputCols):
    means = Param(Params._dummy(), "means", "fitted means", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "fitted population stds", TypeConverters.toListFloat)

    def _out_cols(self) -> list[str]:
        if self.isDefined(self.outputCols):
            return list(self.getOutputCols())
        return list(self.getInputCols())


class PopulationStandardScaler(Estimator, _ScalerParams, DefaultParamsReadable,
                               DefaultParamsWritable):
    """(x - mean) / population std; missing values (null, NaN) are ignored in the fit and null after it;
    zero variance divides by 1 (so a constant column becomes 0)."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "PopulationStandardScalerModel":
        cols = list(self.getInputCols())
        check_columns(dataset, cols)
        aggs = []
        for i, c in enumerate(cols):
            x = present(col(c))
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
        row = dataset.agg(*aggs).first()   # one row, bounded by len(cols)
        means = [row[f"m{i}"] for i in range(len(cols))]
        stds = [row[f"s{i}"] for i in range(len(cols))]
        model = PopulationStandardScalerModel(inputCols=cols, outputCols=self._out_cols())
        model._set(means=[float("nan") if m is None else m for m in means],
                   stds=[float("nan") if s is None else s for s in stds])
        return model


class PopulationStandardScalerModel(Model, _ScalerParams, DefaultParamsReadable,
                                    DefaultParamsWritable):

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, means=None, stds=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def expressions(self) -> dict:
        out = {}
        for src, dst, m, s in zip(self.getInputCols(), self._out_cols(),
                                  self.getOrDefault(self.means), self.getOrDefault(self.stds)):
            if m != m:  # no non-null value in the fit: nothing to centre on
                out[dst] = F.lit(None).cast("double")
                continue
            divisor = s if (s == s and s > 0.0) else 1.0
            out[dst] = (present(col(src)) - F.lit(m)) / F.lit(divisor)
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns(self.expressions())

    def fitted(self) -> dict[str, tuple[float, float]]:
        return {c: (m, s) for c, m, s in zip(self.getInputCols(),
                                             self.getOrDefault(self.means),
                                             self.getOrDefault(self.stds))}


def standardise(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS,
                fit_on: DataFrame | None = None) -> DataFrame:
    """Fit on ``fit_on`` (default: the whole table, the reference's
    behaviour) and apply to ``df`` in place."""
    cols = list(columns)
    check_columns(df, cols)
    model = PopulationStandardScaler(inputCols=cols).fit(fit_on if fit_on is not None else df)
    return model.transform(df)


def standardise_lazily(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS,
                       fit_on: DataFrame | None = None) -> DataFrame:
    """P6 / T4 as one plan without an eager fit: the statistics of ``fit_on``
    (default: the table) are a scalar subquery (one struct, from a single
    aggregate). The values are those of ``standardise``; nothing runs before an action."""
    cols = list(columns)
    check_columns(df, cols)
    source = fit_on if fit_on is not None else df
    stats = source.agg(*[e for i, c in enumerate(cols) for e in (
        F.avg(present(col(c))).alias(f"m{i}"), F.stddev_pop(present(col(c))).alias(f"s{i}"))])
    one = stats.select(F.struct(*[F.col(f"{a}{i}") for i in range(len(cols)) for a in "ms"]).alias("_stats"))
    scaled = {c: (present(col(c)) - F.col(f"_stats.m{i}"))
              / F.when(F.col(f"_stats.s{i}") > 0, F.col(f"_stats.s{i}")).otherwise(F.lit(1.0)) for i, c in enumerate(cols)}
    return df.withColumn("_stats", one.scalar()).withColumns(scaled).drop("_stats")
