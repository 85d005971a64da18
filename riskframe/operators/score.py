"""Batch scoring.

Scoring is narrow: ``PipelineModel.transform`` + one ``select``. No
shuffle, no Python per row; it works unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.constants import (DECISION_THRESHOLD, DISPLAY_DECIMALS, FEATURES_VEC,
                                   LABEL_COLUMN, RISK_TIERS, UNDETERMINED)
from ..functions.expressions import (col, conclusion, display_round, logistic,
                                     present, threshold_label, tier)

SCORE_COLUMNS = ("probability", "pred_label", "conclusion", "risk_tier")
TRUTH_COLUMNS = ("true_label", "correct")


class LinearLogitScorer(Transformer, HasOutputCol, DefaultParamsReadable,
                        DefaultParamsWritable):
    """A fixed-coefficient logistic scorer: p = 1 / (1 + exp(-(b0 + sum b_i x_i))).

    Used where coefficients are given rather than fitted (exact oracle twins
    of scoring). Writes a double column; null inputs give null."""
    featureCols = Param(Params._dummy(), "featureCols", "feature columns",
                        TypeConverters.toListString)
    coefficients = Param(Params._dummy(), "coefficients", "weights", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "bias", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featureCols=None, coefficients=None, intercept=0.0,
                 outputCol="probability"):
        super().__init__()
        self._setDefault(intercept=0.0, outputCol="probability")
        self._set(**self._input_kwargs)

    def logit(self) -> Column:
        z = F.lit(self.getOrDefault(self.intercept))
        for c, b in zip(self.getOrDefault(self.featureCols), self.getOrDefault(self.coefficients)):
            z = z + F.lit(b) * col(c).cast("double")
        return z

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), logistic(self.logit()))


def positive_probability(df: DataFrame, probability_col: str = "probability",
                         prediction_col: str = "prediction") -> Column:
    """K4: the positive-class probability; a model without probabilities
    gives its prediction as a float."""
    if probability_col in df.columns:
        dtype = df.schema[probability_col].dataType
        if isinstance(dtype, (DoubleType, FloatType)):
            return col(probability_col).cast("double")
        arr = vector_to_array(col(probability_col))
        # a one-column probability is the positive class itself
        return F.when(F.size(arr) > 1, arr[1]).otherwise(arr[0])
    if prediction_col in df.columns:
        return col(prediction_col).cast("double")
    raise KeyError(f"neither {probability_col!r} nor {prediction_col!r} in {df.columns}")


def score_columns(p: Column, label: Column | None = None,
                  threshold: float = DECISION_THRESHOLD,
                  tiers=RISK_TIERS, decimals: int = DISPLAY_DECIMALS) -> dict[str, Column]:
    """P10-P14 as named expressions over an exact probability ``p``.

    The label and the row tier always use the unrounded value; only the
    displayed probability is rounded. A missing probability (null or NaN)
    has no label, conclusion or correctness, and the undetermined tier."""
    p = present(p)
    pred = threshold_label(p, threshold)
    out = {
        "probability": display_round(p, decimals),
        "pred_label": pred,
        "conclusion": conclusion(pred),
        "risk_tier": tier(p, tiers, UNDETERMINED),
    }
    if label is not None:
        truth = label.cast("int")
        out["true_label"] = truth
        out["correct"] = pred == truth
    return out


def score_frame(model: Transformer, df: DataFrame, label_col: str = LABEL_COLUMN,
                feature_cols: Sequence[str] | None = None,
                keep_cols: Sequence[str] = (), threshold: float = DECISION_THRESHOLD,
                tiers=RISK_TIERS, keep_exact: bool = False) -> DataFrame:
    """K1: drop the label -> model (scaler inside it if needed, K3) ->
    probability -> P10-P15 in the reference's column order: kept columns,
    features, probability, pred_label, conclusion, risk_tier,
    [true_label, correct]."""
    has_label = label_col in df.columns
    features = list(feature_cols) if feature_cols is not None else \
        [c for c in df.columns if c != label_col and c not in keep_cols]
    # the label goes along under a private name so no stage can read it
    hidden = "__truth__"
    base = df.withColumnRenamed(label_col, hidden) if has_label else df
    scored = model.transform(base)
    p = positive_probability(scored)
    if FEATURES_VEC in scored.columns and FEATURES_VEC not in df.columns:
        # a row with a missing feature is not scored, whatever the model makes of NaN
        missing = F.exists(vector_to_array(col(FEATURES_VEC)), F.isnan)
        p = F.when(~missing, p)
    exprs = score_columns(p, F.col(hidden) if has_label else None, threshold, tiers)
    select = [col(c) for c in keep_cols] + [col(c) for c in features]
    select += [e.alias(n) for n, e in exprs.items()]
    if keep_exact:
        select.append(p.alias("probability_exact"))
    return scored.select(*select)


def score_records(spark: SparkSession, model: Transformer, records: Sequence[dict],
                  **kwargs) -> DataFrame:
    """K5: score records given as dicts through the same batch path (K1)."""
    return score_frame(model, spark.createDataFrame(list(records)), **kwargs)
