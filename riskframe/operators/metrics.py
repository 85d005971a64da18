"""Evaluation (E1-E10): every model evaluated in one pass over long-form
scores ``(model, label, score)``.

* E1-E5: one aggregate grouped by model (conditional counts, map-side
  partial aggregation; the shuffle carries k rows per task).
* E6-E7: exact AUC and ROC from distinct (model, score) counts and the
  range-split running sums of ``ordered.ordered_prefix``.
* E8-E9: joins and sorts over k-row tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import DECISION_THRESHOLD
from ..functions.expressions import col, present, r6, ratio, sql_string
from .ordered import DEFAULT_BUCKETS, ordered_prefix


def long_scores(df: DataFrame, scores: Mapping[str, Column], label: Column) -> DataFrame:
    """Stack per-model probability columns into ``(model, label, score)``
    so one job evaluates all models. A row that cannot be evaluated (label
    other than 0 and 1, missing score) fails the job, as the reference's
    metrics do: figures never cover part of the rows unsaid. Filter such
    rows first where that is meant."""
    names = list(scores)
    wide = (df.select(label.cast("int").alias("label"),
                            *[s.cast("double").alias(f"_s{i}")
                              for i, s in enumerate(scores.values())]))
    args = ", ".join(f"{sql_string(n)}, _s{i}" for i, n in enumerate(names))
    long = wide.selectExpr("label", f"stack({len(names)}, {args}) AS (model, score)")
    good = F.col("label").isin(0, 1) & present(F.col("score")).isNotNull()
    refuse = F.raise_error(F.lit("a row without a 0/1 label or without a score cannot be evaluated"))
    return long.select("model", F.when(F.coalesce(good, F.lit(False)), F.col("label")).otherwise(refuse.cast("int")).alias("label"), "score")


def confusion_counts(long: DataFrame, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """Per model: tp, fp, fn, tn (one aggregate)."""
    pred = F.col("score") >= F.lit(threshold)
    pos = F.col("label") == 1
    return long.groupBy("model").agg(
        F.count_if(pos & pred).alias("tp"), F.count_if(~pos & pred).alias("fp"),
        F.count_if(pos & ~pred).alias("fn"), F.count_if(~pos & ~pred).alias("tn"))


def confusion_matrix(long: DataFrame, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """Long form ``(model, truth, pred, n)``, always all four cells."""
    return confusion_counts(long, threshold).selectExpr(
        "model", "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (truth, pred, n)")


def confusion_from_scores(d: DataFrame, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """tp, fp, fn, tn per model from the distinct-score table of
    ``score_counts``; sharing that table with the AUC lets one scan and one
    exchange serve both."""
    hit = F.col("score") >= F.lit(threshold)
    z = F.lit(0).cast("long")
    return d.groupBy("model").agg(
        F.coalesce(F.sum(F.when(hit, F.col("pos"))), z).alias("tp"),
        F.coalesce(F.sum(F.when(hit, F.col("neg"))), z).alias("fp"),
        F.coalesce(F.sum(F.when(~hit, F.col("pos"))), z).alias("fn"),
        F.coalesce(F.sum(F.when(~hit, F.col("neg"))), z).alias("tn"))


def classification_metrics(counts: DataFrame) -> DataFrame:
    """E2-E5 from the confusion counts: accuracy; precision, recall and F1
    are 0 when undefined (the reference's zero_division=0)."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "model",
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp, 0.0).alias("precision"),
        ratio(tp, tp + fn, 0.0).alias("recall"),
        ratio(tp * 2, tp * 2 + fp + fn, 0.0).alias("f1"))


def score_counts(long: DataFrame) -> DataFrame:
    """Distinct (model, score) with positive / negative counts. Hot scores
    (many rows at one value) collapse here, map-side."""
    return long.groupBy("model", "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"),
        F.count_if(F.col("label") == 0).alias("neg"))


def auc(long: DataFrame, buckets: int = DEFAULT_BUCKETS, counts: DataFrame | None = None
        ) -> DataFrame:
    """Exact ROC AUC per model, ties counted half:
    sum over scores of pos * (negatives below + negatives tied / 2) / (P * N).
    One class only -> null."""
    d = counts if counts is not None else score_counts(long)
    pre = ordered_prefix(d, "model", "score", ["neg"], buckets)
    return pre.groupBy("model").agg(
        F.try_divide(F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)),
                     F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))


def roc_curve(long: DataFrame, drop_intermediate: bool = True,
              buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """``(model, threshold, fpr, tpr)``: one point per distinct score
    (score descending = cumulative counts from the top) plus the start
    (threshold +inf, 0, 0). With ``drop_intermediate``, a point between two
    others is dropped when its step equals the next one's in both counts
    (the second difference is 0), as the reference's library does."""
    d = score_counts(long)
    pre = ordered_prefix(d, "model", "score", ["pos", "neg"], buckets, with_previous=True)
    # per-model totals (k rows, broadcast) from the same distinct-score table,
    # whose exchange the plan reuses
    totals = d.groupBy("model").agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
        F.max("score").alias("top"), F.min("score").alias("bottom"))
    pts = pre.join(F.broadcast(totals), "model")
    tps = F.col("P") - F.col("pos_below")
    fps = F.col("N") - F.col("neg_below")
    keep = F.lit(True)
    if drop_intermediate:
        ends = (F.col("score") == F.col("top")) | (F.col("score") == F.col("bottom"))
        same_step = (F.col("prev_pos") == F.col("pos")) & (F.col("prev_neg") == F.col("neg"))
        # with two points or fewer every point is an end, so all are kept
        keep = ends | ~same_step
    curve = pts.where(keep).select(
        "model", F.col("score").alias("threshold"),
        ratio(fps, F.col("N")).alias("fpr"), ratio(tps, F.col("P")).alias("tpr"))
    start = totals.select("model", F.lit(float("inf")).alias("threshold"),
                          ratio(F.lit(0), F.col("N")).alias("fpr"),
                          ratio(F.lit(0), F.col("P")).alias("tpr"))
    return curve.unionByName(start)


def comparison_table(long: DataFrame, model_order: Sequence[str],
                     threshold: float = DECISION_THRESHOLD,
                     buckets: int = DEFAULT_BUCKETS, digits: int | None = 6) -> DataFrame:
    """E8 (+E10): Model, Accuracy, Precision, Recall, F1, AUC and a rank:
    AUC descending, registry order on ties. Models absent from ``long`` are
    simply not there (skipped)."""
    d = score_counts(long)
    m = classification_metrics(confusion_from_scores(d, threshold)).join(
        auc(long, buckets, counts=d), "model")
    pairs = []
    for i, name in enumerate(model_order):
        pairs += [F.lit(name), F.lit(i)]
    order = F.create_map(*pairs)[F.col("model")]
    rnd = (lambda c: r6(c)) if digits == 6 else (lambda c: c)
    ranked = m.withColumn("_order", order).withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("auc").desc_nulls_last(), "_order")))
    return ranked.select(
        F.col("model").alias("Model"), rnd(F.col("accuracy")).alias("Accuracy"),
        rnd(F.col("precision")).alias("Precision"), rnd(F.col("recall")).alias("Recall"),
        rnd(F.col("f1")).alias("F1"), rnd(F.col("auc")).alias("AUC"),
        F.col("rank").cast("int").alias("rank"))


def best_model(comparison: DataFrame) -> DataFrame:
    """The first row of the comparison (highest AUC, registry order)."""
    return comparison.where(F.col("rank") == 1).select("Model", "AUC")


def evaluate(df: DataFrame, scores: Mapping[str, Column], label: Column,
             threshold: float = DECISION_THRESHOLD) -> dict[str, DataFrame]:
    """Everything for all models from one long-form table."""
    long = long_scores(df, scores, label)
    cmp = comparison_table(long, list(scores), threshold)
    return {"confusion": confusion_matrix(long, threshold), "comparison": cmp,
            "best": best_model(cmp), "roc": roc_curve(long)}
