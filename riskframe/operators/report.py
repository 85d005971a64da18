"""Scoring summary (G1-G5): all counts in one aggregate pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import (HISTOGRAM_BAR_SLOTS, PREVIEW_DEFAULT_ROWS,
                                   RISK_TIERS, UNDETERMINED)
from ..functions.expressions import col, ratio, sql_string


def prediction_summary(scored: DataFrame, pred_col: str = "pred_label",
                       correct_col: str = "correct") -> DataFrame:
    """G1 (+ G2 when labelled): predicted positives / negatives, positive
    rate in percent; correct count and rate. Empty input -> null rates."""
    n = F.count(F.lit(1))
    pos = F.count_if(col(pred_col) == 1)
    aggs = [n.alias("n"), pos.alias("n_positive"),
            F.count_if(col(pred_col) == 0).alias("n_negative"),
            ratio(pos * 100, n).alias("positive_rate_pct")]
    if correct_col in scored.columns:
        ok = F.count_if(col(correct_col))
        aggs += [ok.alias("n_correct"), ratio(ok * 100, n).alias("correct_rate_pct")]
    return scored.agg(*aggs)


def tier_histogram(scored: DataFrame, prob: Column | None = None, tiers=RISK_TIERS,
                   bar_slots: int = HISTOGRAM_BAR_SLOTS) -> DataFrame:
    """G3 + G4: (tier_order, risk_tier, n, bar) for every tier, even empty
    ones, plus an ``undetermined`` row so counts add up to n.

    ``prob`` defaults to the displayed (rounded) ``probability`` column, as
    the reference's histogram does. One aggregate with conditional counts,
    un-pivoted with ``stack``: no join, no per-tier pass."""
    p = prob if prob is not None else F.col("probability")
    aggs = [F.count(F.lit(1)).alias("_total")]
    matched = None
    for i, (lo, hi, _) in enumerate(tiers):
        cond = (p >= F.lit(lo)) & (p < F.lit(hi))
        aggs.append(F.count_if(cond).alias(f"_t{i}"))
        matched = cond if matched is None else (matched | cond)
    aggs.append(F.count_if(~F.coalesce(matched, F.lit(False))).alias("_und"))
    parts = [f"{i}, {sql_string(name)}, _t{i}" for i, (_, _, name) in enumerate(tiers)]
    parts.append(f"{len(tiers)}, {sql_string(UNDETERMINED)}, _und")
    stacked = scored.agg(*aggs).selectExpr(
        "_total", f"stack({len(parts)}, {', '.join(parts)}) AS (tier_order, risk_tier, n)")
    per_slot = F.greatest(F.lit(1), F.floor(F.col("_total") / F.lit(bar_slots)))
    return stacked.select(
        F.col("tier_order").cast("int").alias("tier_order"), "risk_tier",
        F.col("n").cast("long").alias("n"),
        F.floor(F.col("n") / per_slot).cast("long").alias("bar"))


def preview(scored: DataFrame, key: str | list[str], n: int | None = None) -> DataFrame:
    """The first ``n`` rows (default min(10, rows)) in key order.
    Spark has no row order, so a key is required; plans as TakeOrdered."""
    keys = [key] if isinstance(key, str) else list(key)
    return scored.orderBy(*[col(k) for k in keys]).limit(n or PREVIEW_DEFAULT_ROWS)
