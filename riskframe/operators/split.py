"""Exact stratified split, training union and class weights.

``sampleBy`` / ``randomSplit`` are approximate and depend on partitioning, so
the split is defined by ranks instead: within each class, rows ordered by
``md5(key | seed)`` (then key); the first floor(70% n) go to train, up to
floor(85% n) to val, the rest to test. That definition is the DuckDB twin.

Computing ranks with one window per class would put each class in one task.
Instead (SURVEY 7.3): the first hex digits of the hash form buckets; a count
per (class, bucket) is a bounded table (<= 16^digits per class) whose running
sums locate the (at most two) buckets per class that contain a cut. Rows in
any other bucket are decided by comparing their bucket with the cut buckets
(a per-class table of a few numbers, broadcast); only rows in cut buckets are
ranked, in windows of about n / 16^digits rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import SPLIT_NAMES, SPLIT_PERCENT, SPLIT_SEED
from ..functions.expressions import col

HEX_DIGITS = 5


def split_hash(key: Column, seed: int = SPLIT_SEED) -> Column:
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))


def stratified_split(df: DataFrame, key: str, strata: str, seed: int = SPLIT_SEED,
                     percents: Sequence[int] = SPLIT_PERCENT, hex_digits: int = HEX_DIGITS,
                     out_col: str = "split") -> DataFrame:
    """Add ``split`` in {train, val, test}. ``key`` must be unique."""
    if sum(percents) != 100 or len(percents) != 3:
        raise ValueError("percents must be three shares adding up to 100")
    p1, p12 = percents[0], percents[0] + percents[1]
    h = split_hash(col(key), seed)
    base = df.withColumns({
        "_h": h, "_b": F.conv(F.substring(h, 1, hex_digits), 16, 10).cast("long"),
        "_s": col(strata)})

    counts = base.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_s").orderBy("_b")
    run = counts.select("_s", "_b", "_n", F.sum("_n").over(w).alias("_hi"),
                        F.sum("_n").over(Window.partitionBy("_s")).alias("_tot"))
    run = run.withColumns({"_lo": F.col("_hi") - F.col("_n"),
                           "_c1": F.floor(F.col("_tot") * p1 / 100).cast("long"),
                           "_c2": F.floor(F.col("_tot") * p12 / 100).cast("long")})
    # first bucket whose upper end passes each cut: the cut buckets
    cuts = run.groupBy("_s").agg(
        F.min_by(F.struct("_b", "_lo"), F.when(F.col("_hi") > F.col("_c1"), F.col("_b")))
        .alias("_e1"),
        F.min_by(F.struct("_b", "_lo"), F.when(F.col("_hi") > F.col("_c2"), F.col("_b")))
        .alias("_e2"),
        F.first("_c1").alias("_c1"), F.first("_c2").alias("_c2"))
    inf = F.lit(1 << 62)
    # one row a class, joined: its number needs no limit, and a small one is broadcast at run time
    cut_df = cuts.select(
        F.col("_s").alias("_cs"), F.coalesce("_e1._b", inf).alias("_e1"), F.coalesce("_e1._lo", F.lit(0)).alias("_lo1"),
        F.coalesce("_e2._b", inf).alias("_e2"), F.coalesce("_e2._lo", F.lit(0)).alias("_lo2"), "_c1", "_c2")
    j = base.join(cut_df, F.col("_s").eqNullSafe(F.col("_cs"))).drop("_cs")

    train, val, test = SPLIT_NAMES
    on_cut = (F.col("_b") == F.col("_e1")) | (F.col("_b") == F.col("_e2"))
    decided = j.where(~on_cut).withColumn(
        out_col, F.when(F.col("_b") < F.col("_e1"), F.lit(train))
        .when(F.col("_b") < F.col("_e2"), F.lit(val)).otherwise(F.lit(test)))
    wr = Window.partitionBy("_s", "_b").orderBy("_h", col(key))
    lo = F.when(F.col("_b") == F.col("_e1"), F.col("_lo1")).otherwise(F.col("_lo2"))
    rank = lo + F.row_number().over(wr)
    ranked = j.where(on_cut).withColumn("_r", rank).withColumn(
        out_col, F.when(F.col("_r") <= F.col("_c1"), F.lit(train))
        .when(F.col("_r") <= F.col("_c2"), F.lit(val)).otherwise(F.lit(test))).drop("_r")
    helper = ["_h", "_b", "_s", "_e1", "_lo1", "_e2", "_lo2", "_c1", "_c2"]
    return decided.drop(*helper).unionByName(ranked.drop(*helper))


def training_rows(split_df: DataFrame, split_col: str = "split") -> DataFrame:
    """Train + val (the 85% the models learn from)."""
    return split_df.where(col(split_col) != F.lit(SPLIT_NAMES[2]))


def class_weights(df: DataFrame, label_col: str) -> DataFrame:
    """Balanced weights n / (k * n_c) per class: ``(label, n, weight)``
    over the labelled rows; null labels are no class. One plan: one
    aggregate, and the totals over its rows (one a class)."""
    per = (df.where(col(label_col).isNotNull()).groupBy(col(label_col).alias("label"))
           .agg(F.count(F.lit(1)).alias("n")))
    every = Window.partitionBy()
    return per.select("label", "n", (F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))).alias("weight"))


def with_weights(df: DataFrame, label_col: str, weight_col: str = "weight",
                 with_rows: bool = False):
    """Attach the weight column; also returns the weight total (for the
    regularisation scale of T5), and with ``with_rows`` the row count. Rows
    without label get a null weight."""
    weights = class_weights(df, label_col)
    row = weights.agg(F.sum(F.col("weight") * F.col("n")).alias("w"), F.sum("n").alias("n")).first()
    total, n_rows = float(row["w"] or 0.0), int(row["n"] or 0)
    out = (df.join(weights.select(F.col("label").alias("_wl"), F.col("weight").alias(weight_col)),
                   col(label_col) == F.col("_wl"), "left").drop("_wl"))
    return (out, total, n_rows) if with_rows else (out, total)
