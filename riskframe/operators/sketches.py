"""F1 at scale: column profiles from mergeable sketches.

``sketch_columns`` reads the table once and keeps one row a column: exact
counts and moments, a KLL sketch of the values (quantiles) and a HyperLogLog
sketch of them (distinct count). Tasks build sketches map-side, so the
shuffle carries one row of sketches a task, whatever the number of distinct
values; the exact profile (``profile.numeric_profile``) shuffles those.

The rows can be written (``write_table``), kept per partition, day or stage,
and merged later without the data: ``merge_sketches`` gives what one sketch
over all the rows would give (moments and distinct counts the same,
quantiles within the same rank error), and ``sketch_profile`` reads it.

Missing values (null, NaN) are counted and left out. Infinite values count as
values (min, max, quantiles); mean and stddev are then null.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import col, present, sql_string

KLL_SIZE = 1000      # items kept a KLL level: rank error about 0.3 %
HLL_BITS = 14        # 2^14 registers: relative error about 0.8 %
COLUMNS_A_SCAN = 64  # columns whose sketches one task holds at once


def rank_error(size: int = KLL_SIZE) -> float:
    """The rank error that a KLL sketch of this size keeps with 99 % confidence."""
    return 2.296 / size ** 0.9723


def distinct_error(bits: int = HLL_BITS) -> float:
    """The relative standard error of a HyperLogLog count."""
    return 1.04 / 2 ** (bits / 2)


def _finite(c: Column) -> Column:
    return F.when(F.abs(c) < float("inf"), c)


def _sketch_scan(df: DataFrame, columns: Sequence[str], size: int, bits: int) -> DataFrame:
    x = [present(col(c)) + F.lit(0.0) for c in columns]  # -0.0 counts as 0.0
    names = ("n", "nulls", "min", "max", "mean", "m2", "quantiles", "distincts")
    aggs = []
    for i, v in enumerate(x):
        parts = (F.count(v), F.count_if(v.isNull()), F.min(v), F.max(v), F.avg(v), F.var_pop(v) * F.count(v),
                 F.kll_sketch_agg_double(v, F.lit(size)), F.hll_sketch_agg(F.when(v.isNotNull(), F.xxhash64(v)), F.lit(bits)))
        aggs += [p.alias(f"{name}{i}") for p, name in zip(parts, names, strict=True)]
    rows = ", ".join(f"{sql_string(c)}, " + ", ".join(f"{name}{i}" for name in names) for i, c in enumerate(columns))
    return (df.agg(*aggs).selectExpr(f"stack({len(columns)}, {rows}) AS (feature, {', '.join(names)})")
            .withColumns({"mean": _finite(F.col("mean")), "m2": _finite(F.col("m2"))}))


def sketch_columns(df: DataFrame, columns: Sequence[str], kll_size: int = KLL_SIZE, hll_bits: int = HLL_BITS) -> DataFrame:
    """One row a column: feature, n, nulls, min, max, mean, m2 (sum of squared
    deviations), quantiles (KLL), distincts (HyperLogLog).

    One pass; beyond ``COLUMNS_A_SCAN`` columns, one pass a group of columns,
    each reading its own columns only."""
    groups = [columns[i:i + COLUMNS_A_SCAN] for i in range(0, len(columns), COLUMNS_A_SCAN)]
    return reduce(DataFrame.unionByName, [_sketch_scan(df, g, kll_size, hll_bits) for g in groups])


def merge_sketches(*tables: DataFrame) -> DataFrame:
    """One sketch table for all the rows that several describe.

    A column that only some tables have keeps what they know of it."""
    every = reduce(DataFrame.unionByName, tables)
    # one entry a table: (n, mean, m2), added pairwise around the common mean
    some = F.filter("moments", lambda m: m["n"] > 0)
    total = F.aggregate(some, F.lit(0.0), lambda a, m: a + m["n"])
    mean = F.aggregate(some, F.lit(0.0), lambda a, m: a + m["mean"] * (m["n"] / F.col("total")))
    m2 = F.aggregate(some, F.lit(0.0), lambda a, m: a + m["m2"] + m["n"] * F.pow(m["mean"] - F.col("mean"), F.lit(2.0)))
    merged = every.groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.collect_list(F.struct("n", "mean", "m2")).alias("moments"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distincts").alias("distincts"))
    return (merged.withColumn("total", total)
            .withColumn("mean", F.when(F.col("n") > 0, mean)).withColumn("m2", F.when(F.col("n") > 0, m2))
            .select("feature", "n", "nulls", "min", "max", "mean", "m2", "quantiles", "distincts"))


def _name(q: float) -> str:
    return f"q{int(round(q * 100))}"


def sketch_profile(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The columns of ``profile.numeric_profile`` read from a sketch table:
    n_distinct and the quantiles are estimates, the rest is exact."""
    at = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(q)))).alias(_name(q)) for q in quantiles]
    return sketches.select(
        "feature", "n", "nulls", "min", "max", "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("stddev"),
        # united with itself, a sketch is read by its registers alone, as a merged one is
        F.hll_sketch_estimate(F.hll_union("distincts", "distincts")).alias("n_distinct"), *at)


def rank_errors(df: DataFrame, profile: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """How far each estimated quantile's true rank is from the wanted one:
    (feature, quantile, value, rank_error). One pass that counts the values
    below and up to each estimate (a number a column and quantile)."""
    wanted = [(r["feature"], q, r[_name(q)]) for r in profile.collect() for q in quantiles]  # a row a column
    aggs = []
    for i, (c, _, v) in enumerate(wanted):
        x, edge = present(col(c)), F.lit(v).cast("double")
        aggs += [F.avg((x < edge).cast("double")).alias(f"lo{i}"), F.avg((x <= edge).cast("double")).alias(f"hi{i}")]
    rows = ", ".join(f"{sql_string(c)}, {float(q)}D, CAST({'NULL' if v is None else sql_string(repr(float(v)))} AS DOUBLE), "
                     f"greatest(0D, lo{i} - {float(q)}D, {float(q)}D - hi{i})" for i, (c, q, v) in enumerate(wanted))
    return df.agg(*aggs).selectExpr(f"stack({len(wanted)}, {rows}) AS (feature, quantile, value, rank_error)")
