"""Feature analysis (stage B): profile, correlation, VIF, chi-square, mutual
information, label correlation (F1-F3, F5-F7).

Statistics over all features come from at most two shapes of work:
* one wide aggregate (k columns x a few aggregates, map-side partials);
* one long count table ``(feature, value, label, n)`` built by un-pivoting
  with ``stack`` and a single ``groupBy().count()``; map-side partial
  aggregation means the shuffle only carries distinct triples, however hot a
  value is. Everything after that runs on the small count table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expressions import col, pearson, present, sql_string
from ..session import ensure_checkpoint_dir
from . import gram
from .ordered import ordered_prefix



def _stack(df: DataFrame, columns: Sequence[str], as_type: str, extra: Sequence[str] = ()
           ) -> DataFrame:
    """Un-pivot ``columns`` to ``(feature, value)`` keeping ``extra`` columns."""
    parts = ", ".join(f"{sql_string(c)}, CAST(`{c}` AS {as_type})" for c in columns)
    return df.selectExpr(*[f"`{e}`" for e in extra],
                         f"stack({len(columns)}, {parts}) AS (feature, value)")


# --- F1 ---------------------------------------------------------------------------

def numeric_profile(df: DataFrame, columns: Sequence[str],
                    quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """per column n, nulls, n_distinct, min, max, mean, sample stddev and
    exact (interpolated) quantiles ``q25, q50, q75``.

    Moments: one wide aggregate (k rows reach the driver). Distinct counts
    and quantiles: the ``(feature, value, cnt)`` count table, with positions
    found by the range-split running count (no group is ever collected into
    one task); the per-column totals from the moments place the positions."""
    aggs = []
    for i, c in enumerate(columns):
        x = present(col(c))
        aggs += [F.count(x).alias(f"n{i}"), F.count_if(x.isNull()).alias(f"z{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
    m = df.agg(*aggs).first()
    spark = df.sparkSession
    moments = spark.createDataFrame(
        [(c, m[f"n{i}"], m[f"z{i}"], m[f"lo{i}"], m[f"hi{i}"], m[f"m{i}"], m[f"s{i}"])
         for i, c in enumerate(columns)],
        "feature string, n long, nulls long, min double, max double, mean double, "
        "stddev double")
    pairs = []
    for i, c in enumerate(columns):
        pairs += [F.lit(c), F.lit(int(m[f"n{i}"]))]
    total = F.create_map(*pairs)[F.col("feature")]

    src = df.select(*[col(c) for c in columns])
    counts = (_stack(src, columns, "DOUBLE").where(present(F.col("value")).isNotNull())
              .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt")))
    pre = ordered_prefix(counts, "feature", "value", ["cnt"])
    qaggs = [F.count(F.lit(1)).alias("n_distinct")]
    for j, q in enumerate(quantiles):
        h = (total - 1) * F.lit(float(q))
        lo_pos, hi_pos = F.floor(h), F.ceil(h)
        covers = lambda p: (F.col("cnt_below") <= p) & (p < F.col("cnt_below") + F.col("cnt"))
        qaggs += [F.max(F.when(covers(lo_pos), F.col("value"))).alias(f"_lo{j}"),
                  F.max(F.when(covers(hi_pos), F.col("value"))).alias(f"_hi{j}"),
                  F.max(h - lo_pos).alias(f"_fr{j}")]
    qs = pre.groupBy("feature").agg(*qaggs)
    qcols = [(F.col(f"_lo{j}") + (F.col(f"_hi{j}") - F.col(f"_lo{j}")) * F.col(f"_fr{j}"))
             .alias(f"q{int(round(q * 100))}") for j, q in enumerate(quantiles)]
    qs = qs.select("feature", "n_distinct", *qcols)
    out = moments.join(F.broadcast(qs), "feature", "left")
    return out.withColumn("n_distinct", F.coalesce(F.col("n_distinct"), F.lit(0)))


def class_profile(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """F1 per class: rows, share of all rows, and each feature's mean, in
    long form ``(label_value, n, share, feature, mean)``. One aggregate
    grouped by class, read once; the share is of the row count, added up over
    the classes. Missing values (null, NaN) are left out of the means."""
    aggs = [F.count(F.lit(1)).alias("n")] + [F.avg(present(col(c))).alias(f"m{i}")
                                             for i, c in enumerate(columns)]
    per = df.groupBy(col(label).alias("label_value")).agg(*aggs)
    per = per.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))  # a row a class
    parts = ", ".join(f"{sql_string(c)}, m{i}" for i, c in enumerate(columns))
    return per.selectExpr("label_value", "n", "share",
                          f"stack({len(columns)}, {parts}) AS (feature, mean)")


# --- F2, F3, F7 ---------------------------------------------------------------------

def correlation_pairs(df: DataFrame, columns: Sequence[str], block: int = gram.BLOCK,
                      tile_bytes: int = gram.TILE_BYTES) -> DataFrame:
    """Pearson r for all pairs x <= y, long form ``(x, y, r)``, over the
    rows where both are present (null, NaN and infinities are missing),
    whatever the number of columns. Zero variance or fewer than two rows give
    null.

    One pass for the means and one for the tiles of ``gram``; a tile becomes
    its pairs in the task that added it up."""
    names, k = list(columns), len(columns)
    block = gram.tile_side(k, block)
    data = gram.doubles(df, columns)
    sums = gram.pair_sums(data, gram.column_means(data), block, tile_bytes)
    count = -(-k // block)
    tiles = df.sparkSession.createDataFrame(  # a table without rows has its pairs too
        [(i, j) for i in range(count) for j in range(i, count)], "i int, j int")

    def pairs(batches):
        for batch in batches:
            for n in range(len(batch)):
                a, b = batch.column(0)[n].as_py() * block, batch.column(1)[n].as_py() * block
                s = batch.column(2)[n].values
                r = (np.full((block, block), np.nan) if s is None else
                     gram.tile_correlation(s.to_numpy().reshape(len(gram.SUMS), block, block)))
                i, j = np.nonzero((np.arange(a, a + block)[:, None] <= np.arange(b, b + block)) &
                                  (np.arange(a, a + block)[:, None] < k) & (np.arange(b, b + block) < k))
                v = r[i, j]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[x] for x in i + a], pa.string()), pa.array([names[y] for y in j + b], pa.string()),
                     pa.array(v, mask=np.isnan(v))], names=["x", "y", "r"])

    return tiles.join(sums, ["i", "j"], "left").select("i", "j", "sums").mapInArrow(pairs, "x string, y string, r double")


def vif(spark: SparkSession, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """VIF_j = (R^-1)_jj from the correlation matrix of complete rows
    (null, NaN and infinities are missing). The passes over the data are
    ``gram``'s; only the k x k inverse runs on the driver. A singular matrix,
    a constant column or fewer than two rows give null VIFs and ``singular``."""
    g = gram.gram(df, columns)
    sd = np.sqrt(np.diag(g.cov))
    singular = bool(g.n < 2 or (sd == 0).any())
    if not singular:
        r = np.clip(g.cov / np.outer(sd, sd), -1.0, 1.0)
        singular = bool(np.linalg.matrix_rank(r) < len(columns))
    vals = [None] * len(columns) if singular else [float(v) for v in np.diag(np.linalg.inv(r))]
    return spark.createDataFrame(
        [(c, v, singular) for c, v in zip(columns, vals)],
        "feature string, vif double, singular boolean")


def label_correlation(df: DataFrame, label: Column, columns: Sequence[str]) -> DataFrame:
    """Pearson r of each feature with the label, one aggregate."""
    y = label.cast("double")
    aggs = [pearson(col(c), y).alias(f"r{i}") for i, c in enumerate(columns)]
    parts = ", ".join(f"{sql_string(c)}, r{i}" for i, c in enumerate(columns))
    return df.agg(*aggs).selectExpr(f"stack({len(columns)}, {parts}) AS (feature, corr)")


# --- F5, F6 ------------------------------------------------------------------------

def contingency_counts(df: DataFrame, label: Column, columns: Sequence[str],
                       materialize: bool = True) -> DataFrame:
    """``(feature, value, label, n)``: one un-pivot and one count. Rows with
    a null label or value are left out. Numeric features should be binned
    first (see ``features.bin_expr``).

    The table is bounded (features x values x labels) and read several times
    (margins, chi-square, MI), so by default it is cut from its lineage with
    a reliable ``checkpoint()`` into the shared checkpoint folder: one scan
    of the data, and a lost executor does not send the job back to it."""
    base = df.select(label.cast("string").alias("_label"), *[col(c) for c in columns])
    counts = (_stack(base, columns, "STRING", extra=["_label"])
              .where(F.col("value").isNotNull() & F.col("_label").isNotNull())
              .groupBy("feature", "value", F.col("_label").alias("label"))
              .agg(F.count(F.lit(1)).alias("n")))
    if materialize:
        ensure_checkpoint_dir(df.sparkSession)
        counts = counts.checkpoint(eager=True)
    return counts


def _margins(counts: DataFrame) -> DataFrame:
    rows = counts.groupBy("feature", "value").agg(F.sum("n").alias("r"))
    cols = counts.groupBy("feature", "label").agg(F.sum("n").alias("c"))
    tot = counts.groupBy("feature").agg(F.sum("n").alias("total"),
                                        F.countDistinct("value").alias("n_values"),
                                        F.countDistinct("label").alias("n_labels"))
    return (counts.join(rows, ["feature", "value"]).join(cols, ["feature", "label"])
            .join(tot, "feature"))


def contingency_scores(counts: DataFrame) -> DataFrame:
    """F5 + F6 from one margins pass: ``(feature, chi2, dof, mutual_info)``."""
    m = _margins(counts)
    n, total = F.col("n").cast("double"), F.col("total").cast("double")
    rc = F.col("r").cast("double") * F.col("c")
    out = m.groupBy("feature").agg(
        (F.first("total") * (F.sum(n * n / rc) - 1.0)).alias("chi2"),
        ((F.first("n_values") - 1) * (F.first("n_labels") - 1)).cast("long").alias("dof"),
        F.sum((n / total) * F.log(n * total / rc)).alias("mutual_info"))
    return out.select("feature", "chi2", "dof", "mutual_info")


def chi_square(counts: DataFrame) -> DataFrame:
    """contingency chi-square per feature,
    chi2 = N * (sum over observed cells of o^2 / (row * col) - 1),
    which needs no zero cells; dof = (values - 1) * (labels - 1), for any
    number of values."""
    m = _margins(counts)
    out = m.groupBy("feature").agg(
        (F.first("total") * (F.sum(F.col("n").cast("double") * F.col("n")
                                   / (F.col("r").cast("double") * F.col("c"))) - 1.0))
        .alias("chi2"),
        ((F.first("n_values") - 1) * (F.first("n_labels") - 1)).cast("long").alias("dof"))
    return out.select("feature", "chi2", "dof")


def mutual_information(counts: DataFrame) -> DataFrame:
    """discrete mutual information with the label, natural log:
    sum over observed cells of (o / N) * ln(o * N / (row * col))."""
    m = _margins(counts)
    n, total = F.col("n").cast("double"), F.col("total").cast("double")
    term = (n / total) * F.log(n * total / (F.col("r").cast("double") * F.col("c")))
    return m.groupBy("feature").agg(F.sum(term).alias("mutual_info"))

