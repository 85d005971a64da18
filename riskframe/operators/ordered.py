"""Exact running sums over a sorted column, per group, without a window that
holds a whole group (SURVEY 7.3, E6/E7; also exact quantiles).

A plain ``sum(...) OVER (PARTITION BY g ORDER BY x)`` sends each group to one
task: with two models that is two tasks for the whole table. Instead:

1. rows are cut into contiguous ranges of the sort order (equal-frequency
   edges from ``percentile_approx``; approximate edges only balance the work,
   the result stays exact);
2. per (group, range) totals form a small table whose running sums give each
   range's offset;
3. a window partitioned by (group, range) adds the running sum inside the
   range to its offset.

Each task then sorts about ``rows / buckets`` rows, however skewed the sort
key is. Input rows must be unique per (group, order column); callers first
reduce to distinct keys with counts, which also merges hot keys map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import col

WIDTH = 1500.0  # distance of two groups on the common axis of ``_squash``
DEFAULT_BUCKETS = 256
MAX_BUCKETS = 65_536
ROWS_PER_RANGE = 2_000_000
# below this many (group, range) rows the offsets table is broadcast
BROADCAST_ROWS = 200_000


def _squash(x):
    """Monotone map of the extended reals into [-711, 711] that keeps relative
    differences apart at any magnitude (infinities to the ends)."""
    inf = float("inf")
    return (F.when(x == F.lit(inf), F.lit(711.0)).when(x == F.lit(-inf), F.lit(-711.0))
            .otherwise(F.signum(x) * F.log1p(F.abs(x))))


def ordered_prefix(df: DataFrame, group_col: str, order_col: str, value_cols: Sequence[str],
                   buckets: int = DEFAULT_BUCKETS, with_previous: bool = False) -> DataFrame:
    """Add ``<v>_below`` = sum of ``v`` over rows of the same group with a
    smaller ``order_col`` (exclusive prefix), for each ``v`` in
    ``value_cols``. With ``with_previous``, also ``prev_<v>`` = ``v`` of the
    row just below in the same group (null for the lowest).

    ``order_col`` must be a non-null double; (group, order) unique. The
    groups (features, models) are a bounded number; their sizes are not.
    """
    squashed = _squash(col(order_col).cast("double"))
    sizes = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("n")).collect()  # a row a group
    largest = max((r["n"] for r in sizes), default=0)

    # finer ranges as groups grow, so each task sorts about ROWS_PER_RANGE
    # rows (edges reach the driver: keep groups x ranges under 4M doubles)
    b = max(buckets or DEFAULT_BUCKETS,
            min(MAX_BUCKETS, 4_000_000 // max(len(sizes), 1), -(-largest // ROWS_PER_RANGE)))
    probs = [i / b for i in range(1, b)]
    rows = (df.groupBy(group_col)
            .agg(F.percentile_approx(squashed, probs, max(10_000, 8 * b)).alias("e"))
            .collect())
    buckets = b
    rows.sort(key=lambda r: (r[0] is None, str(r[0])))
    pairs, edges = [], set()
    for i, r in enumerate(rows):
        pairs += [F.lit(r[0]), F.lit(float(i))]
        edges.update(i * WIDTH + e for e in (r[1] or []) if e is not None)
    gidx = F.create_map(*pairs)[col(group_col)] if pairs else F.lit(0.0)
    # (group, order) -> one double that sorts the same way; rounding only
    # merges near-equal keys into one range, which keeps the sums exact
    keyed = df.withColumn("_t", gidx * F.lit(WIDTH) + squashed)
    groups = rows
    splits = [float("-inf")] + sorted(edges) + [float("inf")]
    if len(splits) < 3:
        splits = [float("-inf"), 0.0, float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="_t", outputCol="_b",
                          handleInvalid="keep").transform(keyed).drop("_t")

    # per-range totals -> exclusive offsets (small table: groups x ranges)
    totals = bucketed.groupBy(group_col, "_b").agg(
        *[F.sum(col(v)).alias(f"_tot_{i}") for i, v in enumerate(value_cols)],
        *([F.max_by(F.struct(*[col(v).alias(f"_l{i}") for i, v in enumerate(value_cols)]),
                    col(order_col)).alias("_last")] if with_previous else []))
    wg = Window.partitionBy(group_col).orderBy("_b")
    before = wg.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        group_col, "_b",
        *[F.coalesce(F.sum(f"_tot_{i}").over(before), F.lit(0)).alias(f"_off_{i}")
          for i in range(len(value_cols))],
        *([F.lag("_last").over(wg).alias("_prev_last")] if with_previous else []))
    if len(groups) * buckets <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    joined = bucketed.join(offsets, [group_col, "_b"])

    wr = Window.partitionBy(group_col, "_b").orderBy(col(order_col))
    inside = wr.rowsBetween(Window.unboundedPreceding, -1)
    out = {}
    for i, v in enumerate(value_cols):
        out[f"{v}_below"] = F.col(f"_off_{i}") + F.coalesce(F.sum(col(v)).over(inside), F.lit(0))
        if with_previous:
            out[f"prev_{v}"] = F.coalesce(F.lag(col(v)).over(wr), F.col(f"_prev_last._l{i}"))
    drop = ["_b"] + [f"_off_{i}" for i in range(len(value_cols))]
    if with_previous:
        drop.append("_prev_last")
    return joined.withColumns(out).drop(*drop)
