"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source has a target in words. Its documents are hashed into
``BLOCKS`` blocks. A source repeats all its blocks as often as the target
allows, and draws the rest from one more pass: whole blocks in permuted
order, then, inside the block where the target falls, whole sub-blocks, and
inside the last sub-block documents in hash order up to the target; one
document of those left, the one that fits the gap best, ends the pass. The
drawn (pass, block) pairs are the source's quota of units.

The units go to ``SHARDS`` output shards: a binary tree over the shards
splits the vector of source quotas in two by a multivariate hypergeometric
draw at each node, so every shard holds the same number of units (to one)
and their sources are distributed as in a uniform shuffle of all units,
without shuffling. Each source then deals its permuted units to the shards
in turn, so shards are disjoint, and documents are ordered at random inside
their shard by a hash. Everything follows from ids, texts and ``seed``.

Only one row a source (its size) reaches the driver, for the targets and
the tree.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.graph import free_name, saved

WEIGHTS = (5, 2, 1)
MOST = 3           # times a source's size its target can be
BLOCKS = 256
SUB_BLOCKS = 4096
SHARDS = 64
SEED = 17
SMALL_PLAN = 2000  # sources up to which the plan (some 10 KB each) is broadcast

_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(_WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], most: float = MOST) -> list[float]:
    """Share the sum of ``sizes`` by weight; no target above ``most`` times its size,
    the excess shared among the others by weight until none is above."""
    out: list[float] = [0.0] * len(sizes)
    free, left = set(range(len(sizes))), float(sum(sizes))
    while free:
        total = sum(weights[i] for i in sorted(free))
        share = {i: left * weights[i] / total for i in sorted(free)}
        above = [i for i in sorted(free) if share[i] > most * sizes[i]]
        if not above:
            for i, x in share.items():
                out[i] = x
            break
        for i in above:
            out[i] = float(most * sizes[i])
            left -= out[i]
            free.discard(i)
    return out


def split_quotas(units: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources): how many units of each source every shard gets."""
    if shards == 1:
        return units[None, :]
    half = shards // 2
    total = int(units.sum())
    take = total * half // shards
    left = rng.multivariate_hypergeometric(units, take, method="marginals") if total else units * 0
    return np.concatenate((split_quotas(left, half, rng), split_quotas(units - left, shards - half, rng)))


def with_draws(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[float, ...] = WEIGHTS, shards: int = SHARDS, seed: int = SEED) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its size in words, its source's size and target, and its draws, an
    array of (pass, shard, order): one entry for each time the mixture holds the row.

    Sources sort by code point, null last, and take the weights in turn. A
    null text has size 0; rows of size 0 are drawn like their block, and
    sources without words have target 0. Rows equal in id and text are drawn
    alike, and so are rows whose hashes tie. Very long texts are counted
    whole; an empty table gives no rows. Returns also the names of the new
    columns, which avoid those of ``docs``.
    """
    spark = docs.sparkSession
    name = {k: free_name(f"mix_{k}", docs.columns) for k in ("size", "source_size", "target", "draws", "hash", "key")}
    held = free_name("__plan", docs.columns)
    rows = docs.withColumns({name["size"]: word_count(text_col), name["hash"]: F.xxhash64(F.lit(seed), id_col, text_col),
                             name["key"]: F.col(source_col).cast("string")})
    narrow = saved(rows.select(F.col(name["key"]).alias("source"), F.col(name["size"]).alias("size"),
                               F.col(name["hash"]).alias("h")), "sizes")
    block, sub = F.col("h").bitwiseAND(BLOCKS - 1), F.shiftrightunsigned("h", 8).bitwiseAND(SUB_BLOCKS - 1)
    narrow = narrow.select("source", "size", "h", block.cast("int").alias("block"), sub.cast("int").alias("sub"))
    totals = narrow.groupBy("source").agg(F.sum("size").alias("size")).collect()  # one row a source
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in totals]
    goals = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))])
    passes = [min(int(g // s), MOST) if s else 0 for g, s in zip(goals, sizes, strict=True)]
    plan = spark.createDataFrame(
        [(r["source"], r["size"], float(g), p, float(g - p * s)) for r, g, p, s in zip(totals, goals, passes, sizes, strict=True)],
        "source string, source_size bigint, target double, passes int, rest double")

    # Where the rest of each source ends: block, sub-block, document.
    mine = Window.partitionBy("source")
    summed = narrow.groupBy("source", "block").agg(F.sum("size").alias("size"))
    own = F.col("source").eqNullSafe(F.col("p_source"))
    quota = plan.select(F.col("source").alias("p_source"), "passes", "rest")
    order = mine.orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = saved(summed.join(quota, own).select("source", "block", "size", "passes", "rest",
                                                 F.xxhash64(F.lit(seed + 1), "source", "block").alias("turn"))
                   .withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
                   .withColumn("part", F.when(F.col("before") + F.col("size") <= F.col("rest"), F.lit(2))
                               .when(F.col("before") < F.col("rest"), F.lit(1)).otherwise(F.lit(0))), "blocks")
    edge = blocks.filter("part = 1").select(F.col("source").alias("e_source"), F.col("block").alias("e_block"),
                                            (F.col("rest") - F.col("before")).alias("e_rest"))
    inside = narrow.join(edge, F.col("source").eqNullSafe(F.col("e_source")) & (F.col("block") == F.col("e_block")))
    inside = saved(inside.select("source", "sub", "size", "h", F.col("e_rest").alias("rest")), "edge")
    order = mine.orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    subs = (inside.groupBy("source", "sub", "rest").agg(F.sum("size").alias("size"))
            .withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
            .filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("size") > F.col("rest")))
            .select(F.col("source").alias("s_source"), F.col("sub").alias("s_sub"), (F.col("rest") - F.col("before")).alias("s_rest")))
    order = mine.orderBy("h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = (inside.join(subs, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("sub") == F.col("s_sub")))
            .groupBy("source", "s_sub", "s_rest", "h").agg(F.sum("size").alias("size"))
            .withColumn("upto", F.sum("size").over(order))
            .filter(F.col("upto") <= F.col("s_rest"))
            .groupBy("source").agg(F.max("h").alias("cut"), F.max("upto").alias("got")))
    edges = edge.join(blocks.filter("part = 1").select(F.col("source").alias("t_source"), F.col("turn").alias("e_turn")),
                      F.col("e_source").eqNullSafe(F.col("t_source")))
    ends = saved(edges.join(subs, F.col("e_source").eqNullSafe(F.col("s_source")), "left")
                 .join(last, F.col("e_source").eqNullSafe(F.col("source")), "left")
                 .select("e_source", "e_block", "e_turn", "s_sub", "cut",
                         (F.col("s_rest") - F.coalesce("got", F.lit(0))).alias("gap")), "ends")
    # One document more, the one of those not drawn that fits the gap best.
    turn = F.xxhash64(F.lit(seed + 1), "source", "block")
    undrawn = (turn > F.col("e_turn")) | ((F.col("block") == F.col("e_block")) & (
        (F.col("sub") > F.col("s_sub")) | ((F.col("sub") == F.col("s_sub")) & F.coalesce(F.col("h") > F.col("cut"), F.lit(True)))))
    # Rows that are equal are drawn together, so they count together.
    fit = (narrow.join(ends.filter("gap > 0"), F.col("source").eqNullSafe(F.col("e_source"))).filter(undrawn)
           .groupBy("source", "h", "gap").agg(F.sum("size").alias("size"))
           .groupBy("source", "gap").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "h")).alias("x"))
           .filter("x.off < gap").select(F.col("source").alias("f_source"), F.col("x.h").alias("one")))
    ends = ends.join(fit, F.col("e_source").eqNullSafe(F.col("f_source")), "left").drop("f_source")

    # Units and the shards they go to.
    counts = blocks.groupBy("source").agg(F.sum(F.col("passes") + (F.col("part") > 0).cast("int")).alias("units")).collect()
    count = {r["source"]: r["units"] for r in counts}
    units = np.array([count.get(r["source"], 0) for r in totals], np.int64)
    dealt = split_quotas(units, shards, np.random.default_rng(seed)) if len(units) else np.zeros((shards, 0), np.int64)
    upto = spark.createDataFrame([(r["source"], [int(x) for x in np.cumsum(dealt[:, i])]) for i, r in enumerate(totals)],
                                 "u_source string, upto array<bigint>")
    turn = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 2), "source", "block", "pass"), "block", "pass")
    placed = (blocks.withColumn("n", F.col("passes") + (F.col("part") > 0).cast("int")).filter("n > 0")
              .select("source", "block", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("pass"))
              .withColumn("at", F.row_number().over(turn) - 1)
              .join(upto, F.col("source").eqNullSafe(F.col("u_source")))
              .select("source", "block", "pass", F.size(F.filter("upto", lambda x: x <= F.col("at"))).alias("shard")))
    units_of = placed.groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("units"))
    per_source = (blocks.select("source", "block", "part").join(units_of.toDF("x_source", "x_block", "units"),
                  F.col("source").eqNullSafe(F.col("x_source")) & (F.col("block") == F.col("x_block")), "left")
                  .groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("block", F.struct("part", "units")))).alias("blocks")))
    small = saved(plan.join(per_source.withColumnRenamed("source", "b_source"), F.col("source").eqNullSafe(F.col("b_source")))
                  .join(ends, F.col("source").eqNullSafe(F.col("e_source")), "left")
                  .select(F.struct("source", "source_size", "target", "passes", "blocks", "e_block", "s_sub", "cut", "one").alias(held)), "plan")
    if len(totals) <= SMALL_PLAN:
        small = F.broadcast(small)
    joined = rows.join(small, F.col(name["key"]).eqNullSafe(F.col(f"{held}.source")), "left")
    h = F.col(name["hash"])
    block, sub = h.bitwiseAND(BLOCKS - 1).cast("int"), F.shiftrightunsigned(h, 8).bitwiseAND(SUB_BLOCKS - 1).cast("int")
    here = F.element_at(F.col(f"{held}.blocks"), block)
    s_sub = F.col(f"{held}.s_sub")
    more = (here["part"] == 2) | ((here["part"] == 1) & (
        F.when(s_sub.isNull(), F.lit(True)).otherwise((sub < s_sub) | ((sub == s_sub) & F.coalesce(h <= F.col(f"{held}.cut"), F.lit(False))))))
    mine = F.filter(F.coalesce(here["units"], F.array()), lambda u: (u["pass"] < F.col(f"{held}.passes")) | more)
    # The fitting document goes where the unit of its source's last block goes.
    edge_units = F.element_at(F.col(f"{held}.blocks"), F.col(f"{held}.e_block"))["units"]
    mine = F.when(F.coalesce(h == F.col(f"{held}.one"), F.lit(False)),
                  F.concat(mine, F.filter(edge_units, lambda u: u["pass"] == F.col(f"{held}.passes")))).otherwise(mine)
    draws = F.transform(mine, lambda u: F.struct(u["pass"].alias("pass"), u["shard"].alias("shard"),
                                                 F.xxhash64(h, u["pass"], u["shard"], F.lit(seed + 3)).alias("order")))
    out = joined.withColumns({name["source_size"]: F.col(f"{held}.source_size"), name["target"]: F.col(f"{held}.target"),
                              name["draws"]: draws}).drop(held, name["hash"], name["key"])
    return out, name


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: the columns of ``docs`` with mix_pass, mix_shard and mix_order
    (an underscore is added where ``docs`` has the name), one row a draw, one file
    partition a group of shards, shuffled inside each shard."""
    drawn, name = with_draws(docs, **options)
    columns = list(docs.columns)
    made = {k: free_name(f"mix_{k}", columns) for k in ("pass", "shard", "order")}
    draw = free_name("__d", columns)
    rows = (drawn.select(*[F.col(f"`{c}`") for c in columns], F.explode(name["draws"]).alias(draw))
            .select(*[F.col(f"`{c}`") for c in columns], *[F.col(f"{draw}.{k}").alias(v) for k, v in made.items()]))
    return rows.repartition(F.col(made["shard"])).sortWithinPartitions(made["shard"], made["order"])


def taken(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per row of ``docs``: id, size, source_size, target, taken (words the mixture holds of it)."""
    drawn, name = with_draws(docs, id_col=id_col, **options)
    return drawn.select(F.col(id_col), F.col(name["size"]).alias("size"), F.col(name["source_size"]).alias("source_size"),
                        F.col(name["target"]).alias("target"),
                        (F.col(name["size"]) * F.size(name["draws"])).cast("long").alias("taken"),
                        F.size(name["draws"]).alias("times"))
