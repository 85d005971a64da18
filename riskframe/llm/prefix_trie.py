"""Prefix trie of conversations, built by halving the depth (van Emde Boas).

A conversation is a sequence of turns. The depth range is halved level after
level, so at level l a sequence is cut into blocks of 2^l turns:

1. Names, upwards: the name of a block is made from the names of its halves,
   so every block of every level gets a name with one shuffle a level; a
   level has half the rows of the one below.
2. Tries, downwards: at level l a string is a distinct block below a distinct
   cut prefix, with its number of conversations and their smallest id. It is
   cut in half: the upper halves are the strings of the upper trie, and the
   lower halves those of the forest below the named cut prefixes. All tries
   of a level are built at once, and strings that have become equal are
   merged, so a hot beginning is one row from then on. At level 0 a string
   is a node.
3. Totals, upwards: a forest's total is its upper trie's plus those of the
   forests grafted on its cut prefixes.
4. Grafts, downwards: what hangs below the end of a block's string is added
   to the strings of its upper half, until every node knows what lies below.

The number of levels is the logarithm of the longest conversation; no step
handles a conversation as a whole, so one may hold any share of the turns.
Names are two 64-bit hashes, or a cut prefix's and a block's put together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.graph import saved, small_batches

REBUILD_MOST = 6        # a rebuilt conversation borrows fewer turns than this
PART = 1024             # turns of one conversation that a join meets under one key
PIECE = 10_000          # ids joined to one text before hashing
HOT_CHILDREN = 64       # children of a parent joined by key; beyond it (or a ten-thousandth of all) by broadcast
HOT_SHARE = 10_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_ROOT = 0               # both halves of the root's name


def _name(salt: int, *columns) -> list[Column]:
    return [F.xxhash64(F.lit(salt + i), *columns).alias(c) for i, c in enumerate("xy")]


def _number_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place of each turn among those of its conversation in this sorted partition, from 1;
    ``last`` marks the partition's last turn."""
    part = TaskContext.get().partitionId()
    held, conv, seen = None, None, 0
    for batch in batches:
        if not len(batch):
            continue
        if held is not None:
            yield held
        ids = batch.column(0).to_numpy()
        start = np.concatenate(([True], ids[1:] != ids[:-1]))
        at = np.flatnonzero(start)
        local = np.arange(len(ids)) - np.repeat(at, np.diff(np.append(at, len(ids)))) + 1
        if ids[0] == conv:
            local[:at[1] if len(at) > 1 else len(ids)] += seen
        conv, seen = ids[-1], int(local[-1])
        held = pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(local), pa.array(np.full(len(ids), part, np.int32)), *batch.columns[1:],
             pa.array(np.zeros(len(ids), bool))], names=["conv", "local", "part", "x", "y", "chars", "last"])
    if held is not None:
        mark = np.zeros(len(held), bool)
        mark[-1] = True
        yield held.set_column(6, "last", pa.array(mark))


def numbered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, at, x, y, chars): each conversation's turns in order, at from 1.

    Order: turn (null first), then role, then md5 of the text. The rows are
    sorted by ranges, which may cut a conversation; the partitions' last
    turns (one row a partition) carry its count on.
    """
    text, role = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(role_col), F.lit(""))
    turns = saved(small_batches(conversations).filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"), *_name(1, role, text), F.char_length(text).cast("bigint").alias("chars"),
        F.col(turn_col).alias("turn"), role.alias("role"), F.unhex(F.md5(text)).alias("tie")), "turns")
    order = ["conv", "turn", "role", "tie"]
    ranked = saved(turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "x", "y", "chars")
                   .mapInArrow(_number_turns, "conv bigint, local bigint, part int, x bigint, y bigint, chars bigint, last boolean"),
                   "ranked")
    before = (ranked.filter("last").groupBy("conv")
              .agg(F.collect_list(F.struct("part", "local")).alias("lasts")))  # a row a partition at most
    earlier = F.aggregate(F.filter("lasts", lambda r: r["part"] < F.col("part")), F.lit(0).cast("bigint"),
                          lambda total, r: total + r["local"])
    return ranked.join(F.broadcast(before), "conv", "left").select(
        "conv", (F.col("local") + F.coalesce(earlier, F.lit(0))).alias("at"), "x", "y", "chars")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after every conversation c borrowed the first h turns of c - c % 100.

    ``turns``: numbered turns. h is crc32 of the decimal id modulo ``REBUILD_MOST``;
    c's own first h turns go. Returns (conv, blk, x, y, chars) with blk from 0,
    and (conv, turns) of all conversations, those without a turn left too.
    """
    turns = saved(turns, "numbered")
    heads = (turns.filter((F.col("at") < REBUILD_MOST) & (F.col("conv") % 100 == 0))
             .groupBy(F.col("conv").alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("at", "x", "y", "chars"))).alias("head")))  # five at most
    h = F.crc32(F.col("conv").cast("string")) % REBUILD_MOST
    size = F.coalesce(F.size("head"), F.lit(0))
    convs = saved(
        turns.groupBy("conv").agg(F.max("at").alias("n"))
        .select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % 100).alias("base")).join(heads, "base", "left")
        .withColumn("m", F.when(F.col("head").isNull(), 0).otherwise(F.least(F.col("h"), size)).cast("bigint"))
        .select("conv", "n", "h", "m", F.slice(F.coalesce("head", F.array()), 1, F.col("m").cast("int")).alias("head"),
                (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns")), "convs")
    borrowed = convs.select("conv", F.explode("head").alias("t")).select(
        "conv", (F.col("t.at") - 1).alias("blk"), "t.x", "t.y", "t.chars")
    shifts = convs.filter("n > h").select("conv", "h", "m", F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / PART))).alias("part"))
    own = (turns.withColumn("part", F.floor(F.col("at") / PART)).join(shifts, ["conv", "part"]).filter("at > h")
           .select("conv", (F.col("m") + F.col("at") - F.col("h") - 1).alias("blk"), "x", "y", "chars"))
    return borrowed.unionByName(own), convs.select("conv", "turns")


def _halves(names: DataFrame) -> DataFrame:
    """Blocks of the next level: (conv, blk) with the names of both halves and of the whole."""
    of = {side: F.col("blk") % 2 == (0 if side == "l" else 1) for side in "lr"}
    halves = names.groupBy("conv", F.floor(F.col("blk") / 2).alias("blk")).agg(
        *[F.max(F.when(of[s], F.col(c))).alias(s + c) for s in "lr" for c in ("x", "y", "chars")])
    whole = [F.when(F.col("rx").isNull(), F.xxhash64(F.lit(salt), "lx", "ly"))
             .otherwise(F.xxhash64(F.lit(salt), "lx", "ly", "rx", "ry")).alias(c) for salt, c in ((5, "x"), (6, "y"))]
    return halves.select("*", *whole, F.coalesce("rchars", "lchars").alias("chars"))


def _merged(strings: DataFrame) -> DataFrame:
    """Equal strings below equal cut prefixes as one: conversations added, the smallest id kept."""
    return strings.groupBy("blk", "cx", "cy", "x", "y").agg(
        F.sum("n").alias("n"), F.min("rep").alias("rep"), F.max("ends").alias("ends"), F.max("chars").alias("chars"),
        F.max("nx").alias("nx"), F.max("ny").alias("ny"))


def _tries(names: list[DataFrame]) -> tuple[DataFrame, list[DataFrame]]:
    """(nodes, cuts): level 0's strings, and the strings of levels 1.. with their halves.

    ``ends`` is the smallest conversation that ends with the string, if any
    does; (nx, ny) is the name of the prefix at its end. Every prefix length
    is cut at one level only, so a prefix has one name.
    """
    top = names[-1].groupBy("x", "y").agg(F.count("*").alias("n"), F.min("conv").alias("rep"), F.max("chars").alias("chars"))
    strings = top.select(F.lit(0).cast("bigint").alias("blk"), F.lit(_ROOT).cast("bigint").alias("cx"),
                         F.lit(_ROOT).cast("bigint").alias("cy"), "x", "y", "n", "rep", F.col("rep").alias("ends"), "chars",
                         *[F.lit(None).cast("bigint").alias(c) for c in ("nx", "ny")])
    cuts: list[DataFrame] = []
    for level in range(len(names) - 1, 0, -1):
        halves = names[level].select(F.col("conv").alias("rep"), "blk", "lx", "ly", "lchars", "rx", "ry", "rchars")
        cut = saved(strings.drop("x", "y", "chars").join(halves, ["rep", "blk"]).select(
            "*", *[c.alias(f"d{c_}") for c, c_ in zip(_name(7, "cx", "cy", "lx", "ly"), "xy", strict=True)]), "cuts")
        cuts.insert(0, cut)
        upper = cut.select((F.col("blk") * 2).alias("blk"), "cx", "cy", F.col("lx").alias("x"), F.col("ly").alias("y"), "n", "rep",
                           F.when(F.col("rx").isNull(), F.col("ends")).alias("ends"), F.col("lchars").alias("chars"),
                           F.col("dx").alias("nx"), F.col("dy").alias("ny"))
        lower = cut.filter("rx is not null").select(
            (F.col("blk") * 2 + 1).alias("blk"), F.col("dx").alias("cx"), F.col("dy").alias("cy"),
            F.col("rx").alias("x"), F.col("ry").alias("y"), "n", "rep", "ends", F.col("rchars").alias("chars"), "nx", "ny")
        strings = _merged(upper.unionByName(lower))
    return saved(strings, "strings"), cuts


def _forest_totals(nodes: DataFrame, cuts: list[DataFrame]) -> list[DataFrame]:
    """For every level, (blk, cx, cy, leaves, tokens): the totals of each block's forest below a cut prefix."""
    add = [F.sum("leaves").alias("leaves"), F.sum("tokens").alias("tokens")]
    totals = [saved(nodes.groupBy("blk", "cx", "cy").agg(*add), "totals")]
    for cut in cuts:
        below = totals[-1]
        grafts = cut.filter("rx is not null").select(F.col("dx"), F.col("dy"), F.col("cx").alias("ux"), F.col("cy").alias("uy")).distinct()
        lower = (below.filter("blk % 2 = 1").join(grafts, (F.col("cx") == F.col("dx")) & (F.col("cy") == F.col("dy")))
                 .select("blk", F.col("ux").alias("cx"), F.col("uy").alias("cy"), "leaves", "tokens"))
        totals.append(saved(below.filter("blk % 2 = 0").unionByName(lower)
                            .groupBy(F.floor(F.col("blk") / 2).alias("blk"), "cx", "cy").agg(*add), "totals"))
    return totals


def _below(cuts: list[DataFrame], totals: list[DataFrame]) -> DataFrame:
    """(rep, blk, leaves, tokens) of level 0: what lies below each node that is not a dead end."""
    below = None
    for level in range(len(cuts) - 1, -1, -1):
        cut = cuts[level]
        if below is None:
            known = cut.withColumn("leaves", F.lit(0).cast("bigint")).withColumn("tokens", F.lit(0).cast("bigint"))
        else:
            known = cut.join(below, ["rep", "blk"], "left").na.fill(0, ["leaves", "tokens"])
        upper = known.groupBy("blk", "cx", "cy", "lx", "ly", "dx", "dy").agg(
            F.min("rep").alias("rep"), F.sum("leaves").alias("more"), F.sum("tokens").alias("extra"))
        graft = totals[level].filter("blk % 2 = 1").select(F.col("cx").alias("dx"), F.col("cy").alias("dy"), "leaves", "tokens")
        upper = (upper.join(graft, ["dx", "dy"], "left").na.fill(0, ["leaves", "tokens"])
                 .select("rep", (F.col("blk") * 2).alias("blk"), (F.col("leaves") + F.col("more")).alias("leaves"),
                         (F.col("tokens") + F.col("extra")).alias("tokens")))
        lower = known.filter("rx is not null").select("rep", (F.col("blk") * 2 + 1).alias("blk"), "leaves", "tokens")
        below = saved(upper.unionByName(lower).filter("leaves > 0 or tokens > 0"), "below")
    return below


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of sorted (x, y, conv) rows: the ids of one sequence joined by commas, ``PIECE`` at most."""
    for batch in batches:
        x, y, ids = (batch.column(i).to_numpy() for i in range(3))
        if not len(ids):
            continue
        new = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]))))
        ends = np.append(new[1:], len(ids))
        cuts = [(a, min(a + PIECE, e)) for s, e in zip(new, ends, strict=True) for a in range(s, e, PIECE)]
        at = pa.array([a for a, _ in cuts])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i).take(at) for i in range(3)), pa.array([",".join(map(str, ids[a:b])) for a, b in cuts], pa.large_string())],
            names=["x", "y", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of each sequence's pieces, streamed in order: a piece is in memory, never a sequence."""
    key, first, state = None, None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([state.hexdigest()])], names=["ends", "digest"])

    for batch in batches:
        done: list[tuple[int, str]] = []
        for i in range(len(batch)):
            k = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
            if k == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((first, state.hexdigest()))
                key, first, state = k, batch.column(2)[i].as_py(), hashlib.sha256()
            state.update(batch.column(3)[i].as_py().encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done])],
                                             names=["ends", "digest"])
    if key is not None:
        yield row()


def _ending(sequences: DataFrame) -> DataFrame:
    """(ends, digest): per sequence (x, y) its smallest conversation and the sha256 of all of them.

    One sha256 is sequential by nature; a hot sequence is sorted and joined
    to pieces by many tasks, and one task streams the pieces.
    """
    order = ["x", "y", "conv"]
    pieces = saved(sequences.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(_joined_ids, "x bigint, y bigint, first bigint, ids string"), "pieces")
    return (pieces.repartition("x", "y").sortWithinPartitions("x", "y", "first")
            .mapInArrow(_digests, "ends bigint, digest string"))


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie of ``turns`` (conv, blk, x, y, chars; blk from 0) of ``convs`` (conv, turns)."""
    spark = turns.sparkSession
    size = convs.agg(F.count("*").alias("n"), F.min("conv").alias("least"), F.max("turns").alias("deep")).first()
    columns = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
               "n_leaves bigint, saved_tokens bigint, ends_sha256 string")
    if not size["n"]:
        return spark.createDataFrame([], columns)
    names = [saved(turns, "names")]
    for _ in range(max(1, (int(size["deep"]) - 1).bit_length())):
        names.append(saved(_halves(names[-1]), "names"))
    strings, cuts = _tries(names)
    kids = strings.groupBy(F.col("cx").alias("nx"), F.col("cy").alias("ny")).agg(F.count("*").alias("n_children"))
    nodes = saved(strings.join(kids, ["nx", "ny"], "left").na.fill(0, ["n_children"])
                  .withColumn("leaves", (F.col("n_children") == 0).cast("bigint"))
                  .withColumn("tokens", (F.col("n") - 1) * F.col("chars")), "nodes")
    totals = _forest_totals(nodes, cuts)
    below = _below(cuts, totals).withColumnRenamed("leaves", "more").withColumnRenamed("tokens", "extra")

    turnless = convs.filter("turns = 0").select("conv", F.lit(_ROOT).cast("bigint").alias("x"), F.lit(_ROOT).cast("bigint").alias("y"))
    digests = saved(_ending(names[-1].select("conv", "x", "y").unionByName(turnless)), "digests")
    full = saved(nodes.join(below, ["rep", "blk"], "left").join(digests, "ends", "left").select(
        "nx", "ny", "cx", "cy", "blk", F.col("rep").alias("conv_id"), (F.col("blk") + 1).alias("depth"), F.col("n").alias("n_convs"),
        "n_children", (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("n_leaves"),
        (F.col("tokens") + F.coalesce("extra", F.lit(0))).alias("saved_tokens"),
        F.coalesce("digest", F.lit(EMPTY_SHA)).alias("ends_sha256")), "full")

    # The parent's id. Parents of very many children are few: with the bound below, HOT_SHARE at most.
    bound = max(HOT_CHILDREN, full.count() // HOT_SHARE)
    parents = full.filter("n_children > 0").select(
        F.col("nx").alias("cx"), F.col("ny").alias("cy"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = F.broadcast(parents.filter(F.col("n_children") > bound).drop("n_children"))
    rest = parents.filter(F.col("n_children") <= bound).drop("n_children")
    deep = full.filter("blk > 0")
    named = (deep.join(hot, ["cx", "cy"]).unionByName(deep.join(hot, ["cx", "cy"], "left_anti").join(rest, ["cx", "cy"]))
             .unionByName(full.filter("blk = 0").withColumn("parent_conv_id", F.lit(size["least"]).cast("bigint"))))

    # The root stands for all conversations; its totals are those of the top level's one forest.
    ended = digests.join(turnless.agg(F.min("conv").alias("ends")), "ends").select("digest")
    top = totals[-1].agg(F.sum("leaves").alias("leaves"), F.sum("tokens").alias("tokens"))
    root = (spark.range(1).join(top).join(full.filter("blk = 0").agg(F.count("*").alias("n_children")))
            .join(ended.agg(F.max("digest").alias("digest"))).select(
        F.lit(size["least"]).cast("bigint").alias("conv_id"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(None).cast("bigint").alias("parent_conv_id"), F.lit(size["n"]).cast("bigint").alias("n_convs"), "n_children",
        F.coalesce("leaves", F.lit(1)).cast("bigint").alias("n_leaves"), F.coalesce("tokens", F.lit(0)).cast("bigint").alias("saved_tokens"),
        F.coalesce("digest", F.lit(EMPTY_SHA)).alias("ends_sha256")))
    out = root.columns
    return root.unionByName(named.select(*out))


def conversation_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                      role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The prefix trie of the rebuilt conversations, one row a node.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. The root has depth 0 and
    holds every conversation, also one without a turn left.

    Null role or text counts as empty; null turns come first; equal turns are
    ordered by role, then by md5 of the text, and repeated rows are repeated
    turns. Rows without conversation id take no part. Texts are hashed
    whole, however long. An empty table gives no rows. Other columns are not
    looked at, whatever their names.
    """
    return trie(*rebuilt_turns(numbered_turns(conversations, conv_col, turn_col, role_col, text_col)))
