"""N-gram Jaccard join whose candidates must pass prefix filters of several global orders.

A document is the set of its distinct four-word shingles. Under any order of
all shingles, two sets with similarity of at least 0.85 share a shingle among
their first e + 1, e = n - ceil(0.85 n), and their first e + l hold at least
l shared ones. Three orders are used, and a pair must pass all of them:

1. by hash, with l = e / 2 + 1: one scan writes every document's first
   e + l hashes. Sorted by shingle, equal neighbours show which of them occur
   elsewhere; a document with fewer than l such shingles links with nothing.
2. rarest first, ties by hash: the remaining documents' sets are counted
   whole. Shingles of one document come first, so a document with more than
   e of them has no shared prefix and links with nothing; text that many
   documents share comes last and makes no candidates.
3. rarest first, ties by hash backwards.

Documents that share a prefix shingle under order 2 form a bucket; buckets of
the same documents are one. Buckets are not expanded into pairs: first every
member is compared with the bucket's best connected member, which joins the
near copies of one text; only buckets that still hold several components are
compared member by member, in blocks of bounded size, where orders 2, 3 and 1
are intersected before the full sets decide; a block holds what meets in many
buckets, so a set travels a few times and not once a bucket. Copies with equal sets are one
document throughout. The links left out join documents that other links join
already, so the components are those of all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.graph import components, saved, small_batches
from riskframe.llm.text import STEP, U64, mix, shingle_set, signed, slices, words

SHINGLE = 4
PERCENT = 85
PART = 4096               # members of a class or pairs of a hub that a join meets under one key
BLOCK_SHINGLES = 250_000  # set elements in one block of a group of open buckets


def _least(n):
    """Fewest elements a set of n shares with one it links to; also the partner's least size."""
    return (PERCENT * n + 99) // 100


def _others(n):
    """Most elements of a set of n that a partner lacks."""
    return n - _least(n)


def _wanted(n):
    """l of order 1."""
    return (_others(n) + 1) // 2 + 1


_SETS = "id bigint, n bigint, f1 bigint, f2 bigint, first array<bigint>"


def _first_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, two sums over the set (its fingerprint) and order 1's prefix of every text."""
    for batch in batches:
        text = batch.column(1)
        for lo, hi in slices(text):
            w = words(text.slice(lo, hi - lo))
            sets = [shingle_set(w.of(i), SHINGLE) for i in range(hi - lo)]
            f1, f2 = (np.array([f(s).sum(dtype=U64) if len(s) else 0 for s in sets], U64)
                      for f in (lambda s: s, lambda s: mix(s ^ STEP)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(signed(f1)), pa.array(signed(f2)),
                 pa.array([signed(s[:_others(len(s)) + _wanted(len(s))]) for s in sets], pa.list_(pa.int64()))],
                names=["id", "n", "f1", "f2", "first"])


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column(1)
        for lo, hi in slices(text):
            w = words(text.slice(lo, hi - lo))
            sets = [shingle_set(w.of(i), SHINGLE) for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array([int(signed(s.sum(keepdims=True, dtype=U64))[0]) if len(s) else 0 for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([signed(s) for s in sets], pa.list_(pa.int64()))],
                names=["id", "f1", "n", "members"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of the rows of a sorted partition whose shingle a neighbouring row has too.

    The partition's two ends count as shared: their neighbours are elsewhere."""
    token, owner = np.zeros(0, np.int64), np.zeros(0, np.int64)  # the last row, not judged yet
    before = True
    for batch in batches:
        t = np.concatenate((token, batch.column(0).to_numpy()))
        o = np.concatenate((owner, batch.column(1).to_numpy()))
        if len(t) < 2:
            token, owner = t, o
            continue
        same = t[1:] == t[:-1]
        hit = same | np.concatenate(([before], same[:-1]))
        yield pa.RecordBatch.from_arrays([pa.array(o[:-1][hit])], names=["id"])
        before, token, owner = bool(same[-1]), t[-1:], o[-1:]
    if len(token):
        yield pa.RecordBatch.from_arrays([pa.array(owner)], names=["id"])


def _parts(size: Column) -> Column:
    """Into how many parts a key with ``size`` rows is cut: a power of two."""
    return F.pow(F.lit(2), F.greatest(F.ceil(F.log2(F.greatest(size, F.lit(1)) / PART)), F.lit(0))).cast("int")


def _copies(sets: DataFrame) -> DataFrame:
    """(rep, id, f1, f2, n) of the ids whose set a smaller id has too.

    Classes are counted before the shuffle; members look their class up under
    salted keys, whose number grows with the largest class."""
    key = ["f1", "f2", "n"]
    many = saved(sets.groupBy(key).agg(F.min("id").alias("rep"), F.count("*").alias("c")).filter("c > 1"), "classes")
    salts = int(many.agg(F.max(_parts(F.col("c")))).first()[0] or 1)
    spread = many.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = sets.select("id", *key, F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"))
    return saved(salted.join(spread, [*key, "salt"]).filter("id <> rep").select("rep", "id", *key).distinct(), "copies")


def _hash_survivors(sets: DataFrame) -> DataFrame:
    """Ids with enough shared shingles in order 1's prefix."""
    rows = sets.select(F.explode("first").alias("token"), "id")
    shared = (rows.repartitionByRange("token", "id").sortWithinPartitions("token", "id")
              .mapInArrow(_shared, "id bigint").groupBy("id").agg(F.count("*").alias("c")))
    need = sets.groupBy("id").agg(F.min("n").alias("n"))
    enough = F.col("c") >= _sql_wanted(_sql_least(F.col("n")))
    return saved(shared.join(need, "id").filter(enough).select("id"), "survivors")


def _sql_least(n: Column) -> Column:
    return F.floor((n * PERCENT + 99) / 100)


def _sql_wanted(n: Column) -> Column:
    return F.floor((n - _sql_least(n) + 1) / 2) + 1


def _prefixes(sets: DataFrame) -> DataFrame:
    """(id, f1, second, third): shared shingles in the prefixes of orders 2 and 3, documents without any left out."""
    rows = sets.select("id", "f1", "n", F.explode("members").alias("token"))
    # A shingle's frequency is its number of rows: exact, so the order is the same everywhere.
    common = rows.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    held = rows.join(common, "token").groupBy("id", "f1", "n").agg(
        F.collect_list(F.struct("df", "token")).alias("t"))  # at most the document's own set
    rare = F.col("n") - F.size("t")  # shingles of this document alone come first
    left = (F.col("n") - _sql_least(F.col("n")) + 1 - rare).cast("int")
    backwards = F.array_sort(F.transform("t", lambda t: F.struct(t["df"].alias("df"), F.bitwise_not(t["token"]).alias("token"))))
    return (held.withColumn("left", left).filter("left > 0")
            .select("id", "f1", F.slice(F.array_sort("t"), 1, F.col("left")).getField("token").alias("second"),
                    F.transform(F.slice(backwards, 1, F.col("left")).getField("token"), lambda t: F.bitwise_not(t)).alias("third")))


def _alike(common, n, m):
    return 100 * common >= PERCENT * (n + m - common)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column(2), batch.column(3)
        keep = []
        for i in range(len(batch)):
            x, y = (c[i].values.to_numpy() for c in (left, right))
            keep.append(_alike(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


class _Joined:
    """Which labels are joined already within one task's blocks."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x: int, y: int) -> None:
        self.up[max(self.root(x), self.root(y))] = min(self.root(x), self.root(y))


class _Index:
    """Inverted lists of some rows' arrays: how many elements a probe shares with each."""

    def __init__(self, arrays: list[np.ndarray]) -> None:
        every = np.concatenate(arrays)
        order = np.argsort(every, kind="stable")
        self.size = len(arrays)
        self.token = every[order]
        self.row = np.repeat(np.arange(len(arrays)), [len(a) for a in arrays])[order]

    def counts(self, probe: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(self.token, probe), np.searchsorted(self.token, probe, "right")
        reps = hi - lo
        if not reps.any():
            return np.zeros(self.size, np.int64)
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(reps)[:-1])), reps) + np.arange(reps.sum())
        return np.bincount(self.row[at], minlength=self.size)


def _block_links(table: pa.Table) -> pa.Table:
    """Links between components in one pair of blocks of a group.

    Rows: g, i, j, side (0: block i, 1: block j), main, id, label, n,
    members, second, third. Members of the group's main component (main)
    come in blocks of their own, which only meet the others'.
    """
    ids, label, side, n = (table.column(c).to_numpy() for c in ("id", "label", "side", "n"))
    main = table.column("main").to_numpy(zero_copy_only=False).astype(bool)
    arrays = {c: [v.values.to_numpy() for v in table.column(c)] for c in ("members", "second", "third")}
    unsigned = [m.view(U64) for m in arrays["members"]]  # sorted as order 1 sorts
    one = table.column("i")[0] == table.column("j")[0]
    left = np.arange(len(ids)) if one else np.flatnonzero(side == 0)
    right = np.arange(len(ids)) if one else np.flatnonzero(side == 1)
    joined, out = _Joined(), []
    probes, base = (left, right) if one or main[right].sum() >= main[left].sum() else (right, left)
    if len(probes) and len(base):
        want = _wanted(n)
        first = [u[:_others(int(k)) + int(w)].view(np.int64) for u, k, w in zip(unsigned, n, want, strict=True)]
        index = {c: _Index([a[b] for b in base]) for c, a in (("second", arrays["second"]), ("third", arrays["third"]), ("first", first))}
        for p in probes:
            ok = (label[base] != label[p]) & ~(main[base] & main[p])
            if one:
                ok &= base > p
            ok &= index["second"].counts(arrays["second"][p]) > 0
            if not ok.any():
                continue
            ok &= index["third"].counts(arrays["third"][p]) > 0
            ok &= index["first"].counts(first[p]) >= np.minimum(want[base], want[p])
            for b in base[ok]:
                x, y = int(label[p]), int(label[b])
                if joined.root(x) == joined.root(y):
                    continue
                common = len(np.intersect1d(arrays["members"][p], arrays["members"][b], assume_unique=True))
                if _alike(common, int(n[p]), int(n[b])):
                    joined.join(x, y)
                    out.append((int(ids[p]), int(ids[b])))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def _buckets(prefixes: DataFrame) -> DataFrame:
    """(token, id, c): the buckets of two and more ids, one for each different group of ids."""
    rows = prefixes.select(F.explode("second").alias("token"), "id").distinct()
    # Two independent sums over the members tell groups apart; the smallest token stands for a group.
    group = rows.groupBy("token").agg(
        F.count("*").alias("c"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("s"),
        F.sum(F.xxhash64(F.lit(1), "id").cast("decimal(38,0)")).alias("t")).filter("c > 1")
    chosen = group.groupBy("c", "s", "t").agg(F.min("token").alias("token")).select("token", "c")
    return saved(rows.join(chosen, "token"), "buckets")


def _hub_links(buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of every bucket's best connected member with the others."""
    degree = buckets.groupBy("id").agg(F.sum("c").alias("degree"))
    best = (buckets.select("token", "id").join(degree, "id").groupBy("token")
            .agg(F.max(F.struct("degree", F.bitwise_not("id").alias("m"))).alias("x"))
            .select("token", F.bitwise_not(F.col("x.m")).alias("a")))
    pairs = (buckets.join(best, "token").filter("id <> a").groupBy("a", F.col("id").alias("b"))
             .agg(F.max(_parts(F.col("c"))).alias("parts")).withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")))
    pairs = saved(pairs, "pairs")
    # A hub's set goes to as many parts as its largest bucket asks for.
    hubs = (pairs.select("a", "parts").distinct().join(sets.select(F.col("id").alias("a"), F.col("members").alias("x")), "a")
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    both = (pairs.join(sets.select(F.col("id").alias("b"), F.col("members").alias("y")), "b")
            .join(hubs, ["a", "parts", "part"]).select("a", "b", "x", "y"))
    return saved(both.mapInArrow(_verify, "a bigint, b bigint").distinct(), "links")


def _labels(edges: DataFrame) -> DataFrame:
    return saved(components(edges).select("id", F.col("component").alias("label")), "labels")


def _open_links(buckets: DataFrame, label: DataFrame, sets: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Links inside the buckets whose members are still in several components.

    Components that meet in such buckets form a group. Its documents are laid
    into blocks of bounded size, those with the same smallest open bucket
    together, and two blocks are compared if a bucket has members in both: a
    document travels once a block it meets, not once a bucket."""
    marked = buckets.filter("c > 2").join(label, "id", "left").select(
        "token", "id", F.coalesce("label", "id").alias("label"))  # two members: the hub's check was the only one
    spans = (marked.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
             .filter("low < high").select("token", "low"))
    open_ = saved(marked.join(spans, "token"), "open")
    group = components(open_.select(F.col("low").alias("a"), F.col("label").alias("b")).distinct())
    docs = (open_.groupBy("id").agg(F.min("token").alias("home"), F.min("label").alias("label"))
            .join(group.select(F.col("id").alias("label"), F.col("component").alias("g")), "label")
            .join(sets.groupBy("id").agg(F.sum("n").alias("size")), "id"))
    docs = saved(docs, "members")
    top = (docs.groupBy("g", "label").agg(F.count("*").alias("k")).groupBy("g")
           .agg(F.max(F.struct("k", "label")).alias("top")).select("g", F.col("top.label").alias("top")))
    crowded = docs.groupBy("g", "home").agg(F.sum("size").alias("all")).filter(F.col("all") > BLOCK_SHINGLES).select("g", "home")
    docs = (docs.join(top, "g").join(crowded.withColumn("crowded", F.lit(True)), ["g", "home"], "left")
            .select("g", "id", "label", "size", (F.col("label") == F.col("top")).alias("main"),
                    F.when(F.col("crowded"), F.xxhash64("id")).otherwise(F.xxhash64("home")).alias("key")))
    blocks = docs.groupBy("g").agg(
        F.ceil(F.sum(F.when(F.col("main"), F.col("size"))) / BLOCK_SHINGLES).cast("int").alias("mains"),
        F.ceil(F.sum(F.when(~F.col("main"), F.col("size"))) / BLOCK_SHINGLES).cast("int").alias("rest"))
    # Blocks 0.. hold the other components' documents, the following ones the main component's;
    # the main ones meet the others, never each other.
    own = F.when(F.col("main"), F.col("rest") + F.pmod("key", F.col("mains"))).otherwise(F.pmod("key", F.col("rest"))).cast("int")
    placed = saved(docs.join(blocks, "g").select("g", "id", "label", "main", own.alias("own")), "blocks")
    spots = open_.select("token", "id").join(placed, "id").select("token", "g", "own", "main").distinct()
    first, second = spots.alias("s"), spots.alias("t")
    meet = (first.join(second, F.col("s.token") == F.col("t.token"))
            .filter((F.col("s.own") <= F.col("t.own")) & ~(F.col("s.main") & F.col("t.main")))
            .select("s.g", F.col("s.own").alias("i"), F.col("t.own").alias("j")).distinct())
    sides = meet.withColumn("side", F.explode(F.when(F.col("i") == F.col("j"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))))
    sides = sides.withColumn("own", F.when(F.col("side") == 0, F.col("i")).otherwise(F.col("j")))
    rows = (placed.join(sides, ["g", "own"]).select("g", "i", "j", "side", "main", "id", "label")
            .join(sets.join(prefixes, ["id", "f1"]).drop("f1"), "id"))
    return saved(rows.groupBy("g", "i", "j").applyInArrow(_block_links, "a bigint, b bigint").distinct(), "more")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id.

    ``component_id`` is the smallest id reachable over links (100 * common >=
    85 * union of the shingle sets), the row's own id if it has none. Null and
    empty texts (no words) have no shingles and no links; very long texts are
    taken whole. A row without id takes no part: component_id null. Rows that
    repeat an id are one node with the links of all its texts; each keeps its
    own n_shingles. An empty table gives no rows. Other columns of ``docs``
    are not looked at, whatever their names.
    """
    base = small_batches(docs).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    every = saved(base.mapInArrow(_first_hashes, _SETS), "first")
    sets = every.filter("id is not null and n > 0")
    copies = _copies(sets)
    # Copies and survivors grow with the table: by merge at every size, never broadcast.
    single = sets.join(copies.select("id", "f1", "f2", "n").hint("merge"), ["id", "f1", "f2", "n"], "left_anti")
    survivors = _hash_survivors(single)
    texts = base.filter("id is not null").join(survivors.hint("merge"), "id", "left_semi")
    # The whole table is read again, but only the remaining documents are cut into shingles.
    whole = saved(texts.mapInArrow(_whole_sets, "id bigint, f1 bigint, n bigint, members array<bigint>")
                  .filter("n > 0").join(copies.select("id", "f1", "n").hint("merge"), ["id", "f1", "n"], "left_anti")
                  .dropDuplicates(["id", "f1", "n"]), "sets")
    prefixes = saved(_prefixes(whole), "prefixes")
    buckets = _buckets(prefixes)
    near = saved(whole.join(buckets.select("id").distinct(), "id", "left_semi"), "near")
    edges = saved(_hub_links(buckets, near).unionByName(copies.select(F.col("rep").alias("a"), F.col("id").alias("b"))), "links")
    label = _labels(edges)
    more = _open_links(buckets, label, near, prefixes)
    final = _labels(label.select(F.col("id").alias("a"), F.col("label").alias("b")).unionByName(more))
    return every.select("id", "n").join(final, "id", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("label", "id").alias("component_id"))
