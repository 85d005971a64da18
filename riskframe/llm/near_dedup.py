"""MinHash near-duplicates by fast similarity sketching.

A document is the set of its distinct five-word shingles. Its sketch has
``COORDINATES`` values, filled in rounds (Dahlgaard, Knudsen and Thorup
2017): in round i every shingle is thrown into one hashed bin, and a bin
keeps the smallest (round, hash) it has seen; after as many rounds as there
are bins, round i throws every shingle into bin i, so each coordinate is
filled by then at the latest. Two coordinates agree with the probability of
the Jaccard similarity, with concentration like independent hashing, at the
cost of about one hash per shingle for a long document.

Bands of ``ROWS`` coordinates give bucket keys; a pair at similarity 0.75
shares one with probability 1 - (1 - 0.75^4)^32 = 0.999995. Every link is
confirmed on the full shingle sets of both documents. Copies with equal sets
are collapsed to one representative before any bucket is formed.

Buckets are never expanded into all pairs. First each bucket elects its
member with the most colliding neighbours over all bands (in a group of
near copies, the text they derive from) and the others are checked against
it. Buckets whose members still lie in different components are then
gathered into groups of documents that share such buckets, each group is
cut into blocks of bounded size, and a pair of blocks is compared inside
one task by an inverted index on the full sets; only a spanning set of
links leaves it. The outcome is that of checking every pair that shares a
bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.graph import components, free_name, saved, small_batches
from riskframe.llm.text import STEP, U64, mix, seeds, shingle_set, signed, slices, words

SHINGLE = 5
PERCENT = 75
COORDINATES = 128
ROWS = 4
SALTS = 32             # parts of a group of exact copies when its members look up their class
BLOCK_SHINGLES = 250_000  # set elements in one block of an unresolved group

_ROUND = seeds(2 * COORDINATES, 7)
_FILL = 1.5 * math.log(COORDINATES)


def sketch(s: np.ndarray) -> np.ndarray:
    """The sketch of one non-empty set of 64-bit hashes."""
    t, n = COORDINATES, len(s)
    out = np.full(t, ~U64(0), U64)
    step = max(1, min(t, math.ceil(_FILL * t / n)))
    for at in range(0, t, step):
        r = np.arange(at, min(t, at + step))
        h = mix(s[None, :] ^ _ROUND[r][:, None])
        value = (r.astype(U64)[:, None] << U64(56)) | (h >> U64(8))
        np.minimum.at(out, (h & U64(t - 1)).astype(np.int64).ravel(), value.ravel())
        if (out != ~U64(0)).all():
            return out
    empty = np.flatnonzero(out == ~U64(0))
    for b in empty:  # the guarantee: round t + b throws everything into bin b
        out[b] = (U64(t + b) << U64(56)) | (mix(s ^ _ROUND[t + b]) >> U64(8)).min()
    return out


def band_keys(sk: np.ndarray) -> np.ndarray:
    rows = sk.reshape(-1, ROWS)
    h = np.arange(1, len(rows) + 1, dtype=U64) * STEP
    for j in range(ROWS):
        h = mix(h ^ rows[:, j])
    return h


_SKETCHES = "id bigint, n_shingles bigint, f1 bigint, f2 bigint, bands array<bigint>"


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column(1)
        for lo, hi in slices(text):
            w = words(text.slice(lo, hi - lo))
            n, f1, f2, bands = [], [], [], []
            for i in range(hi - lo):
                s = shingle_set(w.of(i), SHINGLE)
                n.append(len(s))
                f1.append(int(signed(s.sum(keepdims=True, dtype=U64))[0]) if len(s) else 0)
                f2.append(int(signed(mix(s ^ STEP).sum(keepdims=True, dtype=U64))[0]) if len(s) else 0)
                bands.append(signed(band_keys(sketch(s))) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                 pa.array(f2, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["id", "n_shingles", "f1", "f2", "bands"])


def _alike(common: int, n: int, m: int) -> bool:
    return 100 * common >= PERCENT * (n + m - common)


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in slices(batch.column(2)):
            x, y = (words(batch.column(c).slice(lo, hi - lo)) for c in (2, 3))
            keep = []
            for i in range(hi - lo):
                s, t = shingle_set(x.of(i), SHINGLE), shingle_set(y.of(i), SHINGLE)
                keep.append(_alike(len(np.intersect1d(s, t, assume_unique=True)), len(s), len(t)))
            part = batch.slice(lo, hi - lo).select([0, 1])
            yield part.filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. ``texts``: id, text."""
    both = (pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
            .select("a", "b", "ta", "tb"))
    return both.mapInArrow(_verify_batches, "a bigint, b bigint")


class _Forest:
    """Union-find over the ids of one block pair."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _block_links(table: pa.Table) -> pa.Table:
    """Links between documents of different labels in one pair of blocks.

    Rows: g, i, j, side (0: block i, 1: block j), id, label, text.
    """
    side = table.column("side").to_numpy()
    ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
    sets: list = [None] * len(ids)
    text = table.column("text").combine_chunks()
    for lo, hi in slices(text):
        w = words(text.slice(lo, hi - lo))
        for i in range(hi - lo):
            sets[lo + i] = shingle_set(w.of(i), SHINGLE)
    one = table.column("i")[0] == table.column("j")[0]
    right = np.arange(len(ids)) if one else np.flatnonzero(side == 1)
    left = np.arange(len(ids)) if one else np.flatnonzero(side == 0)
    out: list[tuple[int, int]] = []
    if len(left) and len(right):
        names, counts = np.unique(labels, return_counts=True)
        main = names[counts.argmax()]
        forest = _Forest()
        for probe, base in ((left, right), (right, left)):
            # Two documents of the main label need no check: ask for the others only.
            probe = [p for p in probe if labels[p] != main]
            if not probe:
                continue
            size = np.array([len(sets[b]) for b in base])
            where = np.repeat(np.arange(len(base)), size)
            every = np.concatenate([sets[b] for b in base])
            order = np.argsort(every, kind="stable")
            every, where = every[order], where[order]
            for p in probe:
                lo, hi = np.searchsorted(every, sets[p]), np.searchsorted(every, sets[p], "right")
                reps = hi - lo
                if not reps.any():
                    continue
                at = np.repeat(lo - np.concatenate(([0], np.cumsum(reps)[:-1])), reps) + np.arange(reps.sum())
                common = np.bincount(where[at], minlength=len(base))
                for k in np.flatnonzero(100 * common >= PERCENT * (size + len(sets[p]) - common)):
                    b = base[k]
                    if labels[b] != labels[p]:
                        x, y = int(labels[p]), int(labels[b])
                        if forest.join(x, y):
                            out.append((int(ids[p]), int(ids[b])))
            if one:
                break
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def _labels(edges: DataFrame) -> DataFrame:
    return components(edges).select(F.col("id"), F.col("component").alias("label"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    ``component_id`` is the smallest id reachable over links (100 * common >=
    75 * union of the shingle sets), the row's own id if it has none;
    ``kept`` says whether it is the row's own id. Null and empty texts (no
    words) have no shingles and no links. A row without id takes no part:
    component_id null, kept true. Rows that repeat an id are one node with
    the links of all its texts; each keeps its own n_shingles. Very long
    texts are taken whole; an empty table gives no rows. Other columns of
    ``docs`` are not looked at, whatever their names.
    """
    base = small_batches(docs).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    sk = saved(base.mapInArrow(_sketch_batches, _SKETCHES), "sketches")
    sets = sk.filter("id is not null and n_shingles > 0")

    # Exact copies: classes of equal sets; their members look the class up by (set, salt).
    key = ["f1", "f2", "n_shingles"]
    many = (sets.groupBy(key).agg(F.min("id").alias("rep"), F.count("*").alias("c")).filter("c > 1")
            .select(*key, "rep", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = sets.select("id", *key, F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    same = saved(salted.join(many, [*key, "salt"]).filter("id <> rep")
                 .select(F.col("rep").alias("a"), F.col("id").alias("b"), *key).distinct(), "copies")

    # Band buckets of representatives with more than one member.
    reps = (sets.join(same.select(F.col("b").alias("id"), *key), ["id", *key], "left_anti")
            .select("id", F.explode("bands").alias("key")).distinct().repartition("key"))
    full = reps.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    met = saved(reps.join(full, "key"), "buckets")
    degree = met.groupBy("id").agg(F.sum("c").alias("degree"))
    ranked = met.select("key", "id").join(degree, "id")
    best = ranked.groupBy("key").agg(F.max(F.struct("degree", (-F.col("id")).alias("m"))).alias("x"))
    pairs = saved(met.select("key", "id").join(best.select("key", (-F.col("x.m")).alias("hub")), "key")
                  .filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    ids = met.select("id").distinct()
    # A repeated id's texts: any row of that id carries a set of its own, so all are kept.
    texts = saved(base.filter("id is not null").join(ids, "id", "left_semi"), "texts")
    links = saved(_verified(pairs, texts).distinct(), "links")
    edges = links.unionByName(same.select("a", "b"))
    label = saved(_labels(edges), "labels")

    # Buckets that still hold different components.
    marked = met.select("key", "id").join(label, "id", "left").select(
        "key", "id", F.coalesce("label", "id").alias("label"))
    spans = (marked.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("id").alias("m"))
             .filter("lo <> hi").select("key", "m"))
    # Those of two members have been checked: hub against the other.
    open_ = saved(marked.join(spans, "key")
                  .join(full.filter("c > 2").select("key"), "key", "left_semi"), "open")
    group = components(open_.select(F.col("m").alias("a"), F.col("id").alias("b")))
    nodes = group.join(open_.select("id", "label").distinct(), "id").select(
        F.col("component").alias("g"), "id", "label")
    sized = nodes.join(sets.groupBy("id").agg(F.max("n_shingles").alias("n")), "id")
    blocks = sized.groupBy("g").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    placed = (sized.join(blocks, "g")
              .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                      F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "id", "label"))
    more = (placed.join(texts, "id").groupBy("g", "i", "j").applyInArrow(_block_links, "a bigint, b bigint"))
    final = saved(_labels(label.select(F.col("id").alias("a"), F.col("label").alias("b")).unionByName(saved(more, "more"))), "labels")
    found = sk.select("id", "n_shingles").join(final, "id", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("label", "id").alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("component_id") == F.col(id_col), F.lit(True)))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near duplicates, all columns.

    The document kept is the one with the smallest id of its component.
    Rows that repeat both id and text are one document and are kept once;
    rows without id are all kept.
    """
    found = near_duplicates(docs, id_col, text_col)
    kept, again_id = free_name("__keep", docs.columns), free_name("__twice", docs.columns)
    keep = found.filter(F.col("kept") & F.col(id_col).isNotNull()).select(F.col(id_col).alias(kept)).distinct()
    own = docs.filter(F.col(id_col).isNotNull()).join(keep, F.col(id_col) == F.col(kept), "left_semi")
    twice = (found.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("rows"))
             .filter("rows > 1").select(F.col(id_col).alias(again_id)))
    once = own.join(twice, F.col(id_col) == F.col(again_id), "left_anti")
    again = own.join(twice, F.col(id_col) == F.col(again_id), "left_semi").dropDuplicates([id_col, text_col])
    return once.unionByName(again).unionByName(docs.filter(F.col(id_col).isNull()))
