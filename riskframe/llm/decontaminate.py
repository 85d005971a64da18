"""Benchmark decontamination by SimHash over item-sized windows.

Case and ASCII punctuation do not count. An item of n words is compared with windows of n words,
or with the whole text where that is shorter. Both are five-word
shingles (an item of fewer words is one shingle) weighted by 1 + ln(N /
items that have the shingle); the 64-bit SimHash of a window is the sign
of the weighted sum of its shingles' +-1 hash bits. All items of a window's length
within Hamming distance ``RADIUS`` are found through ``RADIUS + 1`` bit
blocks: two fingerprints that differ in at most ``RADIUS`` bits agree on
one block at least. Each candidate is then verified by the exact weighted
Jaccard similarity of the two shingle sets, ``SIMILARITY`` or more.

Only windows that hold a shingle of some item of their length are
fingerprinted: any other window has similarity zero with every item it
could be compared with, so nothing is lost. At 0.75 two
fingerprints differ in 11 bits of 64 on average (standard deviation 3).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.graph import free_name, small_batches
from riskframe.llm.text import U64, shingle_hashes, signed, slices, words

SHINGLE = 5
SIMILARITY = 0.75
RADIUS = 20
ITEMS_PER_PASS = 50_000  # items held by a task at a time; more items take more passes over the documents

_BITS = np.arange(64, dtype=U64)
_EDGES = np.linspace(0, 64, RADIUS + 2).astype(int)
_LEAKS = "id bigint, item bigint, first_word int, n_words int, similarity double, distance int"


def _weight(n: int, df: int) -> int:
    """Whole thousandths, so that equal windows have equal sums whatever the order."""
    return round(1000 * (1 + math.log(max(n, 1) / df)))


def _signs(g: np.ndarray) -> np.ndarray:
    return ((g[:, None] >> _BITS) & U64(1)).astype(np.int64) * 2 - 1


def _pack(total: np.ndarray) -> np.ndarray:
    return ((total > 0).astype(U64) << _BITS).sum(axis=1, dtype=U64)


def _blocks(fingerprints: np.ndarray) -> np.ndarray:
    """One key per bit block of each fingerprint: (n, RADIUS + 1)."""
    out = np.empty((len(fingerprints), RADIUS + 1), U64)
    for b, (lo, hi) in enumerate(zip(_EDGES[:-1], _EDGES[1:], strict=True)):
        out[:, b] = U64(b << 56) | ((fingerprints >> U64(lo)) & U64((1 << int(hi - lo)) - 1))
    return out


class Index:
    """Items by length, with their block index."""

    def __init__(self, items: list[tuple[int, int, np.ndarray, np.ndarray]], rare: int) -> None:
        """items: (item, n_words, shingles in any order, weights); rare: weight of a shingle in no item."""
        self.rare, self.items = rare, items
        pairs = {int(s): int(w) for _, _, g, ws in items for s, w in zip(g, ws, strict=True)}
        self.shingles = np.array(sorted(pairs), U64)
        self.weights = np.array([pairs[int(s)] for s in self.shingles])
        owner = sorted({(int(x), n) for _, n, g, _ in items for x in g})
        self.owned = np.array([x for x, _ in owner], U64)  # (shingle, length of an item that has it)
        self.owner = np.array([n for _, n in owner], np.int64)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.shingles >> U64(44)).astype(np.int64)] = True
        self.lengths: dict[int, tuple] = {}
        for n in sorted({x[1] for x in items}):
            at = [k for k, x in enumerate(items) if x[1] == n]
            f = _pack(np.array([(_signs(items[k][2]) * items[k][3][:, None]).sum(axis=0) for k in at]))
            keys = _blocks(f)
            flat, who = keys.ravel(), np.repeat(np.arange(len(at)), keys.shape[1])
            order = np.argsort(flat, kind="stable")
            for k in at:  # repeated shingles count in the fingerprint, not in the set
                first = np.unique(items[k][2], return_index=True)[1]
                items[k] = (*items[k][:2], items[k][2][first], items[k][3][first])
            self.lengths[n] = (np.array(at), f, flat[order], who[order])

    def weigh(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights of shingles, and which of them belong to an item."""
        hit = self.seen[(g >> U64(44)).astype(np.int64)]
        out = np.full(len(g), self.rare, np.int64)
        at = np.flatnonzero(hit)
        if len(at):
            i = np.minimum(np.searchsorted(self.shingles, g[at]), len(self.shingles) - 1)
            real = self.shingles[i] == g[at]
            hit[at] = real
            out[at[real]] = self.weights[i[real]]
        return out, hit

    def leaks(self, h: np.ndarray) -> list[tuple[int, int, int, float, int]]:
        """(item, first word, words, similarity, distance): the best window of each item in a text."""
        best: dict[int, tuple] = {}
        for k in range(1, SHINGLE + 1):
            mine = [n for n in self.lengths if min(n, SHINGLE) == k]
            if mine:
                g = shingle_hashes(h, k)
                w, hit = self.weigh(g)
                if hit.any():
                    self._windows(g, w, hit, k, mine, best)
        return [best[x] for x in sorted(best)]

    def _windows(self, g: np.ndarray, w: np.ndarray, hit: np.ndarray, k: int, lengths: list[int], best: dict) -> None:
        total = np.zeros((len(g) + 1, 64), np.int64)
        np.cumsum(_signs(g) * w[:, None], axis=0, out=total[1:])
        where = np.flatnonzero(hit)
        lo, hi = np.searchsorted(self.owned, g[where]), np.searchsorted(self.owned, g[where], "right")
        reps = hi - lo
        owner = self.owner[np.repeat(lo - np.concatenate(([0], np.cumsum(reps)[:-1])), reps) + np.arange(reps.sum())]
        where = np.repeat(where, reps)
        for n in sorted(set(lengths) & set(owner.tolist())):
            at, f, keys, who = self.lengths[n]
            size = min(n - k + 1, len(g))  # a text shorter than the item is one window
            mine = np.zeros(len(g) + 1, np.int64)
            mine[where[owner == n] + 1] = 1
            some = np.cumsum(mine)
            starts = np.flatnonzero(some[size:] - some[:-size] > 0)
            if not len(starts):
                continue
            prints = _pack(total[starts + size] - total[starts])
            probe = _blocks(prints)
            lo, hi = np.searchsorted(keys, probe), np.searchsorted(keys, probe, "right")
            reps = (hi - lo).ravel()
            if not reps.any():
                continue
            take = np.repeat(lo.ravel() - np.concatenate(([0], np.cumsum(reps)[:-1])), reps) + np.arange(reps.sum())
            pair = np.unique(np.repeat(np.repeat(np.arange(len(starts)), probe.shape[1]), reps) * len(at) + who[take])
            window, item = pair // len(at), pair % len(at)
            distance = np.bitwise_count(prints[window] ^ f[item])
            for x, y, d in zip(window[distance <= RADIUS], item[distance <= RADIUS], distance[distance <= RADIUS], strict=True):
                s = int(starts[x])
                name, _, mine, weights = self.items[at[y]]
                own, first = np.unique(g[s:s + size], return_index=True)
                common = np.isin(mine, own)
                shared = weights[common].sum()
                score = float(shared / (weights.sum() + w[s:s + size][first].sum() - shared))
                if score >= SIMILARITY - 1e-9 and (name not in best or score > best[name][3]):
                    best[name] = (name, s, size + k - 1, score, int(d))


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in slices(batch.column(1)):
            w = words(batch.column(1).slice(lo, hi - lo), punctuation=False)
            rows = [(batch.column(0)[lo + i].as_py(), batch.column(2)[lo + i].as_py(), len(w.of(i)), signed(shingle_hashes(w.of(i), SHINGLE)).tolist()) for i in range(hi - lo)]
            rows = [x for x in rows if x[2]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64()),
                 pa.array([x[2] for x in rows], pa.int32()), pa.array([x[3] for x in rows], pa.list_(pa.int64()))],
                names=["item", "version", "n_words", "shingles"])


def leaked_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Pairs (id, item, first_word, n_words, similarity, distance) of documents and
    the benchmark items they contain, with the best window of each item.

    Null or empty texts and items match nothing, nor do rows without id or
    item id. Rows that repeat a document or an item give their pair once,
    with the best similarity; of equally similar windows the nearest in
    fingerprint, then the first, counts. Every window of a very long text is
    looked at. An empty table or benchmark gives no pairs. Other columns are
    not looked at.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item"), F.lower(item_text_col).alias("text"),
                             F.xxhash64(item_text_col).alias("version")).filter("item is not null").distinct() \
        .mapInArrow(_item_batches, "item bigint, version bigint, n_words int, shingles array<bigint>")
    n = items.count()
    each = items.select("item", "version", "n_words", F.explode("shingles").alias("s"))
    df = each.groupBy("s").agg(F.count_distinct("item").alias("df"))
    weighed = (each.join(df, "s").groupBy("item", "version", "n_words")
               .agg(F.sort_array(F.collect_list(F.struct("s", "df"))).alias("x")))
    base = small_batches(docs).select(F.col(id_col).cast("bigint").alias("id"), F.lower(text_col).alias("text")).filter("id is not null")
    passes = max(1, math.ceil(n / ITEMS_PER_PASS))
    found = None
    for k in range(passes):
        part = weighed.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == k).collect()  # ITEMS_PER_PASS or so
        index = Index([(r["item"], r["n_words"], np.array([x["s"] for x in r["x"]], np.int64).view(U64),
                        np.array([_weight(n, x["df"]) for x in r["x"]])) for r in part], _weight(n, 1))
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for lo, hi in slices(batch.column(1)):
                    w = words(batch.column(1).slice(lo, hi - lo), punctuation=False)
                    rows = [(batch.column(0)[lo + i].as_py(), *x) for i in range(hi - lo) for x in index.leaks(w.of(i))]
                    columns = list(zip(*rows, strict=True)) or [[]] * 6
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                                     names=["id", "item", "first_word", "n_words", "similarity", "distance"])

        one = base.mapInArrow(run, _LEAKS)
        found = one if found is None else found.unionByName(one)
    return (found.groupBy("id", "item")
            .agg(F.max(F.struct("similarity", (-F.col("distance")).alias("d"), (-F.col("first_word")).alias("f"), "n_words")).alias("x"))
            .select(F.col("id").alias(id_col), F.col("item").alias(item_col), (-F.col("x.f")).alias("first_word"),
                    F.col("x.n_words").alias("n_words"), F.col("x.similarity").alias("similarity"), (-F.col("x.d")).alias("distance")))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that contain a benchmark item; rows without id stay."""
    leak = free_name("__leak", docs.columns)
    found = leaked_items(docs, benchmark, id_col, text_col).select(F.col(id_col).alias(leak)).distinct()
    return docs.join(found, F.col(id_col) == F.col(leak), "left_anti")
