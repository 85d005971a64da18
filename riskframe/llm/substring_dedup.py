"""Repeated passages between documents by collinear chaining of seeds.

1. Seeds: of every ``WINDOW`` consecutive k-mers of ``KMER`` words the one
   with the smallest hash (winnowing), so any shared run of ``KMER + WINDOW
   - 1`` words shares a seed.
2. Anchors: the n-th occurrence of a seed in a text is matched with the n-th
   occurrence in the document with the smallest id that has so many, and
   with that one only. A passage in a million documents gives a million
   matches, not their pairs; one that repeats a line inside itself still
   matches in order. Parts of a passage may have different anchors, so
   that none shares the whole: where all seeds of ``MIN_WORDS`` words are
   shared with any document, those words are hashed as one, at every word,
   and matched with the smallest id that has them all, unless a passage
   found by chains holds them already. No text keeps ``MIN_WORDS`` words that
   an earlier one keeps, however often they occur.
3. Chains: the matches of one document with one anchor document are merged
   into runs on a diagonal; the best chains of runs that advance in both
   documents are found by a sweep with a Fenwick tree of prefix maxima, a
   gap costing half a word for each word skipped on either side.
4. Alignment: the runs of a chain are extended on the texts of both
   documents and the gaps between them are aligned (banded longest common
   subsequence). Every longest stretch of runs with ``IDENTITY`` of its words
   equal, the whole chain or a part of it, is extended outward word by word
   with a drop limit and counts as a passage from ``MIN_WORDS`` words.

The anchor keeps the passage; the other documents lose it, but for words put
in between that the anchor does not have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.graph import free_name, saved, small_batches
from riskframe.llm.text import shingle_hashes, signed, slices, words

KMER = 8
WINDOW = 12
MIN_WORDS = 50
IDENTITY = 0.8
GAP = 0.5
LEAST_CHAIN = 20   # words from the first to the last seed of a chain worth aligning
MARGIN = 96        # words of the anchor fetched on either side of a chain
DROP = 4           # mismatches that end an extension
BAND = 24          # diagonals on either side in a banded alignment

_SEEDS = "id bigint, version bigint, seed bigint, nth int, pos int"
_RUNS = "runs array<struct<p0:int,p1:int,a0:int>>"  # words p0 to p1 of the text, from a0 on in the anchor
_CHAINS = f"id bigint, version bigint, anchor bigint, {_RUNS}"
_WINDOWS = f"id bigint, version bigint, anchor bigint, {_RUNS}, first int, other string"
_FOUND = "passages array<struct<first:int,last:int,source_id:bigint>>"
_ALIGNED = f"id bigint, version bigint, {_FOUND}, grams array<struct<gram:bigint,pos:int,again:boolean>>"
_PASSAGES = ("id bigint, version bigint, n_words bigint, removed bigint, "
             "passages array<struct<first:int,last:int,source_id:bigint>>, kept string")


def winnow(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the seeds of one text's word hashes."""
    if len(h) < KMER:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = shingle_hashes(h, KMER)
    if len(g) <= WINDOW:
        at = np.array([g.argmin()])
    else:
        view = np.lib.stride_tricks.sliding_window_view(g, WINDOW)
        at = np.unique(view.argmin(axis=1) + np.arange(len(view)))
    return at, g[at]


def occurrence(g: np.ndarray) -> np.ndarray:
    """For each seed of a text, how many equal ones come before it."""
    order = np.argsort(g, kind="stable")
    new = np.concatenate(([True], np.diff(g[order]) != 0))
    start = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
    out = np.empty(len(g), np.int32)
    out[order] = np.arange(len(g)) - start
    return out


def _seed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in slices(batch.column(1)):
            w = words(batch.column(1).slice(lo, hi - lo))
            ids, versions = (batch.column(c).slice(lo, hi - lo).to_pylist() for c in (0, 2))
            parts = []
            for i in range(hi - lo):
                at, g = winnow(w.of(i))
                if len(at):
                    n = len(at)
                    parts.append((np.full(n, ids[i]), np.full(n, versions[i]), signed(g), occurrence(g), at.astype(np.int32)))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)],
                                                 names=["id", "version", "seed", "nth", "pos"])


class _PrefixMax:
    """Fenwick tree of (value, item) prefix maxima."""

    def __init__(self, n: int) -> None:
        self.best = [(0.0, -1)] * (n + 1)

    def put(self, at: int, value: float, item: int) -> None:
        at += 1
        while at < len(self.best):
            if value > self.best[at][0]:
                self.best[at] = (value, item)
            at += at & -at

    def upto(self, at: int) -> tuple[float, int]:
        """The best of positions before ``at``."""
        out = (0.0, -1)
        while at:
            if self.best[at][0] > out[0]:
                out = self.best[at]
            at -= at & -at
        return out


def chains(pos: np.ndarray, apos: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Best chains of seed matches: (p0, p1, a0, a1), word ranges in both texts."""
    return [(c[0][0], c[-1][1], c[0][2], c[-1][2] + c[-1][1] - c[-1][0]) for c in linked(pos, apos)]


def linked(pos: np.ndarray, apos: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Best chains of seed matches, each as its runs in order: (p0, p1, a0)."""
    order = np.lexsort((pos, pos - apos))
    p, a = pos[order], apos[order]
    diagonal = p - a
    cut = np.flatnonzero((np.diff(diagonal) != 0) | (np.diff(p) > KMER + WINDOW)) + 1
    begin, stop = np.concatenate(([0], cut)), np.concatenate((cut, [len(p)])) - 1
    p0, p1, a0, a1 = p[begin], p[stop] + KMER, a[begin], a[stop] + KMER
    n = len(p0)
    if n == 1:
        return [[(int(p0[0]), int(p1[0]), int(a0[0]))]]
    ends = np.unique(a1 - KMER)
    tree = _PrefixMax(len(ends))
    score, back = [0.0] * n, [-1] * n
    # A run is open to others that begin after its last seed's first word, in both texts.
    events = sorted([(int(p0[i]), 0, i) for i in range(n)] + [(int(p1[i]) - KMER, 1, i) for i in range(n)])
    for _, kind, i in events:
        if kind == 0:
            value, item = tree.upto(int(np.searchsorted(ends, a0[i], "left")))
            value -= GAP * float(p0[i] + a0[i])
            size = float(p1[i] - p0[i])
            score[i], back[i] = (size + value, item) if item >= 0 and value > 0 else (size, -1)
        else:
            # Offset so that stored values are positive whatever the position.
            tree.put(int(np.searchsorted(ends, a1[i] - KMER)), score[i] + GAP * float(p1[i] + a1[i]), i)
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: -score[i]):
        if used[i]:
            continue
        chain, j = [], i
        while j >= 0 and not used[j]:
            used[j] = True
            chain.append((int(p0[j]), int(p1[j]), int(a0[j])))
            j = back[j]
        out.append(chain[::-1])
    return out


def _run_lists(runs: list[list[tuple[int, int, int]]]) -> pa.Array:
    flat = [x for r in runs for x in r]
    p0, p1, a0 = zip(*flat, strict=True) if flat else ((), (), ())
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum([len(r) for r in runs]))), pa.int32()),
        pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in (p0, p1, a0)], ["p0", "p1", "a0"]))


def _chain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        ids, versions = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        lists = batch.column(2)
        offsets = lists.offsets.to_numpy()
        anchor, apos, pos = (lists.values.field(c).to_numpy(zero_copy_only=False) for c in range(3))
        for r in range(len(batch)):
            lo, hi = offsets[r], offsets[r + 1]
            an, ap, po = anchor[lo:hi], apos[lo:hi].astype(np.int64), pos[lo:hi].astype(np.int64)
            order = np.argsort(an, kind="stable")
            order = order[an[order] != ids[r]]  # what the text keeps itself
            if not len(order):
                continue
            an, ap, po = an[order], ap[order], po[order]
            cut = np.flatnonzero(np.diff(an)) + 1
            for b, e in zip([0, *cut], [*cut, len(an)], strict=True):
                if e - b < 2 or po[b:e].max() - po[b:e].min() + KMER < LEAST_CHAIN:
                    continue
                rows += [(ids[r], versions[r], int(an[b]), c) for c in linked(po[b:e], ap[b:e])
                         if c[-1][1] - c[0][0] >= LEAST_CHAIN]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], _run_lists(columns[3])],
                                         names=["id", "version", "anchor", "runs"])


def whole_grams(h: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the runs of ``MIN_WORDS`` words of which every seed is a
    shared one; ``shared`` holds positions of shared seeds, the first of each at least.

    The seeds of the windows inside a run depend on its words only, so two
    texts with the run have the same ones.
    """
    if len(h) < MIN_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = shingle_hashes(h, KMER)
    view = np.lib.stride_tricks.sliding_window_view(g, WINDOW)
    seed = g[view.argmin(axis=1) + np.arange(len(view))]
    inside = MIN_WORDS - KMER - WINDOW + 2  # windows in a run
    total = np.concatenate(([0], np.cumsum(np.isin(seed, g[shared]))))
    at = np.flatnonzero(total[inside:] - total[:-inside] == inside)
    return at, shingle_hashes(h, MIN_WORDS)[at] if len(at) else np.zeros(0, np.uint64)


def _exact_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, version, gram matches) to the exact runs, as chains of one run."""
    for batch in batches:
        rows = []
        ids, versions = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        lists = batch.column(2)
        offsets = lists.offsets.to_numpy()
        anchor, apos, pos = (lists.values.field(c).to_numpy(zero_copy_only=False) for c in range(3))
        for r in range(len(batch)):
            lo, hi = offsets[r], offsets[r + 1]
            an, ap, po = anchor[lo:hi], apos[lo:hi].astype(np.int64), pos[lo:hi].astype(np.int64)
            order = np.lexsort((po, po - ap, an))
            an, ap, po = an[order], ap[order], po[order]
            cut = np.flatnonzero((np.diff(an) != 0) | (np.diff(po - ap) != 0) | (np.diff(po) > 1)) + 1
            for b, e in zip([0, *cut], [*cut, len(an)], strict=True):
                rows.append((ids[r], versions[r], int(an[b]), [(int(po[b]), int(po[e - 1]) + MIN_WORDS, int(ap[b]))]))
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], _run_lists(columns[3])],
                                         names=["id", "version", "anchor", "runs"])


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chain columns, text of the anchor) to rows with the anchor's words around the
    chain and the place of the first of them."""
    for batch in batches:
        text = batch.column(4)
        for lo, hi in slices(text):
            w = words(text.slice(lo, hi - lo))
            part = batch.slice(lo, hi - lo)
            first, other = [], []
            for i, runs in enumerate(part.column(3).to_pylist()):
                b, n = w.offsets[i], w.offsets[i + 1] - w.offsets[i]
                end = runs[-1]["a0"] + runs[-1]["p1"] - runs[-1]["p0"]
                s, t = max(0, runs[0]["a0"] - MARGIN), min(n, end + MARGIN)
                first.append(s)
                other.append(bytes(w.data[w.start[b + s]:w.end[b + t - 1]]).decode() if s < t else "")
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in range(4)], pa.array(first, pa.int32()), pa.array(other)],
                                             names=["id", "version", "anchor", "runs", "first", "other"])


def _extend(same: np.ndarray) -> int:
    """How many words from the left of ``same`` belong to the passage (best prefix score)."""
    if not len(same):
        return 0
    score = np.cumsum(np.where(same, 1, -2))
    top = np.maximum.accumulate(np.maximum(score, 0))
    stop = np.flatnonzero(top - score > 2 * DROP)
    score = score[:stop[0]] if len(stop) else score
    best = int(score.argmax()) if len(score) else 0
    return best + 1 if len(score) and score[best] > 0 else 0


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Words in a banded longest common subsequence."""
    if len(x) == len(y):
        straight = int((x == y).sum())
        if straight >= IDENTITY * len(x):
            return straight
    shift = len(y) - len(x)
    low, width = min(0, shift) - BAND, abs(shift) + 2 * BAND + 1
    padded = np.zeros(len(x) + len(y) + 2 * width, np.uint64)
    inside = np.zeros(len(padded), bool)
    at = width - low
    padded[at:at + len(y)], inside[at:at + len(y)] = y, True
    row = np.zeros(width + 2, np.int64)
    for i, h in enumerate(x):
        here = slice(at + i + low, at + i + low + width)
        diagonal = row[1:-1] + ((padded[here] == h) & inside[here])
        best = np.maximum(diagonal, row[2:])
        row[1:-1] = np.maximum.accumulate(best)
    return int(row.max())


def _equal_from(same: np.ndarray) -> int:
    """How many words from the left are equal without a break."""
    return len(same) if same.all() else int(same.argmin())


def align(d: np.ndarray, a: np.ndarray, runs: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The passages of ``d`` that match ``a`` along a chain of runs (p0, p1, a0).

    A stretch of neighbouring runs has equal words (of the runs, and of the
    gaps between them) and a span (the longer side); all longest stretches
    with ``IDENTITY`` of the span equal are taken, the whole chain or parts.
    A gap with more words in ``d`` than in ``a`` holds words that ``a`` lacks:
    it is left out, so that no text is lost that its source does not have.
    """
    fitted: list[list[int]] = []  # p0, p1, q0, q1 of runs that advance on both sides
    for p0, p1, q0 in runs:
        q1 = min(q0 + p1 - p0, len(a))
        p1 = min(p0 + q1 - q0, len(d))
        q1 = q0 + p1 - p0
        if fitted:
            over = max(0, fitted[-1][1] - p0, fitted[-1][3] - q0)
            p0, q0 = p0 + over, q0 + over
        if p1 > p0:
            fitted.append([p0, p1, q0, q1])
    for k, r in enumerate(fitted):  # words next to a run that are equal belong to it
        low = fitted[k - 1] if k else (0, 0, 0, 0)
        n = min(r[0] - low[1], r[2] - low[3])
        n = _equal_from((d[r[0] - n:r[0]] == a[r[2] - n:r[2]])[::-1]) if n else 0
        r[0], r[2] = r[0] - n, r[2] - n
        high = fitted[k + 1] if k + 1 < len(fitted) else (len(d), 0, len(a), 0)
        n = min(high[0] - r[1], high[2] - r[3])
        n = _equal_from(d[r[1]:r[1] + n] == a[r[3]:r[3] + n]) if n else 0
        r[1], r[3] = r[1] + n, r[3] + n
    if not fitted:
        return []
    m = len(fitted)
    surplus = np.zeros(2 * m - 1)  # runs and the gaps between them: equal words less those that IDENTITY asks for
    for k, (p0, p1, q0, q1) in enumerate(fitted):
        surplus[2 * k] = int((d[p0:p1] == a[q0:q1]).sum()) - IDENTITY * (p1 - p0)
        if k + 1 < m:
            x, y = d[p1:fitted[k + 1][0]], a[q1:fitted[k + 1][2]]
            surplus[2 * k + 1] = (_common(x, y) if len(x) and len(y) else 0) - IDENTITY * max(len(x), len(y))
    total = np.concatenate(([0.0], np.cumsum(surplus)))
    before, after = total[0:-1:2], total[1::2]  # up to the start and the end of each run
    ahead = np.maximum.accumulate(after[::-1])[::-1]  # falls: the last end that is no lower than a start
    found: list[tuple[int, int]] = []
    reach = -1
    for k in range(m):
        last = m - 1 - int(np.searchsorted(ahead[::-1], before[k] - 1e-9))
        if last <= reach or last < k:
            continue  # part of a stretch that was taken, or a run too unequal
        reach = last
        p0, q0, p1, q1 = fitted[k][0], fitted[k][2], fitted[last][1], fitted[last][3]
        n = min(p0, q0)
        left = _extend((d[p0 - n:p0] == a[q0 - n:q0])[::-1])
        n = min(len(d) - p1, len(a) - q1)
        right = _extend(d[p1:p1 + n] == a[q1:q1 + n])
        equal = after[last] - before[k]
        more = int((d[p0 - left:p0] == a[q0 - left:q0]).sum() + (d[p1:p1 + right] == a[q1:q1 + right]).sum())
        if equal + more - IDENTITY * (left + right) < -1e-9:
            left = right = 0
        spans = [[p0 - left, p1 + right]]
        for (_, s0, _, s1), (t0, _, t1, _) in zip(fitted[k:last], fitted[k + 1:last + 1], strict=True):
            if t0 - s0 > t1 - s1:  # words that the other text does not have: they stay
                spans[-1][1], spans = s0, [*spans, [t0, spans[-1][1]]]
        if sum(q - p for p, q in spans) >= MIN_WORDS:
            found += [(p, q) for p, q in spans]
    return found


def _cut(w, i: int, spans: list[tuple[int, int]]) -> str:
    """Text i without the word ranges, the rest as it was."""
    b, e = int(w.offsets[i]), int(w.offsets[i + 1])
    lo, hi = int(w.bytes[i]), int(w.bytes[i + 1])
    out, at = [], lo
    for p0, p1 in spans:
        out.append(bytes(w.data[at:w.start[b + p0]]))
        at = int(w.start[b + p1]) if b + p1 < e else hi
    out.append(bytes(w.data[at:hi]))
    return b"".join(out).decode()


def _matched(h: np.ndarray, chained: list | None) -> list[tuple[int, int, int]]:
    """Passages (first word, word after the last, anchor) of a text's chains."""
    found = []
    for c in chained or []:
        runs = [(x["p0"], x["p1"], x["a0"] - c["first"]) for x in c["runs"]]
        found += [(*x, c["anchor"]) for x in align(h, words(pa.array([c["other"]])).hash, runs)]
    return found


def _union(found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    spans: list[list[int]] = []
    for p0, p1, _ in sorted(found):
        if spans and p0 <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], p1)
        else:
            spans.append([p0, p1])
    return [(p, q) for p, q in spans]


def _rows_of(found: list[tuple[int, int, int]]) -> list[dict]:
    return [{"first": p, "last": q - 1, "source_id": s} for p, q, s in sorted(set(found))]


_FOUND_TYPE = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("source_id", pa.int64())]))


def _aligned_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, version, shared, chains) to the passages of the chains, and the whole
    grams that no passage holds."""
    for batch in batches:
        for lo, hi in slices(batch.column(1)):
            part = batch.slice(lo, hi - lo)
            w = words(part.column(1))
            passages, sizes, grams, places, again = [], [0], [], [], []
            for i in range(hi - lo):
                h = w.of(i)
                found = _matched(h, part.column(4)[i].as_py())
                passages.append(_rows_of(found))
                at, g = whole_grams(h, part.column(3)[i].values.to_numpy())
                held = np.zeros(len(at), bool)
                for p0, p1 in _union(found):
                    held |= (at >= p0) & (at + MIN_WORDS <= p1)
                at, g = at[~held], g[~held]
                sizes.append(sizes[-1] + len(at))
                grams.append(signed(g))
                places.append(at.astype(np.int32))
                again.append(occurrence(g) > 0 if len(g) else np.zeros(0, bool))
            lists = pa.ListArray.from_arrays(
                pa.array(sizes, pa.int32()),
                pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in (grams, places, again)], ["gram", "pos", "again"]))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(passages, _FOUND_TYPE), lists],
                                             names=["id", "version", "passages", "grams"])


def _passage_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, version, passages, chains of exact runs) to all passages and the text left."""
    for batch in batches:
        for lo, hi in slices(batch.column(1)):
            part = batch.slice(lo, hi - lo)
            w = words(part.column(1))
            out: dict[str, list] = {k: [] for k in ("id", "version", "n_words", "removed", "passages", "kept")}
            for i in range(hi - lo):
                h = w.of(i)
                found = [(x["first"], x["last"] + 1, x["source_id"]) for x in part.column(3)[i].as_py() or []]
                found += _matched(h, part.column(4)[i].as_py())
                if not found:
                    continue
                spans = _union(found)
                out["id"].append(part.column(0)[i].as_py())
                out["version"].append(part.column(2)[i].as_py())
                out["n_words"].append(len(h))
                out["removed"].append(sum(q - p for p, q in spans))
                out["passages"].append(_rows_of(found))
                out["kept"].append(_cut(w, i, spans))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["id"], pa.int64()), pa.array(out["version"], pa.int64()), pa.array(out["n_words"], pa.int64()),
                 pa.array(out["removed"], pa.int64()), pa.array(out["passages"], _FOUND_TYPE),
                 pa.array(out["kept"], pa.string())], names=list(out))


def _windows(found: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, version, chains) of each text, the chains with the anchor's words around them."""
    windows = (found.join(texts.select(F.col("id").alias("anchor"), "text"), "anchor")
               .select("id", "version", "anchor", "runs", "text").mapInArrow(_window_batches, _WINDOWS))
    # Bounded: the chains of one text are about as long as the text.
    return windows.groupBy("id", "version").agg(F.collect_list(F.struct("anchor", "runs", "first", "other")).alias("chains"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, version, n_words, removed, passages, kept): one row per text with repeats.

    ``passages`` lists word ranges (first, last, both included) with the id
    of the document that keeps the passage; ``removed`` counts the words in
    their union; ``kept`` is the text without them. Null, empty and short
    texts have no passages. Repeats are searched between rows of different
    ids: rows without id, and repeats inside one document or between rows of
    one id, are left alone. ``version`` (a hash of the text) tells apart
    different texts under one id. Very long texts are searched whole; of
    documents that hold the same words the smallest id keeps them; an empty
    table gives no rows. Other columns are not looked at.
    """
    base = small_batches(docs).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("version")).filter("id is not null")
    seeds = base.mapInArrow(_seed_batches, _SEEDS)
    anchors = (seeds.groupBy("seed", "nth")
               .agg(F.min("id").alias("anchor"), F.max("id").alias("most"), F.min_by("pos", "id").alias("apos"))
               .filter("anchor < most").select("seed", "nth", "anchor", "apos"))
    hits = seeds.join(anchors, ["seed", "nth"])
    # The texts that keep a seed are in it too. A run of MIN_WORDS words has more than one seed.
    per_text = saved(hits.groupBy("id", "version").agg(F.collect_list(F.struct("anchor", "apos", "pos")).alias("m"))
                     .filter(F.size("m") > 1), "matches")
    linked_up = saved(per_text.mapInArrow(_chain_batches, _CHAINS), "chains")
    texts = saved(base.join(per_text.select("id", "version", F.col("m.pos").alias("shared")), ["id", "version"])
                  .dropDuplicates(["id", "version"]).select("id", "text", "version", "shared"), "texts")
    aligned = saved(texts.join(_windows(linked_up, texts), ["id", "version"], "left")
                    .select("id", "text", "version", "shared", "chains").mapInArrow(_aligned_batches, _ALIGNED), "aligned")
    grams = aligned.select("id", "version", F.explode("grams").alias("g")).select("id", "version", "g.*")
    firsts = (grams.groupBy("gram")
              .agg(F.min("id").alias("anchor"), F.max("id").alias("most"),
                   F.min_by("pos", F.when(~F.col("again"), F.col("id"))).alias("apos"))
              .filter("anchor < most").select("gram", "anchor", "apos"))
    exact = saved(grams.join(firsts, "gram").filter("id <> anchor")
                  .groupBy("id", "version").agg(F.collect_list(F.struct("anchor", "apos", "pos")).alias("m"))
                  .mapInArrow(_exact_batches, _CHAINS), "exact")
    both = (aligned.filter(F.size("passages") > 0).select("id", "version", "passages")
            .join(_windows(exact, texts), ["id", "version"], "full"))
    return saved(texts.join(both, ["id", "version"]).select("id", "text", "version", "passages", "chains")
                 .mapInArrow(_passage_batches, _PASSAGES), "passages")


def passage_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per repeated passage: id, first_word, last_word (both included),
    source_id (the document that keeps it), removed_words (of the whole text)."""
    return (repeated_passages(docs, id_col, text_col)
            .select("id", "removed", F.explode("passages").alias("p"))
            .select(F.col("id").alias(id_col), F.col("p.first").alias("first_word"), F.col("p.last").alias("last_word"),
                    F.col("p.source_id").alias("source_id"), F.col("removed").alias("removed_words")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` without the repeated passages: texts cut, all columns and rows kept
    but for documents of which no word is left, which go. ``length_col``, where
    the table has it, is set to the new length of a text that was cut."""
    own_id, version, kept, gone = (free_name(n, docs.columns) for n in ("__id", "__version", "__kept", "__gone"))
    cut = repeated_passages(docs, id_col, text_col).select(
        F.col("id").alias(own_id), F.col("version").alias(version), F.col("kept").alias(kept),
        (F.col("n_words") == F.col("removed")).alias(gone))
    joined = docs.join(cut, (F.col(id_col) == F.col(own_id)) & (F.xxhash64(text_col) == F.col(version)), "left")
    changed = F.col(kept).isNotNull()
    out = {text_col: F.when(changed, F.col(kept)).otherwise(F.col(text_col))}
    if length_col and length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out[length_col] = F.when(changed, F.char_length(kept).cast(kind)).otherwise(F.col(length_col))
    return joined.filter(~F.coalesce(gone, F.lit(False))).select(
        *[out.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
