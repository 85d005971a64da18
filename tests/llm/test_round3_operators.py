"""Operators 11 to 13 against plain versions and on edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from riskframe.llm import multi_order_join, prefix_trie
from riskframe.llm.multi_order_join import jaccard_components
from riskframe.llm.prefix_trie import conversation_trie
from riskframe.llm.threshold_clusters import CentroidLists, nearest, threshold_clusters

CLASH = ["id", "n", "x", "y", "conv", "turn_", "label", "token", "cluster", "distance", "rep", "blk", "part", "v", "first"]


# --- 11 -----------------------------------------------------------------------------

@pytest.mark.parametrize("k, d, reach, n", [(8, 64, 300, 2000), (8, 3, 4, 2000), (1, 5, 9, 50), (20, 2, 30, 3000), (8, 4, 1, 500)])
def test_threshold_search_is_exact(k, d, reach, n):
    rng = np.random.default_rng(k * d)
    x, c = rng.integers(-reach, reach + 1, (n, d)), rng.integers(-reach, reach + 1, (k, d))
    best, far, exact = nearest(x, CentroidLists.of(c))
    every = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()
    assert 1 <= exact.min() and exact.max() <= k


def test_threshold_search_stops_early():
    rng = np.random.default_rng(1)
    c = np.arange(50)[:, None] * 1000 + rng.integers(0, 50, (50, 4))
    x = c[rng.integers(0, 50, 400)] + rng.integers(-60, 61, (400, 4))
    best, _, exact = nearest(x, CentroidLists.of(c))
    assert (best == ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert exact.mean() < 4  # of 50


def test_threshold_search_refuses_what_does_not_fit():
    with pytest.raises(ArithmeticError):
        nearest(np.array([[1 << 31]]), CentroidLists.of(np.array([[-(1 << 31)]])))


def _plain_clusters(rows, k=8, rounds=10, dim=64):
    kept = [(i, [int(np.floor(1024 * float(c))) for c in v]) for i, v in rows
            if v is not None and len(v) == dim and all(c is not None and np.isfinite(c) for c in v)]
    starts = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [v for _, v in starts]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, w, strict=True)) for w in c]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        where = assign()
        for j in range(len(c)):
            mine = [v for (_, v), (a, _) in zip(kept, where, strict=True) if a == j]
            if mine:
                c[j] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    where = assign()
    inertia = defaultdict(int)
    for a, d in where:
        inertia[a] += d
    digest = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in c]
    return sorted(((i, a, d, inertia[a], sum(inertia.values()), digest[a]) for (i, _), (a, d) in zip(kept, where, strict=True)),
                  key=str)


def test_clusters_match_the_plain_version(spark):
    random.seed(2)
    vector = [[random.gauss(0, 0.3) for _ in range(64)] for _ in range(60)]
    rows = [(i, v) for i, v in enumerate(vector)] + [(100 + i, vector[0]) for i in range(30)]
    rows += [(7, vector[8]), (7, vector[7]), (None, vector[3]), (200, None), (201, []), (202, [0.1] * 63), (203, [0.1] * 65),
             (204, [float("nan")] + [0.0] * 63), (205, [float("inf")] + [0.0] * 63), (206, [None] + [0.0] * 63), (-5, [0.0] * 64)]
    df = spark.createDataFrame([(i, v, *["z"] * len(CLASH)) for i, v in rows],
                               "vec_id bigint, embedding array<double>, " + ", ".join(f"{c} string" for c in CLASH)).repartition(5)
    assert sorted((tuple(r) for r in threshold_clusters(df).collect()), key=str) == _plain_clusters(rows)


def test_clusters_of_few_and_no_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert threshold_clusters(spark.createDataFrame([], schema)).collect() == []
    one = threshold_clusters(spark.createDataFrame([(3, [0.5] * 64)], schema)).collect()
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in one] == [(3, 0, 0, 0)]


# --- 12 -----------------------------------------------------------------------------

def _plain_trie(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append(((t is not None, t or 0), role, hashlib.md5(text.encode()).digest(), text))
    own = {c: [(r, x) for _, r, _, x in sorted(v, key=lambda z: z[:3])] for c, v in turns.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - int(np.fmod(c, 100)), [])[:h] + v[h:]
    members, kids = defaultdict(list), defaultdict(list)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, tokens = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        tokens[p] = sum(tokens[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], tokens[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p)).encode()).hexdigest())
                   for p, m in members.items()), key=str)


def _trie(spark, rows):
    df = spark.createDataFrame([(*r, *["z"] * len(CLASH)) for r in rows],
                               "conv_id bigint, turn bigint, role string, text string, " + ", ".join(f"{c} string" for c in CLASH))
    return sorted((tuple(r) for r in conversation_trie(df.repartition(3)).collect()), key=str)


def test_trie_matches_the_plain_version(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PART", 4)          # a conversation under many join keys
    monkeypatch.setattr(prefix_trie, "HOT_CHILDREN", 2)  # parents of both kinds
    random.seed(5)
    rows = [(c, t if random.random() < 0.9 else None, random.choice(["user", "bot", None]), random.choice(["", "x", "yé", "long text", None]))
            for c in [*range(12), *range(100, 125), 250, 251, -5, -100, -1] for t in range(random.randint(1, 9))]
    rows += [(None, 1, "user", "x"), *rows[:5]]                                  # no id; repeated rows, ties
    rows += [(5000 + i, t, "user", f"same {t}") for i in range(40) for t in range(3)]  # a hot conversation
    rows += [(c, t, "user", f"t{t % 7}") for c, n in ((7000, 40), (7001, 33)) for t in range(n)]
    rows += [(8000, 0, "user", "word " * 50_000)]
    assert _trie(spark, rows) == _plain_trie(rows)


def test_ids_are_hashed_in_pieces(monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    ids = {(1, 1): [4, 7, 9, 12, 13, 20, 21], (1, 2): [5], (2, 0): [1, 2, 3]}
    rows = [(x, y, c) for (x, y), cs in ids.items() for c in cs]
    batches = [pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*rows[a:a + 4], strict=True)], names=["x", "y", "conv"])
               for a in range(0, len(rows), 4)]
    pieces = list(prefix_trie._joined_ids(iter(batches)))
    assert sum(len(p) for p in pieces) > 3
    found = {r["ends"]: r["digest"] for b in prefix_trie._digests(iter(pieces)) for r in b.to_pylist()}
    assert found == {cs[0]: hashlib.sha256(",".join(map(str, cs)).encode()).hexdigest() for cs in ids.values()}


def test_trie_of_one_turn_and_none(spark):
    assert _trie(spark, [(1, None, None, None)]) == _plain_trie([(1, None, None, None)])
    assert conversation_trie(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).collect() == []
    only = [(None, 0, "user", "x")]
    assert _trie(spark, only) == []


# --- 13 -----------------------------------------------------------------------------

def _plain_components(rows):
    def shingles(text):
        w = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or "")
        for s in "\t\n\v\f\r":
            w = w.replace(s, " ")
        w = [x for x in w.split(" ") if x]
        return {tuple(w[i:i + 4]) for i in range(max(len(w) - 3, 1))} if w else set()

    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    where = defaultdict(list)
    for n, (i, s) in enumerate(sets):
        if i is not None:
            for x in s:
                where[x].append(n)
    for n, (i, s) in enumerate(sets):
        common = defaultdict(int)
        for x in s if i is not None else ():
            for m in where[x]:
                common[m] += 1
        for m, c in common.items():
            j, t = sets[m]
            if i != j and 100 * c >= 85 * len(s | t):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=str)


def _components(spark, rows):
    df = spark.createDataFrame([(i, t, *["z"] * len(CLASH)) for i, t in rows],
                               "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in CLASH))
    return sorted((tuple(r) for r in jaccard_components(df.repartition(4)).collect()), key=str)


def _corpus():
    random.seed(11)
    words = [f"w{i}" for i in range(400)]
    passage = [random.choice(words) for _ in range(60)]
    rows, i = [], 0
    for size in (3, 4, 6, 12, 40, 120):  # chains of near copies: neighbours link, ends need not
        text = [random.choice(words) for _ in range(size)]
        for _ in range(25):
            rows.append((i, " ".join(text)))
            i += 1
            text = list(text)
            text[random.randrange(len(text))] = random.choice(words)
    for size in (90, 100, 110, 400):  # a passage that many documents share, without being alike
        for _ in range(20):
            own = [random.choice(words) for _ in range(size - 60)]
            rows.append((i, " ".join(own[:10] + passage + own[10:])))
            i += 1
    for n in range(30):  # exact copies, in other case and spacing
        rows.append((i + n, "  ".join(passage).upper() if n % 2 else "\n".join(passage)))
    return rows


def test_components_match_the_plain_version(spark):
    rows = _corpus()
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "one"), (904, "ONE"), (905, "one two"), (None, rows[0][1]), (None, None),
             (5, "another text under an id that is used"), rows[9], rows[9], (906, " ".join(f"q{j}" for j in range(30_000))),
             (907, " ".join(f"q{j}" for j in range(29_000)))]
    assert _components(spark, rows) == _plain_components(rows)


def test_components_in_small_blocks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(multi_order_join, "BLOCK_SHINGLES", 200)
    monkeypatch.setattr(multi_order_join, "PART", 2)
    rows = _corpus()
    assert _components(spark, rows) == _plain_components(rows)


def test_components_of_an_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    assert _components(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]
