"""op6: every word of the training text has a class by its own contexts."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskframe.llm import class_lm
from riskframe.llm.text import signed, words

SF = "/root/testdata/sf0.01"


def _held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def test_rare_words_of_one_form_are_told_apart_by_their_contexts(spark):
    """600 frequent words in two groups, so no rare word is among the ``WORDS``; the
    rare ones end in the same three bytes and stand in one group's sentences each."""
    rng = np.random.default_rng(5)
    groups = [[f"{g}{i}" for i in range(300)] for g in "ab"]
    rare = [[f"{g}{i}rare" for i in range(100)] for g in "xy"]
    train, held = ([i for i in range(5000) if _held(i) == h] for h in (False, True))
    rows = []
    for k in range(300):  # a rare word occurs three times
        for group, some in zip(groups, rare):
            text = rng.permutation(group)[:60].tolist()
            text[30:30] = [some[k % 100]]
            rows.append((train.pop(), " ".join(text)))
    asked = {}
    for k in range(50):
        for g in (0, 1):
            left, right = rng.choice(groups[g], 2)
            for s in (0, 1):
                i = held.pop()
                asked[i] = (k, g, s)
                rows.append((i, f"{left} {rare[s][k]} {right}"))
    found = class_lm.scores(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    score = {asked[r.doc_id]: r.score for r in found if r.held_out}
    assert len(score) == 200
    fits = [score[k, g, g] > score[k, g, 1 - g] + 0.1 for k in range(50) for g in (0, 1)]
    assert np.mean(fits) > 0.95


@pytest.mark.parametrize("head", [0, 3000])
def test_classes_paths_and_scores_by_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(class_lm, "HEAD", head)  # 0: all words through the join
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learn = ~class_lm.held_out(F.col("id"))
    walks, model = class_lm.walked(docs, learn)
    keys = {r.doc_id: signed(class_lm._keys(words(pa.array([r.text])))).tolist() for r in docs.select("doc_id", "text").collect()}
    table = {r["word"]: (r["n"], r["class"]) for r in model.classes.collect()}
    count = Counter(k for i, w in keys.items() if not _held(i) for k in w)
    assert {k: n for k, (n, _) in table.items()} == count and all(0 <= c < class_lm.CLASSES - 1 for _, c in table.values())
    form = lambda k: k & (class_lm.FORMS - 1)
    end = class_lm.CLASSES - 1
    paths = {i: [table[k][1] if k in table else int(model.form[form(k)]) for k in w] + [end] for i, w in keys.items()}
    rows = {r.id: r for r in walks.collect()}
    assert {i: list(r.path) for i, r in rows.items()} == paths
    g = np.zeros((class_lm.CLASSES, class_lm.CLASSES))
    for i, p in paths.items():
        if not _held(i):
            np.add.at(g, ([end, *p[:-1]], p), 1)
    assert np.array_equal(class_lm.transitions(walks.filter(learn)), g) and np.array_equal(g.sum(axis=0), model.size)
    step, unseen = class_lm._transitions(g), model.unseen()
    for r in class_lm.scores(docs).collect():
        p = paths[r.doc_id]
        want = sum(step[a, b] for a, b in zip([end, *p], p)) + sum(
            math.log10((table[k][0] - model.discount) / model.size[c]) if k in table else unseen[c] for k, c in zip(keys[r.doc_id], p))
        assert math.isclose(r.score, want, rel_tol=1e-9)
    # words of one form no longer share its class
    assert any(len({c for k, (n, c) in table.items() if form(k) == f}) > 3 for f in range(20))


def test_a_words_class_is_the_likeliest_over_all_its_occurrences():
    rng = np.random.default_rng(2)
    k = class_lm.CLASSES
    step, size = np.log10(rng.dirichlet(np.ones(k), k)), rng.integers(1, 1000, k)
    rows = sorted((int(w), int(n) * k * k + int(a) * k + int(b)) for w, n, a, b in zip(
        rng.integers(-40, 40, 900), rng.integers(1, 5, 900), rng.integers(0, k, 900), rng.integers(0, k, 900)))
    want = {}
    for w, seen in rows:
        n, a, b = seen // k**2, seen // k % k, seen % k
        had = want.setdefault(w, [0, np.zeros(k)])
        had[0] += n
        had[1] += n * (step[a] + step[:, b] - np.log10(size))
    for cut in (1, 7, 900):  # a word's rows go on in the next batches
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i:i + cut]]), pa.array([r[1] for r in rows[i:i + cut]])],
                                              names=["word", "seen"]) for i in range(0, 900, cut)]
        got = [tuple(r.values()) for b in class_lm._likeliest(iter(batches), step, step.T, size) for r in b.to_pylist()]
        assert got == [(w, n, int(v[:-1].argmax())) for w, (n, v) in want.items()]


def test_contexts_count_every_occurrence(monkeypatch):
    texts = ["a b c a b", "", None, "c", "b a"]
    own = np.arange(class_lm._UNITS) % (class_lm.CLASSES - 1)
    own[-1] = end = class_lm.CLASSES - 1
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    key = {w: int(class_lm._keys(words(pa.array([w])))[0]) for w in "abc"}
    unit = {w: class_lm.WORDS + (key[w] & (class_lm.FORMS - 1)) for w in "bc"} | {"a": 0}
    frequent = class_lm._Lookup(np.array([key["a"]], np.uint64))
    for most in (1, 1000):
        monkeypatch.setattr(class_lm, "MERGE", most)
        got = Counter()
        for b in class_lm._contexts(iter([batch]), frequent, np.array([0]), own):
            for r in b.to_pylist():
                n, around = divmod(r["seen"], class_lm.CLASSES**2)
                got[r["word"], divmod(around, class_lm.CLASSES)] += n
        want = Counter()
        for t in texts:
            w = (t or "").split()
            c = [end, *[int(own[unit[x]]) for x in w], end]
            for i, x in enumerate(w):
                if x != "a":
                    want[int(np.array(key[x], np.uint64).view(np.int64)), (c[i], c[i + 2])] += 1
        assert {k: n for k, n in got.items() if n} == dict(want)


def test_most_frequent_words_need_no_sort_in_one_task(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([1] * 50 + [2] * 20 + [3, 700, 9, 9, 10**12])], "word bigint, n bigint")
    take = lambda most: sorted(r["n"] for r in class_lm._most_frequent(counts, most).collect())
    assert [take(m) for m in (0, 1, 3, 4, 5, 24)] == [[], [10**12], [700, 10**12], [9, 9, 700, 10**12],
                                                      [3, 9, 9, 700, 10**12], [3, 9, 9, 700, 10**12]]
    assert len(take(25)) == 25 and len(take(74)) == 25 and len(take(75)) == 75
    plan = class_lm._most_frequent(counts, 25)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "SinglePartition" not in plan
