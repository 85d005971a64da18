"""Every operator against a plain version on the whole small tables."""

import math
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.dataset as ds
import pytest

import corpus_pipeline
from riskframe.llm import class_lm, near_dedup
from riskframe.llm.html_extract import common_lines
from riskframe.llm.mixing import split_quotas, targets
from riskframe.llm.queries import QUERIES
from riskframe.llm.substring_dedup import chains
from riskframe.llm.text import shingle_set

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _table(name):
    return ds.dataset(f"{SF}/{name}.parquet").to_table().to_pylist()


def _words(text):
    return WORD.findall((text or "").translate(LOW))


@pytest.fixture(scope="module")
def documents():
    return {r["doc_id"]: r for r in _table("documents")}


def test_near_duplicates_equal_all_pairs(spark, documents):
    sets = {}
    for i, r in documents.items():
        w = _words(r["text"])
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    common = Counter()
    for ids in by.values():
        for k, a in enumerate(ids):
            for b in ids[:k]:
                common[min(a, b), max(a, b)] += 1
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    got = QUERIES["op5_minhash_near_dedup"](spark, SF).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {(i, len(s), root(i), root(i) == i) for i, s in sets.items()}


def test_blocks_find_links_that_hubs_miss(spark, monkeypatch):
    """A chain of texts, each near the next only, in blocks of a few shingles."""
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 300)
    base = [f"w{k}" for k in range(400)]
    rows = [(i, " ".join(base[8 * i:8 * i + 100])) for i in range(30)]  # neighbours 0.8, next but one 0.7
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.component_id for r in near_dedup.near_duplicates(df).collect()} == {0}


def test_sketch_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (1, 3, 40, 2000):
        a = np.unique(rng.integers(0, 2 ** 63, n, np.uint64))
        sk = near_dedup.sketch(a)
        assert (sk != ~np.uint64(0)).all() and (near_dedup.sketch(a) == sk).all()
    x = np.unique(rng.integers(0, 2 ** 63, 900, np.uint64))
    shared = [(near_dedup.sketch(x[:800]) == near_dedup.sketch(x[100:])).mean()]
    assert abs(shared[0] - 700 / 900) < 0.15


def test_repeated_passages_cover_every_long_repeat(spark, documents):
    words = {i: _words(r["text"]) for i, r in sorted(documents.items())}
    first = {}
    for i, w in words.items():
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k:k + 50]), i)
    found = defaultdict(set)
    for r in QUERIES["op9_collinear_substring_dedup"](spark, SF).collect():
        assert r.source_id < r.doc_id and r.last_word - r.first_word + 1 >= 50
        found[r.doc_id].update(range(r.first_word, r.last_word + 1))
        # Most of the passage's words are the source's.
        own = Counter(words[r.doc_id][r.first_word:r.last_word + 1])
        assert sum((own & Counter(words[r.source_id])).values()) >= 0.75 * own.total()
    need = 0
    for i, w in words.items():
        repeated = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k:k + 50])] < i:
                repeated.update(range(k, k + 50))
        need += bool(repeated)
        assert len(repeated - found[i]) <= 0.1 * len(repeated)
    assert need > 50


def test_chains_advance_in_both_texts():
    run = np.arange(0, 60, 5)
    pos, apos = np.concatenate((run, run + 70, [30])), np.concatenate((run + 200, run + 274, [10]))
    best = chains(pos, apos)[0]
    assert best == (0, 70 + 55 + 8, 200, 274 + 55 + 8)
    assert len(chains(np.array([1, 2]), np.array([50, 10]))) == 2


def test_leaks_equal_every_window(spark, documents):
    cut = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    split = lambda t: [w for w in cut.split((t or "").lower()) if w]
    shingles = lambda w: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
    items = {r["item_id"]: split(r["text"]) for r in _table("benchmark")}
    want = set()
    for i, r in documents.items():
        w = split(r["text"])
        have = shingles(w)
        for item, x in items.items():
            s = shingles(x)
            if s & have:
                best = max((len(s & y) / len(s | y) for k in range(len(w) - len(x) + 1) if (y := shingles(w[k:k + len(x)]))), default=0)
                if best >= 0.75:
                    want.add((i, item))
    got = QUERIES["op2_simhash_decontamination"](spark, SF).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and want


def test_quality_on_held_out_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in _table("labels")}
    rows = QUERIES["op4_sparse_rule_quality"](spark, SF).collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([(a > b) + (a == b) / 2 for a in good for b in bad]) > 0.95
    assert np.mean([(s >= 0.5) == bool(y) for s, y in held]) > 0.95


def test_language_model_counts_and_gain(spark, documents, monkeypatch):
    monkeypatch.setattr(class_lm, "HEAD", 3000)  # most words through the join
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    tokens = {i: [*_words(r["text"]), None] for i, r in documents.items()}
    count = Counter(t for i, w in tokens.items() if not held(i) for t in w)
    n, v = sum(count.values()), len(count)
    rows = QUERIES["op6_brown_class_lm"](spark, SF).collect()
    assert len(rows) == len(tokens)
    for r in rows:
        w = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(w), sum(t in count for t in w), n)
        assert math.isclose(r.base_score, sum(math.log10((count[t] + 1) / (n + v + 1)) for t in w), rel_tol=1e-9)
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def test_exchange_ends_where_no_single_move_helps():
    rng = np.random.default_rng(3)
    n, k = 30, 7
    counts = np.zeros((n + 1, n + 1), int)
    for _ in range(8000):  # three planted groups that mostly follow themselves
        a = rng.integers(0, n)
        b = (a + 3 * rng.integers(0, n)) % n if rng.random() < 0.9 else rng.integers(0, n)
        counts[a, b] += 1

    def gain(own):
        m = np.eye(k)[own]
        g = m.T @ counts @ m
        f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return f(g) - f(g.sum(axis=0)) - f(g.sum(axis=1))

    own = class_lm.exchange(counts, classes=k)
    best = gain(own)
    assert best > gain(class_lm.exchange(counts, classes=k, sweeps=0)) and own[-1] == k - 1
    for u in range(n):
        for c in range(k - 1):
            other = own.copy()
            other[u] = c
            assert gain(other) <= best + 1e-6
    assert all(len({u % 3 for u in range(n) if own[u] == c}) <= 1 for c in range(k - 1))


def test_mixture_matches_targets(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op7_hypergeometric_mixing"](spark, SF).collect()}
    again = {r.doc_id: r.taken for r in QUERIES["op7_hypergeometric_mixing"](spark, SF).collect()}
    size = Counter()
    for i, r in documents.items():
        assert rows[i].size == len(_words(r["text"])) and rows[i].taken <= 3 * rows[i].size and rows[i].taken == again[i]
        size[r["source"]] += rows[i].size
    names = sorted(size)
    goal = dict(zip(names, targets([size[s] for s in names], [(5, 2, 1)[k % 3] for k in range(len(names))]), strict=True))
    took = Counter()
    for i, r in documents.items():
        assert rows[i].source_size == size[r["source"]] and math.isclose(rows[i].target, goal[r["source"]])
        took[r["source"]] += rows[i].taken
    assert all(abs(took[s] - goal[s]) <= 0.05 * goal[s] for s in names)
    assert math.isclose(sum(goal.values()), sum(size.values()))


def test_targets_stop_at_three_times_the_size():
    assert targets([10, 100, 1000], [100, 1, 1]) == [30.0, 300.0, 780.0]
    assert targets([], []) == [] and targets([0, 0], [5, 2]) == [0.0, 0.0]


def test_splitting_tree_is_exact():
    units = np.array([700, 3, 0, 41])
    dealt = split_quotas(units, 7, np.random.default_rng(1))
    assert (dealt.sum(axis=0) == units).all() and np.ptp(dealt.sum(axis=1)) <= 1 and (dealt >= 0).all()


def test_top_products_equal_all_pairs(spark):
    rows = _table("embeddings")
    ids = np.array([r["vec_id"] for r in rows])
    x = np.floor(256 * np.array([r["embedding"] for r in rows], np.float32).astype(float)).astype(np.int64)
    want = set()
    for q in np.flatnonzero(ids % 50 == 0):
        s = x @ x[q]
        order = [k for k in np.lexsort((ids, -s)) if ids[k] != ids[q]][:5]
        want |= {(int(ids[q]), n + 1, int(ids[k]), int(s[k])) for n, k in enumerate(order)}
    assert {tuple(r) for r in QUERIES["op10_voronoi_top_products"](spark, SF).collect()} == want


def test_licence_lines_are_found(spark, documents):
    lines = {"MIT": "released under the mit license.", "CC-BY-NC-4.0": "licensed under cc by-nc 4.0.",
             "GPL-3.0": "this work is licensed under the gnu general public license, version 3.",
             "Apache-2.0": "licensed under the apache license, version 2.0."}
    for r in QUERIES["op8_tfidf_license_scan"](spark, SF).collect():
        want = {k for k, x in lines.items() if x in (documents[r.doc_id]["text"] or "").lower()}
        assert (r.origin == "header") == bool(want) and (not want or r.licence in want)


def test_articles_are_extracted_whole(spark):
    import html

    pages = {r["page_id"]: r["html"] for r in _table("pages")}
    for r in QUERIES["op3_nearest_url_extraction"](spark, SF).collect():
        body = pages[r.page_id].partition("<article>")[2].partition("</article>")[0]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", body))
        assert r.text == "\n\n".join(x for x in blocks if x)


def test_lines_shared_with_the_nearest_page_go(spark):
    from riskframe.llm.html_extract import main_texts

    page = "<body><div>Site name</div><div>{}</div><div>Contact us</div></body>"
    rows = [(k, f"http://a.com/x/{k}", page.format(f"text number {k} of the site")) for k in range(600)]  # several runs
    got = main_texts(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()
    assert {(r.page_id, r.text) for r in got} == {(k, f"text number {k} of the site") for k in range(600)}


def test_common_lines_are_longest():
    rng = np.random.default_rng(5)
    for _ in range(200):
        x, y = rng.integers(0, 4, rng.integers(0, 12)), rng.integers(0, 4, rng.integers(0, 12))
        table = np.zeros((len(x) + 1, len(y) + 1), int)
        for i, a in enumerate(x):
            for j, b in enumerate(y):
                table[i + 1, j + 1] = table[i, j] + 1 if a == b else max(table[i, j + 1], table[i + 1, j])
        at = common_lines(x, y)
        assert len(at) == table[-1, -1] and at == sorted(set(at))
        rest = iter(y)
        assert all(any(v == w for w in rest) for v in x[at])


def test_rules_decide_as_written(spark):
    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
    urls = {r["page_id"]: r["url"] for r in _table("pages")}
    open_ = 0
    for r in QUERIES["op1_url_markov_ratio"](spark, SF).collect():
        rest = urls[r.page_id].partition("://")[2]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        fits = [k for k in rules if (host.lower() == (h := k.partition("/")[0]) or host.lower().endswith("." + h))
                and path.startswith("/" + k.partition("/")[2])]
        want = max(fits, key=len, default=None)
        assert (r.host, r.path, r.rule) == (host.lower(), path, want)
        if want:
            assert r.verdict == rules[want]
        else:
            open_ += 1
            assert r.verdict == ("allow" if r.score >= r.threshold else "block")
    assert open_


def test_pipeline_keeps_clean_documents(spark):
    """Against a plain version of each stage's decision, on each stage's own input."""
    labels = {r["doc_id"]: r["quality"] for r in _table("labels")}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.saved(stage(spark, docs, SF), name)
        after = {r.doc_id: r.text for r in docs.collect()}
        assert after.keys() <= before.keys()
        if name != "source_mixing":
            assert docs.columns == columns
        if name == "quality_classifier":
            gone = before.keys() - after.keys()
            assert sum(labels.get(i) == 1 for i in gone) <= 0.02 * len(before)
            assert sum(labels.get(i) == 0 for i in after) <= 0.1 * sum(y == 0 for y in labels.values())
        if name == "minhash_near_dedup":
            assert len({frozenset(shingle_set(near_dedup.words(near_dedup.pa.array([t])).hash, 5).tolist()) for t in after.values()}) >= len(after) - 1
        if name == "benchmark_decontamination":
            items = [" ".join(_words(r["text"])) for r in _table("benchmark")]
            assert not any(x in " ".join(_words(t)) for t in after.values() for x in items)
            assert len(after) >= 0.9 * len(before)


def test_exact_passages_beside_gaps_go(spark):
    """Two exact 100-word passages of one pair, and five of 60 words, whatever the gaps between them."""
    from riskframe.llm.substring_dedup import repeated_passages

    rows, want = [], {}

    def text(n, name):
        return [f"{name}x{k}" for k in range(n)]

    def pair(n, size, gap_own, gap_other):
        i = 10 * (len(want) + 1)
        shared = [text(size, f"p{i}n{k}") for k in range(n)]
        first, second, at = text(30, f"u{i}"), text(30, f"v{i}"), set()
        for k, x in enumerate(shared):
            first += x + text(gap_other, f"g{i}n{k}")
            at.update(range(len(second), len(second) + size))
            second += x + text(gap_own, f"h{i}n{k}")
        rows.extend([(i, " ".join(first)), (i + 1, " ".join(second))])
        want[i + 1] = at

    for gap in range(20, 201, 15):
        for own, other in ((0, gap), (gap, 0), (gap, gap)):
            pair(2, 100, own, other)
            pair(5, 60, own, other)
    got = {}
    for r in repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        got[r.id] = {k for x in r.passages for k in range(x.first, x.last + 1)}
        for x in r.passages:
            own = want[r.id] & set(range(x.first, x.last + 1))
            assert len(own) >= 0.8 * (x.last - x.first + 1) and x.last - x.first >= 49
    assert got.keys() == want.keys() and all(want[i] <= got[i] for i in want)


def test_exact_passages_of_lines_found_elsewhere_go(spark):
    """Passages of two lines that earlier documents hold apart, and copies beyond the anchor's number."""
    from riskframe.llm.substring_dedup import repeated_passages

    rng = np.random.default_rng(7)

    def text(n):
        return [f"w{x}" for x in rng.integers(0, 10 ** 9, n)]

    rows, want = [], {}
    for i in range(0, 600, 10):
        one, two, cut = text(30), text(30), int(rng.integers(0, 6))
        both = (one + two)[cut:cut + 50 + i % 11]
        rows += [(i, text(40) + one + text(40)), (i + 1, text(40) + two + text(40)),
                 (i + 2, text(25) + both + text(25)), (i + 3, text(10) + both + text(45) + both + text(5))]
        n = len(both)
        want[i + 3] = {*range(10, 10 + n), *range(55 + n, 55 + 2 * n)}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")
    got = {r.id: {k for x in r.passages for k in range(x.first, x.last + 1)} for r in repeated_passages(df).collect()}
    assert got == want


def test_texts_shorter_than_an_item_leak(spark):
    """A text that is an item with words missing, whole text against whole item."""
    from riskframe.llm.decontaminate import leaked_items

    item = [f"q{k}" for k in range(59)]
    shingles = lambda w: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
    docs = {n: item[:n] for n in range(0, 60)} | {100 + n: item[n:] for n in range(1, 59)}
    near = {i: len(shingles(w) & shingles(item)) / len(shingles(w) | shingles(item)) for i, w in docs.items()}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id bigint, text string")
    one = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    got = {r.doc_id: (r.first_word, r.n_words) for r in leaked_items(df, one).collect()}
    assert got == {i: (0, len(docs[i])) for i, x in near.items() if x >= 0.75}
