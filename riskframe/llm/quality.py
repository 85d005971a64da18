"""Quality classifier: a sparse rule ensemble over text statistics.

Every text is reduced to ``STATISTICS`` (one Arrow pass over its bytes and
words). A random forest on labelled documents supplies tree paths; each
path is a conjunctive rule, and a lasso logistic regression on the rules
keeps few of them, with weights (RuleFit, Friedman and Popescu 2008). The
kept rules are compiled to one Spark column expression, so scoring is a
projection: no join, no model object in the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.graph import free_name, saved, small_batches
from riskframe.llm.text import shingle_hashes, slices, words

SAMPLE = 20_000   # labelled documents used for fitting, at most; scoring and statistics cover all
TREES = 16
DEPTH = 3
LASSO = 0.001
SEED = 42

STATISTICS = (
    "log_words", "log_chars", "mean_word", "longest_word", "distinct_share", "top_word_share",
    "repeat_next_share", "distinct_triples", "upper_share", "capital_words", "digit_share", "mark_share",
    "symbol_share", "bang_share", "bar_share", "stop_share", "comma_share", "space_share", "other_script_share",
    "words_per_line", "ends_in_mark",
)
_TYPE = "struct<" + ",".join(f"{s}:double" for s in STATISTICS) + ">"


def _table(*chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in "".join(chars)]] = True
    return t


_UPPER, _DIGIT = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("0123456789")
_MARK = _table("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_CLASSES = {
    "upper": _UPPER, "digit": _DIGIT, "mark": _MARK, "symbol": _table("#$%&*+<=>@\\^_`{}~"), "bang": _table("!?"),
    "bar": _table("|"), "stop": _table("."), "comma": _table(","), "space": _table(" \t"), "line": _table("\n"),
    "high": np.arange(256) >= 0xC0, "more": (np.arange(256) >= 0x80) & (np.arange(256) < 0xC0),
}


def _per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[edges]).astype(float)


def statistics(column: pa.Array) -> pa.Array:
    """``STATISTICS`` of each text; all zero for null, empty and blank ones."""
    parts: dict[str, list[np.ndarray]] = {s: [] for s in STATISTICS}
    for lo, hi in slices(column):
        w = words(column.slice(lo, hi - lo))
        n = np.diff(w.offsets).astype(float)
        c = {k: _per_text(t[w.data], w.bytes) for k, t in _CLASSES.items()}
        chars = np.diff(w.bytes) - c["more"]
        size = (w.end - w.start).astype(float)
        some, letters = np.maximum(n, 1), np.maximum(chars, 1)
        first, last = w.data[w.start], w.data[np.maximum(w.end - 1, 0)]
        same = np.concatenate((w.hash[1:] == w.hash[:-1], [False]))[:len(w.hash)]
        distinct, top, triples, longest = (np.zeros(hi - lo) for _ in range(4))
        for i in range(hi - lo):
            h = w.of(i)
            if len(h):
                _, counts = np.unique(h, return_counts=True)
                distinct[i], top[i] = len(counts) / len(h), counts.max() / len(h)
                g = shingle_hashes(h, 3)
                triples[i] = len(np.unique(g)) / len(g)
                longest[i] = size[w.offsets[i]:w.offsets[i + 1]].max()
        out = {
            "log_words": np.log1p(n), "log_chars": np.log1p(chars), "mean_word": _sums(size, w.offsets) / some,
            "longest_word": longest, "distinct_share": distinct, "top_word_share": top,
            "repeat_next_share": _per_text(same, w.offsets) / some, "distinct_triples": triples,
            "upper_share": c["upper"] / letters, "capital_words": _per_text(_UPPER[first], w.offsets) / some,
            "digit_share": c["digit"] / letters, "mark_share": c["mark"] / letters, "symbol_share": c["symbol"] / letters,
            "bang_share": c["bang"] / letters, "bar_share": c["bar"] / letters, "stop_share": c["stop"] / some,
            "comma_share": c["comma"] / some, "space_share": c["space"] / letters, "other_script_share": c["high"] / letters,
            "words_per_line": n / (c["line"] + 1), "ends_in_mark": _per_text(_MARK[last], w.offsets) / some,
        }
        for s in STATISTICS:
            parts[s].append(out[s])
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate(parts[s]) if parts[s] else np.zeros(0), pa.float64()) for s in STATISTICS], list(STATISTICS))


def _sums(x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0.0], np.cumsum(x)))[offsets])


def statistics_column(text_col: str) -> Column:
    return F.arrow_udf(statistics, _TYPE)(F.col(text_col))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, above, threshold) tests."""

    tests: tuple[tuple[str, bool, float], ...]

    def column(self, of: str) -> Column:
        out = F.lit(True)
        for name, above, threshold in self.tests:
            c = F.col(f"{of}.{name}")
            out = out & ((c > threshold) if above else (c <= threshold))
        return out.cast("double")


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, of: str) -> Column:
        """Probability of label 1 from a struct column of statistics."""
        z = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            z = z + rule.column(of) * F.lit(float(weight))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


_TEST = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([-0-9.eE]+)\)$")


def tree_rules(description: str) -> Iterator[Rule]:
    """Every path from the root to a node below it, from a tree's printed form."""
    path: list[tuple[int, tuple[str, bool, float]]] = []
    for line in description.splitlines():
        m = _TEST.match(line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth]
        path.append((depth, (STATISTICS[int(m[3])], m[4] == ">", float(m[5]))))
        bounds: dict[tuple[str, bool], float] = {}
        for _, (name, above, threshold) in path:  # the tightest bound of each kind
            old = bounds.get((name, above))
            bounds[name, above] = threshold if old is None else (max if above else min)(old, threshold)
        yield Rule(tuple(sorted((n, a, t) for (n, a), t in bounds.items())))


def fit(train: DataFrame) -> RuleEnsemble:
    """Fit on rows (key, stats, label 0/1). With one class only, or no rows, the
    score is the smoothed share of label 1 (0.5 without rows)."""
    n, ones = train.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n or ones in (0, n):
        share = (ones + 1) / (n + 2)
        return RuleEnsemble(float(np.log(share / (1 - share))), ())
    if n > SAMPLE:  # a fixed pseudo-random choice by key
        train = train.filter(F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(1 << 30)) < int(SAMPLE / n * (1 << 30)))
    rows = saved(train.select("label", *[F.col(f"stats.{s}").alias(s) for s in STATISTICS]).coalesce(8), "labelled")
    assembled = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows).select("label", "features")
    forest = RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=SEED,
                                    featureSubsetStrategy="onethird").fit(assembled)
    rules = sorted({r for tree in forest.trees for r in tree_rules(tree.toDebugString)}, key=lambda r: r.tests)
    marked = rows.select("label", F.struct(*STATISTICS).alias("stats")).select(
        "label", F.array(*[r.column("stats") for r in rules]).alias("hits"))
    lasso = LogisticRegression(labelCol="label", featuresCol="hits", elasticNetParam=1.0, regParam=LASSO, maxIter=60,
                               standardization=False).fit(marked.select("label", array_to_vector("hits").alias("hits")).cache())
    weights = lasso.coefficients.toArray()
    return RuleEnsemble(float(lasso.intercept), tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if w))


def training_rows(docs: DataFrame, labels: DataFrame, use: Column | None = None, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(key, stats, label) of the labelled documents for which ``use`` holds.

    Labels other than 0 and 1 and rows without id are left out; a null text
    counts as empty. A document with several labels takes the largest.
    """
    marks = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("key"))
             .agg(F.max(label_col).cast("double").alias("label")))
    own = small_batches(docs).select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).filter("key is not null")
    if use is not None:
        own = own.filter(use)
    stats = own.select("key", statistics_column("text").alias("stats"))
    return stats.join(marks, "key")


def scored(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score in [0, 1] for every row, empty and null texts included."""
    names = list(docs.columns)
    stats = free_name("__stats", names)
    return (docs.withColumn(stats, statistics_column(text_col))
            .select(*[F.col(f"`{c}`") for c in names], model.score(stats).alias(out)))


def learn_fold(key: Column) -> Column:
    """Rows whose labels may be learned: crc32 of the id as text, mod 3, is not 1."""
    return (F.crc32(key.cast("string")) % 3) != 1


def high_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts (score 0.5 or more)."""
    model = fit(saved(training_rows(docs, labels, learn_fold(F.col("key")), id_col, text_col), "train"))
    score = free_name("__score", docs.columns)
    return scored(docs, model, text_col, score).filter(F.col(score) >= 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, held_out, score, predicted (1 from 0.5).

    Rows that repeat an id are each scored by their own text; a row without
    id is scored and never learned from (held_out null). Null and empty texts
    have all statistics zero. Without labels every score is 0.5. Other
    columns are neither read nor returned.
    """
    model = fit(saved(training_rows(docs, labels, learn_fold(F.col("key")), id_col, text_col), "train"))
    own = scored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model)
    return own.select(F.col("id").alias(id_col), ~learn_fold(F.col("id")), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted")).toDF(id_col, "held_out", "score", "predicted")
