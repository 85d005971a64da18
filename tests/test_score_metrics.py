import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics as M
from riskframe.operators.report import prediction_summary, preview, tier_histogram
from riskframe.operators.score import LinearLogitScorer, score_frame, score_records


def test_tiers_half_open_and_undetermined(spark):
    ps = [0.0, 0.19996, 0.2, 0.5, 0.7, 0.99999, 1.0, None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(ps)], "id int, p double")

    class Ident(LinearLogitScorer):
        def _transform(self, d):
            return d.withColumn("probability", F.col("p"))

    out = score_frame(Ident(featureCols=[], coefficients=[]), df, feature_cols=[],
                      keep_cols=["id"], keep_exact=True).orderBy("id").collect()
    assert [r["risk_tier"] for r in out] == ["low", "low", "medium", "elevated", "high", "high",
                                             "undetermined", "undetermined"]
    assert [r["pred_label"] for r in out] == [0, 0, 0, 1, 1, 1, 1, None]
    # histogram on the displayed (rounded) value, as the reference does:
    # 0.19996 -> 0.2 -> medium and 0.99999 -> 1.0 -> undetermined; counts add up
    hist = {r["risk_tier"]: r["n"] for r in tier_histogram(score_frame(
        Ident(featureCols=[], coefficients=[]), df, feature_cols=[])).collect()}
    assert hist == {"low": 1, "medium": 2, "elevated": 1, "high": 1, "undetermined": 3}
    exact = score_frame(Ident(featureCols=[], coefficients=[]), df, feature_cols=[],
                        keep_exact=True)
    hist_exact = {r["risk_tier"]: r["n"] for r in
                  tier_histogram(exact, F.col("probability_exact")).collect()}
    assert hist_exact == {"low": 2, "medium": 1, "elevated": 1, "high": 2, "undetermined": 2}
    assert sum(hist.values()) == len(ps)


def test_summary_preview_and_single_record(spark):
    scorer = LinearLogitScorer(featureCols=["x"], coefficients=[1.0], intercept=0.0)
    df = spark.createDataFrame([(i, float(i - 2), i % 2) for i in range(5)], "id int, x double, class int")
    scored = score_frame(scorer, df, keep_cols=["id"])
    assert scored.columns == ["id", "x", "probability", "pred_label", "conclusion", "risk_tier",
                              "true_label", "correct"]
    s = prediction_summary(scored).first()
    assert (s["n"], s["n_positive"], s["n_negative"]) == (5, 3, 2)
    assert s["positive_rate_pct"] == pytest.approx(60.0)
    assert s["n_correct"] == 2  # pred 0,0,1,1,1 vs truth 0,1,0,1,0
    assert [r["id"] for r in preview(scored, "id", 2).collect()] == [0, 1]
    one = score_records(spark, scorer, [{"x": 0.0}]).first()
    assert one["probability"] == 0.5 and one["pred_label"] == 1


def _long(spark, pairs, model="m"):
    return spark.createDataFrame([(model, y, p) for p, y in pairs], "model string, label int, score double")


def test_auc_ties_counted_half(spark):
    pairs = [(0.2, 0), (0.5, 1), (0.5, 0), (0.5, 1), (0.9, 1), (0.9, 0)]
    assert M.auc(_long(spark, pairs)).first()["auc"] == pytest.approx(0.611111, abs=1e-6)


def test_one_class_and_no_predicted_positive(spark):
    long = _long(spark, [(0.2, 1), (0.6, 1)])
    assert M.auc(long).first()["auc"] is None
    m = M.classification_metrics(M.confusion_counts(long)).first()
    assert m["precision"] == 1.0 and m["recall"] == 0.5
    assert m["f1"] == pytest.approx(0.666667, abs=1e-6)
    m0 = M.classification_metrics(M.confusion_counts(_long(spark, [(0.1, 1), (0.2, 0)]))).first()
    assert m0["precision"] == 0.0 and m0["f1"] == 0.0


def _brute_auc(pairs):
    pos = [p for p, y in pairs if y == 1]
    neg = [p for p, y in pairs if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def _brute_roc(pairs):
    """The reference library's curve: distinct thresholds descending,
    collinear points dropped, (0, 0) prepended."""
    scores = sorted({p for p, _ in pairs}, reverse=True)
    P = sum(y for _, y in pairs)
    N = len(pairs) - P
    tps = np.array([sum(1 for p, y in pairs if y == 1 and p >= s) for s in scores])
    fps = np.array([sum(1 for p, y in pairs if y == 0 and p >= s) for s in scores])
    if len(scores) > 2:
        keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
        tps, fps, scores = tps[keep], fps[keep], [scores[i] for i in keep]
    pts = {(float("inf"), 0.0, 0.0)}
    pts |= {(s, round(f / N, 9), round(t / P, 9)) for s, f, t in zip(scores, fps, tps)}
    return pts


@pytest.mark.parametrize("buckets", [2, 3, 7, 256])
def test_auc_and_roc_match_brute_force_across_ranges(spark, buckets):
    rnd = random.Random(buckets)
    pairs = [(round(rnd.random(), 2), rnd.randint(0, 1)) for _ in range(300)]
    long = _long(spark, pairs, "a").unionByName(
        _long(spark, [(1 - p, y) for p, y in pairs], "b"))
    got = {r["model"]: r["auc"] for r in M.auc(long, buckets=buckets).collect()}
    assert got["a"] == pytest.approx(_brute_auc(pairs), abs=1e-12)
    assert got["b"] == pytest.approx(1 - got["a"], abs=1e-12)  # AUC(1-p) = 1 - AUC(p)
    roc = {(r["threshold"], round(r["fpr"], 9), round(r["tpr"], 9))
           for r in M.roc_curve(long, buckets=buckets).where("model = 'a'").collect()}
    assert roc == _brute_roc(pairs)


def test_auc_invariant_under_monotone_map(spark):
    rnd = random.Random(1)
    pairs = [(rnd.random(), rnd.randint(0, 1)) for _ in range(200)]
    a = M.auc(_long(spark, pairs)).first()["auc"]
    b = M.auc(_long(spark, [(p ** 3, y) for p, y in pairs])).first()["auc"]
    assert a == pytest.approx(b, abs=1e-12)


def test_confusion_cells_sum_and_comparison_order(spark):
    rnd = random.Random(2)
    rows = [(rnd.random(), rnd.randint(0, 1)) for _ in range(100)]
    df = spark.createDataFrame(rows, "s double, y int")
    long = M.long_scores(df, {"good": F.col("s"), "same": F.col("s"), "bad": 1 - F.col("s")},
                         F.col("y"))
    cm = M.confusion_matrix(long).groupBy("model").agg(F.sum("n").alias("t"), F.count("*").alias("c"))
    assert all(r["t"] == 100 and r["c"] == 4 for r in cm.collect())
    cmp = M.comparison_table(long, ["bad", "same", "good"]).orderBy("rank").collect()
    best = M.best_model(M.comparison_table(long, ["bad", "same", "good"])).first()
    aucs = [r["AUC"] for r in cmp]
    assert aucs == sorted(aucs, reverse=True)
    if aucs[0] == aucs[1]:  # tie -> registry order
        assert [r["Model"] for r in cmp[:2]] == ["same", "good"]
        assert best["Model"] == "same"
