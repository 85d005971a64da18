import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import features as FT
from riskframe.operators import profile as PR
from riskframe.operators.split import class_weights, stratified_split


def _brute_split(keys_labels, seed=42):
    out = {}
    by = {}
    for k, c in keys_labels:
        by.setdefault(c, []).append(k)
    for c, ks in by.items():
        ks.sort(key=lambda k: (hashlib.md5(f"{k}|{seed}".encode()).hexdigest(), k))
        n = len(ks)
        c1, c2 = n * 70 // 100, n * 85 // 100
        for r, k in enumerate(ks, start=1):
            out[k] = "train" if r <= c1 else "val" if r <= c2 else "test"
    return out


@pytest.mark.parametrize("digits", [1, 2, 5])
def test_split_exact_counts_and_brute_force(spark, digits):
    rows = [(i, "pos" if i < 200 else "neg") for i in range(520)]
    df = spark.createDataFrame(rows, "id long, c string")
    s = stratified_split(df, "id", "c", hex_digits=digits)
    got = {r["id"]: r["split"] for r in s.collect()}
    assert got == _brute_split(rows)
    counts = {(r["c"], r["split"]): r["n"] for r in
              s.groupBy("c", "split").agg(F.count("*").alias("n")).collect()}
    assert counts == {("neg", "train"): 224, ("neg", "val"): 48, ("neg", "test"): 48,
                      ("pos", "train"): 140, ("pos", "val"): 30, ("pos", "test"): 30}
    # stable under repartitioning
    again = {r["id"]: r["split"] for r in
             stratified_split(df.repartition(7), "id", "c", hex_digits=digits).collect()}
    assert again == got


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 320 + [("b",)] * 200, "c string")
    w = {r["label"]: r["weight"] for r in class_weights(df, "c").collect()}
    assert w == {"a": pytest.approx(0.8125), "b": pytest.approx(1.3)}


def test_chi_square_and_mi_match_brute_force(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("xyz"), rnd.randint(0, 3), rnd.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "f1 string, f2 int, y int")
    counts = PR.contingency_counts(df, F.col("y"), ["f1", "f2"])
    chi = {r["feature"]: (r["chi2"], r["dof"]) for r in PR.chi_square(counts).collect()}
    mi = {r["feature"]: r["mutual_info"] for r in PR.mutual_information(counts).collect()}
    for j, name in enumerate(["f1", "f2"]):
        vals = sorted({r[j] for r in rows})
        t = np.array([[sum(1 for r in rows if r[j] == v and r[2] == y) for y in (0, 1)]
                      for v in vals], dtype=float)
        e = t.sum(1, keepdims=True) * t.sum(0, keepdims=True) / t.sum()
        assert chi[name][0] == pytest.approx(((t - e) ** 2 / e).sum(), rel=1e-9)
        assert chi[name][1] == (len(vals) - 1)
        p = t / t.sum()
        px, py = p.sum(1, keepdims=True), p.sum(0, keepdims=True)
        nz = p > 0
        assert mi[name] == pytest.approx((p[nz] * np.log(p[nz] / (px @ py)[nz])).sum(), rel=1e-9)


def test_profile_quantiles_match_numpy(spark, monkeypatch):
    from riskframe.operators import ordered
    monkeypatch.setattr(ordered, "DEFAULT_BUCKETS", 3)
    rnd = random.Random(4)
    xs = [float(rnd.randint(0, 40)) for _ in range(250)] + [None] * 5
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    prof = PR.numeric_profile(df, ["x"]).first()
    arr = np.array([x for x in xs if x is not None])
    assert prof["n"] == 250 and prof["nulls"] == 5 and prof["n_distinct"] == len(set(arr))
    for q, name in [(0.25, "q25"), (0.5, "q50"), (0.75, "q75")]:
        assert prof[name] == pytest.approx(np.percentile(arr, q * 100), abs=1e-12)


def test_vif_two_columns_and_bounds(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    r = li.agg(F.corr("l_quantity", "l_extendedprice")).first()[0]
    v = {x["feature"]: x["vif"] for x in PR.vif(spark, li, ["l_quantity", "l_extendedprice"]).collect()}
    assert v["l_quantity"] == pytest.approx(1 / (1 - r * r), rel=1e-9)
    v4 = PR.vif(spark, li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]).collect()
    assert all(x["vif"] >= 1.0 - 1e-12 for x in v4)


def test_pca_variance_descends(spark):
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    proj, var = FT.pca_projection(emb, "embedding", k=3, key="vec_id")
    ev = [r["explained"] for r in var.orderBy("component").collect()]
    assert ev == sorted(ev, reverse=True) and sum(ev) <= 1.0 + 1e-9
    assert proj.count() == emb.count()


def test_ranking_and_recommendation(spark):
    scores = {
        "a": spark.createDataFrame([("f1", 3.0), ("f2", 2.0), ("f3", 1.0)], "feature string, a double"),
        "b": spark.createDataFrame([("f1", -0.1), ("f2", 0.9), ("f3", 0.5)], "feature string, b double"),
    }
    rk = FT.combined_ranking(scores, abs_scores=("b",))
    got = {r["feature"]: r["final_rank"] for r in rk.collect()}
    assert got == {"f2": 1, "f1": 2, "f3": 3}
    rec = FT.recommend(rk, 2)
    assert {r["feature"] for r in rec.where("recommended").collect()} == {"f1", "f2"}


def test_chi_square_agrees_with_spark_ml(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        F.col("l_discount"), F.col("l_tax"),
        (F.col("l_returnflag") == "R").cast("double").alias("y"))
    ours = {r["feature"]: (r["chi2"], r["dof"]) for r in
            PR.chi_square(PR.contingency_counts(li, F.col("y"), ["l_discount", "l_tax"])).collect()}
    vec = VectorAssembler(inputCols=["l_discount", "l_tax"], outputCol="v").transform(li)
    res = ChiSquareTest.test(vec, "v", "y").first()
    for i, name in enumerate(["l_discount", "l_tax"]):
        assert ours[name][0] == pytest.approx(float(res["statistics"][i]), rel=1e-9)
        assert ours[name][1] == res["degreesOfFreedom"][i]
