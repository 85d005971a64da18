"""Sketch profiles, tiled pair sums, lasso at width and Newton steps against numpy and Spark ML."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskframe.operators import features as FT
from riskframe.operators import gram as G
from riskframe.operators import profile as PR
from riskframe.operators import sketches as SK
from riskframe.operators.newton import NewtonLogisticRegression, fit_logistic

SF = "/root/testdata/sf0.01"
INF, NAN = float("inf"), float("nan")


# --- sketches -----------------------------------------------------------------------

COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


def test_sketch_profile_is_exact_but_for_estimates(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    sketches = SK.sketch_columns(li, COLUMNS).checkpoint()
    got = {r["feature"]: r for r in SK.sketch_profile(sketches).collect()}
    exact = {r["feature"]: r for r in PR.numeric_profile(li, COLUMNS).collect()}
    for c in COLUMNS:
        for name in ("n", "nulls", "min", "max"):
            assert got[c][name] == exact[c][name]
        assert got[c]["mean"] == pytest.approx(exact[c]["mean"], rel=1e-12)
        assert got[c]["stddev"] == pytest.approx(exact[c]["stddev"], rel=1e-9)
        assert abs(got[c]["n_distinct"] - exact[c]["n_distinct"]) <= 4 * SK.distinct_error() * exact[c]["n_distinct"]
    errors = SK.rank_errors(li, SK.sketch_profile(sketches, (0.01, 0.25, 0.5, 0.9)), (0.01, 0.25, 0.5, 0.9)).collect()
    assert len(errors) == 4 * len(COLUMNS)
    assert all(r["rank_error"] <= 2 * SK.rank_error() for r in errors)


def test_rank_errors_are_measured(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    wrong = spark.createDataFrame([("v", 600.0)], "feature string, q50 double")
    assert SK.rank_errors(df, wrong, (0.5,)).first()["rank_error"] == pytest.approx(0.1)


def test_merged_sketches_equal_one_sketch(spark, tmp_path):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    paths = []
    for i in range(3):  # written by stage, read back later
        paths.append(str(tmp_path / f"stage{i}"))
        SK.sketch_columns(li.where(F.col("l_linenumber") % 3 == i), COLUMNS).write.parquet(paths[-1])
    merged = {r["feature"]: r for r in SK.sketch_profile(SK.merge_sketches(*[spark.read.parquet(p) for p in paths])).collect()}
    whole = {r["feature"]: r for r in SK.sketch_profile(SK.sketch_columns(li, COLUMNS)).collect()}
    for c in COLUMNS:
        for name in ("n", "nulls", "min", "max", "n_distinct"):
            assert merged[c][name] == whole[c][name]
        assert merged[c]["mean"] == pytest.approx(whole[c]["mean"], rel=1e-12)
        assert merged[c]["stddev"] == pytest.approx(whole[c]["stddev"], rel=1e-9)


def test_sketch_edges(spark):
    rows = [(1.0, None, NAN, 0.0), (2.0, None, INF, -0.0), (None, None, -INF, 0.0), (NAN, None, 3.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, `c x` double, z double")
    empty = df.where(F.lit(False))
    r = {x["feature"]: x for x in SK.sketch_profile(SK.merge_sketches(
        SK.sketch_columns(df, df.columns), SK.sketch_columns(empty, df.columns))).collect()}
    assert (r["a"]["n"], r["a"]["nulls"], r["a"]["mean"], r["a"]["n_distinct"]) == (2, 2, 1.5, 2)
    assert (r["b"]["n"], r["b"]["nulls"], r["b"]["min"], r["b"]["mean"], r["b"]["q50"], r["b"]["n_distinct"]) == (0, 4, None, None, None, 0)
    assert (r["c x"]["min"], r["c x"]["max"], r["c x"]["n"]) == (-INF, INF, 3)
    assert r["c x"]["mean"] is None and r["c x"]["stddev"] is None
    assert r["z"]["n_distinct"] == 1


def test_many_columns_are_sketched_in_groups(spark, monkeypatch):
    monkeypatch.setattr(SK, "COLUMNS_A_SCAN", 3)
    df = spark.range(50).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(8)])
    got = {r["feature"]: r for r in SK.sketch_profile(SK.sketch_columns(df, df.columns)).collect()}
    assert [got[f"c{i}"]["max"] for i in range(8)] == [49.0 * i for i in range(8)]


# --- pair sums ------------------------------------------------------------------------

def _pairwise(x):
    k = x.shape[1]
    out = {}
    for i in range(k):
        for j in range(i, k):
            both = np.isfinite(x[:, i]) & np.isfinite(x[:, j])
            a, b = x[both, i], x[both, j]
            ok = len(a) > 1 and a.std() > 0 and b.std() > 0
            out[i, j] = float(np.corrcoef(a, b)[0, 1]) if ok else None
    return out


@pytest.mark.parametrize("block, held", [(128, 64 << 20), (4, 1), (3, 3000)])
def test_tiles_match_numpy_with_missing_values(spark, block, held):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 10)) @ rng.normal(size=(10, 10)) + 1e9
    x[:, 2] = 7.0                       # constant
    x[rng.random(x.shape) < 0.2] = NAN
    x[5, 3], x[6, 3], x[7, 4] = INF, -INF, -INF
    x[:, 9] = NAN                       # nothing present
    df = spark.createDataFrame([tuple(None if i % 2 and math.isnan(v) else float(v) for i, v in enumerate(r)) for r in x],
                               ", ".join(f"`f {i}` double" for i in range(10))).repartition(6)
    got = {(int(r["x"][2:]), int(r["y"][2:])): r["r"] for r in PR.correlation_pairs(df, df.columns, block, held).collect()}
    want = _pairwise(x)
    assert set(got) == set(want)
    for pair, r in want.items():
        assert got[pair] == (None if r is None else pytest.approx(r, abs=1e-6)), pair


def test_an_outlier_keeps_r_within_bounds(spark):
    rows = [(-1e12, 0.1)] + [(i / 100, i / 50) for i in range(100)]
    got = {(r["x"], r["y"]): r["r"] for r in PR.correlation_pairs(spark.createDataFrame(rows, "a double, b double"), ["a", "b"]).collect()}
    assert got["a", "a"] == 1.0 and got["b", "b"] == 1.0 and abs(got["a", "b"]) <= 1.0


def test_correlation_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert sorted((r["x"], r["y"], r["r"]) for r in PR.correlation_pairs(df, ["a", "b"]).collect()) == [
        ("a", "a", None), ("a", "b", None), ("b", "b", None)]
    assert all(r["singular"] and r["vif"] is None for r in PR.vif(spark, df, ["a", "b"]).collect())


def test_many_columns_in_several_passes(spark):
    """600 columns, five tiles a pass: 15 tiles in three passes."""
    k, n = 600, 60
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 20)) @ rng.normal(size=(20, k)) + rng.normal(size=(n, k))
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(2)
    wide = df.select(*[F.col("v")[i].alias(f"c{i}") for i in range(k)])
    got = PR.correlation_pairs(wide, wide.columns, tile_bytes=4 << 20).toArrow().to_pydict()
    r = np.corrcoef(x, rowvar=False)
    i, j = (np.array([int(c[1:]) for c in got[name]]) for name in "xy")
    assert len(set(zip(i, j))) == len(i) == k * (k + 1) // 2 and (i <= j).all()
    assert np.abs(np.array(got["r"]) - r[i, j]).max() < 1e-9


# --- lasso ----------------------------------------------------------------------------

def test_lasso_of_500_columns_meets_its_conditions(spark):
    k, n, alpha = 500, 200, 0.05
    rng = np.random.default_rng(8)
    x = rng.normal(size=(n, k)) * rng.uniform(0.1, 50, k) + 1e4
    y = x[:, :5] @ np.array([1.0, -2.0, 0.5, 3.0, -1.0]) + rng.normal(size=n)
    df = (spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y)], "v array<double>, y double")
          .select("y", *[F.col("v")[i].alias(f"c{i}") for i in range(k)]))
    names = [f"c{i}" for i in range(k)]
    solution = FT.lasso_selection(df, names, F.col("y"), alpha)
    b = {r["feature"]: r["coefficient"] for r in solution.collect()}
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    g = z.T @ (y - y.mean() - z @ np.array([b[c] for c in names])) / n
    nonzero = np.array([b[c] != 0 for c in names])
    assert np.abs(g[nonzero] - alpha * np.sign([b[c] for c in names if b[c] != 0])).max() < 1e-8
    assert np.abs(g[~nonzero]).max() <= alpha + 1e-8
    assert {f"c{i}" for i in (0, 1, 3)} <= {c for c in names if b[c] != 0}


def test_lasso_certificate_tells_right_from_wrong(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    names, label = ["l_quantity", "l_discount", "l_tax"], (F.col("l_quantity") + 100 * F.col("l_tax") > 30).cast("int")
    solution = FT.lasso_selection(li, names, label, 0.01)
    assert all(r["gap"] < 1e-9 for r in FT.lasso_certificate(li, names, label, solution, 0.01).collect())
    off = solution.withColumn("coefficient", F.col("coefficient") + 0.1)
    assert max(r["gap"] for r in FT.lasso_certificate(li, names, label, off, 0.01).collect()) > 0.01


def test_lasso_leaves_out_missing_and_infinite_rows(spark):
    rows = [(float(i % 7), float(i % 3), float(i % 2)) for i in range(60)]
    bad = [(INF, 1.0, 1.0), (-INF, 0.0, 0.0), (1.0, NAN, 1.0), (None, 1.0, 0.0), (1.0, 2.0, None)]
    schema = "a double, b double, y double"
    clean = FT.lasso_selection(spark.createDataFrame(rows, schema), ["a", "b"], F.col("y"), 0.001).collect()
    mixed = FT.lasso_selection(spark.createDataFrame(rows + bad, schema), ["a", "b"], F.col("y"), 0.001).collect()
    for c, m in zip(clean, mixed, strict=True):
        assert (c["feature"], c["selected"]) == (m["feature"], m["selected"])
        assert c["coefficient"] == pytest.approx(m["coefficient"], abs=1e-12)
    none = FT.lasso_selection(spark.createDataFrame([], schema), ["a", "b"], F.col("y")).collect()
    assert [(r["coefficient"], r["selected"]) for r in none] == [(0.0, False)] * 2


# --- Newton steps -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def signal(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2000, 4)) * [1.0, 3.0, 0.2, 1.0]
    p = 1 / (1 + np.exp(-(x @ [1.5, -0.4, 2.0, 0.0] - 1.0)))
    y = (rng.random(2000) < p).astype(float)
    w = np.where(y > 0, 1.7, 0.8)
    return spark.createDataFrame([(*map(float, r), float(a), float(b)) for r, a, b in zip(x, y, w)],
                                 "a double, b double, c double, d double, label double, weight double").repartition(5)


def test_newton_agrees_with_spark_ml(signal):
    names = ["a", "b", "c", "d"]
    fit = fit_logistic(signal, names, "label", "weight", penalty=1.0)
    assert fit.converged and fit.steps <= 12
    total = signal.agg(F.sum("weight")).first()[0]
    ml = LogisticRegression(featuresCol="v", weightCol="weight", maxIter=2000, tol=1e-14, regParam=1.0 / total,
                            standardization=False).fit(VectorAssembler(inputCols=names, outputCol="v").transform(signal))
    assert np.allclose(fit.coefficients, ml.coefficients.toArray(), atol=1e-6)
    assert fit.intercept == pytest.approx(ml.intercept, abs=1e-6)


def test_newton_stops_on_separable_data(spark):
    df = spark.createDataFrame([(float(i), float(i >= 10)) for i in range(20)], "x double, label double")
    with_penalty = fit_logistic(df, ["x"], "label", penalty=1.0)
    assert with_penalty.converged and np.isfinite(with_penalty.coefficients).all()
    without = fit_logistic(df, ["x"], "label", penalty=0.0, max_steps=40)
    assert without.steps <= 40 and np.isfinite(without.coefficients).all() and without.coefficients[0] > 1


def test_newton_edges(spark, signal):
    rows = signal.limit(300).cache()
    holes = rows.unionByName(rows.limit(3).withColumn("a", F.lit(None).cast("double"))).unionByName(
        rows.limit(3).withColumn("b", F.lit(INF))).unionByName(rows.limit(3).withColumn("label", F.lit(None).cast("double")))
    a, b = (fit_logistic(d, ["a", "b"], "label") for d in (rows, holes))
    assert np.allclose(a.coefficients, b.coefficients, atol=1e-9)
    nothing = fit_logistic(rows.where("a > 1e9"), ["a", "b"], "label")
    assert (nothing.coefficients == 0).all() and nothing.intercept == 0.0
    one_class = fit_logistic(rows.where("label = 1"), ["a"], "label", max_steps=30)
    assert np.isfinite(one_class.coefficients).all() and one_class.intercept > 3


def test_newton_stage_saves_and_loads(spark, signal, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    model = Pipeline(stages=[NewtonLogisticRegression(featureCols=["a", "b"], weightCol="weight")]).fit(signal)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert (again.transform(signal).select("probability").orderBy("a").collect()
            == model.transform(signal).select("probability").orderBy("a").collect())
