"""Brute-force checks for the operators whose result has no SQL twin or whose
twin only covers a special case: VIF for k > 2 (F3), lasso (F8), PCA (F10).
Each is recomputed with numpy on the same small fixture."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import features as FT
from riskframe.operators import profile as PR

SF = "/root/testdata/sf0.001"


def _lineitem(spark):
    # four columns with real collinearity: price grows with quantity, and the
    # discounted quantity shares both
    return spark.read.parquet(f"{SF}/lineitem.parquet").select(
        "l_quantity", "l_extendedprice", "l_tax",
        (F.col("l_quantity") * (F.lit(1.0) - F.col("l_discount"))).alias("net_qty"),
        (F.col("l_quantity") > 25).cast("double").alias("bulk"))


def _numpy(df, cols):
    rows = df.select(*cols).collect()
    return np.array([[float(r[c]) for c in cols] for r in rows])


def test_vif_matches_regression_r2(spark):
    cols = ["l_quantity", "l_extendedprice", "l_tax", "net_qty"]
    df = _lineitem(spark)
    got = {r["feature"]: r["vif"] for r in PR.vif(spark, df, cols).collect()}
    x = _numpy(df, cols)
    for j, c in enumerate(cols):
        others = np.column_stack([np.ones(len(x)), np.delete(x, j, axis=1)])
        beta, *_ = np.linalg.lstsq(others, x[:, j], rcond=None)
        resid = x[:, j] - others @ beta
        r2 = 1.0 - resid @ resid / ((x[:, j] - x[:, j].mean()) @ (x[:, j] - x[:, j].mean()))
        assert got[c] == pytest.approx(1.0 / (1.0 - r2), rel=1e-7)
    assert got["net_qty"] > 2.0  # the fixture is collinear, not a trivial all-ones case


def _lasso_cd(x, y, alpha, sweeps=20_000, tol=1e-13):
    """Coordinate descent on 1/(2n) |y - b0 - X b|^2 + alpha |b|_1 for
    population-standardised X (column mean 0, mean square 1)."""
    n, k = x.shape
    b = np.zeros(k)
    r = y - y.mean()
    for _ in range(sweeps):
        delta = 0.0
        for j in range(k):
            rho = x[:, j] @ r / n + b[j]
            new = np.sign(rho) * max(abs(rho) - alpha, 0.0)
            if new != b[j]:
                r -= x[:, j] * (new - b[j])
                delta = max(delta, abs(new - b[j]))
                b[j] = new
        if delta < tol:
            break
    return b


@pytest.mark.parametrize("alpha", [0.001, 0.02])
def test_lasso_matches_coordinate_descent(spark, alpha):
    feats = ["l_quantity", "l_extendedprice", "l_tax", "net_qty"]
    df = _lineitem(spark)
    got = {r["feature"]: r for r in
           FT.lasso_selection(df, feats, F.col("bulk"), alpha=alpha).collect()}
    data = _numpy(df, feats + ["bulk"])
    x, y = data[:, :-1], data[:, -1]
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    want = _lasso_cd(z, y, alpha, sweeps=200_000, tol=1e-15)
    for f, w in zip(feats, want):
        assert got[f]["coefficient"] == pytest.approx(w, abs=1e-7)
        assert got[f]["selected"] == (w != 0.0)
    assert any(abs(w) > 1e-3 for w in want)
    if alpha >= 0.02:
        assert any(w == 0.0 for w in want)  # the larger penalty drops features


def test_lasso_agrees_with_spark_ml_when_well_conditioned(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from riskframe.operators.scale import PopulationStandardScaler
    feats = ["l_quantity", "l_extendedprice", "l_tax"]
    df = _lineitem(spark).select(*feats, "bulk")
    got = {r["feature"]: r["coefficient"] for r in
           FT.lasso_selection(df, feats, F.col("bulk"), alpha=0.01).collect()}
    z = PopulationStandardScaler(inputCols=feats).fit(df).transform(df)
    v = VectorAssembler(inputCols=feats, outputCol="v").transform(z)
    lr = LinearRegression(featuresCol="v", labelCol="bulk", elasticNetParam=1.0, regParam=0.01,
                          standardization=False, tol=1e-12, maxIter=1000).fit(v)
    for f, w in zip(feats, lr.coefficients.toArray()):
        assert got[f] == pytest.approx(float(w), abs=1e-6)


def test_pca_matches_numpy_eigendecomposition(spark):
    emb = spark.read.parquet(f"{SF}/embeddings.parquet")
    proj, var = FT.pca_projection(emb, "embedding", k=2, key="vec_id")
    rows = emb.select("vec_id", "embedding").collect()
    ids = [r["vec_id"] for r in rows]
    x = np.array([r["embedding"] for r in rows], dtype=np.float64)
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    vals, vecs = np.linalg.eigh(np.cov(z, rowvar=False))
    order = np.argsort(vals)[::-1][:2]
    ratio = vals[order] / vals.sum()
    got = var.orderBy("component").collect()
    assert [r["explained"] for r in got] == pytest.approx(list(ratio), rel=1e-6)
    assert got[1]["cumulative"] == pytest.approx(ratio.sum(), rel=1e-6)
    v = vecs[:, order]
    v = v * np.sign(v[np.abs(v).argmax(axis=0), range(2)])
    want = dict(zip(ids, z @ v))
    for r in proj.collect():
        assert [r["pc1"], r["pc2"]] == pytest.approx(list(want[r["vec_id"]]), abs=1e-6)


def test_correlation_is_pairwise_complete_for_any_number_of_columns(spark):
    df = _lineitem(spark).withColumns({
        "const": F.lit(3.0), "holes": F.when(F.col("l_quantity") > 20, F.col("l_tax")),
        "nans": F.when(F.col("l_tax") > 0.02, F.col("net_qty")).otherwise(F.lit(float("nan")))})
    cols = ["l_quantity", "l_extendedprice", "l_tax", "net_qty", "const", "holes", "nans"]
    few = {(r["x"], r["y"]): r["r"] for r in PR.correlation_pairs(df, cols).collect()}
    many = PR.correlation_pairs(df.withColumns({f"more{i}": F.col("l_quantity") + i for i in range(70)}),
                                [*cols, *[f"more{i}" for i in range(70)]])
    many = {(r["x"], r["y"]): r["r"] for r in many.collect()}
    pdf = df.select(*cols).toPandas().astype(float)
    want = pdf.corr()
    for (x, y), r in few.items():
        if "const" in (x, y):
            assert r is None and many[x, y] is None
        else:
            assert r == pytest.approx(want.loc[x, y], abs=1e-9) == many[x, y]


def test_correlation_with_constant_columns_is_null_not_an_error(spark):
    df = _lineitem(spark).withColumns({"c1": F.lit(1.0), "c2": F.lit(2.0)})
    for cols in (["l_quantity", "c1", "c2"], ["c1", "c2"]):
        got = {(r["x"], r["y"]): r["r"] for r in PR.correlation_pairs(df, cols).collect()}
        for (x, y), r in got.items():
            assert (r is None) == (x != "l_quantity" or y != "l_quantity"), cols
    lc = PR.label_correlation(df, F.col("c1"), ["l_quantity"]).first()
    assert lc["corr"] is None


def test_lasso_reads_the_rows_in_one_aggregate(spark):
    """However many coordinate-descent sweeps run, the data is aggregated
    once (an optimiser over the rows would launch jobs per step)."""
    sc = spark.sparkContext
    df = _lineitem(spark)  # reading the schema is a job of its own, not counted
    sc.setJobGroup("lasso-one-pass", "lasso job count")
    try:
        FT.lasso_selection(df, ["l_quantity", "l_extendedprice", "l_tax", "net_qty"],
                           F.col("bulk"), alpha=0.001)
        jobs = sc.statusTracker().getJobIdsForGroup("lasso-one-pass")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert 1 <= len(jobs) <= 2, jobs  # the aggregate (plus AQE's shuffle-stage job)


def test_wide_correlation_on_empty_input_is_null(spark):
    empty = spark.createDataFrame([], "a double, b double, c double")
    rows = PR.correlation_pairs(empty, ["a", "b", "c"]).collect()
    assert len(rows) == 6 and all(r["r"] is None for r in rows)


# --- components from products with the rows ------------------------------------------------

@pytest.mark.parametrize("d, n, k", [(2, 50, 2), (5, 300, 3), (130, 200, 4)])
def test_block_components_match_eigh(spark, monkeypatch, d, n, k):
    from riskframe.operators import principal as PC
    monkeypatch.setattr(PC, "MOST", 40)  # the widest case is cut back on its way
    rng = np.random.default_rng(d)
    x = rng.normal(size=(n, 3)) @ rng.normal(size=(3, d)) * 2 + rng.normal(size=(n, d)) + 100
    if d > 2:
        x[:, 1] = 7.0  # constant
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    bad = [(-1, None), (-2, [1.0] * (d - 1)), (-3, [float("nan")] * d), (-4, [float("inf")] * d), (-5, [None] * d)]
    df = spark.createDataFrame(rows + bad, "id int, v array<double>").repartition(3)
    fit = PC.fit_components(df, "v", k)
    sd = x.std(axis=0, ddof=1)
    z = (x - x.mean(axis=0)) / np.where(sd > 1e-9, sd, 1.0) * (sd > 1e-9)
    value, vector = np.linalg.eigh(z.T @ z / (n - 1))
    assert np.allclose(fit.explained, value[::-1][:k] / value.sum(), atol=1e-9)
    for j in range(k):
        assert abs(fit.vectors[:, j] @ vector[:, -1 - j]) == pytest.approx(1.0, abs=1e-6)
        assert fit.vectors[np.abs(fit.vectors[:, j]).argmax(), j] > 0
    got = {r["id"]: r["pc1"] for r in PC.project(df, "v", fit, ["id"]).collect()}
    assert np.allclose([got[i] for i in range(n)], z @ fit.vectors[:, 0], atol=1e-8)
    assert all(got[i] is None for i in range(-5, 0))


def test_block_components_of_nothing(spark):
    from riskframe.operators import principal as PC
    empty = spark.createDataFrame([], "v array<double>")
    assert PC.fit_components(empty, "v").explained.size == 0
    one = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    assert (PC.fit_components(one, "v").explained == 0).all()
    same = spark.createDataFrame([([1.0, 2.0],)] * 5, "v array<double>")
    assert (PC.fit_components(same, "v").explained == 0).all()
