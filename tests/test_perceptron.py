import os
from urllib.parse import urlparse

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import functions as F

from riskframe.operators import perceptron as P
from riskframe.operators import train as T

LAYERS = [3, 5, 4, 2]


def _rows(n=400):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] * x[:, 1] + 0.3 * rng.normal(size=n) > 0).astype(int)
    return x, y


@pytest.fixture(scope="module")
def table(spark):
    x, y = _rows()
    return spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"]).repartition(3).persist()


def test_gradient_is_the_slope_of_the_loss():
    x, y = _rows(30)
    rng = np.random.default_rng(1)
    w = rng.normal(size=sum(a * b + b for a, b in zip(LAYERS, LAYERS[1:])))
    _, g = P.loss_and_gradient(w, LAYERS, x, y)
    for i in range(len(w)):
        step = np.zeros(len(w))
        step[i] = 1e-6
        up, down = P.loss_and_gradient(w + step, LAYERS, x, y)[0], P.loss_and_gradient(w - step, LAYERS, x, y)[0]
        assert g[i] == pytest.approx((up - down) / 2e-6, rel=1e-5, abs=1e-5)


def test_same_start_and_as_good_an_end_as_spark(spark, table):
    # one block, as Spark averages over blocks, however few rows the last one has
    theirs = MultilayerPerceptronClassifier(layers=LAYERS, maxIter=80, seed=42, blockSize=400).fit(table.coalesce(1))
    start = P._model(spark, LAYERS, seed=42).weights.toArray()
    ours, losses = P.fit_weights(table, "features", "label", LAYERS, start, 80)
    x, y = _rows()
    loss = lambda w: P.loss_and_gradient(np.asarray(w), LAYERS, x, y)[0] / len(y)
    # Spark's own first loss is ours, so weights are read in the same order
    assert losses[0] == pytest.approx(loss(start)) == pytest.approx(theirs.summary().objectiveHistory[0], rel=1e-9)
    assert all(b < a for a, b in zip(losses, losses[1:]))
    assert losses[-1] == pytest.approx(loss(ours)) and losses[-1] <= loss(theirs.weights.toArray()) + 0.02


def test_stage_gives_sparks_model_with_our_probabilities(spark, table, tmp_path):
    model = P.PerceptronClassifier(layers=LAYERS, maxIter=20, seed=42).fit(table)
    model.write().save(str(tmp_path / "mlp"))
    w = model.weights.toArray()
    rows = model.transform(table).collect()
    for r in rows[:20]:
        p = np.exp(-P.loss_and_gradient(w, LAYERS, np.array([r.features.toArray()]), np.array([1]))[0])
        assert r.probability[1] == pytest.approx(p, rel=1e-9)
    with pytest.raises(Exception, match="labels must be whole"):
        P.fit_weights(table.withColumn("label", F.lit(2.0)), "features", "label", LAYERS, w)


def test_sums_of_many_partitions_are_not_shuffled(spark, table, monkeypatch):
    start = P._model(spark, LAYERS, seed=1).weights.toArray()
    few = P.fit_weights(table, "features", "label", LAYERS, start, 3)[0]

    def shuffled(*_):
        raise AssertionError("a shuffle in every pass")

    monkeypatch.setattr("pyspark.RDD.treeReduce", shuffled)
    many = P.fit_weights(table.repartition(70), "features", "label", LAYERS, start, 3)[0]
    assert np.allclose(few, many, rtol=1e-6, atol=1e-9)


def test_some_thousand_rows_are_dealt_out(spark):
    """One task for 4 MB of rows left a network's or a booster's passes to one core."""
    rows = spark.range(20_000).select("id", (F.col("id") % 2).alias("y"), *[(F.col("id") % (i + 2)).cast("double").alias(f"x{i}") for i in range(12)])
    data = T.prepare_training(rows, [f"x{i}" for i in range(12)], "y", "id")
    try:
        assert data.rdd.getNumPartitions() >= 12
    finally:
        data.unpersist()
    assert [T.training_partitions(n) for n in (0, 1, 1 << 20, 4 << 20, 1 << 30)] == [1, 1, 8, 16, 256]


def test_training_rows_carry_no_lineage(spark):
    """Every task of a fit read the plans of the split, the weights and the shuffle first."""
    rows = spark.range(500).select("id", (F.col("id") % 2).alias("y"), (F.col("id") % 7).cast("double").alias("x"))
    data = T.prepare_training(rows, ["x"], "y", "id")
    try:
        lineage = data.rdd._jrdd.rdd().toDebugString()
        assert "ReliableCheckpointRDD" in lineage and "ShuffledRowRDD" not in lineage
        assert data.count() == 500
    finally:
        data.unpersist()


def test_kept_arrays_give_the_same_gradient():
    x, y = _rows(40)
    x[0] = 1e4  # far out on the sigmoid
    w = np.random.default_rng(1).normal(size=sum(a * b + b for a, b in zip(LAYERS, LAYERS[1:])))
    held = {}
    for rows in (40, 13, 40):
        loss, g = P.loss_and_gradient(w, LAYERS, x[:rows], y[:rows], held)
        fresh = P.loss_and_gradient(w, LAYERS, x[:rows], y[:rows])
        assert loss == fresh[0] and np.array_equal(g, fresh[1])
    again = P.loss_and_gradient(w, LAYERS, x, y, held)[1]
    assert again is g


def test_passes_read_no_lineage_and_leave_no_files(spark, table, monkeypatch):
    """Every task of every pass was sent the plans of the training rows."""
    seen = []
    minimise = P.minimise

    def watched(of, start, *more):
        seen.append(len(os.listdir(root)))
        return minimise(of, start, *more)

    root = urlparse(spark.sparkContext.getCheckpointDir()).path
    before = len(os.listdir(root))
    monkeypatch.setattr(P, "minimise", watched)
    P.fit_weights(table, "features", "label", LAYERS, P._model(spark, LAYERS, seed=1).weights.toArray(), 1)
    assert seen == [before + 1] and len(os.listdir(root)) == before
