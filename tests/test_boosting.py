import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskframe.operators import boosting as B
from riskframe.operators import train as T


def _table(spark, n=3000, partitions=3):
    """Continuous features, one of them mostly zero, and one with four values."""
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=n), rng.exponential(size=n), np.where(rng.random(n) < 0.9, 0.0, rng.random(n)),
                         rng.integers(0, 4, n)])
    y = (x[:, 0] * x[:, 1] + x[:, 2] + 0.3 * x[:, 3] + 0.5 * rng.normal(size=n) > 0.5).astype(float)
    return spark.createDataFrame([(i, Vectors.dense(a), float(b)) for i, (a, b) in enumerate(zip(x, y))],
                                 ["id", "features", "label"]).repartition(partitions, "id").persist()


def _margins(model, rows):
    return np.array([r.rawPrediction[1] for r in model.transform(rows).orderBy("id").collect()])


def test_same_trees_as_spark(spark, tmp_path):
    """Up to 10,000 rows Spark places its bins on all rows, as ours does, so the trees are the same."""
    rows = _table(spark)
    theirs = GBTClassifier(maxIter=14, maxDepth=4, stepSize=0.3, seed=1).fit(rows)
    ours = B.BoostedTreesClassifier(maxIter=14, maxDepth=4, stepSize=0.3, seed=1).fit(rows)
    assert isinstance(ours, GBTClassificationModel) and ours.getNumTrees == 14
    assert np.allclose(_margins(ours, rows), _margins(theirs, rows), rtol=0, atol=1e-9)
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-9)
    ours.write().save(str(tmp_path / "boosted"))
    again = GBTClassificationModel.load(str(tmp_path / "boosted"))
    assert np.array_equal(_margins(again, rows), _margins(ours, rows))


def test_separable_and_one_class_labels(spark):
    rows = spark.range(200).select("id", (F.col("id") >= 90).cast("double").alias("label"), F.floor(F.col("id") / 10).cast("double").alias("x"),
                                   F.lit(7.0).alias("same"))
    for label in (F.col("label"), F.lit(1.0), F.lit(0.0)):
        data = rows.withColumn("label", label)
        model = T.build_pipeline("boosted_shallow", ["x", "same"], max_iter_scale=0.05).fit(data)
        assert model.transform(data).where("prediction <> label").count() == 0
    with pytest.raises(Exception, match="0 or 1"):
        T.build_pipeline("boosted_shallow", ["x", "same"], max_iter_scale=0.05).fit(rows.withColumn("label", F.lit(2.0)))


def test_layout_and_histograms_sent_in_steps_change_nothing(spark, monkeypatch):
    rows = _table(spark)
    few = B.fit_trees(rows, "features", "label", 3, 4, 0.3)[0]
    monkeypatch.setattr(B, "FLAT_BYTES", 0)
    monkeypatch.setattr(B, "BLOCK_ROWS", 500)
    monkeypatch.setattr(B, "CHECKPOINT_ROUNDS", 2)
    many = B.fit_trees(rows.repartition(11, "id"), "features", "label", 3, 4, 0.3)[0]
    for a, b in zip(few, many, strict=True):
        assert (a.feature, a.cut, a.left) == (b.feature, b.cut, b.left) and np.allclose(a.stats, b.stats)


def test_thinned_summaries_place_cuts_by_rank():
    rng = np.random.default_rng(5)
    x = np.where(rng.random(200_000) < 0.4, 1.5, rng.normal(size=200_000))
    parts = [B._merged([(c, np.ones(len(c)))]) for c in np.split(x, 20)]
    values, counts = parts[0]
    for p in parts[1:]:
        values, counts = B._merged([(values, counts), p])
    assert len(values) <= 2 * B.SUMMARY and counts.sum() == len(x)
    exact = B._cuts(*np.unique(x, return_counts=True), 32)
    cuts = B._cuts(values, counts, 32)
    assert len(cuts) == len(exact) <= 31
    assert np.abs((x[:, None] <= cuts).mean(axis=0) - (x[:, None] <= exact).mean(axis=0)).max() < 0.005


def test_a_level_is_one_job_without_lineage(spark):
    """Spark ML's booster sent the plans of the training rows and up to ten rounds to every task of its jobs."""
    sc = spark.sparkContext
    rows = _table(spark, partitions=16)
    sc.setJobGroup("boosting", "jobs of a fit")
    try:
        B.fit_trees(rows, "features", "label", 6, 3, 0.3)
        jobs = sc.statusTracker().getJobIdsForGroup("boosting")
        tasks = [sc.statusTracker().getStageInfo(s) for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    levels = [t for t in tasks if t and t.numTasks == 1]  # 3,000 rows are one block
    assert len(jobs) <= 6 * 3 + 5 and len(levels) >= 6 * 3


def test_training_reads_split_and_scores_once(spark, monkeypatch):
    """T10 made the split again for every read of it, and every model's scores for each of the figures."""
    from riskframe.plans import q_train as Q

    features = spark.range(400).select(
        F.col("id").alias("doc_id"), (F.col("id") % 3 > 0).cast("int").alias("quality"), *[(F.col("id") % (i + 2)).cast("double").alias(c) for i, c in enumerate(Q.DOC_FEATURES)])
    monkeypatch.setattr(Q, "document_features", lambda s, d: features)
    models = {}

    def train(rows, cols, label, key_col):
        assert "Window" not in rows._jdf.queryExecution().optimizedPlan().toString()  # the split's ranks
        models["logistic"] = T.train_models(rows, cols, label, ["logistic"], max_iter_scale=0.01, key_col=key_col)["logistic"]
        return models

    monkeypatch.setattr(Q, "train_models", train)
    plan = []
    compare = Q.M.comparison_table
    monkeypatch.setattr(Q.M, "comparison_table", lambda long, order: plan.append(long._jdf.queryExecution().optimizedPlan().toString()) or compare(long, order))
    assert [r.Model for r in Q.t10_evaluate_trained(spark, "").collect()] == ["logistic"]
    assert "UDF" not in plan[0] and "is_en" not in plan[0]
