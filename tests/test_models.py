import pytest
from pyspark.sql import functions as F

from riskframe.operators.score import score_frame
from riskframe.operators.train import load_model, save_models, train_models


@pytest.fixture(scope="module")
def separable(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    return ev.select("value", ((F.col("value") > 100).cast("int")).alias("y"),
                     (F.col("value") % 7).alias("noise"))


def test_models_fit_score_save_load(spark, separable, tmp_path):
    models = train_models(separable, ["value", "noise"], "y", ["logistic", "random_forest"],
                          max_iter_scale=0.1)
    scored = score_frame(models["logistic"], separable, label_col="y")
    row = scored.agg(F.min("probability"), F.max("probability"),
                     F.avg(F.col("correct").cast("double"))).first()
    assert 0.0 <= row[0] <= row[1] <= 1.0
    assert row[2] > 0.9
    paths = save_models(models, str(tmp_path / "models"))
    key, m = load_model(spark, str(tmp_path / "models"), "logistic")
    assert key == "logistic"
    again = score_frame(m, separable, label_col="y").select("probability").collect()
    assert again == scored.select("probability").collect()
    # absent key falls back to the first saved model in registry order
    key2, _ = load_model(spark, str(tmp_path / "models"), "mlp")
    assert key2 == "logistic"
    with pytest.raises(KeyError):
        load_model(spark, str(tmp_path / "models"), "nope")
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "empty"), "mlp")
    assert set(paths) == {"logistic", "random_forest"}


def test_same_seed_same_forest(spark, separable):
    a = train_models(separable, ["value", "noise"], "y", ["random_forest"], max_iter_scale=0.05)
    b = train_models(separable, ["value", "noise"], "y", ["random_forest"], max_iter_scale=0.05)
    pa = score_frame(a["random_forest"], separable, label_col="y").select("probability").collect()
    pb = score_frame(b["random_forest"], separable, label_col="y").select("probability").collect()
    assert pa == pb
