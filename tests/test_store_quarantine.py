"""Model store versions, CSV quarantine and the lazy scaler."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from riskframe.operators.model_store import ModelStore
from riskframe.operators.scale import standardise, standardise_lazily
from riskframe.operators.score import LinearLogitScorer, score_frame
from riskframe.operators.train import train_models
from riskframe.sources.tables import accepted, quarantined, read_csv_checked


def _model(slope):
    return PipelineModel([LinearLogitScorer(featureCols=["x"], coefficients=[slope], intercept=0.0)])


def _scores(spark, model):
    return [r["probability"] for r in model.transform(spark.createDataFrame([(1.0,), (2.0,)], "x double")).collect()]


def test_versions_are_kept_and_the_newest_is_current(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "store"))
    with pytest.raises(FileNotFoundError):
        store.load("mlp")
    first = store.save({"mlp": _model(1.0)}, ["x"], "y")
    held = store.load("mlp")[1]
    second = store.save({"logistic": _model(2.0), "mlp": _model(3.0)}, ["x"], "y", note="more")
    assert store.versions() == [first, second] and store.current() == second
    assert _scores(spark, held) == _scores(spark, _model(1.0)) == _scores(spark, store.load("mlp", first)[1])
    assert _scores(spark, store.load("mlp")[1]) == _scores(spark, _model(3.0))
    assert store.load("random_forest")[0] == "logistic" and store.load("logistic", first)[0] == "mlp"
    assert list(store.load_all()) == ["logistic", "mlp"]
    assert [r["note"] for r in store.manifest().collect()] == ["more", "more"]
    with pytest.raises(KeyError):
        store.load("nope")
    with pytest.raises(KeyError):
        store.save({"nope": _model(1.0)}, ["x"], "y")


def test_a_version_without_commit_is_not_seen(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "store"))
    done = store.save({"mlp": _model(1.0)}, ["x"], "y")
    _model(9.0).write().overwrite().save(str(tmp_path / "store" / "versions" / "half" / "mlp"))  # a writer that stopped
    assert store.current() == done
    assert _scores(spark, store.load("mlp")[1]) == _scores(spark, _model(1.0))


def test_all_five_fitted_models_save_load_and_score_alike(spark, tmp_path):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "event_id", "value", (F.col("value") > 60).cast("int").alias("y"), (F.col("value") % 7).alias("noise"))
    models = train_models(ev, ["value", "noise"], "y", max_iter_scale=0.02, key_col="event_id")
    store = ModelStore(spark, str(tmp_path / "store"))
    store.save(models, ["value", "noise"], "y")
    loaded = store.load_all()
    assert list(loaded) == list(models)
    for key in models:
        a, b = (score_frame(m, ev, label_col="y", feature_cols=["value", "noise"], keep_cols=["event_id"]).orderBy("event_id").collect()
                for m in (models[key], loaded[key]))
        assert a == b


SCHEMA = StructType([StructField("id", IntegerType()), StructField("x", DoubleType()), StructField("name", StringType()),
                     StructField("class", IntegerType())])


def test_good_and_bad_rows_add_up_to_the_file(spark, tmp_path):
    lines = ["name,id,x", "a,1,1.5", "b,2,forty", "c,2.5,1", "d,3,NA", "e,4.0,", "f,99999999999,x", "g,5", "h,6,1,1", '"i, j",7,2']
    path = tmp_path / "in.csv"
    path.write_text("\n".join(lines) + "\n")
    checked = read_csv_checked(spark, str(path), SCHEMA)
    good = sorted(tuple(r) for r in accepted(checked).collect())
    assert good == [(1, 1.5, "a"), (3, None, "d"), (4, None, "e"), (7, 2.0, "i, j")]
    bad = sorted((str(r["column"]), r["text"], r["reason"]) for r in quarantined(checked).collect())
    assert bad == [("None", "g,5", "another number of fields than the header"), ("None", "h,6,1,1", "another number of fields than the header"),
                   ("id", "2.5", "not a whole number"), ("id", "99999999999", "out of range"),
                   ("x", "forty", "not a double"), ("x", "x", "not a double")]
    rejected = checked.where(F.size("_problems") > 0).count()
    assert len(good) + rejected == len(lines) - 1
    with pytest.raises(KeyError):
        read_csv_checked(spark, str(path), StructType([StructField("none", DoubleType())]))


def test_the_lazy_scaler_gives_the_same_values(spark):
    df = spark.createDataFrame([(i, float(i % 5), 3.0, None if i % 4 else float(i)) for i in range(20)] + [(20, float("nan"), 3.0, 1.0)],
                               "id int, a double, flat double, holes double")
    fit_on = df.where("id < 10")
    for on in (None, fit_on):
        a = standardise(df, ["a", "flat", "holes"], on).orderBy("id").collect()
        b = standardise_lazily(df, ["a", "flat", "holes"], on).orderBy("id").collect()
        for x, y in zip(a, b, strict=True):
            assert [v is None for v in x] == [v is None for v in y]
            assert all(v is None or v == pytest.approx(w, abs=1e-12) for v, w in zip(x, y))
    with pytest.raises(KeyError):
        standardise_lazily(df, ["none"])
