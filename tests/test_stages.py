import pytest
from pyspark.sql import functions as F

from riskframe.operators.encode import BinaryCode
from riskframe.plans.stages import predict_stage, run_stages
from riskframe.session import shared_path


def test_stages_end_to_end(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    raw = o.select("o_orderkey", F.col("o_orderstatus").alias("class"), "o_totalprice",
                   F.col("o_orderpriority").alias("urgent"),
                   (F.dayofweek("o_orderdate")).cast("double").alias("weekday"))
    codes = [BinaryCode("class", {"F": 1, "O": 0}), BinaryCode("urgent", {"1-URGENT": 1, "2-HIGH": 1,
                                                                          "3-MEDIUM": 0, "4-NOT SPECIFIED": 0,
                                                                          "5-LOW": 0})]
    root = shared_path(spark, "stages-test")
    out = run_stages(spark, raw, root, key="o_orderkey", label_col="class", codes=codes,
                     numeric=["o_totalprice", "weekday"],
                     features=["o_totalprice", "urgent", "weekday"], top_n=2,
                     keys=["logistic", "random_forest"], max_iter_scale=0.05,
                     bins={"o_totalprice": [-1.0, 0.0, 1.0], "weekday": [-1.0, 0.0, 1.0]})
    cmp = out["evaluation"]["comparison"].collect()
    assert {r["Model"] for r in cmp} == {"logistic", "random_forest"}
    assert out["evaluation"]["skipped"] == ["boosted_deep", "boosted_shallow", "mlp"]
    assert len(out["features"]) == 2
    store = out["store"]
    n = {s: store.get(spark, s).count() for s in ("train", "val", "test")}
    labelled = raw.where(F.col("class").isin("F", "O")).count()
    assert sum(n.values()) == labelled
    pred = predict_stage(spark, out["model_root"],
                         [shared_path(spark, "absent"), store.path("test")],
                         output=shared_path(spark, "scored"),
                         key="mlp", label_col="class", preview_key="o_orderkey")
    assert pred["model"] == "logistic" and pred["input"] == store.path("test")
    hist = pred["histogram"].collect()
    assert sum(r["n"] for r in hist) == n["test"]
    assert len(pred["preview"].collect()) == min(10, n["test"])
    # an explicit input that is absent stops the run, whatever else exists
    with pytest.raises(FileNotFoundError, match="typo"):
        predict_stage(spark, out["model_root"], [store.path("test")], label_col="class",
                      explicit=shared_path(spark, "typo"))
