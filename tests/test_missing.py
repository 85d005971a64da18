"""Missing values, caps that are gone, folders: findings of the last review."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics as M
from riskframe.operators import profile as PR
from riskframe.operators.ordered import ordered_prefix
from riskframe.operators.scale import standardise
from riskframe.operators.score import score_columns, score_frame
from riskframe.operators.split import class_weights, stratified_split, with_weights
from riskframe.operators.train import train_models
from riskframe.session import ensure_checkpoint_dir

NAN = float("nan")


def test_a_missing_probability_gets_no_label(spark):
    df = spark.createDataFrame([(NAN, 1), (None, 1), (0.9, 1), (0.1, 1)], "p double, y int")
    got = df.select(*[e.alias(n) for n, e in score_columns(F.col("p"), F.col("y")).items()]).collect()
    assert [(r.pred_label, r.correct) for r in got] == [(None, None), (None, None), (1, True), (0, False)]
    assert got[0].conclusion is None and got[0].risk_tier == got[1].risk_tier


def test_a_missing_feature_is_refused_in_training_and_unscored_after(spark):
    rows = [(float(i % 7), float(i % 3), int(i % 7 > 3)) for i in range(80)]
    train = spark.createDataFrame(rows, "a double, b double, y int")
    for bad in (None, NAN):
        dirty = train.unionByName(spark.createDataFrame([(bad, 1.0, 1)], "a double, b double, y int"))
        with pytest.raises(ValueError, match="'a': 1"):
            train_models(dirty, ["a", "b"], "y", max_iter_scale=0.01)
    from riskframe.operators.train import REGISTRY
    for key in list(REGISTRY)[:2]:
        model = train_models(train, ["a", "b"], "y", keys=[key], max_iter_scale=0.05)[key]
        new = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (NAN, 1.0)], "a double, b double")
        got = score_frame(model, new, label_col="y").collect()
        assert got[0].pred_label is not None
        assert [(r.probability, r.pred_label, r.conclusion) for r in got[1:]] == [(None, None, None)] * 2


def test_scaler_and_profile_leave_nan_out(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (NAN,), (None,)], "x double")
    assert [r.x for r in standardise(df, ["x"]).collect()] == [-1.0, 1.0, None, None]
    p = PR.numeric_profile(df, ["x"]).first()
    assert (p["n"], p["nulls"], p["mean"], p["q75"], p["n_distinct"]) == (2, 2, 2.0, 2.5, 2)


def test_null_labels_are_no_class(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 3 + [(None,)] * 3, "y int")
    assert {r.label: r.weight for r in class_weights(df, "y").collect()} == {0: 0.75, 1: 1.5}
    out, total, n = with_weights(df, "y", with_rows=True)
    assert (total, n, out.count(), out.filter("weight is null").count()) == (9.0, 9, 12, 3)


def test_rows_that_cannot_be_evaluated_are_refused(spark):
    df = spark.createDataFrame([(0.2, 1), (NAN, 0)], "s double, y int")
    with pytest.raises(Exception, match="cannot be evaluated"):
        M.long_scores(df, {"m": F.col("s")}, F.col("y")).collect()


def test_chi_square_of_many_values(spark):
    df = spark.range(24_000).select((F.col("id") % 12_000).alias("v"), (F.col("id") % 2).alias("y"))
    row = PR.chi_square(PR.contingency_counts(df, F.col("y"), ["v"])).first()
    assert row.chi2 == pytest.approx(24_000) and row.dof == 11_999


def test_ranges_stay_even_at_epoch_size(spark):
    x = 1.7e12 + np.arange(20_000) * 977.0
    df = spark.createDataFrame([("a", float(v), 1) for v in x], "g string, x double, n int")
    got = ordered_prefix(df, "g", "x", ["n"], buckets=16)
    assert {r.x: r.n_below for r in got.collect()} == {float(v): i for i, v in enumerate(x)}
    from riskframe.operators.ordered import _squash
    assert df.select(F.count_distinct(_squash(F.col("x")))).first()[0] == len(x)


def test_split_over_many_and_null_strata(spark):
    df = spark.range(30_000).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 12_000).alias("s"))
    out = stratified_split(df, "id", "s")
    assert out.count() == 30_000
    got = {r.split: r["count"] for r in out.filter("s is null").groupBy("split").count().collect()}
    assert got == {"train": 2100, "val": 450, "test": 450}


def test_a_cluster_without_shared_folder_is_refused(spark):
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_csv_is_read_by_header_name(spark, tmp_path):
    from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

    from riskframe.sources.tables import read_csv
    schema = StructType([StructField("Age", IntegerType()), StructField("x", DoubleType()),
                         StructField("s", StringType()), StructField("class", StringType())])
    good = tmp_path / "good.csv"
    good.write_text("s,more,x,Age\na,1,0.5,35\nnan,2,NA,36.0\n,3,None,\n")
    rows = read_csv(spark, str(good), schema).collect()
    assert [tuple(r) for r in rows] == [(35, 0.5, "a"), (36, None, None), (None, None, None)]
    bad = tmp_path / "bad.csv"
    for value in ("forty", "35.5"):
        bad.write_text(f"Age,x,s\n{value},1,a\n")
        with pytest.raises(Exception):
            read_csv(spark, str(bad), schema).collect()
    bad.write_text("x,s\n1,a\n")
    with pytest.raises(KeyError, match="Age"):
        read_csv(spark, str(bad), schema)
