import math

import pytest
from pyspark.sql import functions as F

from riskframe.functions.constants import YES_NO_CODE
from riskframe.operators.encode import (REFERENCE_CODES, BinaryCode, columns_with_nulls,
                                        encode_categories, null_audit, split_label)
from riskframe.operators.scale import (PopulationStandardScaler,
                                       PopulationStandardScalerModel, standardise)
from riskframe.session import shared_path
from riskframe.sources.tables import EmptyInputError, read_csv, require_rows, write_table


def test_mapping_is_exact_and_case_sensitive(spark):
    vals = ["Yes", "No", "yes", " Yes", "", None, "1"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, Polyuria string")
    out, rep = encode_categories(df, [BinaryCode("Polyuria", YES_NO_CODE)])
    got = [r[0] for r in out.orderBy("id").select("Polyuria").collect()]
    assert got == [1, 0, None, None, None, None, None]
    assert rep.encoded == ("Polyuria",)


def test_already_encoded_input_gives_null(spark):
    df = spark.createDataFrame([(1,), (0,)], "Gender int")
    out, _ = encode_categories(df)
    assert [r[0] for r in out.collect()] == [None, None]


def test_soft_schema_skips_absent_columns(spark):
    df = spark.createDataFrame([("Male", "Yes", 40.0)], "Gender string, Obesity string, Age double")
    out, rep = encode_categories(df, REFERENCE_CODES)
    assert rep.encoded == ("Gender", "Obesity")
    assert "class" in rep.skipped and len(rep.skipped) == 14
    assert out.first()["Gender"] == 1 and out.first()["Obesity"] == 1
    assert split_label(out)[1] is None
    with pytest.raises(KeyError):
        split_label(out, required=True)


def test_missing_numeric_column_raises(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(KeyError, match="Age"):
        standardise(df, ["Age"])


def test_null_audit_counts_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    audit = {r["column_name"]: r["nulls"] for r in null_audit(df).collect()}
    assert audit == {"x": 2, "s": 1}
    assert columns_with_nulls(null_audit(df)).first()[0] == 2


def test_scaling_population_std_constant_and_null(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.0, 5.0), (4, None, 5.0)],
                               "id int, x double, c double")
    out = standardise(df, ["x", "c"]).orderBy("id").collect()
    assert [round(r["x"], 6) if r["x"] is not None else None for r in out] == \
        [-1.224745, 0.0, 1.224745, None]
    assert all(r["c"] == 0.0 for r in out)


def test_scaler_properties_on_table(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    out = standardise(li, ["l_quantity", "l_extendedprice"])
    row = out.agg(F.avg("l_quantity"), F.stddev_pop("l_quantity"),
                  F.avg("l_extendedprice"), F.stddev_pop("l_extendedprice")).first()
    assert abs(row[0]) < 1e-9 and abs(row[1] - 1) < 1e-9
    assert abs(row[2]) < 1e-9 and abs(row[3] - 1) < 1e-9


def test_scaler_model_saves_and_loads(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    m = PopulationStandardScaler(inputCols=["x"], outputCols=["z"]).fit(df)
    m.write().overwrite().save(str(tmp_path / "s"))
    m2 = PopulationStandardScalerModel.load(str(tmp_path / "s"))
    assert m2.fitted() == {"x": (2.0, 1.0)}
    assert [r["z"] for r in m2.transform(df).orderBy("x").collect()] == [-1.0, 1.0]


def test_csv_roundtrip_and_empty_input(spark):
    nation = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    path = write_table(nation, shared_path(spark, "t-nation"), "csv")
    back = read_csv(spark, path, nation.schema)
    assert sorted(back.collect()) == sorted(nation.collect())
    empty = write_table(nation.limit(0), shared_path(spark, "t-empty"), "csv")
    with pytest.raises(EmptyInputError):
        require_rows(read_csv(spark, empty, nation.schema))


def test_csv_null_tokens(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("Age,Gender\n40,Male\nNA,NA\n,Female\n")
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    sch = StructType([StructField("Age", DoubleType()), StructField("Gender", StringType())])
    rows = read_csv(spark, str(p), sch).collect()
    assert rows[1]["Age"] is None and rows[1]["Gender"] is None
    assert rows[2]["Age"] is None and rows[2]["Gender"] == "Female"
    assert not math.isnan(rows[0]["Age"])
