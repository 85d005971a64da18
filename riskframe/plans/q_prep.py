"""Stage-A queries: sources, encoding, null audit, scaling, and the
minimum end-to-end slice (SURVEY 7.1), each with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.constants import RISK_TIERS, UNDETERMINED
from ..functions.expressions import r6
from ..operators.encode import (REFERENCE_CODES, BinaryCode, columns_with_nulls,
                                encode_categories, null_audit, split_label)
from ..operators.report import tier_histogram
from ..operators.scale import standardise
from ..operators.score import LinearLogitScorer, score_frame
from ..session import shared_path
from ..sources.tables import (StageStore, accepted, quarantined, read_csv, read_csv_checked,
                              read_table, require_rows, write_table)
from . import sqltext as S

RETURNFLAG_CODE = {"R": 1, "N": 0}       # A -> null (about a third of rows)
LINESTATUS_CODE = {"O": 1, "F": 0}
ORDERSTATUS_CODE = {"F": 1, "O": 0}      # P -> null
LINE_FLAGS_CODE = {"R": 1, "N": 0, "O": 1, "F": 0}
MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINEITEM_FLOATS = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}
LINEITEM_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                    "l_linestatus", "l_shipdate")
# fixed coefficients of the slice's scorer: flag, standardised quantity
SLICE_COEFS = (1.5, 0.9)
SLICE_INTERCEPT = -0.5

CHECKED_COLUMNS = ("l_orderkey", "l_linenumber", "l_quantity", "l_suppkey", "l_tax")
CHECKED_SCHEMA = StructType([StructField("l_orderkey", LongType()), StructField("l_linenumber", IntegerType()),
                             StructField("l_quantity", DoubleType()), StructField("l_suppkey", LongType()),
                             StructField("l_tax", DoubleType())])
NATION_SCHEMA = StructType([StructField("n_nationkey", IntegerType()),
                            StructField("n_name", StringType()),
                            StructField("n_regionkey", IntegerType())])


def lineitem_codes() -> list[BinaryCode]:
    return [BinaryCode("l_returnflag", RETURNFLAG_CODE), BinaryCode("l_linestatus", LINESTATUS_CODE)]


# --- S1-S4 -------------------------------------------------------------------

def s1_s3_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write nation as header CSV to the shared folder, read it back typed."""
    path = write_table(read_table(spark, sf_dir, "nation"), shared_path(spark, "nation-csv"), "csv")
    return require_rows(read_csv(spark, path, NATION_SCHEMA), "nation csv")


def s4_stage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand a table over through a named stage directory (parquet)."""
    store = StageStore(shared_path(spark, "stages"))
    return store.put("cleaned", read_table(spark, sf_dir, "region"))


def _checked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as CSV with some cells spoilt, read back with a quarantine."""
    li = read_table(spark, sf_dir, "lineitem").select(*CHECKED_COLUMNS)
    spoilt = li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 97 == 0, "forty").when(F.col("l_orderkey") % 89 == 0, "NA")
        .otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"),
        F.when(F.col("l_orderkey") % 83 == 0, "12.5").otherwise(F.col("l_suppkey").cast("string")).alias("l_suppkey"),
        F.col("l_tax").cast("string").alias("l_tax"))
    path = write_table(spoilt, shared_path(spark, "lines-csv"), "csv")
    return read_csv_checked(spark, path, CHECKED_SCHEMA)


def s1_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 with a quarantine: the rows that are of their types."""
    return accepted(_checked_lines(spark, sf_dir))


def s1_quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 with a quarantine: the cells that are not, with their rows' keys."""
    return quarantined(_checked_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"])


# --- P1-P5 -------------------------------------------------------------------

def p1_encode_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return encode_categories(li, lineitem_codes())[0]


def p2_encode_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return encode_categories(o, [BinaryCode("o_orderstatus", ORDERSTATUS_CODE)])[0]


def p3_encode_column_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One code over a list of columns, with the reference's own code list
    alongside: its columns are absent here and skipped (P4)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    codes = [BinaryCode(["l_returnflag", "l_linestatus"], LINE_FLAGS_CODE), *REFERENCE_CODES]
    out, report = encode_categories(li, codes)
    assert report.n_encoded == 2 and len(report.skipped) == 16
    return out


def p5_null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = encode_categories(read_table(spark, sf_dir, "lineitem"), lineitem_codes())[0]
    return null_audit(li, LINEITEM_COLUMNS)


def p5_columns_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = encode_categories(read_table(spark, sf_dir, "orders"),
                          [BinaryCode("o_orderstatus", ORDERSTATUS_CODE)])[0]
    return columns_with_nulls(null_audit(o))


def p8_features_without_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded orders with the label column (o_orderstatus) split off."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    enc = encode_categories(o, [BinaryCode("o_orderstatus", ORDERSTATUS_CODE)])[0]
    return split_label(enc, "o_orderstatus", required=True)[0]


# --- P6, P9 ------------------------------------------------------------------

def p6_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)
    out = standardise(li, MEASURES)
    return out.select("l_orderkey", "l_linenumber", *[r6(F.col(m)).alias(m) for m in MEASURES])


def p9_preprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage A as one plan: encode -> standardise, projected to measures."""
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", *MEASURES)
    enc = encode_categories(li, lineitem_codes())[0]
    out = standardise(enc, MEASURES)
    return out.select("l_returnflag", "l_linestatus", *[r6(F.col(m)).alias(m) for m in MEASURES])


# --- minimum slice (flagship) --------------------------------------------------

def slice_tier_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """encode l_returnflag -> standardise l_quantity -> fixed logit ->
    probability -> tier -> tier histogram (all tiers + undetermined)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    enc = encode_categories(li, [BinaryCode("l_returnflag", RETURNFLAG_CODE)])[0]
    scaled = standardise(enc, ["l_quantity"])
    scorer = LinearLogitScorer(featureCols=["l_returnflag", "l_quantity"],
                               coefficients=list(SLICE_COEFS), intercept=SLICE_INTERCEPT)
    scored = score_frame(scorer, scaled, feature_cols=[])
    return tier_histogram(scored)


QUERIES = {
    "s1_s3_csv_roundtrip": s1_s3_csv_roundtrip,
    "s1_accepted": s1_accepted,
    "s1_quarantined": s1_quarantined,
    "s4_stage_roundtrip": s4_stage_roundtrip,
    "p1_encode_flags": p1_encode_flags,
    "p2_encode_label": p2_encode_label,
    "p3_encode_column_list": p3_encode_column_list,
    "p5_null_audit": p5_null_audit,
    "p5_columns_with_nulls": p5_columns_with_nulls,
    "p8_features_without_label": p8_features_without_label,
    "p6_standardise": p6_standardise,
    "p9_preprocess": p9_preprocess,
    "slice_tier_histogram": slice_tier_histogram,
}


def _scaled_sql(cols) -> tuple[str, str]:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    exprs = ", ".join(
        S.r6(f"({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END") + f" AS {c}"
        for c in cols)
    return stats, exprs


def _null_audit_sql(source: str, columns, floats) -> str:
    parts = []
    for c in columns:
        cond = f"{c} IS NULL OR isnan({c})" if c in floats else f"{c} IS NULL"
        parts.append(f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) "
                     f"AS nulls FROM {source}")
    return " UNION ALL ".join(parts)


_rf = S.case_map("l_returnflag", RETURNFLAG_CODE)
_ls = S.case_map("l_linestatus", LINESTATUS_CODE)
_lineitem_encoded = ("(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
                     f"l_extendedprice, l_discount, l_tax, {_rf} AS l_returnflag, "
                     f"{_ls} AS l_linestatus, l_shipdate FROM lineitem)")
_orders_encoded = ("(SELECT o_orderkey, o_custkey, "
                   f"{S.case_map('o_orderstatus', ORDERSTATUS_CODE)} AS o_orderstatus, "
                   "o_totalprice, o_orderdate, o_orderpriority FROM orders)")
_stats4, _scaled4 = _scaled_sql(MEASURES)
_stats1, _ = _scaled_sql(["l_quantity"])

SQL = {
    "s1_s3_csv_roundtrip": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "s1_accepted": (
        "SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 89 <> 0 THEN l_quantity END AS l_quantity, l_suppkey, l_tax "
        "FROM lineitem WHERE l_orderkey % 97 <> 0 AND l_orderkey % 83 <> 0"),
    "s1_quarantined": (
        "SELECT l_orderkey, l_linenumber, 'l_quantity' AS \"column\", 'forty' AS text, 'not a double' AS reason "
        "FROM lineitem WHERE l_orderkey % 97 = 0 UNION ALL "
        "SELECT l_orderkey, l_linenumber, 'l_suppkey', '12.5', 'not a whole number' FROM lineitem WHERE l_orderkey % 83 = 0"),
    "s4_stage_roundtrip": "SELECT * FROM region",
    "p1_encode_flags": f"SELECT l_orderkey, l_linenumber, {_rf} AS l_returnflag, "
                       f"{_ls} AS l_linestatus FROM lineitem",
    "p2_encode_label": f"SELECT o_orderkey, {S.case_map('o_orderstatus', ORDERSTATUS_CODE)} "
                       "AS o_orderstatus FROM orders",
    "p3_encode_column_list": f"SELECT l_orderkey, l_linenumber, "
                             f"{S.case_map('l_returnflag', LINE_FLAGS_CODE)} AS l_returnflag, "
                             f"{S.case_map('l_linestatus', LINE_FLAGS_CODE)} AS l_linestatus "
                             "FROM lineitem",
    "p5_null_audit": _null_audit_sql(_lineitem_encoded, LINEITEM_COLUMNS, LINEITEM_FLOATS),
    "p5_columns_with_nulls": (
        "SELECT CAST(count(*) FILTER (WHERE nulls > 0) AS BIGINT) AS columns_with_nulls FROM ("
        + _null_audit_sql(_orders_encoded, ("o_orderkey", "o_custkey", "o_orderstatus",
                                            "o_totalprice", "o_orderdate", "o_orderpriority"),
                          {"o_totalprice"}) + ")"),
    "p8_features_without_label": "SELECT o_orderkey, o_totalprice FROM orders",
    "p6_standardise": f"WITH s AS (SELECT {_stats4} FROM lineitem) "
                      f"SELECT l_orderkey, l_linenumber, {_scaled4} FROM lineitem, s",
    "p9_preprocess": f"WITH s AS (SELECT {_stats4} FROM lineitem) "
                     f"SELECT {_rf} AS l_returnflag, {_ls} AS l_linestatus, {_scaled4} "
                     "FROM lineitem, s",
    "slice_tier_histogram": (
        f"WITH s AS (SELECT {_stats1} FROM lineitem), "
        "z AS (SELECT round(1.0 / (1.0 + exp(-("
        f"{SLICE_INTERCEPT} + {SLICE_COEFS[0]} * {_rf} + {SLICE_COEFS[1]} * "
        "((l_quantity - m_l_quantity) / CASE WHEN s_l_quantity > 0 THEN s_l_quantity ELSE 1 END)"
        "))), 4) AS p FROM lineitem, s) "
        + S.tier_histogram("z", "p", RISK_TIERS, UNDETERMINED).replace("WITH c AS", ", c AS", 1)
    ),
}
