"""Sources and sinks (S1-S4): typed CSV / parquet reads, writes, stage
hand-over tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType,
                               StringType, StructField, StructType)

from ..functions.constants import LABEL_COLUMN
from ..functions.expressions import col

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


class EmptyInputError(ValueError):
    """An input table without rows."""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables; projections and filters applied
    later reach the scan (column pruning, pushed filters)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means "missing" in the reference; Spark keeps it as a value that
    passes IS NOT NULL. Normalise float columns to null once, on read."""
    floats = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (DoubleType, FloatType))]
    if not floats:
        return df
    return df.withColumns({c: F.nanvl(col(c), F.lit(None).cast("double"))
                           .cast(df.schema[c].dataType) for c in floats})


# Spellings of a missing value, besides an empty field.
MISSING_TOKENS = ("NA", "N/A", "n/a", "NaN", "nan", "null", "NULL", "None")


def read_csv(spark: SparkSession, path: str, schema: StructType, null_value: str = "",
             extra_null_tokens: Iterable[str] = MISSING_TOKENS,
             optional: Iterable[str] = (LABEL_COLUMN,)) -> DataFrame:
    """CSV read by header name into an explicit schema (never inferSchema).

    Columns may come in any order; others in the file are left out. A column
    of the schema that the file lacks is an error naming all such columns,
    unless it is ``optional`` (the label, by default): then it is left out.
    Missing-value tokens become null in every column. Text in a numeric
    column, or a row of another width, fails the read.
    """
    raw = (spark.read.option("header", True).option("nullValue", null_value)
           .option("mode", "FAILFAST").csv(path))
    optional = set(optional)
    missing = [f.name for f in schema.fields if f.name not in raw.columns and f.name not in optional]
    if missing:
        raise KeyError(f"{path} lacks the columns {missing}; it has {raw.columns}")
    tokens = list(extra_null_tokens)
    out = []
    for f in schema.fields:
        if f.name in raw.columns:
            x = F.when(~F.trim(col(f.name)).isin(tokens), col(f.name)) if tokens else col(f.name)
            if isinstance(f.dataType, (ByteType, ShortType, IntegerType, LongType)):
                # "35.0" is the whole number 35; "35.5" and "forty" are errors
                number = x.cast("decimal(38,9)")
                bad = F.raise_error(F.concat(F.lit(f"not a whole number in {f.name}: "), x))
                x = F.when(number.isNull() | (number == F.floor(number)), number).otherwise(bad.cast("decimal(38,9)"))
            out.append(x.cast(f.dataType).alias(f.name))
    return nan_to_null(raw.select(*out))


ROW, PROBLEMS = "_row", "_problems"


def _checked(f, text: Column) -> tuple[Column, Column]:
    """(value, reason): the text as the field's type, or null and why not."""
    if isinstance(f.dataType, StringType):
        return text, F.lit(None).cast("string")
    if isinstance(f.dataType, (ByteType, ShortType, IntegerType, LongType)):
        number = text.try_cast("decimal(38,9)")
        whole = number == F.floor(number)  # "35.0" is the whole number 35
        value = F.when(whole, number).try_cast(f.dataType)
        reason = (F.when(text.isNotNull() & number.isNull(), "not a number")
                  .when(~whole, "not a whole number").when(whole & value.isNull(), "out of range"))
        return value, reason
    value = text.try_cast(f.dataType)
    return value, F.when(text.isNotNull() & value.isNull(), F.lit(f"not a {f.dataType.simpleString()}"))


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, null_value: str = "",
                     extra_null_tokens: Iterable[str] = MISSING_TOKENS,
                     optional: Iterable[str] = (LABEL_COLUMN,)) -> DataFrame:
    """S1 that keeps what it cannot read: ``read_csv``'s typed columns, with
    ``_row`` (the line, if it has another number of fields than the header)
    and ``_problems`` (column, text, reason of each cell that is not of its
    column's type). One read gives both; ``accepted`` and ``quarantined``
    part them, and together they hold every row of the file."""
    header = spark.read.option("header", True).csv(path).columns
    optional, tokens = set(optional), list(extra_null_tokens)
    missing = [f.name for f in schema.fields if f.name not in header and f.name not in optional]
    if missing:
        raise KeyError(f"{path} lacks the columns {missing}; it has {header}")
    texts = StructType([StructField(c, StringType()) for c in [*header, ROW]])
    raw = (spark.read.schema(texts).option("header", True).option("nullValue", null_value)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", ROW)
           .option("columnPruning", False).csv(path))  # a line's width is judged whatever is selected of it
    values, problems = [], []
    for f in schema.fields:
        if f.name in header:
            text = F.when(~F.trim(col(f.name)).isin(tokens), col(f.name)) if tokens else col(f.name)
            value, reason = _checked(f, text)
            values.append(value.alias(f.name))
            problems.append(F.when(reason.isNotNull(), F.struct(F.lit(f.name).alias("column"), col(f.name).alias("text"), reason.alias("reason"))))
    shape = F.when(col(ROW).isNotNull(), F.struct(F.lit(None).cast("string").alias("column"), col(ROW).alias("text"),
                                                  F.lit("another number of fields than the header").alias("reason")))
    # a line of another width has no cells to trust: one problem, of the line
    found = F.when(col(ROW).isNotNull(), F.array(shape)).otherwise(F.filter(F.array(*problems), lambda p: p.isNotNull()))
    return nan_to_null(raw.select(*values, col(ROW), found.alias(PROBLEMS)))


def accepted(checked: DataFrame) -> DataFrame:
    """The rows without a problem, typed."""
    return checked.where(F.size(PROBLEMS) == 0).drop(ROW, PROBLEMS)


def quarantined(checked: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """The rejected rows: ``keys`` (columns that tell the row), and column, text, reason of each problem."""
    return (checked.where(F.size(PROBLEMS) > 0)
            .select(*[col(k) for k in keys], F.explode(PROBLEMS).alias("p")).select(*[col(k) for k in keys], "p.*"))


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Refuse an empty table. ``isEmpty`` runs a one-row job."""
    if df.isEmpty():
        raise EmptyInputError(f"{what} has no rows")
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", header: bool = True) -> str:
    """S3: write a table (overwrite). CSV gets a header and no index; the
    reference's UTF-8 BOM is not written (Spark writes part files)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", header).csv(path)
    else:
        w.format(fmt).save(path)
    return path


class StageStore:
    """Explicit, named hand-over tables between stages, one parquet
    directory each, under a root (a shared folder on a cluster)."""

    STAGES = ("cleaned", "features_full", "features_recommended", "encoded",
              "train", "val", "test", "scored", "model_comparison")

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def path(self, stage: str) -> str:
        if stage not in self.STAGES:
            raise KeyError(f"unknown stage {stage!r}; known: {self.STAGES}")
        return f"{self.root}/{stage}"

    def put(self, stage: str, df: DataFrame) -> DataFrame:
        write_table(df, self.path(stage))
        return df.sparkSession.read.parquet(self.path(stage))

    def get(self, spark: SparkSession, stage: str) -> DataFrame:
        return spark.read.parquet(self.path(stage))

    def exists(self, spark: SparkSession, stage: str) -> bool:
        return path_exists(spark, self.path(stage))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop file system (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete what a step wrote for itself, through the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def first_existing(spark: SparkSession, paths: Iterable[str]) -> str:
    """K6: first path that exists, else an error naming all of them."""
    tried = list(paths)
    for p in tried:
        if path_exists(spark, p):
            return p
    raise FileNotFoundError(f"none of these inputs exists: {tried}")
