"""Category encoding and null audit.

All codes in one ``select`` (``withColumns``): one projection, codegen'd,
no per-column plan growth."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.constants import (CLASS_CODE, GENDER_CODE, LABEL_COLUMN,
                                   SYMPTOM_COLUMNS, YES_NO_CODE)
from ..functions.expressions import code_map, col, sql_string


@dataclass(frozen=True)
class BinaryCode:
    """One value->0/1 map applied to a list of columns.

    ``required=False`` gives the soft schema of P4: absent columns are
    skipped and reported."""
    columns: tuple[str, ...]
    mapping: Mapping[str, int]
    required: bool = False

    def __init__(self, columns: str | Iterable[str], mapping: Mapping[str, int],
                 required: bool = False):
        cols = (columns,) if isinstance(columns, str) else tuple(columns)
        object.__setattr__(self, "columns", cols)
        object.__setattr__(self, "mapping", dict(mapping))
        object.__setattr__(self, "required", required)


# the reference's stage-A codes: gender, label, 14 yes/no symptoms
REFERENCE_CODES = (
    BinaryCode("Gender", GENDER_CODE),
    BinaryCode(LABEL_COLUMN, CLASS_CODE),
    BinaryCode(SYMPTOM_COLUMNS, YES_NO_CODE),
)


@dataclass(frozen=True)
class EncodeReport:
    """What was encoded and what was skipped. Pure metadata, no job."""
    encoded: tuple[str, ...]
    skipped: tuple[str, ...] = field(default=())

    @property
    def n_encoded(self) -> int:
        return len(self.encoded)


def encode_categories(df: DataFrame, codes: Sequence[BinaryCode] = REFERENCE_CODES
                      ) -> tuple[DataFrame, EncodeReport]:
    """Replace each present column by its 0/1 code; unmapped -> null."""
    present = set(df.columns)
    replace: dict = {}
    skipped: list[str] = []
    for code in codes:
        for name in code.columns:
            if name in present:
                replace[name] = code_map(col(name), code.mapping)
            elif code.required:
                raise KeyError(f"column {name!r} is required but absent")
            else:
                skipped.append(name)
    out = df.withColumns(replace) if replace else df
    return out, EncodeReport(encoded=tuple(replace), skipped=tuple(skipped))


def _missing(df: DataFrame, name: str):
    c = col(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def null_audit(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """P5: long table (column_name, nulls), one aggregate pass for all
    columns (map-side partial counts, a one-row result), un-pivoted with
    ``stack``. NaN counts as missing, as in the reference."""
    names = list(columns) if columns is not None else list(df.columns)
    aggs = [F.count_if(_missing(df, n)).alias(f"_n{i}") for i, n in enumerate(names)]
    stack_args = ", ".join(f"{sql_string(n)}, _n{i}" for i, n in enumerate(names))
    return (df.agg(*aggs)
            .selectExpr(f"stack({len(names)}, {stack_args}) AS (column_name, nulls)"))


def columns_with_nulls(audit: DataFrame) -> DataFrame:
    """P5 summary: how many columns hold at least one missing value."""
    return audit.agg(F.count_if(F.col("nulls") > 0).alias("columns_with_nulls"))


def split_label(df: DataFrame, label_col: str = LABEL_COLUMN, required: bool = False
                ) -> tuple[DataFrame, str | None]:
    """Features without the label. Scoring tolerates an absent label,
    evaluation (``required=True``) does not."""
    if label_col not in df.columns:
        if required:
            raise KeyError(f"label column {label_col!r} is absent")
        return df, None
    return df.drop(label_col), label_col
