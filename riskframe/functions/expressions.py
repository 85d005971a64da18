"""Column-expression builders. Everything here is a JVM-side Catalyst
expression: no Python runs per row."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (CONCLUSION_NEGATIVE, CONCLUSION_POSITIVE,
                        DECISION_THRESHOLD, DISPLAY_DECIMALS, RISK_TIERS,
                        UNDETERMINED)


def col(name: str) -> Column:
    """Reference a column by its exact name (spaces, dots and all)."""
    return F.col("`" + name.replace("`", "``") + "`")


def sql_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def code_map(c: Column, mapping: Mapping[str, int]) -> Column:
    """Exact, case-sensitive lookup; anything unmapped (and null) -> null."""
    pairs: list[Column] = []
    for key, value in mapping.items():
        pairs += [F.lit(key), F.lit(value)]
    return F.create_map(*pairs)[c.cast("string")].cast("int")


def present(c: Column) -> Column:
    """As double, with NaN as null: both mean "missing"."""
    x = c.cast("double")
    return F.when(~F.isnan(x), x)


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def threshold_label(p: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    """1 if p >= threshold else 0; null for a missing probability (null or NaN)."""
    return (present(p) >= F.lit(threshold)).cast("int")


def conclusion(label: Column, positive: str = CONCLUSION_POSITIVE,
               negative: str = CONCLUSION_NEGATIVE) -> Column:
    return F.when(label == 1, F.lit(positive)).when(label == 0, F.lit(negative))


def tier(p: Column, tiers: Iterable[tuple[float, float, str]] = RISK_TIERS,
         otherwise: str = UNDETERMINED) -> Column:
    """Half-open tier lookup as one CASE WHEN; null and out-of-range fall
    through to ``otherwise``."""
    expr = None
    for lo, hi, name in tiers:
        cond = (p >= F.lit(lo)) & (p < F.lit(hi))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(otherwise))


def display_round(p: Column, decimals: int = DISPLAY_DECIMALS) -> Column:
    return F.round(p, decimals)


def ratio(num: Column, den: Column, default=None) -> Column:
    """num / den, null (or ``default``) when den is 0 or null."""
    out = F.try_divide(num.cast("double"), den.cast("double"))
    return out if default is None else F.coalesce(out, F.lit(default))


def r6(c: Column, digits: int = 6) -> Column:
    """Round to ``digits`` decimals for cross-engine comparison; +0.0 folds
    -0.0. Means of short decimals (prices, rates) are short decimals too and
    can sit exactly on a 6-digit tie; compare those at 9."""
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def sig(c: Column, digits: int = 10) -> Column:
    """Round to ``digits`` significant digits (for cross-engine comparison of
    means whose magnitude varies: fixed decimals either cut below the
    summation noise of large values or land on exact ties of short
    decimals). 0 and null stay as they are."""
    x = c.cast("double")
    p = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x / p, digits - 1) * p) + F.lit(0.0)


def pearson(a: Column, b: Column) -> Column:
    """Aggregate: Pearson r over rows where neither is missing, null when
    either side has zero variance or fewer than two rows. (Built-in
    ``corr`` raises DIVIDE_BY_ZERO on a constant column under ANSI mode.)
    Same central moments as ``corr``, so the values agree."""
    x, y = present(a), present(b)
    both = x.isNotNull() & y.isNotNull()
    vx = F.var_pop(F.when(both, x))
    vy = F.var_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), F.sqrt(vx * vy))
