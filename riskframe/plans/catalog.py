"""Registry of every query: Spark builder and, where SQL can say the same,
its DuckDB twin. ``__spark_entry__`` exposes these to the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import q_features, q_prep, q_score, q_train

_MODULES = (q_prep, q_score, q_features, q_train)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict = {}
    for m in _MODULES:
        out.update(m.SQL)
    return out
