"""Documents to a training mixture: quality, near duplicates, repeated
passages, benchmark leaks, source weights.

Each stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs``
with the columns of documents; the last returns the mixture, one row a draw.
Between stages the rows are written as Parquet and read again. Rows without
id pass every stage but the classifier, which judges their text; empty
tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm.decontaminate import without_leaks
from riskframe.llm.graph import saved
from riskframe.llm.mixing import mixture
from riskframe.llm.near_dedup import keep_one
from riskframe.llm.quality import high_quality
from riskframe.llm.substring_dedup import remove_repeats


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts; it learns from the table's labels."""
    return high_quality(docs, _table(spark, sf_dir, "labels"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document holds; emptied documents go."""
    return remove_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture at the sources' target weights: one row a draw, with pass, shard and order."""
    return mixture(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

#: The stages learn, cluster and align: no SQL says the same (tests/llm compares with brute force).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each on the written rows of the one before."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
