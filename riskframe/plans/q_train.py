"""Stage-C queries: split, weights and scaling on ``orders`` (exact twins),
and the five models on ``labels`` joined to ``documents`` (rows checks).

Binding: split key o_orderkey, strata o_orderstatus; models learn
``labels.quality`` from the document's length, language and simple text
measures computed over the whole text with built-in functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import SPLIT_SEED
from ..functions.expressions import r6
from ..operators import metrics as M
from ..operators.newton import fit_logistic
from ..operators.scale import PopulationStandardScaler, standardise_lazily
from ..operators.score import positive_probability, score_frame
from ..operators.split import class_weights, stratified_split, training_rows, with_weights
from ..operators.train import REGISTRY, train_models
from ..session import ensure_checkpoint_dir
from ..sources.tables import read_table
from . import sqltext as S

LANGS = ("en", "de", "es", "fr")
DOC_FEATURES = ("log_chars", "n_words", "n_lines", "mean_word_len", "unique_ratio",
                "digit_ratio", "upper_ratio", "punct_ratio", *[f"is_{lang}" for lang in LANGS])


def split_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return stratified_split(o, "o_orderkey", "o_orderstatus", SPLIT_SEED)


def t1_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", "split")


def t1_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_orders(spark, sf_dir).groupBy("o_orderstatus", "split").agg(
        F.count(F.lit(1)).alias("n"))


def t2_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_rows(split_orders(spark, sf_dir)).select("o_orderkey", "o_orderstatus")


def t3_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    cw = class_weights(training_rows(split_orders(spark, sf_dir)), "o_orderstatus")
    return cw.select(F.col("label").alias("o_orderstatus"), "n", r6(F.col("weight")).alias("weight"))


def t4_scaler_fit_on_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = split_orders(spark, sf_dir).checkpoint()  # the split is made once, for the fit and for all rows
    return standardise_lazily(s, ["o_totalprice"], training_rows(s)).select("o_orderkey", "split",
                                     r6(F.col("o_totalprice")).alias("o_totalprice"))


def split_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return stratified_split(lab, "doc_id", "quality", SPLIT_SEED)


def t1_split_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split on an imbalanced label (quality)."""
    return split_labels(spark, sf_dir)


def t3_class_weights_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    cw = class_weights(training_rows(split_labels(spark, sf_dir)), "quality")
    return cw.select(F.col("label").alias("quality"), "n", r6(F.col("weight")).alias("weight"))


# --- models ----------------------------------------------------------------------

def document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with text measures over the whole text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = labels.join(docs, "doc_id")
    text = F.coalesce(F.col("text"), F.lit(""))
    # The words are a column of their own: written out in three features they would be split three times.
    # They are words of the lower-cased text, which has the same white space, digits and punctuation: one
    # call for a text instead of one for a word. Only the first and the last piece of a split can be empty.
    j = j.withColumn("text", text).withColumn("text_lower", F.lower("text")).withColumn("words", F.split("text_lower", r"\s+"))
    length = F.greatest(F.length("text"), F.lit(1)).cast("double")
    empty = lambda i: (F.element_at("words", i) == "").cast("int")
    n_words = F.size("words") - empty(1) - F.when(F.size("words") > 1, empty(-1)).otherwise(0)
    n_distinct = F.size(F.array_distinct("words")) - F.greatest(empty(1), empty(-1))
    feats = {
        "log_chars": F.log1p(F.col("n_chars").cast("double")),
        "n_words": n_words.cast("double"),
        "n_lines": F.size(F.split("text", "\n")).cast("double"),
        "mean_word_len": length / F.greatest(n_words, F.lit(1)),
        "unique_ratio": n_distinct / F.greatest(n_words, F.lit(1)),
        "digit_ratio": F.regexp_count("text_lower", F.lit("[0-9]")) / length,
        "upper_ratio": F.regexp_count("text", F.lit("[A-Z]")) / length,
        "punct_ratio": F.regexp_count("text_lower", F.lit(r"\p{Punct}")) / length,
        **{f"is_{lang}": (F.col("lang") == lang).cast("double") for lang in LANGS},
    }
    return j.select("doc_id", "quality", *[e.alias(n) for n, e in feats.items()])


def _split_docs(spark, sf_dir):
    """The labelled feature table is small (one row per label) but costly
    (regex passes over whole texts) and read by the split, the training and
    the scoring: computed once and cut from its lineage with a reliable
    checkpoint in the shared folder, and so is its split, which reads them
    three times."""
    ensure_checkpoint_dir(spark)
    feats = document_features(spark, sf_dir).checkpoint(eager=True)
    return stratified_split(feats, "doc_id", "quality", SPLIT_SEED).checkpoint(eager=True)


def _scored(key: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = _split_docs(spark, sf_dir)
        model = train_models(training_rows(s), list(DOC_FEATURES), "quality", [key],
                             key_col="doc_id")[key]
        test = s.where(F.col("split") == "test").select("doc_id", "quality", *DOC_FEATURES)
        return score_frame(model, test, label_col="quality", feature_cols=[],
                           keep_cols=["doc_id"])
    run.__name__ = f"scored_{key}"
    return run


NEWTON_FEATURES = ("log_chars", "is_en")


def t5_newton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5's solver on two standardised features, with balanced weights: the
    coefficients, whose Newton steps plain SQL can repeat."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    rows = read_table(spark, sf_dir, "labels").select("doc_id", "quality").join(docs, "doc_id").select(
        F.col("quality").cast("double").alias("y"), F.log1p(F.col("n_chars").cast("double")).alias("log_chars"),
        (F.col("lang") == "en").cast("double").alias("is_en")).dropna()
    scaled = PopulationStandardScaler(inputCols=list(NEWTON_FEATURES)).fit(rows).transform(rows)
    weighted = with_weights(scaled, "y", "w")[0]
    fit = fit_logistic(weighted, NEWTON_FEATURES, "y", "w", penalty=1.0)
    return spark.createDataFrame(
        [("intercept", round(fit.intercept, 6))] + [(c, round(float(b), 6)) for c, b in zip(NEWTON_FEATURES, fit.coefficients)],
        "term string, coefficient double").withColumn("converged", F.lit(fit.converged))


def t10_evaluate_trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10 + E10: train every registered model on one cached training set,
    score the test split with each, evaluate all in one pass."""
    s = _split_docs(spark, sf_dir)
    models = train_models(training_rows(s), list(DOC_FEATURES), "quality", key_col="doc_id")
    scored = s.where(F.col("split") == "test").select("doc_id", "quality", *DOC_FEATURES)
    keep = scored.columns
    for key, m in models.items():
        out = m.transform(scored)
        scored = out.select(*keep, positive_probability(out).alias(f"p_{key}"))
        keep = scored.columns
    scored = scored.select("quality", *[f"p_{key}" for key in models]).checkpoint()  # the figures below read it several times
    long = M.long_scores(scored, {k: F.col(f"p_{k}") for k in models}, F.col("quality"))
    return M.comparison_table(long, list(REGISTRY))


QUERIES = {
    "t1_split": t1_split,
    "t1_split_counts": t1_split_counts,
    "t2_training_rows": t2_training_rows,
    "t3_class_weights": t3_class_weights,
    "t4_scaler_fit_on_train": t4_scaler_fit_on_train,
    "t1_split_labels": t1_split_labels,
    "t3_class_weights_labels": t3_class_weights_labels,
    "t5_newton": t5_newton,
    "t5_logistic": _scored("logistic"),
    "t6_random_forest": _scored("random_forest"),
    "t7_boosted_deep": _scored("boosted_deep"),
    "t8_boosted_shallow": _scored("boosted_shallow"),
    "t9_mlp": _scored("mlp"),
    "t10_evaluate_trained": t10_evaluate_trained,
}

_split_sql = (
    "WITH h AS (SELECT o_orderkey, o_orderstatus, o_totalprice, "
    f"md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '{SPLIT_SEED}')) AS h FROM orders), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY h, o_orderkey) AS r, "
    "count(*) OVER (PARTITION BY o_orderstatus) AS n FROM h), "
    "s AS (SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN r <= (n * 70) // 100 "
    "THEN 'train' WHEN r <= (n * 85) // 100 THEN 'val' ELSE 'test' END AS split FROM r)")

_split_labels_sql = (
    "WITH h AS (SELECT doc_id, quality, "
    f"md5(concat_ws('|', CAST(doc_id AS VARCHAR), '{SPLIT_SEED}')) AS h FROM labels), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY h, doc_id) AS r, "
    "count(*) OVER (PARTITION BY quality) AS n FROM h), "
    "s AS (SELECT doc_id, quality, CASE WHEN r <= (n * 70) // 100 THEN 'train' "
    "WHEN r <= (n * 85) // 100 THEN 'val' ELSE 'test' END AS split FROM r)")

_newton_sql = (
    "WITH d AS (SELECT CAST(quality AS DOUBLE) AS y, ln(1 + CAST(n_chars AS DOUBLE)) AS a, "
    "CAST(lang = 'en' AS DOUBLE) AS b FROM labels JOIN documents USING (doc_id) "
    "WHERE quality IS NOT NULL AND n_chars IS NOT NULL AND lang IS NOT NULL), "
    "rows_ AS (SELECT y, (a - avg(a) OVER ()) / stddev_pop(a) OVER () AS x1, "
    "(b - avg(b) OVER ()) / stddev_pop(b) OVER () AS x2, "
    "count(*) OVER () / ((SELECT count(DISTINCT y) FROM d) * count(*) OVER (PARTITION BY y)) AS w FROM d), "
    + S.newton("rows_") + " SELECT term, " + S.r6("coefficient") + " AS coefficient, true AS converged FROM ("
    "SELECT 'intercept' AS term, b0 AS coefficient FROM newton UNION ALL "
    f"SELECT '{NEWTON_FEATURES[0]}', b1 FROM newton UNION ALL SELECT '{NEWTON_FEATURES[1]}', b2 FROM newton)")

SQL = {
    "t5_newton": _newton_sql,
    "t1_split_labels": f"{_split_labels_sql} SELECT doc_id, quality, split FROM s",
    "t3_class_weights_labels": (
        f"{_split_labels_sql}, c AS (SELECT quality, count(*) AS n FROM s WHERE split <> 'test' "
        "GROUP BY quality) SELECT quality, n, "
        "(round(CAST(sum(n) OVER () / (count(*) OVER () * n) AS DOUBLE), 6) + 0.0) AS weight "
        "FROM c"),
    "t1_split": f"{_split_sql} SELECT o_orderkey, o_orderstatus, split FROM s",
    "t1_split_counts": f"{_split_sql} SELECT o_orderstatus, split, count(*) AS n FROM s "
                       "GROUP BY o_orderstatus, split",
    "t2_training_rows": f"{_split_sql} SELECT o_orderkey, o_orderstatus FROM s "
                        "WHERE split <> 'test'",
    "t3_class_weights": (
        f"{_split_sql}, c AS (SELECT o_orderstatus, count(*) AS n FROM s WHERE split <> 'test' "
        "GROUP BY o_orderstatus) SELECT o_orderstatus, n, "
        "(round(CAST(sum(n) OVER () / (count(*) OVER () * n) AS DOUBLE), 6) + 0.0) AS weight "
        "FROM c"),
    "t4_scaler_fit_on_train": (
        f"{_split_sql}, st AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd "
        "FROM s WHERE split <> 'test') SELECT o_orderkey, split, "
        "(round(CAST((o_totalprice - m) / CASE WHEN sd > 0 THEN sd ELSE 1 END AS DOUBLE), 6) "
        "+ 0.0) AS o_totalprice FROM s, st"),
}
