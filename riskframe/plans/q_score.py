"""Scoring (K1, P10-P15), summary (G1-G5) and evaluation (E1-E10) queries on
``events`` with fixed scorers, each with its DuckDB twin.

Binding: truth = event_type in (error, purchase); the scored "model" is the
fixed logistic scorer p = 1 / (1 + exp(-(-2 + value / 60))); evaluation
compares three fixed scorers: value / 500, that logistic, 1 - value / 500.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import (CONCLUSION_NEGATIVE, CONCLUSION_POSITIVE,
                                   RISK_TIERS, UNDETERMINED)
from ..functions.expressions import logistic, r6
from ..operators import metrics as M
from ..operators.model_store import ModelStore
from ..operators.report import prediction_summary, preview, tier_histogram
from ..operators.scale import PopulationStandardScaler
from ..operators.score import LinearLogitScorer, score_frame, score_records
from ..operators.train import REGISTRY
from ..session import shared_path
from ..sources.tables import read_table
from . import sqltext as S

POSITIVE_EVENTS = ("error", "purchase")
EVENT_SLOPE = 1.0 / 60.0
EVENT_INTERCEPT = -2.0
MODEL_ORDER = ("ratio", "logit", "complement")


def _label_events(ev: DataFrame) -> DataFrame:
    return ev.select("event_id", "value",
                     F.col("event_type").isin(*POSITIVE_EVENTS).cast("int").alias("label"))


def _labelled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_events(read_table(spark, sf_dir, "events"))


def event_scorer() -> LinearLogitScorer:
    return LinearLogitScorer(featureCols=["value"], coefficients=[EVENT_SLOPE],
                             intercept=EVENT_INTERCEPT)


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_frame(event_scorer(), _labelled_events(spark, sf_dir), label_col="label",
                       feature_cols=["value"], keep_cols=["event_id"])


def k1_score_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + P10-P15: features, probability (4 dp), label, conclusion, tier,
    truth and correctness, one narrow projection."""
    return scored_events(spark, sf_dir)


def k1_score_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 over Structured Streaming: the events file as a file-stream source,
    scored by the same plan, appended exactly once to a parquet sink in the
    shared folder; the sink read back must equal the batch result."""
    from ..session import shared_path
    from ..streaming.scoring import scored_stream, start_scoring
    schema = read_table(spark, sf_dir, "events").schema
    stream = scored_stream(spark, event_scorer(), f"{sf_dir.rstrip('/')}/[e]vents.parquet", schema,
                           label_col="label", feature_cols=["value"], keep_cols=["event_id"],
                           prepare=_label_events)
    sink = shared_path(spark, "scored-events-stream")
    start_scoring(spark, stream, sink).awaitTermination()
    return spark.read.parquet(sink)


def k6_score_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + K6 + S1 + S3 as users run it: the events as a CSV file without
    label, its columns in another order, are read by header name, scored,
    written as CSV and read back."""
    from ..session import shared_path
    from ..sources.tables import read_csv, write_table
    from .stages import read_scoring_input
    ev = _labelled_events(spark, sf_dir)
    source = write_table(ev.select("value", F.lit("x").alias("more"), "event_id"), shared_path(spark, "events") + ".csv", "csv")
    new = read_scoring_input(spark, source, ev.schema, "label")
    scored = score_frame(event_scorer(), new, label_col="label", feature_cols=["value"], keep_cols=["event_id"])
    kinds = scored.schema
    return read_csv(spark, write_table(scored, shared_path(spark, "scored") + ".csv", "csv"), kinds)


# S5 with given coefficients: (scaled, coefficient, intercept, column written)
STORED = {
    "logistic": (True, 0.8, -0.3, "probability"),
    "random_forest": (False, 1.0 / 90.0, -1.2, "prediction"),  # a model without probabilities
    "boosted_deep": (False, EVENT_SLOPE, EVENT_INTERCEPT, "probability"),
    "boosted_shallow": (False, 1.0 / 80.0, -1.0, "probability"),
    "mlp": (True, -0.5, 0.1, "probability"),
}
FIRST_VERSION = ("boosted_deep", "mlp")  # the others fall back to the first of these


def _stored_models(events: DataFrame) -> dict[str, PipelineModel]:
    scaler = PopulationStandardScaler(inputCols=["value"], outputCols=["_z_value"]).fit(events)
    return {key: PipelineModel([*([scaler] if scaled else []),
                                LinearLogitScorer(featureCols=["_z_value" if scaled else "value"], coefficients=[slope],
                                                  intercept=intercept, outputCol=out)])
            for key, (scaled, slope, intercept, out) in STORED.items()}


def s5_model_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + K2-K4: two versions of the registered models saved, every key
    asked of both (an absent one falls back), and the events scored with what
    was loaded: the scaler goes with its models, and a model without
    probabilities gives its prediction."""
    ev = _labelled_events(spark, sf_dir)
    models = _stored_models(ev)
    store = ModelStore(spark, shared_path(spark, "models"))
    store.save({k: models[k] for k in FIRST_VERSION}, ["value"], "label")
    store.save(models, ["value"], "label")
    out = []
    for version in store.versions():
        for key in REGISTRY:
            used, model = store.load(key, version)
            out.append(score_frame(model, ev, label_col="label", feature_cols=["value"], keep_cols=["event_id"]).select(
                F.lit(version.number).alias("version"), F.lit(key).alias("asked"), F.lit(used).alias("used"), "*"))
    return reduce(DataFrame.unionByName, out)


def s5_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the current version of the model store says of itself."""
    ev = _labelled_events(spark, sf_dir)
    store = ModelStore(spark, shared_path(spark, "models"))
    store.save(_stored_models(ev), ["value"], "label", note=f"{ev.count()} events")
    return store.manifest().drop("version")


def k5_score_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: records as dicts, one an event type (its mean value), through the batch path."""
    means = read_table(spark, sf_dir, "events").groupBy("event_type").agg(r6(F.avg("value")).alias("value"))
    records = [r.asDict() for r in means.collect()]  # a row an event type
    return score_records(spark, event_scorer(), records, feature_cols=["value"], keep_cols=["event_type"])


def g1_g2_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prediction_summary(scored_events(spark, sf_dir)).select(
        "n", "n_positive", "n_negative", r6(F.col("positive_rate_pct")).alias("positive_rate_pct"),
        "n_correct", r6(F.col("correct_rate_pct")).alias("correct_rate_pct"))


def g3_g4_tier_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tier_histogram(scored_events(spark, sf_dir))


def g3_tier_histogram_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 on the unrounded probability (``basis="exact"``)."""
    scored = score_frame(event_scorer(), _labelled_events(spark, sf_dir), label_col="label",
                         feature_cols=["value"], keep_cols=["event_id"], keep_exact=True)
    return tier_histogram(scored, F.col("probability_exact"))


def g5_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(scored_events(spark, sf_dir), "event_id").select(
        "event_id", "probability", "pred_label", "conclusion", "correct", "risk_tier")


# --- evaluation ------------------------------------------------------------------

def event_long_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _labelled_events(spark, sf_dir)
    v = F.col("value").cast("double")
    scores = {"ratio": v / F.lit(500.0),
              "logit": logistic(F.lit(EVENT_INTERCEPT) + F.lit(EVENT_SLOPE) * v),
              "complement": F.lit(1.0) - v / F.lit(500.0)}
    return M.long_scores(ev, scores, F.col("label"))


def e1_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.confusion_matrix(event_long_scores(spark, sf_dir))


def e2_e5_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = M.classification_metrics(M.confusion_counts(event_long_scores(spark, sf_dir)))
    return m.select("model", *[r6(F.col(c)).alias(c)
                               for c in ("accuracy", "precision", "recall", "f1")])


def e6_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.auc(event_long_scores(spark, sf_dir)).select("model", r6(F.col("auc")).alias("auc"))


def e7_roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    roc = M.roc_curve(event_long_scores(spark, sf_dir))
    return roc.select("model", r6(F.col("threshold")).alias("threshold"),
                      r6(F.col("fpr")).alias("fpr"),
                      r6(F.col("tpr")).alias("tpr"))


def e8_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.comparison_table(event_long_scores(spark, sf_dir), MODEL_ORDER)


def e9_best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.best_model(M.comparison_table(event_long_scores(spark, sf_dir), MODEL_ORDER))


QUERIES = {
    "k1_score_events": k1_score_events,
    "k1_score_events_stream": k1_score_events_stream,
    "k6_score_csv": k6_score_csv,
    "s5_model_store": s5_model_store,
    "s5_manifest": s5_manifest,
    "k5_score_records": k5_score_records,
    "g1_g2_summary": g1_g2_summary,
    "g3_g4_tier_histogram": g3_g4_tier_histogram,
    "g3_tier_histogram_exact": g3_tier_histogram_exact,
    "g5_preview": g5_preview,
    "e1_confusion": e1_confusion,
    "e2_e5_metrics": e2_e5_metrics,
    "e6_auc": e6_auc,
    "e7_roc_curve": e7_roc_curve,
    "e8_comparison": e8_comparison,
    "e9_best_model": e9_best_model,
}

# --- DuckDB twins -------------------------------------------------------------------

_pos_list = ", ".join(f"'{e}'" for e in POSITIVE_EVENTS)
_p = f"1.0 / (1.0 + exp(-({EVENT_INTERCEPT} + CAST({EVENT_SLOPE!r} AS DOUBLE) * value)))"
_scored_cte = (
    f"s0 AS (SELECT event_id, value, CAST(event_type IN ({_pos_list}) AS INTEGER) AS label, "
    f"{_p} AS p FROM events), "
    "scored AS (SELECT event_id, value, round(p, 4) AS probability, "
    "CAST(p >= 0.5 AS INTEGER) AS pred_label, "
    f"CASE WHEN p >= 0.5 THEN '{CONCLUSION_POSITIVE}' WHEN p < 0.5 THEN '{CONCLUSION_NEGATIVE}' "
    "END AS conclusion, "
    f"{S.tier_case('p', RISK_TIERS, UNDETERMINED)} AS risk_tier, label AS true_label, "
    "(CAST(p >= 0.5 AS INTEGER) = label) AS correct FROM s0)")
_long_cte = (
    f"base AS (SELECT CAST(event_type IN ({_pos_list}) AS INTEGER) AS label, "
    f"value / 500.0 AS s_ratio, {_p} AS s_logit, 1.0 - value / 500.0 AS s_complement "
    "FROM events), "
    "long AS (SELECT 'ratio' AS model, label, s_ratio AS score FROM base "
    "UNION ALL SELECT 'logit', label, s_logit FROM base "
    "UNION ALL SELECT 'complement', label, s_complement FROM base), "
    "cnt AS (SELECT model, count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp, "
    "count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp, "
    "count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, "
    "count(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn FROM long GROUP BY model), "
    "met AS (SELECT model, CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy, "
    "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS precision, "
    "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS recall, "
    "coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM cnt), "
    "d AS (SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, "
    "count(*) FILTER (WHERE label = 0) AS neg FROM long GROUP BY model, score), "
    "c AS (SELECT *, coalesce(sum(pos) OVER wx, 0) AS pos_below, "
    "coalesce(sum(neg) OVER wx, 0) AS neg_below, lag(pos) OVER w AS prev_pos, "
    "lag(neg) OVER w AS prev_neg, sum(pos) OVER g AS P, sum(neg) OVER g AS N, "
    "count(*) OVER g AS K, max(score) OVER g AS top, min(score) OVER g AS bottom FROM d "
    "WINDOW w AS (PARTITION BY model ORDER BY score), "
    "wx AS (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), "
    "g AS (PARTITION BY model)), "
    "auc AS (SELECT model, sum(pos * (neg_below + neg / 2.0)) / "
    "(CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc FROM c GROUP BY model), "
    "cmp AS (SELECT met.model AS Model, " + S.r6("accuracy") + " AS Accuracy, "
    + S.r6("precision") + " AS Precision, " + S.r6("recall") + " AS Recall, "
    + S.r6("f1") + " AS F1, " + S.r6("auc") + " AS AUC, "
    "CAST(row_number() OVER (ORDER BY auc DESC NULLS LAST, "
    "CASE met.model WHEN 'ratio' THEN 0 WHEN 'logit' THEN 1 WHEN 'complement' THEN 2 END) "
    "AS INTEGER) AS rank FROM met JOIN auc ON met.model = auc.model)")



def _judged(p: str) -> str:
    """The columns that scoring adds to an exact probability."""
    return (f"round({p}, 4) AS probability, CAST({p} >= 0.5 AS INTEGER) AS pred_label, "
            f"CASE WHEN {p} >= 0.5 THEN '{CONCLUSION_POSITIVE}' WHEN {p} < 0.5 THEN '{CONCLUSION_NEGATIVE}' END AS conclusion, "
            f"{S.tier_case(p, RISK_TIERS, UNDETERMINED)} AS risk_tier")


def _store_sql() -> str:
    order = list(REGISTRY)
    parts = []
    for version, held in ((1, FIRST_VERSION), (2, order)):
        for asked in order:
            used = asked if asked in held else next(k for k in order if k in held)
            scaled, slope, intercept, _ = STORED[used]
            x = "z" if scaled else "CAST(value AS DOUBLE)"
            parts.append(f"SELECT {version} AS version, '{asked}' AS asked, '{used}' AS used, event_id, value, label, "
                         f"1.0 / (1.0 + exp(-(CAST({intercept!r} AS DOUBLE) + CAST({slope!r} AS DOUBLE) * {x}))) AS p FROM ev")
    return (f"WITH ev AS (SELECT event_id, value, CAST(event_type IN ({_pos_list}) AS INTEGER) AS label, "
            "(value - avg(value) OVER ()) / stddev_pop(value) OVER () AS z FROM events), "
            f"s AS ({' UNION ALL '.join(parts)}) SELECT version, asked, used, event_id, value, {_judged('p')}, "
            "label AS true_label, CAST(p >= 0.5 AS INTEGER) = label AS correct FROM s")


_manifest_sql = " UNION ALL ".join(
    f"SELECT '{k}' AS model, '{spec.name}' AS name, {i} AS place, {str(spec.needs_scaler).lower()} AS needs_scaler, "
    "['value'] AS features, 'label' AS label, count(*) || ' events' AS note FROM events" for i, (k, spec) in enumerate(REGISTRY.items()))

SQL = {
    "s5_model_store": _store_sql(),
    "s5_manifest": _manifest_sql,
    "k5_score_records": (
        "WITH m AS (SELECT event_type, " + S.r6("avg(value)") + " AS value FROM events GROUP BY event_type), "
        f"s AS (SELECT event_type, value, {_p} AS p FROM m) SELECT event_type, value, {_judged('p')} FROM s"),
    "k1_score_events": f"WITH {_scored_cte} SELECT * FROM scored",
    "k1_score_events_stream": f"WITH {_scored_cte} SELECT * FROM scored",
    "k6_score_csv": f"WITH {_scored_cte} SELECT * EXCLUDE (true_label, correct) FROM scored",
    "g1_g2_summary": (
        f"WITH {_scored_cte} SELECT count(*) AS n, count(*) FILTER (WHERE pred_label = 1) "
        "AS n_positive, count(*) FILTER (WHERE pred_label = 0) AS n_negative, "
        + S.r6("100.0 * count(*) FILTER (WHERE pred_label = 1) / count(*)")
        + " AS positive_rate_pct, count(*) FILTER (WHERE correct) AS n_correct, "
        + S.r6("100.0 * count(*) FILTER (WHERE correct) / count(*)")
        + " AS correct_rate_pct FROM scored"),
    "g3_g4_tier_histogram": (
        f"WITH {_scored_cte}, "
        + S.tier_histogram("scored", "probability", RISK_TIERS, UNDETERMINED)[len("WITH "):]),
    "g3_tier_histogram_exact": (
        f"WITH {_scored_cte}, "
        + S.tier_histogram("s0", "p", RISK_TIERS, UNDETERMINED)[len("WITH "):]),
    "g5_preview": (f"WITH {_scored_cte} SELECT event_id, probability, pred_label, conclusion, "
                   "correct, risk_tier FROM scored ORDER BY event_id LIMIT 10"),
    "e1_confusion": (
        f"WITH {_long_cte} "
        "SELECT model, 0 AS truth, 0 AS pred, tn AS n FROM cnt "
        "UNION ALL SELECT model, 0, 1, fp FROM cnt UNION ALL SELECT model, 1, 0, fn FROM cnt "
        "UNION ALL SELECT model, 1, 1, tp FROM cnt"),
    "e2_e5_metrics": (
        f"WITH {_long_cte} SELECT model, " + S.r6("accuracy") + " AS accuracy, "
        + S.r6("precision") + " AS precision, " + S.r6("recall") + " AS recall, "
        + S.r6("f1") + " AS f1 FROM met"),
    "e6_auc": f"WITH {_long_cte} SELECT model, " + S.r6("auc") + " AS auc FROM auc",
    "e7_roc_curve": (
        f"WITH {_long_cte} SELECT model, " + S.r6("score") + " AS threshold, "
        + S.r6("(N - neg_below) / CAST(N AS DOUBLE)") + " AS fpr, "
        + S.r6("(P - pos_below) / CAST(P AS DOUBLE)") + " AS tpr FROM c "
        "WHERE K <= 2 OR score = top OR score = bottom OR NOT (prev_pos = pos AND prev_neg = neg) "
        "UNION ALL SELECT model, " + S.r6("CAST('inf' AS DOUBLE)") + ", " + S.r6("0 / CAST(sum(neg) AS DOUBLE)")
        + ", " + S.r6("0 / CAST(sum(pos) AS DOUBLE)") + " FROM d GROUP BY model"),
    "e8_comparison": f"WITH {_long_cte} SELECT * FROM cmp",
    "e9_best_model": f"WITH {_long_cte} SELECT Model, AUC FROM cmp WHERE rank = 1",
}
