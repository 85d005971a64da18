"""The reference's stages as DataFrame transforms with explicit hand-over
tables: A preprocess -> B feature analysis -> C split + train -> D evaluate,
plus batch scoring with its input fallback and summary. Every path is given
by the caller (a shared folder on a cluster); nothing writes to the working
directory, and every error is raised.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.constants import LABEL_COLUMN, NUMERIC_COLUMNS
from ..functions.expressions import col
from ..operators import features as FT
from ..operators import metrics as M
from ..operators import profile as PR
from ..operators.encode import REFERENCE_CODES, BinaryCode, encode_categories, null_audit
from ..operators.report import prediction_summary, preview, tier_histogram
from ..operators.scale import PopulationStandardScaler
from ..operators.score import positive_probability, score_frame
from ..operators.split import stratified_split, training_rows
from ..operators.train import (DEFAULT_MODEL, REGISTRY, load_model, save_models,
                               train_models)
from ..sources.tables import (StageStore, first_existing, path_exists, read_csv,
                              require_rows, write_table)


def preprocess(spark: SparkSession, source: DataFrame | str, schema: StructType | None = None,
               codes: Sequence[BinaryCode] = REFERENCE_CODES,
               numeric: Sequence[str] = NUMERIC_COLUMNS, export_path: str | None = None,
               fit_on: str | DataFrame = "all") -> tuple[DataFrame, dict]:
    """Stage A (P9): read (S1) -> refuse empty (S2) -> encode (P1-P4) ->
    null audit (P5) -> standardise (P6) -> optional export (S3). Returns the
    cleaned table and a report.

    ``fit_on="all"`` fits the scaler on the whole table, as the reference
    does (test rows then leak into mean and std); pass the training rows
    (already encoded) to fit on them instead."""
    if isinstance(source, str):
        if schema is None:
            raise ValueError("reading a CSV needs an explicit schema")
        source = read_csv(spark, source, schema)
    df = require_rows(source, "raw table")
    enc, report = encode_categories(df, codes)
    audit = null_audit(enc)
    if isinstance(fit_on, str) and fit_on != "all":
        raise ValueError("fit_on is 'all' or a DataFrame of training rows")
    scaler = PopulationStandardScaler(inputCols=list(numeric)).fit(
        enc if isinstance(fit_on, str) else fit_on)
    cleaned = scaler.transform(enc)
    if export_path:
        write_table(cleaned, export_path, "csv")
    return cleaned, {"encode": report, "null_audit": audit, "scaler": scaler}


def feature_stage(df: DataFrame, label_col: str, features: Sequence[str], top_n: int,
                  bins: dict | None = None) -> dict[str, DataFrame]:
    """Stage B: count-table statistics, lasso and the combined ranking of the
    four scores (F5-F9), the recommendation (F11) and both feature tables."""
    table = df
    if bins:
        table = df.withColumns({c: FT.bin_expr(col(c), edges) for c, edges in bins.items()})
    label = col(label_col)
    scores = PR.contingency_scores(PR.contingency_counts(table, label, features))
    ranking = FT.combined_ranking(
        {"chi2": scores.select("feature", "chi2"),
         "mutual_info": scores.select("feature", "mutual_info"),
         "corr": PR.label_correlation(table, label, features),
         "lasso": FT.lasso_selection(table, features, label).select("feature", "lasso")}, abs_scores=("corr",))
    rec = FT.recommend(ranking, top_n)
    return {"ranking": ranking, "recommendation": rec,
            "features_full": df.select(*[col(c) for c in features], label),
            "features_recommended": FT.recommended_table(df, rec, label_col)}


def split_stage(df: DataFrame, key: str, label_col: str, store: StageStore | None = None
                ) -> DataFrame:
    """Stage C-1: exact stratified split (T1); rows with no label are left
    out. Optionally written as three stage tables."""
    s = stratified_split(df.where(col(label_col).isNotNull()), key, label_col)
    if store is not None:
        for name in ("train", "val", "test"):
            store.put(name, s.where(F.col("split") == name).drop("split"))
    return s


def train_stage(split_df: DataFrame, features: Sequence[str], label_col: str, model_root: str,
                keys: Sequence[str] | None = None, max_iter_scale: float = 1.0) -> dict[str, str]:
    """Stage C-2: fit the registered models on train + val (T2, T10) and
    save each as one PipelineModel (S5)."""
    models = train_models(training_rows(split_df), features, label_col, keys,
                          max_iter_scale=max_iter_scale)
    return save_models(models, model_root)


def evaluate_stage(spark: SparkSession, test: DataFrame, label_col: str, model_root: str
                   ) -> dict:
    """Stage D (E1-E10): every saved model scores the test table; absent
    models are skipped and named; all metrics come from one long table."""
    scored = test
    keep = list(test.columns)
    present, skipped = [], []
    for key in REGISTRY:
        path = f"{model_root.rstrip('/')}/{key}"
        if not path_exists(spark, path):
            skipped.append(key)
            continue
        _, model = load_model(spark, model_root, key)
        out = model.transform(scored)
        scored = out.select(*[col(c) for c in keep], positive_probability(out).alias(f"p_{key}"))
        keep = scored.columns
        present.append(key)
    if not present:
        raise FileNotFoundError(f"no saved model under {model_root}")
    long = M.long_scores(scored, {k: F.col(f"p_{k}") for k in present}, col(label_col))
    cmp = M.comparison_table(long, list(REGISTRY))
    return {"comparison": cmp, "best": M.best_model(cmp), "confusion": M.confusion_matrix(long),
            "roc": M.roc_curve(long), "skipped": skipped}


def read_scoring_input(spark: SparkSession, path: str, schema: StructType | None,
                       label_col: str = LABEL_COLUMN) -> DataFrame:
    """A table to score: parquet, or CSV by header name with an optional label."""
    if not path.rstrip("/").endswith(".csv"):
        return spark.read.parquet(path)
    if schema is None:
        raise ValueError("reading a CSV needs an explicit schema")
    return read_csv(spark, path, schema, optional=(label_col,))


def predict_stage(spark: SparkSession, model_root: str, inputs: Sequence[str],
                  key: str = DEFAULT_MODEL, label_col: str = LABEL_COLUMN,
                  preview_key: str | None = None, preview_rows: int | None = None,
                  explicit: str | None = None, schema: StructType | None = None,
                  output: str | None = None) -> dict:
    """Batch scoring (K1-K6, G1-G5): an explicit input, which must exist, or
    else the first existing one of ``inputs`` (test split, then recommended
    features: K6); the chosen model or its fallback (K2), scored table,
    summary, tier histogram and a key-ordered preview. A ``.csv`` input is
    read by header name into ``schema``, the label optional. With ``output``
    the scored table is written there (as CSV where the name says so) and
    ``scored`` reads what was written."""
    path = first_existing(spark, [explicit] if explicit is not None else inputs)
    df = read_scoring_input(spark, path, schema, label_col)
    used, model = load_model(spark, model_root, key)
    scored = score_frame(model, df, label_col=label_col)
    if output:
        fmt = "csv" if output.endswith(".csv") else "parquet"
        kinds = scored.schema
        write_table(scored, output, fmt)
        scored = (read_csv(spark, output, kinds, optional=()) if fmt == "csv" else spark.read.parquet(output))
    out = {"input": path, "model": used, "scored": scored,
           "summary": prediction_summary(scored), "histogram": tier_histogram(scored)}
    if preview_key:
        out["preview"] = preview(scored, preview_key, preview_rows)
    return out


def run_stages(spark: SparkSession, raw: DataFrame, root: str, key: str, label_col: str,
               codes: Sequence[BinaryCode], numeric: Sequence[str], features: Sequence[str],
               top_n: int, keys: Sequence[str] | None = None, max_iter_scale: float = 1.0,
               bins: dict | None = None) -> dict:
    """A -> B -> C -> D over explicit stage tables under ``root``."""
    store = StageStore(f"{root.rstrip('/')}/data")
    model_root = f"{root.rstrip('/')}/models"
    cleaned, report = preprocess(spark, raw, codes=codes, numeric=numeric)
    cleaned = store.put("cleaned", cleaned)
    b = feature_stage(cleaned, label_col, features, top_n, bins)
    store.put("features_full", b["features_full"])
    chosen = [r["feature"] for r in b["recommendation"].where("recommended")
              .orderBy("final_rank").collect()]
    with_key = cleaned.select(col(key), *[col(c) for c in chosen], col(label_col))
    recommended = store.put("features_recommended", with_key)
    s = split_stage(recommended, key, label_col, store)
    saved = train_stage(s, chosen, label_col, model_root, keys, max_iter_scale)
    test = store.get(spark, "test")
    d = evaluate_stage(spark, test, label_col, model_root)
    store.put("model_comparison", d["comparison"])
    return {"report": report, "features": chosen, "saved": saved, "evaluation": d,
            "store": store, "model_root": model_root}
