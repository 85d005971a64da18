"""Stage-B queries (F1-F11, S6) on lineitem, customer and embeddings.

Binding: label = (l_returnflag = 'R'); features l_linestatus (O 1, F 0),
l_discount, l_tax and a quantity bin; profile measures are lineitem's four
numeric columns and customer's c_acctbal by market segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import code_map, r6, sig
from ..operators import features as FT
from ..operators import principal as PC
from ..operators import profile as PR
from ..operators import sketches as SK
from ..sources.tables import read_table
from . import sqltext as S
from .q_prep import LINESTATUS_CODE, MEASURES

QTY_EDGES = (10.0, 25.0, 40.0)
FEATURES = ("l_linestatus", "l_discount", "l_tax", "quantity_bin")
KEYS = ("l_orderkey", "l_linenumber")
TOP_N = 2
ALPHA = 0.0005  # F8's penalty: small, as the bound features tell little of the label
PAIR = ("l_quantity", "l_discount")  # F8 in closed form, against a dear line
DEAR = 40_000.0
# S6 display texts for the bound features
DESCRIPTIONS = {
    "l_linestatus": "line still open (1) or fulfilled (0)",
    "l_discount": "discount fraction on the line",
    "l_tax": "tax fraction on the line",
    "quantity_bin": "quantity band: <10, 10-24, 25-39, 40+",
}


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        *KEYS, code_map(F.col("l_linestatus"), LINESTATUS_CODE).alias("l_linestatus"),
        "l_discount", "l_tax",
        FT.bin_expr(F.col("l_quantity"), QTY_EDGES).alias("quantity_bin"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"))


def _r6(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.select(*[r6(F.col(c), digits).alias(c) if c in names else F.col(c)
                       for c in df.columns])


def f1_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    prof = PR.numeric_profile(li, MEASURES).withColumn("mean", sig(F.col("mean")))
    return _r6(prof, "stddev", "q25", "q50", "q75")


def f1_sketch_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 from sketches of two stages of lineitem, merged; counts and moments
    are exact, estimates are held against exact counts of the data."""
    li = read_table(spark, sf_dir, "lineitem")
    stages = [SK.sketch_columns(li.where(F.col("l_linenumber") % 2 == i), MEASURES) for i in (0, 1)]
    merged = SK.merge_sketches(*stages).checkpoint()
    prof = SK.sketch_profile(merged)
    ranks = (SK.rank_errors(li, prof).groupBy("feature")
             .agg(F.max("rank_error").alias("worst")))
    exact = li.agg(*[F.count_distinct(c).alias(c) for c in MEASURES]).unpivot([], list(MEASURES), "feature", "distinct")
    return (prof.join(ranks, "feature").join(exact, "feature").select(
        "feature", "n", "nulls", "min", "max", sig(F.col("mean")).alias("mean"), r6(F.col("stddev")).alias("stddev"),
        (F.col("worst") <= 2 * SK.rank_error()).alias("ranks_within_bound"),
        (F.abs(F.col("n_distinct") - F.col("distinct")) <= 4 * SK.distinct_error() * F.col("distinct"))
        .alias("distinct_within_bound")))


def f1_sketch_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of stages merge to what one sketch of all the rows says."""
    li = read_table(spark, sf_dir, "lineitem")
    parts = [SK.sketch_columns(li.where(F.col("l_returnflag") == f), MEASURES) for f in ("A", "N", "R")]
    merged, whole = SK.sketch_profile(SK.merge_sketches(*parts)), SK.sketch_profile(SK.sketch_columns(li, MEASURES))
    m, w = merged.alias("m"), whole.alias("w")
    return m.join(w, F.col("m.feature") == F.col("w.feature")).select(
        "m.feature", "m.n", sig(F.col("m.mean")).alias("mean"),
        *[(F.col(f"m.{c}") == F.col(f"w.{c}")).alias(f"same_{c}") for c in ("n", "nulls", "min", "max", "n_distinct")],
        (F.abs(F.col("m.stddev") - F.col("w.stddev")) <= 1e-9 * F.col("w.stddev")).alias("same_stddev"))


def f1_class_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = read_table(spark, sf_dir, "customer")
    return _r6(PR.class_profile(cu, "c_mktsegment", ["c_acctbal"]), "share", "mean")


def f1_class_profile_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    prof = PR.class_profile(li, "l_returnflag", list(MEASURES))
    return _r6(prof, "share").withColumn("mean", sig(F.col("mean")))


def f2_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").withColumn(
        "is_returned", (F.col("l_returnflag") == "R").cast("int"))
    return _r6(PR.correlation_pairs(li, [*MEASURES, "is_returned"]), "r")


def f2_correlation_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 over many columns: all pairs of the embedding dimensions. The size
    is the data's; vectors of different sizes are refused."""
    emb = read_table(spark, sf_dir, "embeddings")
    low, size = emb.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if low != size:
        raise ValueError(f"vectors of {low} to {size} dimensions")
    dims = [F.col("embedding")[i].alias(f"e{i:02d}") for i in range(size or 0)]
    wide = emb.select(*dims)
    return _r6(PR.correlation_pairs(wide, wide.columns), "r")


def f3_vif_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return _r6(PR.vif(spark, li, ["l_quantity", "l_extendedprice"]), "vif")


def f3_vif(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return _r6(PR.vif(spark, li, list(MEASURES)), "vif")


def f4_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    is_r = (F.col("l_returnflag") == "R").cast("int")
    is_o = (F.col("l_linestatus") == "O").cast("int")
    spec = {
        "flags_sum": is_r + is_o,
        "returned_bulk": ((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25)).cast("int"),
        "discount_value": r6(F.col("l_discount") * F.col("l_extendedprice")),
        "quantity_bin": FT.bin_expr(F.col("l_quantity"), QTY_EDGES),
    }
    return FT.composite_features(li, spec, keep=["l_orderkey", "l_linenumber"])


def _counts(spark, sf_dir):
    ft = feature_table(spark, sf_dir)
    return PR.contingency_counts(ft, F.col("label"), FEATURES)


def f5_chi_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r6(PR.chi_square(_counts(spark, sf_dir)), "chi2")


def f6_mutual_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r6(PR.mutual_information(_counts(spark, sf_dir)), "mutual_info")


def f7_label_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    ft = feature_table(spark, sf_dir)
    return _r6(PR.label_correlation(ft, F.col("label"), FEATURES), "corr")


def ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    ft = feature_table(spark, sf_dir)
    scores = PR.contingency_scores(PR.contingency_counts(ft, F.col("label"), FEATURES))
    return FT.combined_ranking(
        {"chi2": scores.select("feature", "chi2"),
         "mutual_info": scores.select("feature", "mutual_info"),
         "corr": PR.label_correlation(ft, F.col("label"), FEATURES),
         "lasso": FT.lasso_selection(ft, FEATURES, F.col("label"), ALPHA).select("feature", "lasso")},
        abs_scores=("corr",))


def f9_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking(spark, sf_dir)


def f11_recommended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FT.recommend(ranking(spark, sf_dir), TOP_N)


def f11_full_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the full feature table, by line."""
    return feature_table(spark, sf_dir)


def f11_recommended_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the recommended feature table, un-pivoted (its columns depend on the ranking)."""
    table = FT.recommended_table(feature_table(spark, sf_dir), FT.recommend(ranking(spark, sf_dir), TOP_N),
                                 "label", KEYS)
    features = [c for c in table.columns if c not in (*KEYS, "label")]
    return table.select(*KEYS, "label", *[F.col(c).cast("double").alias(c) for c in features]).unpivot(
        [*KEYS, "label"], features, "feature", "value")


def s6_field_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FT.field_dictionary(spark, FT.recommend(ranking(spark, sf_dir), TOP_N), DESCRIPTIONS)


def f8_lasso(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return _r6(FT.lasso_selection(li, list(MEASURES), (F.col("l_returnflag") == "R").cast("int"), ALPHA), "coefficient", "lasso")


def f8_lasso_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 of two features, which has a closed form."""
    li = read_table(spark, sf_dir, "lineitem")
    return _r6(FT.lasso_selection(li, list(PAIR), (F.col("l_extendedprice") > DEAR).cast("int"), ALPHA), "coefficient", "lasso")


def f8_lasso_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 with the proof of its optimality from the rows' residuals."""
    ft = feature_table(spark, sf_dir)
    solution = FT.lasso_selection(ft, FEATURES, F.col("label"), ALPHA)
    return _r6(FT.lasso_certificate(ft, FEATURES, F.col("label"), solution, ALPHA), "coefficient", "gradient", "gap")


def f10_pca_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    return FT.pca_projection(emb, "embedding", k=2, key="vec_id")[0]


def f10_pca_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    return FT.pca_projection(emb, "embedding", k=2, key="vec_id")[1]


PCA_PAIR = ("l_quantity", "l_tax")


def _pair_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns as vectors: their components have a closed form."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(*KEYS, F.array(*[F.col(c).cast("double") for c in PCA_PAIR]).alias("v"))


def f10_pair_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pair_vectors(spark, sf_dir)
    return _r6(PC.project(pairs, "v", PC.fit_components(pairs, "v"), KEYS), "pc1", "pc2")


def f10_pair_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pair_vectors(spark, sf_dir)
    return _r6(PC.variance_table(pairs, PC.fit_components(pairs, "v")), "explained", "cumulative")


def f10_block_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10 of the embeddings without their covariance on the driver."""
    emb = read_table(spark, sf_dir, "embeddings")
    return _r6(PC.variance_table(emb, PC.fit_components(emb, "embedding", k=5)), "explained", "cumulative")


QUERIES = {
    "f1_profile": f1_profile,
    "f1_sketch_profile": f1_sketch_profile,
    "f1_sketch_merge": f1_sketch_merge,
    "f1_class_profile": f1_class_profile,
    "f1_class_profile_lineitem": f1_class_profile_lineitem,
    "f2_correlation": f2_correlation,
    "f2_correlation_wide": f2_correlation_wide,
    "f3_vif_pair": f3_vif_pair,
    "f3_vif": f3_vif,
    "f4_composite": f4_composite,
    "f5_chi_square": f5_chi_square,
    "f6_mutual_info": f6_mutual_info,
    "f7_label_correlation": f7_label_correlation,
    "f9_ranking": f9_ranking,
    "f11_recommended": f11_recommended,
    "f11_full_table": f11_full_table,
    "f11_recommended_table": f11_recommended_table,
    "s6_field_dictionary": s6_field_dictionary,
    "f8_lasso": f8_lasso,
    "f8_lasso_pair": f8_lasso_pair,
    "f8_lasso_certificate": f8_lasso_certificate,
    "f10_pca_projection": f10_pca_projection,
    "f10_pca_variance": f10_pca_variance,
    "f10_block_variance": f10_block_variance,
    "f10_pair_projection": f10_pair_projection,
    "f10_pair_variance": f10_pair_variance,
}

# --- DuckDB twins -------------------------------------------------------------------

_bin = ("CAST(CASE WHEN l_quantity IS NULL THEN NULL WHEN l_quantity < 10.0 THEN 0 "
        "WHEN l_quantity < 25.0 THEN 1 WHEN l_quantity < 40.0 THEN 2 ELSE 3 END AS INTEGER)")
_ft = (f"ft AS (SELECT {', '.join(KEYS)}, {S.case_map('l_linestatus', LINESTATUS_CODE)} AS l_linestatus, "
       f"l_discount, l_tax, {_bin} AS quantity_bin, "
       "CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem)")
_long = "long AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS value, CAST(label AS VARCHAR) AS label "
    "FROM ft" for f in FEATURES) + ")"
_margins = (
    "cnt AS (SELECT feature, value, label, count(*) AS n FROM long "
    "WHERE value IS NOT NULL AND label IS NOT NULL GROUP BY feature, value, label), "
    "rr AS (SELECT feature, value, sum(n) AS r FROM cnt GROUP BY feature, value), "
    "cc AS (SELECT feature, label, sum(n) AS c FROM cnt GROUP BY feature, label), "
    "tt AS (SELECT feature, sum(n) AS total, count(DISTINCT value) AS nv, "
    "count(DISTINCT label) AS nl FROM cnt GROUP BY feature), "
    "m AS (SELECT cnt.feature, cnt.n, r, c, total, nv, nl FROM cnt "
    "JOIN rr ON cnt.feature = rr.feature AND cnt.value = rr.value "
    "JOIN cc ON cnt.feature = cc.feature AND cnt.label = cc.label "
    "JOIN tt ON cnt.feature = tt.feature), "
    "chi AS (SELECT feature, any_value(total) * (sum(CAST(n AS DOUBLE) * n / "
    "(CAST(r AS DOUBLE) * c)) - 1.0) AS chi2, "
    "CAST((any_value(nv) - 1) * (any_value(nl) - 1) AS BIGINT) AS dof FROM m GROUP BY feature), "
    "mi AS (SELECT feature, sum((CAST(n AS DOUBLE) / total) * ln(CAST(n AS DOUBLE) * total / "
    "(CAST(r AS DOUBLE) * c))) AS mutual_info FROM m GROUP BY feature), "
    "lc AS (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, corr({f}, label) AS corr FROM ft"
                                   for f in FEATURES) + ")")
_rank = (
    S.lasso("ft", FEATURES, "label", ALPHA) + ", "
    "sc AS (SELECT chi.feature, " + S.r6("chi2") + " AS s1, " + S.r6("mutual_info")
    + " AS s2, " + S.r6("abs(corr)") + " AS s3, " + S.r6("abs(coefficient)") + " AS s4 "
    "FROM chi JOIN mi ON chi.feature = mi.feature JOIN lc ON chi.feature = lc.feature "
    f"JOIN ({S.lasso_rows(FEATURES)}) la ON chi.feature = la.feature), "
    "rk AS (SELECT feature, CAST(rank() OVER (ORDER BY s1 DESC NULLS LAST) AS INTEGER) AS chi2_rank, "
    "CAST(rank() OVER (ORDER BY s2 DESC NULLS LAST) AS INTEGER) AS mutual_info_rank, "
    "CAST(rank() OVER (ORDER BY s3 DESC NULLS LAST) AS INTEGER) AS corr_rank, "
    "CAST(rank() OVER (ORDER BY s4 DESC NULLS LAST) AS INTEGER) AS lasso_rank FROM sc), "
    "rk2 AS (SELECT *, " + S.r6("(chi2_rank + mutual_info_rank + corr_rank + lasso_rank) / 4.0")
    + " AS mean_rank FROM rk), "
    "ranking AS (SELECT *, CAST(row_number() OVER (ORDER BY mean_rank, feature) AS INTEGER) "
    "AS final_rank FROM rk2)")
_bfeat = f"WITH RECURSIVE {_ft}, {_long}, {_margins}"


def _profile_sql() -> str:
    parts = []
    for c in MEASURES:
        parts.append(
            f"SELECT '{c}' AS feature, count({c}) AS n, count(*) FILTER (WHERE {c} IS NULL) "
            f"AS nulls, min({c}) AS min, max({c}) AS max, " + S.sig(f"avg({c})") + " AS mean, "
            + S.r6(f"stddev_samp({c})") + " AS stddev, count(DISTINCT " + c + ") AS n_distinct, "
            + ", ".join(S.r6(f"quantile_cont({c}, {q})") + f" AS q{int(q * 100)}"
                        for q in (0.25, 0.5, 0.75)) + " FROM lineitem")
    return " UNION ALL ".join(parts)


def _sketch_profile_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS n, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
        f"min({c}) AS min, max({c}) AS max, " + S.sig(f"avg({c})") + " AS mean, " + S.r6(f"stddev_samp({c})")
        + " AS stddev, true AS ranks_within_bound, true AS distinct_within_bound FROM lineitem" for c in MEASURES)


def _sketch_merge_sql() -> str:
    same = ", ".join(f"true AS same_{c}" for c in ("n", "nulls", "min", "max", "n_distinct", "stddev"))
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS n, " + S.sig(f"avg({c})") + f" AS mean, {same} FROM lineitem"
                              for c in MEASURES)


def _lasso_sql(with_: str, rows: str) -> str:
    return (f"WITH RECURSIVE {with_}, la AS ({rows}) SELECT feature, " + S.r6("coefficient") + " AS coefficient, "
            + S.r6("abs(coefficient)") + " AS lasso, coefficient <> 0 AS selected FROM la")


def _certificate_sql() -> str:
    """The gradient from the correlations: c - R b."""
    rows = []
    for i, c in enumerate(FEATURES):
        others = "".join(f" - r_{min(i, j)}_{max(i, j)} * b{j}" for j in range(len(FEATURES)) if j != i)
        rows.append(f"SELECT '{c}' AS feature, b{i} AS coefficient, c{i} - b{i}{others} AS gradient "
                    "FROM lasso_b, lasso_g WHERE it = 400")
    gap = (f"CASE WHEN coefficient <> 0 THEN abs(gradient - {ALPHA} * sign(coefficient)) "
           f"ELSE greatest(abs(gradient) - {ALPHA}, 0) END")
    return (f"WITH RECURSIVE {_ft}, {S.lasso('ft', FEATURES, 'label', ALPHA)}, k AS ({' UNION ALL '.join(rows)}) "
            "SELECT feature, " + S.r6("coefficient") + " AS coefficient, " + S.r6("gradient") + " AS gradient, "
            + S.r6(gap) + " AS gap FROM k")


def _corr_sql() -> str:
    cols = [*MEASURES, "is_returned"]
    src = "(SELECT *, CAST(l_returnflag = 'R' AS INTEGER) AS is_returned FROM lineitem)"
    return " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, " + S.r6(f"corr({a}, {b})") + f" AS r FROM {src}"
        for i, a in enumerate(cols) for b in cols[i:])


_desc_values = ", ".join(f"('{k}', '{v}')" for k, v in DESCRIPTIONS.items())

# Two standardised columns have the components (1, sign r) and (1, -sign r), over the root of 2.
_pca_pair_cte = ("g AS (SELECT avg({0}) AS ma, stddev_samp({0}) AS sa, avg({1}) AS mb, stddev_samp({1}) AS sb, corr({0}, {1}) AS r "
                 "FROM lineitem)").format(*PCA_PAIR)

_full = ", ".join([*KEYS, *FEATURES, "label"])

SQL = {
    "f1_profile": _profile_sql(),
    "f10_pair_variance": (
        f"WITH {_pca_pair_cte} SELECT 1 AS component, " + S.r6("(1 + abs(r)) / 2") + " AS explained, "
        + S.r6("(1 + abs(r)) / 2") + " AS cumulative FROM g UNION ALL SELECT 2, " + S.r6("(1 - abs(r)) / 2") + ", 1.0 FROM g"),
    "f10_pair_projection": (
        f"WITH {_pca_pair_cte}, z AS (SELECT l_orderkey, l_linenumber, ({PCA_PAIR[0]} - ma) / sa AS a, "
        f"({PCA_PAIR[1]} - mb) / sb AS b, sign(r) AS s FROM lineitem, g) SELECT l_orderkey, l_linenumber, "
        + S.r6("(a + s * b) / sqrt(2)") + " AS pc1, " + S.r6("(a - s * b) / sqrt(2)") + " AS pc2 FROM z"),
    "f1_sketch_profile": _sketch_profile_sql(),
    "f1_sketch_merge": _sketch_merge_sql(),
    "f8_lasso": _lasso_sql(
        "li AS (SELECT *, CAST(l_returnflag = 'R' AS INTEGER) AS y FROM lineitem), "
        + S.lasso("li", MEASURES, "y", ALPHA), S.lasso_rows(MEASURES)),
    "f8_lasso_pair": _lasso_sql(
        f"li AS (SELECT *, CAST(l_extendedprice > {DEAR} AS INTEGER) AS y FROM lineitem), "
        + S.lasso_pair("li", *PAIR, "y", ALPHA),
        f"SELECT '{PAIR[0]}' AS feature, b0 AS coefficient FROM pair UNION ALL SELECT '{PAIR[1]}', b1 FROM pair"),
    "f8_lasso_certificate": _certificate_sql(),
    "f11_full_table": f"WITH {_ft} SELECT {_full} FROM ft",
    "f11_recommended_table": (
        f"{_bfeat}, {_rank}, long_ft AS ("
        + " UNION ALL ".join(f"SELECT {', '.join(KEYS)}, label, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM ft"
                             for f in FEATURES)
        + f") SELECT long_ft.* FROM long_ft JOIN ranking USING (feature) WHERE final_rank <= {TOP_N}"),
    "f1_class_profile": (
        "WITH per AS (SELECT c_mktsegment AS label_value, count(*) AS n, avg(c_acctbal) AS m0 "
        "FROM customer GROUP BY c_mktsegment) SELECT label_value, n, "
        + S.r6("n / sum(n) OVER ()") + " AS share, 'c_acctbal' AS feature, "
        + S.r6("m0") + " AS mean FROM per"),
    "f1_class_profile_lineitem": (
        "WITH per AS (SELECT l_returnflag AS label_value, count(*) AS n, "
        + ", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(MEASURES))
        + " FROM lineitem GROUP BY l_returnflag) "
        + " UNION ALL ".join(
            "SELECT label_value, n, " + S.r6("n / sum(n) OVER ()") + f" AS share, '{c}' AS feature, "
            + S.sig(f"m{i}") + " AS mean FROM per" for i, c in enumerate(MEASURES))),
    "f2_correlation": _corr_sql(),
    "f3_vif": S.vif("lineitem", list(MEASURES)),
    "f2_correlation_wide": (
        "WITH u AS (SELECT vec_id, unnest(embedding) AS v, "
        "generate_subscripts(embedding, 1) AS i FROM embeddings) "
        "SELECT 'e' || lpad(CAST(a.i - 1 AS VARCHAR), 2, '0') AS x, "
        "'e' || lpad(CAST(b.i - 1 AS VARCHAR), 2, '0') AS y, "
        + S.r6("corr(CAST(a.v AS DOUBLE), CAST(b.v AS DOUBLE))") + " AS r "
        "FROM u a JOIN u b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i"),
    "f3_vif_pair": (
        "WITH r AS (SELECT corr(l_quantity, l_extendedprice) AS r FROM lineitem) "
        "SELECT 'l_quantity' AS feature, " + S.r6("1.0 / (1.0 - r * r)")
        + " AS vif, false AS singular FROM r UNION ALL SELECT 'l_extendedprice', "
        + S.r6("1.0 / (1.0 - r * r)") + ", false FROM r"),
    "f4_composite": (
        "SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) + "
        "CAST(l_linestatus = 'O' AS INTEGER) AS flags_sum, "
        "CAST(l_returnflag = 'R' AND l_quantity > 25 AS INTEGER) AS returned_bulk, "
        + S.r6("l_discount * l_extendedprice") + " AS discount_value, "
        f"{_bin} AS quantity_bin FROM lineitem"),
    "f5_chi_square": f"{_bfeat} SELECT feature, " + S.r6("chi2") + " AS chi2, dof FROM chi",
    "f6_mutual_info": f"{_bfeat} SELECT feature, " + S.r6("mutual_info") + " AS mutual_info FROM mi",
    "f7_label_correlation": f"{_bfeat} SELECT feature, " + S.r6("corr") + " AS corr FROM lc",
    "f9_ranking": f"{_bfeat}, {_rank} SELECT * FROM ranking",
    "f11_recommended": f"{_bfeat}, {_rank} SELECT feature, final_rank, "
                       f"final_rank <= {TOP_N} AS recommended FROM ranking",
    "s6_field_dictionary": (
        f"{_bfeat}, {_rank}, spec(feature, description) AS (VALUES {_desc_values}) "
        f"SELECT ranking.feature, spec.description, final_rank <= {TOP_N} AS recommended "
        "FROM ranking LEFT JOIN spec ON ranking.feature = spec.feature"),
}
