"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from riskframe.llm.class_lm import scores
from riskframe.llm.decontaminate import leaked_items
from riskframe.llm.html_extract import main_texts
from riskframe.llm.knn import top_products
from riskframe.llm.license_scan import scan
from riskframe.llm.mixing import taken
from riskframe.llm.multi_order_join import jaccard_components
from riskframe.llm.near_dedup import near_duplicates
from riskframe.llm.prefix_trie import conversation_trie
from riskframe.llm.quality import quality_scores
from riskframe.llm.substring_dedup import passage_rows
from riskframe.llm.threshold_clusters import threshold_clusters
from riskframe.llm.url_filter import judged


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_url_markov_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return judged(_table(spark, sf_dir, "pages"))


def op2_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, with the window that matches."""
    return leaked_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_nearest_url_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_texts(_table(spark, sf_dir, "pages"))


def op4_sparse_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents, learned from the labels of two folds of three."""
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_brown_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-based log probability of all documents, beside a unigram base."""
    return scores(_table(spark, sf_dir, "documents"))


def op7_hypergeometric_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mixture takes of every document."""
    return taken(_table(spark, sf_dir, "documents"))


def op8_tfidf_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of all documents; a document is a file of its source's and language's directory."""
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return scan(_table(spark, sf_dir, "documents"), path=path)


def op9_collinear_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of all documents, with the document that keeps each."""
    return passage_rows(_table(spark, sf_dir, "documents"))


def op10_voronoi_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest integer inner products of every 50th embedding with all others."""
    return top_products(_table(spark, sf_dir, "embeddings"))


def op11_threshold_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of all embeddings after ten rounds, assigned by the threshold algorithm."""
    return threshold_clusters(_table(spark, sf_dir, "embeddings"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations, rebuilt on the first turns of each hundred's first."""
    return conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_multi_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under four-word shingle similarity of 0.85."""
    return jaccard_components(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_url_markov_ratio": op1_url_markov_ratio,
    "op2_simhash_decontamination": op2_simhash_decontamination,
    "op3_nearest_url_extraction": op3_nearest_url_extraction,
    "op4_sparse_rule_quality": op4_sparse_rule_quality,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_brown_class_lm": op6_brown_class_lm,
    "op7_hypergeometric_mixing": op7_hypergeometric_mixing,
    "op8_tfidf_license_scan": op8_tfidf_license_scan,
    "op9_collinear_substring_dedup": op9_collinear_substring_dedup,
    "op10_voronoi_top_products": op10_voronoi_top_products,
    "op11_threshold_clusters": op11_threshold_clusters,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_multi_order_join": op13_multi_order_join,
}

_TOP_PRODUCTS = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""

# Words of a shingle and percent of similarity are put in by the two queries below.
_SHINGLE_COMPONENTS = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {words} - 1], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words} + 1, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= {percent} * (x.n + y.n - c)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT DISTINCT a AS id, a AS root FROM edges
  UNION
  SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.id
), component AS (
  SELECT id, min(root) AS root FROM reach GROUP BY id
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id{more}
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN component ON id = d.doc_id
"""



def _components_sql(words: int, percent: int, more: str = "") -> str:
    return _SHINGLE_COMPONENTS.replace("{words}", str(words)).replace("{percent}", str(percent)).replace("{more}", more)


def _clusters_sql(rounds: int = 10) -> str:
    """The rounds written out: a{i} assigns to the centroids c{i}, c{i + 1} are their means."""
    def assigned(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
  SELECT row, vec_id, v, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
  FROM (SELECT row, vec_id, kept.v, cluster, CAST(list_sum(list_transform(list_zip(kept.v, c{i}.v),
          lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance FROM kept, c{i})
  GROUP BY row, vec_id, v)"""

    def moved(i: int) -> str:
        return f"""c{i + 1} AS MATERIALIZED (
  SELECT c{i}.cluster, coalesce(m.v, c{i}.v) AS v
  FROM c{i} LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS v
    FROM (SELECT cluster, place, sum(x) AS s, count(*) AS n
          FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS place FROM a{i}) GROUP BY cluster, place)
    GROUP BY cluster) m USING (cluster))"""

    steps = ",\n".join(f"{assigned(i)},\n{moved(i)}" for i in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS cluster, v
  FROM kept QUALIFY cluster < 8
),
{steps},
{assigned(rounds)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)
"""


_TRIE = r"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))
), turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 100 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
           lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM turns), crc_table
), sequences AS (
  SELECT c, list({'role': role, 'text': text} ORDER BY part, place) AS s FROM (
    SELECT convs.c, 0 AS part, place, role, text FROM convs JOIN turns ON turns.c = base AND place <= h
    UNION ALL SELECT convs.c, 1, place, role, text FROM convs JOIN turns ON turns.c = convs.c AND place > h)
  GROUP BY c
), whole AS (
  SELECT c, coalesce(s, []) AS s FROM convs LEFT JOIN sequences USING (c)
), prefixes AS (
  SELECT c, d, s[1:d] AS p, s[1:d - 1] AS up, len(s) = d AS ends, CASE WHEN d > 0 THEN length(s[d].text) ELSE 0 END AS chars
  FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM whole)
), nodes AS (
  SELECT min(c) AS conv_id, d, p, any_value(up) AS up, count(*) AS n, any_value(chars) AS chars,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY d, p
), family AS (
  SELECT x.*, up.conv_id AS parent, coalesce(kids.n_children, 0) AS n_children
  FROM nodes x LEFT JOIN nodes up ON up.d = x.d - 1 AND up.p = x.up
  LEFT JOIN (SELECT d - 1 AS d, up AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL) kids ON kids.d = x.d AND kids.p = x.p
), below AS (
  SELECT q.d, q.p, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum(CASE WHEN x.d > 0 THEN (n - 1) * x.chars ELSE 0 END) AS saved_tokens
  FROM family x JOIN prefixes q ON q.c = x.conv_id AND q.d <= x.d GROUP BY q.d, q.p
)
SELECT conv_id, d AS depth, CASE WHEN d > 0 THEN parent END AS parent_conv_id, n AS n_convs, n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM family JOIN below USING (d, p)
"""

SQL: dict[str, str] = {
    "op5_minhash_near_dedup": _components_sql(5, 75, ", coalesce(root, d.doc_id) = d.doc_id AS kept"),
    "op10_voronoi_top_products": _TOP_PRODUCTS,
    "op11_threshold_clusters": _clusters_sql(),
    "op12_conversation_trie": _TRIE,
    "op13_multi_order_join": _components_sql(4, 85),
}
