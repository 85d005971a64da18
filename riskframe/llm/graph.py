"""Tables in the shared folder, and connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir, shared_path


BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def free_name(name: str, columns: Iterable[str]) -> str:
    """``name``, with underscores added until none of ``columns`` has it (case does not count)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_batches(df: DataFrame) -> DataFrame:
    """Bound the Arrow batches of this session to ``BATCH_BYTES`` (Spark's default is 64
    MB, held by the JVM and by the worker at once); a smaller setting stays. Returns ``df``."""
    conf = df.sparkSession.conf
    now = str(conf.get(_BATCH, "64m")).lower().rstrip("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(now[-1:], 1)
    if int(now.rstrip("kmg") or 0) * unit > BATCH_BYTES:
        conf.set(_BATCH, str(BATCH_BYTES))
    return df


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here,
    and a lost executor costs no recomputation of what came before."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b): component is the
    smallest id reachable. Ids in no edge are not returned; self loops are
    allowed.

    Alternating large-star / small-star rounds (Kiveris et al. 2014): each
    round re-hangs a node's neighbours on its smallest neighbour, so a hub
    is reduced by a partial ``min`` and joined back as 16-byte rows, which
    adaptive execution splits when one hub is hot. The number of rounds
    grows with the logarithm of the longest path. No edges reach the driver.
    """
    e = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
              .filter("a <> b").distinct(), "edges")
    before = None
    while True:
        # large star: neighbours above a node go to the smallest of its neighbourhood
        n = _neighbours(e)
        low = n.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (n.filter("b > a").join(low, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        # small star: the rest, and the node itself, to the smallest at or below it
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        e = saved(large.join(low, "a")
                  .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                  .select("e.a", "e.b").filter("a <> b").distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = e.select(F.col("b").alias("id"), F.col("b").alias("component"))
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots).distinct()
