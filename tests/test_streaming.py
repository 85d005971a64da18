"""K1 over Structured Streaming: restarts from the checkpoint neither lose
nor repeat rows, and the sink equals batch scoring of the same input."""

from pyspark.sql import functions as F

from riskframe.plans.q_score import _label_events, event_scorer, scored_events
from riskframe.streaming.scoring import scored_stream, start_scoring

SF = "/root/testdata/sf0.001"


def test_stream_restarts_exactly_once_and_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    cut = events.approxQuantile("event_id", [0.5], 0.0)[0]
    src, sink, ckpt = (str(tmp_path / d) for d in ("src", "sink", "ckpt"))
    events.where(F.col("event_id") <= cut).write.parquet(f"{src}/part=1")
    schema = events.schema

    def run():
        stream = scored_stream(spark, event_scorer(), src, schema, label_col="label",
                               feature_cols=["value"], keep_cols=["event_id"],
                               prepare=lambda df: _label_events(df.select(*schema.names)))
        start_scoring(spark, stream, sink, checkpoint=ckpt).awaitTermination()
        return spark.read.parquet(sink)

    first = run().count()
    assert first == events.where(F.col("event_id") <= cut).count()
    assert run().count() == first  # restart without new files: nothing repeated
    events.where(F.col("event_id") > cut).write.parquet(f"{src}/part=2")
    out = run()
    batch = scored_events(spark, SF)
    assert out.count() == batch.count() == events.count()
    cols = batch.columns
    assert out.select(*cols).exceptAll(batch).count() == 0
    assert batch.exceptAll(out.select(*cols)).count() == 0
