"""Scoring new files as they arrive (K1 over Structured Streaming).

Scoring is row-wise, so the batch plan applies to a stream unchanged: a file
source -> the fitted ``PipelineModel`` -> the K1 projection -> a parquet file
sink. The sink and the checkpoint give exactly-once output across restarts;
the checkpoint lives under the shared ``spark.checkpoint.dir`` unless given.
No state is kept, so no watermark is needed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.constants import LABEL_COLUMN
from ..operators.score import score_frame
from ..session import shared_path


def scored_stream(spark: SparkSession, model: Transformer, source_dir: str, schema: StructType,
                  glob: str | None = None, max_files_per_trigger: int | None = None,
                  label_col: str = LABEL_COLUMN, feature_cols: Sequence[str] | None = None,
                  keep_cols: Sequence[str] = (),
                  prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The streaming DataFrame of scored rows (K1 columns). ``prepare`` is
    any row-wise projection applied to the raw stream first (encoding,
    deriving the label)."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    if prepare is not None:
        stream = prepare(stream)
    return score_frame(model, stream, label_col=label_col, feature_cols=feature_cols,
                       keep_cols=keep_cols)


def start_scoring(spark: SparkSession, scored: DataFrame, sink_path: str,
                  checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Append scored rows to a parquet sink. ``available_now`` processes
    what is there and stops (a scheduled batch); otherwise it keeps running."""
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", sink_path)
              .option("checkpointLocation", checkpoint or shared_path(spark, "scoring-checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
