"""Scoring a stream with fitted, row-local stages.

The reference has no streaming (SURVEY 2.13); what carries over is that every
row-local operator (column expressions, literal lookups, fitted encoders and
models) applies unchanged to a streaming DataFrame. ``score_stream`` wires a
Parquet ``readStream`` through such stages into a sink, with the stream's
checkpoint under the session's shared checkpoint folder so a restarted query
resumes exactly once. Stages that need a group or global statistic are fitted
on a batch table first (``Estimator.fit``) and only their fitted form runs on
the stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..session import scratch_dir


def apply_stages(df: DataFrame, stages: Sequence) -> DataFrame:
    """Apply fitted transformers and ``DataFrame -> DataFrame`` functions in order."""
    for st in stages:
        df = st.transform(df) if hasattr(st, "transform") else st(df)
    return df


def score_stream(spark: SparkSession, source: str, schema: StructType, stages: Sequence,
                 sink: Callable[[DataFrame, int], None] | None = None, name: str = "scores",
                 output_path: str | None = None, max_files_per_trigger: int = 1) -> StreamingQuery:
    """Start a stream from Parquet files in ``source`` through ``stages``.

    With ``sink`` each micro-batch is handed to ``sink(batch_df, batch_id)``
    (``foreachBatch``); otherwise batches are appended as Parquet to
    ``output_path`` (default: a folder under the checkpoint dir).
    """
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source))
    scored = apply_stages(stream, stages)
    ckpt = scratch_dir(spark, f"stream_ckpt_{name}")
    writer = scored.writeStream.option("checkpointLocation", ckpt).queryName(name)
    if sink is not None:
        return writer.foreachBatch(sink).start()
    out = output_path or scratch_dir(spark, f"stream_out_{name}")
    return writer.format("parquet").option("path", out).outputMode("append").start()


def run_to_completion(query: StreamingQuery) -> None:
    """Process everything available now, then stop (batch-style use and tests)."""
    query.processAllAvailable()
    query.stop()
