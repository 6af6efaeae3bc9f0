"""Streaming scorer equals batch scoring."""

import os
import tempfile

from pyspark.sql import functions as F

from tabforge.functions import columns as C
from tabforge.operators import encode as J
from tabforge.streaming import scoring as S

from .conftest import SF001, rows


def test_stream_scoring_equals_batch(spark):
    batch = spark.read.parquet(f"{SF001}/events.parquet")
    src = tempfile.mkdtemp(prefix="tabforge-stream-src-")
    batch.repartition(3).write.mode("overwrite").parquet(src)       # a folder of files to stream
    scaler = J.StandardScale(["value"], suffix="_z").fit(batch)           # fitted on a batch
    stages = [scaler, lambda df: df.withColumn("flag", C.indicator(F.col("value_z") > 1))]
    out = tempfile.mkdtemp(prefix="tabforge-stream-")
    q = S.score_stream(spark, src, batch.schema, stages, name=f"ev_{os.path.basename(out)}",
                       output_path=out)
    S.run_to_completion(q)
    streamed = spark.read.parquet(out)
    expected = S.apply_stages(batch, stages)
    assert rows(streamed, "event_id", "flag") == rows(expected, "event_id", "flag")
