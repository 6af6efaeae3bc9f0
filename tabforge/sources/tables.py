"""Driver test tables (``{sf_dir}/{name}.parquet``) and the image view of
``embeddings`` (SURVEY ids A4, A5).

Callers select columns right after the scan so the Parquet reader prunes to
them (``ReadSchema`` in the plan) and filters push down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4/A5: ``(id, label, pixels array<double>)``; the 64 float32 values of an
    embedding are read as an 8x8 image (widened to double)."""
    e = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return e.select(F.col("vec_id").alias("id"), "label",
                    F.col("embedding").cast("array<double>").alias("pixels"))
