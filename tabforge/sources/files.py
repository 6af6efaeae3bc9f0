"""CSV sources and sinks, checkpointed intermediates and model persistence
(SURVEY ids A1-A3, A6-A10).

Paths are caller-provided shared folders (or sub-folders of the session's
``spark.checkpoint.dir`` via ``session.scratch_dir``); nothing is written to
machine-local temp space on a cluster.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def read_csv(spark: SparkSession, path: str, schema: str | None = None,
             overrides: Mapping[str, str] | None = None, header: bool = True,
             sampling_ratio: float = 1.0) -> DataFrame:
    """A1/A2: CSV scan with a header.

    ``schema`` (DDL) avoids an inference pass; without it the schema is
    inferred (over ``sampling_ratio`` of the rows) and ``overrides`` pins the
    listed column types afterwards (``dtype={'Age': float}``). A UTF-8 BOM on
    the first header name is stripped by the reader.
    """
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema:
        df = reader.schema(schema).csv(path)
    else:
        df = (reader.option("inferSchema", True).option("samplingRatio", sampling_ratio)
              .csv(path))
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    if overrides:
        df = df.withColumns({c: F.col(c).cast(t) for c, t in overrides.items()})
    return df


def read_csv_head(spark: SparkSession, path: str, n: int, order_by: str,
                  schema: str | None = None) -> DataFrame:
    """A3: the first ``n`` rows (``nrows=n``); a top-n on an explicit order
    key, since a distributed scan has no row order of its own."""
    return read_csv(spark, path, schema=schema).orderBy(order_by).limit(n)


def write_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False) -> str:
    """CSV sink without an index column. ``single_file`` coalesces to one
    part file (only for small outputs such as a submission)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", header).csv(path)
    return path


def write_keyed_csv(df: DataFrame, path: str, key: str, value: str, name: str,
                    cast: str | None = None) -> str:
    """``key, name`` two-column CSV (value renamed, e.g. to 'Survived')."""
    v = F.col(value) if cast is None else F.col(value).cast(cast)
    return write_csv(df.select(key, v.alias(name)), path)


def write_score_lines(scores: DataFrame, path: str) -> str:
    """Free-text score lines ``name: mean (std)`` written as text."""
    line = F.format_string("%s: mean=%.5f std=%.5f", F.col("name"), F.col("mean"), F.col("std"))
    scores.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def source_fingerprint(df: DataFrame) -> str:
    """A digest of the files behind a file-based frame: names, sizes and times, one aggregate row."""
    files = df.sparkSession.read.format("binaryFile").load(df.inputFiles()).select(
        F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("h"))
    r = files.agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("h")).first()
    return f"{r['n']}-{r['h']}"


def materialize(spark: SparkSession, path: str, builder: Callable[[], DataFrame],
                valid: Callable[[DataFrame], bool] | None = None,
                expected_rows: int | None = None, fingerprint: str | None = None) -> DataFrame:
    """Reuse a Parquet copy when present and valid, else rebuild it.

    With a ``fingerprint`` of the sources (``source_fingerprint``) each state of
    the sources has a copy of its own, so changed values never meet an old one.
    Further validity is ``valid(df)`` or a row-count check (the "5 x input rows"
    staleness rule is ``expected_rows=5 * n``). The returned frame always reads
    the written copy, which also cuts lineage.
    """
    if fingerprint is not None:
        path = f"{path.rstrip('/')}/{fingerprint}"
    try:
        existing = spark.read.parquet(path)
        ok = True
        if expected_rows is not None:
            ok = existing.count() == expected_rows
        if ok and valid is not None:
            ok = bool(valid(existing))
        if ok:
            return existing
    except AnalysisException:
        pass
    builder().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stage_table(df: DataFrame, path: str) -> DataFrame:
    """Write an expensive intermediate once (Parquet, shared folder) and read it
    back: later passes scan the narrow columnar copy instead of recomputing
    its joins, and the lineage is cut, so a lost executor re-reads files
    rather than replaying the plan. Every call writes a folder of its own below
    ``path``, so runs side by side never replace each other's files."""
    run = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(run)
    return df.sparkSession.read.schema(df.schema).parquet(run)


def save_model(model, path: str, params: Mapping | None = None) -> str:
    """A10: persist a fitted ML stage; best params go alongside as one JSON row."""
    model.write().overwrite().save(path)
    if params is not None:
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(dict(params), default=str),)], "params string") \
            .write.mode("overwrite").json(path.rstrip("/") + "_params")
    return path


def load_params(spark: SparkSession, path: str) -> dict:
    row = spark.read.json(path.rstrip("/") + "_params").first()
    return json.loads(row["params"]) if row else {}
