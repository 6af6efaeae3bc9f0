"""Shared helpers: written stages in the shared folder, ASCII text rules, stores.

A stage is a Parquet table below the shared checkpoint folder. It cuts the
lineage, survives a lost executor and fixes everything that a re-run could
otherwise change (partition ids, row numbers, sampled bounds).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.session import scratch_dir

#: The white space of every word and line rule here: x20 and x09 to x0D.
WHITE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder URI below the shared checkpoint folder."""
    return f"{scratch_dir(spark, 'llm')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    folder = fresh_folder(spark, name)
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(folder)
    # the schema is known: no inference, and partition columns keep their type
    return spark.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only.

    ``lower`` is the fast way and right unless the text holds another character
    that has a lower-case form; only such texts take the per-character way.
    """
    other = col.rlike(r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^\x00-\x7F]]")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(other, F.translate(col, upper, upper.lower())).otherwise(F.lower(col))


def strip_white(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITE))


def word_count(col: Column) -> Column:
    """Number of words of a text, as long; null counts as empty."""
    trimmed = strip_white(F.coalesce(col, F.lit("")))
    return F.when(trimmed == "", F.lit(0)).otherwise(
        F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def content_key(*cols: Column) -> tuple[Column, Column]:
    """128 bits that name a row by its content, as two longs.

    Rows that are equal in ``cols`` share the key, so a decision that depends on
    content alone joins back to each of them once.
    """
    return (F.xxhash64(*cols), F.xxhash64(F.lit(0x5EED), *cols))


def least_hashed(df: DataFrame, rows: int, *cols: str) -> DataFrame:
    """The ``rows`` rows of least hash of ``cols`` (hash in column h), for bounded samples.

    A threshold on the hash, from the row count, leaves about twice as many rows
    before they are sorted, so no task hands on more than its share.
    """
    n = df.count()
    share = min(1.0, (2 * rows + 100) / max(1, n))
    h = F.shiftrightunsigned(F.xxhash64(*cols), 1)
    return df.withColumn("h", h).where(F.col("h") <= int(share * (2**63 - 1024))).orderBy("h", *cols).limit(rows)


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` as one struct, so that no name of theirs can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def open_store(uri: str):
    """(filesystem, path) of a shared folder, for the tasks that write raw files."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:")
                                  else f"file://{uri}")


def store_uri(uri: str) -> str:
    """``file:/x`` as Spark prints it and ``/x`` both become ``file:///x``."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        return "file://" + uri[len("file:"):]
    return uri if "://" in uri else f"file://{uri}"
