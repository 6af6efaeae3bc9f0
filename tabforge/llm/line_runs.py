"""Line dedup on levelled sorted runs of line hashes (DataFrame operations only).

A run is a bucketed, sorted table (h1, h2, n): 128 bits of a line's key and the
number of documents that hold it. New runs enter level 0; when a level has
``fanout`` runs they are merged into one run of the next level. A key whose
merged count reaches ``min_docs`` is settled: it moves to the settled run, and
later batches merge-anti-join that run, so settled lines are never recorded
again. All runs share one bucketing, so merges and anti-joins need no shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, content_key, fresh_folder, packed, stage, strip_white

BATCHES = 4
FANOUT = 2


class LineRuns:
    """The runs of one corpus; see the module text."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.settled: list[DataFrame] = []

    def _write(self, df: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        (df.select("h1", "h2", "n").repartition(self.buckets, "h1").write
         .bucketBy(self.buckets, "h1").sortBy("h1", "h2")
         .option("path", fresh_folder(self.spark, "line-run")).saveAsTable(name))
        run = self.spark.table(name)
        # the frame keeps files and bucketing; the catalog need not keep the name
        self.spark.sql(f"DROP TABLE {name}")
        return run

    def _union(self, runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for r in runs[1:]:
            out = out.unionByName(r)
        return out

    def _merge(self, runs: list[DataFrame]) -> DataFrame:
        """One row per key. Runs join pairwise on their common bucketing."""
        out = runs[0]
        for r in runs[1:]:
            right = r.select("h1", "h2", F.col("n").alias("m"))
            out = (out.join(right, ["h1", "h2"], "full")
                   .select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n")))
        return out

    def _unsettled(self, df: DataFrame) -> DataFrame:
        for s in self.settled:
            df = df.join(s, ["h1", "h2"], "left_anti")
        return df

    def add(self, batch: DataFrame) -> None:
        """Anti-join one batch (h1, h2, n; one row per key) with the settled runs and add the rest as a run."""
        self._push(0, self._write(self._unsettled(batch)))

    def _push(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            self.compact(level)

    def compact(self, level: int) -> None:
        runs, self.levels[level] = self.levels[level], []
        # a run older than a settled run may still hold keys that settled since
        merged = self._write(self._unsettled(self._merge(runs)))
        self.settled.append(self._write(merged.where(F.col("n") >= self.min_docs)))
        self._push(level + 1, merged.where(F.col("n") < self.min_docs))

    def finish(self) -> DataFrame:
        """Keys (h1, h2) found in at least ``min_docs`` documents of all batches."""
        rest = [r for level in self.levels for r in level]
        found = [s.select("h1", "h2") for s in self.settled]
        if rest:
            last = self._unsettled(self._merge(rest)).where(F.col("n") >= self.min_docs)
            found.append(last.select("h1", "h2"))
        return self._union(found)


def _keys(lines: Column, min_chars: int) -> Column:
    """Of each line, its key's hashes; null for keys under ``min_chars``.

    Three nested transforms, since a lambda evaluates what it names each time.
    """
    def hashes(key: Column) -> Column:
        h1, h2 = content_key(key)
        return F.when(F.char_length(key) >= min_chars, F.struct(h1.alias("h1"), h2.alias("h2")))
    return F.transform(F.transform(F.transform(lines, strip_white), ascii_lower), hashes)


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                      batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Each row of ``docs`` (doc_id, text, any others) without the common lines.

    Returns row (a struct of all input columns), n_lines (before), n_dropped and
    kept (the text that is left). Lines end at \\n. A line's key is the line stripped of x20 and x09 to
    x0D at both ends, A-Z lower-cased. Keys of at least ``min_chars`` code points
    that occur in at least ``min_docs`` documents lose all their lines in every
    document. Rows that are equal in doc_id and text are one document (each row is
    still returned); other rows with equal or null doc_id are separate. A null or empty text is one empty line. A document
    whose lines all go has the empty text. An empty table gives no rows.

    128-bit hashes stand for keys (64 bits within one document); batches are
    drawn by a hash of doc_id. Per document, at most its own lines are gathered.
    """
    spark = docs.sparkSession
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    k1, k2 = content_key(F.col("doc_id"), F.coalesce("text", F.lit("")))
    held = stage(docs.select(
        F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(batches)).cast("int").alias("batch"),
        k1.alias("k1"), k2.alias("k2"), _keys(lines, min_chars).alias("keys")), "line-keys", "batch")
    held = (held.withColumn("keys", F.filter(F.array_distinct("keys"), lambda k: k.isNotNull()))
            .groupBy("batch", "k1", "k2").agg(F.first("keys").alias("keys"))
            .select("batch", "k1", "k2", F.explode("keys").alias("key"))
            .select("batch", "k1", "k2", "key.h1", "key.h2"))
    runs = LineRuns(spark, min_docs, fanout)
    for b in range(batches):
        runs.add(held.where(F.col("batch") == b).groupBy("h1", "h2").agg(F.count("*").alias("n")))
    common = runs.finish()
    marks = (held.join(common, ["h1", "h2"], "left_semi")
             .groupBy("k1", "k2").agg(F.collect_set("h1").alias("gone")))
    out = (docs.select(packed(docs), "text", k1.alias("d1"), k2.alias("d2"))
           .join(marks, (F.col("d1") == F.col("k1")) & (F.col("d2") == F.col("k2")), "left"))
    # each line beside its key; lines with short keys never drop
    marked = F.arrays_zip(lines.alias("line"), _keys(lines, min_chars).alias("key"))
    kept = F.transform(
        F.filter(marked, lambda x: x["key"].isNull() | ~F.array_contains("gone", x["key"]["h1"])),
        lambda x: x["line"])
    left = F.when(F.col("gone").isNull(), lines).otherwise(kept)
    return (out.select("row", F.size(lines).cast("long").alias("n_lines"), left.alias("left"))
            .select("row", "n_lines", (F.col("n_lines") - F.size("left")).alias("n_dropped"),
                    F.array_join("left", "\n").alias("kept")))
