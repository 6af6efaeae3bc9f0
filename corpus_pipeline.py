"""The corpus pipeline: five operators of ``tabforge.llm``, one after another.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept. All but the last return the columns of their ``docs``.

Defined cases, for every stage: rows of a null or empty text stay unless a stage
says otherwise, repeated rows and equal doc_ids are handled row by row where not
said otherwise, an empty table gives an empty table, and further columns of any
name come along untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import registry
from tabforge.llm.common import content_key, packed, stage, table, word_count
from tabforge.llm.crf_quality import score, train
from tabforge.llm.line_runs import drop_common_lines
from tabforge.llm.mixing import cyclic_weights, mix
from tabforge.llm.ngram_join import jaccard_components
from tabforge.llm.piece_bpe import token_digests


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores 0.5 or higher; without labels of both kinds all stay."""
    field = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, field).where(F.col("score") >= 0.5).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more go; n_chars follows the text. A text whose lines all go is empty."""
    out = drop_common_lines(docs, min_docs=10, min_chars=1)
    text = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("row.text"))
    row = F.col("row").withField("text", text)
    if "n_chars" in docs.columns:
        length = F.char_length(text).cast(docs.schema["n_chars"].dataType)
        row = row.withField("n_chars", F.when(F.col("n_dropped") > 0, length).otherwise(F.col("row.n_chars")))
    return out.select(row.alias("row")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five words, 0.75) one row: that of least doc_id, then of least text key.

    Documents without words stay. Rows without a doc_id stay unless they are
    near copies of one that has one.
    """
    k1, k2 = content_key(F.col("doc_id"), F.coalesce("text", F.lit("")))
    # rows without a doc_id come last, so they are least only where no other is
    of = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), k1.alias("k1"), k2.alias("k2"))
    least = stage(jaccard_components(docs.select(of.alias("doc_id"), "text"), width=5, percent=75)
                  .where((F.col("n_shingles") == 0) | F.col("component_id.none") | (F.col("doc_id.k1") == F.col("component_id.k1"))
                         & (F.col("doc_id.k2") == F.col("component_id.k2")))
                  .groupBy(F.col("doc_id.k1").alias("m1"), F.col("doc_id.k2").alias("m2"))
                  .agg((F.max(~F.col("doc_id.none")) & (F.count("*") > 1) & (F.max("n_shingles") > 0)).alias("several")), "kept-rows")
    found = docs.select(packed(docs), k1.alias("k1"), k2.alias("k2")).join(
        least, (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")))
    one = found.where("several").groupBy("k1", "k2").agg(F.first("row").alias("row")).select("row.*")
    return found.where(~F.col("several")).select("row.*").unionByName(one)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them: sources weigh 3, 1, 2, repeating, and share 150% of all words.

    Rows equal in doc_id and text share their repetitions.
    """
    k1, k2 = content_key(F.col("doc_id"), F.coalesce("text", F.lit("")))
    sized = docs.select("doc_id", F.array("source").alias("sources"), word_count(F.col("text")).alias("size"),
                        k1.alias("m1"), k2.alias("m2"))
    times = stage(mix(sized, cyclic_weights, share=1.5, most=2, seed=17, keep=("m1", "m2"))
                  .groupBy("m1", "m2").agg(F.sum("copies").cast("int").alias("times"), F.count("*").alias("rows"))
                  .where("times > 0"), "mix-times")
    rows = docs.select(packed(docs), k1.alias("k1"), k2.alias("k2")).join(
        times, (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")))
    again = rows.where("rows > 1").groupBy("k1", "k2").agg(F.first("row").alias("row"), F.first("times").alias("times"))
    each = rows.where("rows = 1").select("row", "times").unionByName(again.select("row", "times"))
    return each.select("row", F.explode(F.array_repeat(F.lit(1), F.col("times")))).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    return token_digests(docs, registry.tokenizer("piece_bpe_32k.model"))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("source_mix", source_mix), ("encode", encode)]

#: Scores, tokens and seeded choices have no SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
