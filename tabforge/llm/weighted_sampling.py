"""Document fingerprints by consistent weighted sampling (DataFrame operations only).

A document is a set of words weighted by their counts. For each of ``samples``
draws and each word there are r, c ~ Gamma(2, 1) and b ~ U(0, 1), fixed by a
hash of word and draw. With weight w: t = floor(ln w / r + b), ln y = r (t - b),
ln a = ln c - ln y - r; the draw's sample is the (word, t) with the least a. Two
documents share a sample with the probability of their generalised Jaccard
similarity, the sum of the lesser weights over the sum of the greater.

A sample is one long: ln a in fixed point above 32 bits of hash of (word, t), so
that the least a is a plain minimum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import content_key, stage, strip_white

SAMPLES = 64
#: Draws that one row computes: keeps generated methods small enough to compile.
BLOCK = 4
_BITS = 21


def _uniform(bits: Column, shift: int) -> Column:
    """A number in (0, 1) from 21 bits of a hash."""
    part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << _BITS) - 1).cast("long"))
    return part.cast("double") * F.lit(2.0 ** -_BITS) + F.lit(2.0 ** -(_BITS + 1))


def _with_draws(terms: DataFrame, samples: int) -> DataFrame:
    """One row per term and block of draws, with x, r, lc and b of each draw."""
    blocks = math.ceil(samples / BLOCK)
    rows = terms.withColumn("block", F.explode(F.array(*[F.lit(i) for i in range(blocks)])))
    rows = rows.withColumns({f"x{j}": F.xxhash64("h", F.col("block") * BLOCK + j) for j in range(BLOCK)})
    rows = rows.withColumns({f"z{j}": F.xxhash64(f"x{j}") for j in range(BLOCK)})
    out = {}
    for j in range(BLOCK):
        x, z = F.col(f"x{j}"), F.col(f"z{j}")
        out[f"r{j}"] = -F.log(_uniform(x, 0) * _uniform(x, 21))
        out[f"lc{j}"] = F.log(-F.log(_uniform(z, 0) * _uniform(z, 21)))
        out[f"b{j}"] = _uniform(x, 42)
    return rows.withColumns(out)


def _sample(j: int, log_weight: Column) -> Column:
    """The packed (a, word, t) of draw ``j`` at the given weight."""
    r, b = F.col(f"r{j}"), F.col(f"b{j}")
    t = F.floor(log_weight / r + b)
    log_a = F.col(f"lc{j}") - r * (t - b + 1.0)
    fixed = ((F.greatest(F.lit(-127.0), F.least(F.lit(127.0), log_a)) + 128.0) * F.lit(2.0 ** 23)).cast("long")
    return F.shiftleft(fixed, 32).bitwiseOR(F.xxhash64(f"x{j}", t).bitwiseAND(F.lit((1 << 32) - 1)))


def signatures(terms: DataFrame, keys: list[str], weights: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and, for each weight column, an array of ``samples`` longs.

    ``terms``: keys, h (long hash of the term), and weight columns; a term counts
    for a weight column where that is above 0, and a group without such terms
    gets a null array. Terms of a group are expected once. When ``terms`` is
    partitioned by ``keys``, nothing is shuffled.
    """
    first = weights[0]
    rows = terms.withColumns({f"l_{w}": F.log(F.col(w).cast("double")) for w in weights})
    drawn = _with_draws(rows, samples).withColumns({f"s{j}": _sample(j, F.col(f"l_{first}")) for j in range(BLOCK)})

    def own(w: str, j: int) -> Column:
        """The sample at weight ``w``; where it equals the first weight, so does the sample."""
        return F.col(f"s{j}") if w == first else F.when(F.col(w) == F.col(first), F.col(f"s{j}")).otherwise(_sample(j, F.col(f"l_{w}")))

    least = drawn.groupBy(*keys, "block").agg(*[
        F.min(F.when(F.col(w) > 0, own(w, j))).alias(f"{w}_{j}") for w in weights for j in range(BLOCK)])
    listed = least.groupBy(*keys).agg(*[
        F.sort_array(F.collect_list(F.struct("block", F.array(*[F.col(f"{w}_{j}") for j in range(BLOCK)]).alias("s")))).alias(w)
        for w in weights])
    flat = {w: F.slice(F.flatten(F.transform(w, lambda x: x["s"])), 1, samples) for w in weights}
    flat = {w: F.when(F.col(w)[0]["s"][0].isNotNull(), a) for w, a in flat.items()}
    return listed.select(*keys, *[a.alias(w) for w, a in flat.items()])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; two texts without words are alike, one with none is unlike any other."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda z, x: z + x)
    return (F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0))
            .otherwise(same / F.size(a)))


def fingerprint(a: Column) -> Column:
    """Hexadecimal text of a signature, 8 digits a sample; empty for texts without words."""
    low = F.transform(a, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit((1 << 32) - 1))), 8, "0"))
    return F.lower(F.coalesce(F.array_join(low, ""), F.lit("")))


def successors(docs: DataFrame) -> DataFrame:
    """(k1, k2, n1, n2): the content key of each document and of the next one.

    Order: doc_id, nulls first, then content key; the last is followed by the
    first. Only narrow rows are range-partitioned; the written stage fixes the
    ranges, and one row per range carries over to the one before.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = stage(docs.select("doc_id", "k1", "k2").distinct().repartitionByRange(n, "doc_id", "k1", "k2")
                    .withColumn("part", F.spark_partition_id()), "doc-order")
    # at most one row per range
    heads = sorted(ordered.groupBy("part").agg(F.min(F.struct("doc_id", "k1", "k2")).alias("h")).collect(), key=lambda r: r.part)
    after = [(r.part, heads[(i + 1) % len(heads)].h.k1, heads[(i + 1) % len(heads)].h.k2) for i, r in enumerate(heads)]
    after = spark.createDataFrame(after, "part int, h1 bigint, h2 bigint")
    order = Window.partitionBy("part").orderBy("doc_id", "k1", "k2")
    return (ordered.withColumns({"n1": F.lead("k1").over(order), "n2": F.lead("k2").over(order)})
            .join(F.broadcast(after), "part")
            .select("k1", "k2", F.coalesce("n1", "h1").alias("n1"), F.coalesce("n2", "h2").alias("n2")))


def _words(text: Column) -> Column:
    """Words of a text, as hashes come from them: an array, empty without words."""
    bare = strip_white(text)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of each document of ``docs`` (doc_id, text) and of its edited text.

    Edited: the last floor(n_chars / 4) code points replaced by the first as many
    (or all) of the next document, in ascending doc_id (nulls first; equal ids by
    content; after the last comes the first). Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next. A null text is empty.
    Texts without words have an empty fingerprint, are like each other (1) and
    unlike all others (0). Rows equal in doc_id and text are one document,
    returned once per row. A single document is its own next. An empty table
    gives no rows.
    """
    k1, k2 = content_key(F.col("doc_id"), F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns({"k1": k1, "k2": k2})
    copies = stage(rows.groupBy("doc_id", "k1", "k2").agg(F.count("*").alias("copies"), F.max(F.char_length("text")).alias("n_chars"))
                   .withColumn("n_chars", F.col("n_chars").cast("long")), "doc-keys")
    following = stage(successors(copies), "doc-next")
    need = (following.join(copies.select("k1", "k2", F.expr("n_chars div 4").alias("m")), ["k1", "k2"])
            .select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("n1").alias("k1"), F.col("n2").alias("k2"), "m"))
    once = rows.select("k1", "k2", "text").groupBy("k1", "k2").agg(F.max("text").alias("text"))
    # only the replacing part of the next text travels, keyed by the document that takes it
    tails = once.join(need, ["k1", "k2"]).select(
        F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.expr("left(text, cast(m as int))").alias("tail"))
    both = once.join(tails, ["k1", "k2"])
    kept = F.expr("left(text, cast(char_length(text) - char_length(text) div 4 as int))")
    both = both.withColumn("kept", kept).withColumn(
        # words of the common part end before its last white space
        "shared", F.regexp_extract("kept", r"(?s)^(.*[\x20\x09-\x0D])", 1))
    rest = F.char_length("shared") + 1
    def part(w: int, e: int, text: Column) -> Column:
        return F.struct(F.lit(w).alias("w"), F.lit(e).alias("e"), _words(text).alias("words"))

    parts = F.array(part(1, 1, F.col("shared")), part(1, 0, F.substr("text", rest)),
                    part(0, 1, F.concat(F.substr("kept", rest), F.col("tail"))))
    terms = (both.select("k1", "k2", F.explode(parts).alias("p"))
             .select("k1", "k2", "p.w", "p.e", F.explode_outer("p.words").alias("word"))
             # a text without words keeps a row, without weight
             .select("k1", "k2", F.xxhash64("word").alias("h"), F.when(F.col("word").isNotNull(), F.col("w")).alias("w"),
                     F.when(F.col("word").isNotNull(), F.col("e")).alias("e"))
             .groupBy("k1", "k2", "h").agg(F.coalesce(F.sum("w"), F.lit(0)).alias("w"), F.coalesce(F.sum("e"), F.lit(0)).alias("e")))
    digest = both.select("k1", "k2", F.sha2(F.concat("kept", "tail"), 256).alias("edited_sha256"))
    # both sides lie on the same two exchanges, so the texts move once
    marks = stage(signatures(terms, ["k1", "k2"], ["w", "e"], samples).join(digest, ["k1", "k2"]), "doc-marks")
    return _assemble(copies, following, marks)


def _assemble(copies: DataFrame, following: DataFrame, marks: DataFrame) -> DataFrame:
    """One row per input row, with the likeness to the edited text and to the next document."""
    ahead = marks.select(F.col("k1").alias("n1"), F.col("k2").alias("n2"), F.col("w").alias("next_w"))
    out = (copies.join(marks, ["k1", "k2"]).join(following, ["k1", "k2"]).join(ahead, ["n1", "n2"]))
    out = out.select("doc_id", "copies", "n_chars", "edited_sha256", fingerprint(F.col("w")).alias("fingerprint"),
                     fingerprint(F.col("e")).alias("edited_fingerprint"),
                     likeness(F.col("w"), F.col("e")).alias("near_edited"),
                     likeness(F.col("w"), F.col("next_w")).alias("near_next"))
    return (out.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("_i", "copies"))
