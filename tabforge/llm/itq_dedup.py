"""Embedding near-dedup: iterative quantisation, multi-index Hamming tables, rerank.

1. Equal vectors collapse to one representative with a multiplicity.
2. A rotation learnt on a bounded sample (principal axes, then alternating
   signs and orthogonal Procrustes) turns each vector into a balanced binary
   code. Every representative is encoded, in Arrow batches.
3. A code splits into chunks, a chunk into parts. Two codes at distance 2 or
   less in a chunk agree in all of its parts but two, so each code is filed
   under every choice of such parts. More codes make more and shorter parts, so
   buckets stay about as large; a bucket of many codes is dealt over cells, each
   with one pair of its blocks.
4. In a cell, dot products of vectors rounded to bytes rule out pairs by a bound
   that holds for the whole vectors. A pair within the Hamming radius that is
   not ruled out is emitted once: by the first table that holds both.
5. Those pairs are compared by cosine in double precision.

With 64 bits and 4 chunks of 16, all pairs up to Hamming distance 11 meet, and
most of those above up to the radius; a cosine of 0.9 is 9.2 bits on average.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import least_hashed, stage
from .components import components

#: Vectors from which the rotation is learnt.
SAMPLE = 20_000
CHUNKS = 4
CHUNK_BITS = 16
ROUNDS = 50
#: Pairs farther apart than this are not reranked (cosine 0.9: 9.2 bits on average, 2.8 deviation).
RADIUS = 22
#: Codes that a bucket holds on average, about; above it the parts get shorter, to so many a chunk.
BUCKET = 4096
MOST_PARTS = 6
#: Codes of a bucket above which it is dealt over several cells, in blocks of so many.
BLOCK = 8192
#: Codes that a task compares at once with those of a block.
TILE = 128
#: Recall at the threshold below which codes are taken about the origin instead of the mean.
LEAST_RECALL = 0.9


def sign_codes(x: np.ndarray, mean: np.ndarray, proj: np.ndarray) -> np.ndarray:
    """Sign bits of the projections as one unsigned 64-bit integer each."""
    bits = ((x - mean) @ proj >= 0).astype(np.uint64)
    return (bits << np.arange(bits.shape[1], dtype=np.uint64)).sum(1, dtype=np.uint64)


def recall_at(sample: np.ndarray, mean: np.ndarray, proj: np.ndarray, threshold: float, chunks: int, width: int,
              radius: int, seed: int = 11) -> float:
    """Share of neighbours drawn at the very threshold that the tables would propose."""
    rng = np.random.default_rng(seed)
    base = sample[rng.integers(0, len(sample), 2000)]
    side = rng.standard_normal(base.shape)
    side -= (side * base).sum(1, keepdims=True) * base
    length = np.linalg.norm(side, axis=1, keepdims=True)
    near = threshold * base + np.sqrt(1 - threshold**2) * side / np.where(length > 0, length, 1)
    apart = sign_codes(base, mean, proj) ^ sign_codes(near, mean, proj)
    parts = np.array([np.bitwise_count((apart >> np.uint64(t * width)) & np.uint64((1 << width) - 1)) for t in range(chunks)])
    return float(((parts.min(0) <= 2) & (parts.sum(0, dtype=np.int64) <= radius)).mean())


def learn_rotation(sample: np.ndarray, bits: int, centre: bool, rounds: int = ROUNDS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection of shape dim x bits) by iterative quantisation.

    More bits than dimensions take the principal axes several times, each with a
    rotation of its own.
    """
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    mean = sample.mean(0) if centre else np.zeros(dim)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1]
    out = []
    for at in range(0, bits, dim):
        use = axes[:, :min(dim, bits - at)]
        low = centred @ use
        turn, _ = np.linalg.qr(rng.standard_normal((use.shape[1], use.shape[1])))
        for _ in range(rounds):
            signs = np.where(low @ turn >= 0, 1.0, -1.0)
            u, _, vt = np.linalg.svd(signs.T @ low)
            turn = (u @ vt).T
        out.append(use @ turn)
    return mean, np.concatenate(out, 1)


def tables(chunks: int, width: int, parts: int) -> list[tuple[int, int]]:
    """(bits of the chunk, bits that must agree) of every table: each choice of all parts of a chunk but two."""
    cuts = [sum(1 << int(i) for i in part) for part in np.array_split(np.arange(width), min(parts, width))]
    return [(((1 << width) - 1) << t * width, sum(chosen) << t * width)
            for t in range(chunks) for chosen in combinations(cuts, max(0, len(cuts) - 2))]


def parts_for(codes: int, width: int) -> int:
    """The fewest parts of a chunk, 3 at least, that leave about BUCKET codes or fewer in a bucket."""
    return next((p for p in range(3, MOST_PARTS) if codes <= BUCKET * 2 ** (width * (p - 2) / p)), MOST_PARTS)


def rounded(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scale, bytes, rest): a unit vector is scale times its bytes plus a vector of length ``rest``."""
    scale = np.abs(units).max(1) / 127
    small = np.rint(units / scale[:, None]).astype(np.int8)
    return scale, small, np.linalg.norm(units - scale[:, None] * small, axis=1)


def _codes(vectors: DataFrame, mean: np.ndarray, proj: np.ndarray) -> DataFrame:
    """rep, code (one long of sign bits, 64 or fewer) and the rounded vector: scale, small, rest."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                units = batch.column("unit").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                scale, small, rest = rounded(units)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep"), pa.array(sign_codes(units, mean, proj).view(np.int64)), pa.array(scale),
                     pa.array([x.tobytes() for x in small], pa.binary()), pa.array(rest)], ["rep", "code", "scale", "small", "rest"])
    return vectors.select("rep", "unit").mapInArrow(run, "rep long, code long, scale double, small binary, rest double")


def alike(codes: np.ndarray, vectors: np.ndarray, rest: np.ndarray, first: np.ndarray, second: np.ndarray, at: int,
          of: list[tuple[int, int]], threshold: float, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (x in ``first``, y in ``second``) of the pairs that table ``at`` emits; if both are the same, x before y.

    A dot product of rounded vectors is off by the two rests and by float32 at
    most; no pair whose cosine may reach the threshold is left out.
    """
    least, once = threshold - (vectors.shape[1] + 8) * 2.0**-23, first is second
    any_pair = np.float32(least - 3 * rest.max(initial=0))
    for i in range(0, len(first), TILE):
        one, two = first[i:i + TILE], second[i:] if once else second
        dots = vectors[one] @ vectors[two].T
        x, y = np.nonzero(dots >= any_pair)
        ok = dots[x, y] + (rest[one[x]] + (1 + rest[one[x]]) * rest[two[y]]) >= least
        if once:
            ok &= x < y
        x, y = one[x[ok]], two[y[ok]]
        apart = codes[x] ^ codes[y]
        ok = np.bitwise_count(apart) <= radius
        for k, (chunk, same) in enumerate(of[:at + 1]):
            meet = (np.bitwise_count(apart & np.uint64(chunk)) <= 2) & (apart & np.uint64(same) == 0)
            ok &= meet if k == at else ~meet
        yield x[ok], y[ok]


def near_vectors(vectors: DataFrame, threshold: float = 0.9, sample: int = SAMPLE, chunks: int = CHUNKS,
                 chunk_bits: int = CHUNK_BITS, radius: int = RADIUS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding).

    Rows link when their cosine (in double precision) is at least ``threshold``;
    n_links counts other rows, component_id is the least vec_id reachable by
    links, kept is vec_id = component_id. Vectors that are null, empty, zero, or
    hold a null or a non-finite component link with nothing and are components
    of their own. Vectors of unlike length never link. Rows are vectors: a
    repeated row links with its copies. A null vec_id counts as a linked row and
    is least only where no other is; its component is then null. An empty table
    gives no rows.
    """
    width = chunk_bits
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    fine = (F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("v", lambda x: x != 0))
    # scale by the largest component first: squares of huge or tiny values stay finite
    top = F.array_max(F.transform("v", F.abs))
    scaled = F.transform("v", lambda x: x / top)
    norm = F.sqrt(F.aggregate("s", F.lit(0.0), lambda z, x: z + x * x))
    good = rows.where(F.coalesce(fine, F.lit(False)))
    groups = stage(good.groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
                   .withColumn("rep", F.monotonically_increasing_id()).withColumn("s", scaled)
                   .withColumn("n", norm).withColumn("unit", F.transform("s", lambda x: x / F.col("n")))
                   .select("v", "least", "copies", "rep", "unit"), "vec-groups")
    links = []
    for (dim,) in groups.select(F.size("unit")).distinct().collect():
        mine = groups.where(F.size("unit") == dim)
        drawn = least_hashed(mine.select("rep", "unit"), sample, "rep").select("unit").toArrow()
        units = drawn["unit"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        reach = radius
        mean, proj = learn_rotation(units, chunks * width, centre=True)
        if recall_at(units, mean, proj, threshold, chunks, width, radius) < LEAST_RECALL:
            # far from the origin the signs about the mean no longer follow the angle
            mean, proj = learn_rotation(units, chunks * width, centre=False)
            if recall_at(units, mean, proj, threshold, chunks, width, radius) < LEAST_RECALL:
                reach = chunks * width                        # every pair that meets is compared
        links.append(_links(mine, mean, proj, threshold, chunks, width, reach))
    if not links:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    pairs = links[0]
    for x in links[1:]:
        pairs = pairs.unionByName(x)
    pairs = stage(pairs, "vec-links")
    size = groups.select(F.col("rep").alias("r"), F.col("copies").alias("c"))
    ends = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # told to shuffle: by their compressed files pairs and roots seem small enough to go through the driver
    degree = (ends.hint("merge").join(size, F.col("b") == F.col("r")).groupBy(F.col("a").alias("rep")).agg(F.sum("c").alias("others")))
    root = components(pairs, "a", "b").select(F.col("node").alias("rep"), "component")
    known = (groups.select("v", "least", "copies", "rep").join(degree, "rep", "left").hint("merge").join(root, "rep", "left")
             .withColumn("component", F.coalesce("component", "rep")))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = (known.join(least, "component")
             .select("v", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"))
    linked = good.join(known, "v").select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(fine, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(reps: DataFrame, mean: np.ndarray, proj: np.ndarray, threshold: float, chunks: int, width: int, radius: int) -> DataFrame:
    """Pairs (a < b) of representatives whose cosine reaches the threshold.

    The joins are told to shuffle: Spark's estimate of their sides does not count
    the rows that are filed or emitted, and would send them through the driver.
    """
    codes = stage(_codes(reps, mean, proj), "vec-codes")
    of = tables(chunks, width, parts_for(codes.count(), width))
    signed = lambda bits: F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")
    keys = F.explode(F.array(*[F.struct(F.lit(at).alias("at"), F.col("code").bitwiseAND(signed(same)).alias("key"))
                               for at, (_, same) in enumerate(of)]))
    blocks = (codes.select(keys.alias("k")).groupBy("k.at", "k.key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
              .where("blocks > 1").select(F.struct("at", "key").alias("large"), "blocks"))
    filed = (codes.withColumn("k", keys).join(blocks, F.col("k") == F.col("large"), "left")
             .withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
             .select("rep", "code", "scale", "small", "rest", "k.at", "k.key", "block",
                     F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")))
    filed = filed.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("other")

    def cell(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        reps, codes, scale, rest, block = (rows[c].to_numpy() for c in ("rep", "code", "scale", "rest", "block"))
        small = np.frombuffer(b"".join(rows["small"].to_pylist()), np.int8).reshape(len(reps), -1)
        at, _, lo, hi = (x.as_py() for x in key)
        first = np.flatnonzero(block == lo)
        second = first if lo == hi else np.flatnonzero(block == hi)
        for x, y in alike(codes.view(np.uint64), (scale[:, None] * small).astype(np.float32), rest, first, second, at, of, threshold, radius):
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(reps[x], reps[y])), pa.array(np.maximum(reps[x], reps[y]))], ["a", "b"])

    near = filed.groupBy("at", "key", "lo", "hi").applyInArrow(cell, "a long, b long")
    one = reps.select(F.col("rep").alias("a"), F.col("unit").alias("ua"))
    two = reps.select(F.col("rep").alias("b"), F.col("unit").alias("ub"))
    cosine = F.aggregate(F.zip_with("ua", "ub", lambda x, y: x * y), F.lit(0.0), lambda z, x: z + x)
    return near.hint("merge").join(one, "a").hint("merge").join(two, "b").where(cosine >= threshold).select("a", "b")
