"""Exact n-gram Jaccard self-join with grouped prefixes, as connected components.

1. Every text becomes its set of word shingles (64-bit hashes). Equal sets are
   one node, named by a digest of the set. The same pass counts shingles into a
   table of fixed size (2**20 counters), summed over all documents.
2. Shingles are ordered by that count, then by hash: one order for all sets. Two
   sets with Jaccard >= t share a shingle among the first n - ceil(t n) + 1 of
   each. Nodes with equal prefixes and size form one group; only groups are
   posted under their prefix shingles. Shingles with large counts are salted.
3. Bands of least shingles of the whole sets propose stars: every node against
   those leaders of its bands with which it shares the most, and the members of
   a group against one of them. They are only a guide: whole sets are compared
   exactly, and verified stars make components.
4. Lists of several components propose stars twice more, against groups of the
   component that most of the list is in, by the same choice.
5. Group pairs that share a list and are not within one component are filtered
   by size, by the position of each common shingle, by the number of prefix
   shingles that each can share, by signatures of the whole sets and by the
   number that both do share, which bound the intersection from above. What is
   left expands to members of different components, whose whole sets are compared.
6. The links of all rounds make the components. So a group of n near copies
   costs about n comparisons, and still every pair that could connect two
   components is compared.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage
from .components import components
from .piece_bpe import text_slices

SKETCH_BITS = 20
SKETCH_CHUNKS = 256
#: Postings that one salt of a frequent shingle holds, about.
SALT_ROWS = 2000
#: Bands that propose stars, and least shingles in each: two sets of similarity 0.75 share one of 12 bands 99.8 % of the time.
BANDS, BAND_ROWS = 12, 3
#: Leaders that a node is compared with, by bands and then by lists: those with which it shares the most bands.
STAR_LEADERS, LIST_LEADERS = 3, 12
#: Bits of the filter that keeps texts of no interest from being made sets again (8 MB), and its chunks.
MARK_BITS, MARK_CHUNKS = 26, 256
#: Text whose words a task hashes at once.
BLOCK_BYTES = 1 << 20
#: Bits of a set's signature.
SIGN_BITS = 1024
#: Shingles of two sets above which their signatures hardly tell how alike they are.
SIGNED = 4 * SIGN_BITS

# Odd multipliers for the places of a word in a shingle, from a fixed seed.
_PLACES = np.random.default_rng(20).integers(1 << 62, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
# A random number for each byte (A-Z: that of a-z), and the bytes that belong to words.
_LETTERS = np.random.default_rng(22).integers(0, 1 << 64, 256, dtype=np.uint64)
_LETTERS[65:91] = _LETTERS[97:123]
_INSIDE = np.ones(256, bool)
_INSIDE[[0x20, *range(0x09, 0x0E)]] = False
_WHITE_BYTE = re.compile(rb"[\x20\x09-\x0D]")


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of texts: A-Z lower-cased, words between x20 and x09 to x0D.

    A word's hash sums a random number of each byte times one of its place.
    """

    def __init__(self, width: int):
        self.width = width
        self.places = _odd(1024)

    def __call__(self, text: str) -> np.ndarray:
        return self.sets([text])[0]

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """One array for each text; texts are hashed together, about ``BLOCK_BYTES`` at a time."""
        out, part, size = [], [], 0
        for text in texts:
            part.append(text.encode())
            size += len(part[-1])
            if size > BLOCK_BYTES:
                out += self._of(part)
                part, size = [], 0
        return out + self._of(part)

    def _of(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(texts) == 1:
            blocks = [self._words(b) for b in _blocks(texts[0])]
            counts, h = [sum(map(len, blocks))], np.concatenate(blocks)
        else:
            data = b" ".join(texts)
            h, starts = self._words(data, True)
            ends = np.cumsum([len(t) + 1 for t in texts])
            counts = np.diff(np.searchsorted(starts, ends), prepend=0).tolist()
        w = self.width
        every = np.full(max(0, len(h) - w + 1), np.uint64(w))
        for i in range(w):
            every += h[i:len(h) - w + 1 + i] * _PLACES[i] if len(every) else every
        every, out, at = _mix(every), [], 0
        for n in counts:
            if n >= w:
                s = np.sort(every[at:at + n - w + 1])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                out.append(s[keep])
            elif n:
                out.append(_mix((h[at:at + n] * _PLACES[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n)))
            else:
                out.append(np.empty(0, np.uint64))
            at += n
        return out

    def _words(self, data: bytes, with_starts: bool = False):
        b = np.frombuffer(b" " + data + b" ", np.uint8)
        inside = _INSIDE[b]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        if not len(starts):
            h = np.empty(0, np.uint64)
        else:
            if sizes.max() > len(self.places):
                self.places = _odd(2 * int(sizes.max()))
            at = np.flatnonzero(inside)
            values = _LETTERS[b[at]]
            values *= self.places[at - np.repeat(starts, sizes)]
            h = _mix(np.add.reduceat(values, np.cumsum(sizes) - sizes))
        return (h, starts) if with_starts else h


def _odd(n: int) -> np.ndarray:
    """The first ``n`` of a fixed row of random odd numbers."""
    return np.random.default_rng(21).integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1)


def _blocks(data: bytes) -> Iterator[bytes]:
    """``data`` cut between words, about BLOCK_BYTES each."""
    at = 0
    while len(data) - at > BLOCK_BYTES:
        cut = _WHITE_BYTE.search(data, at + BLOCK_BYTES)
        if cut is None:
            break
        yield data[at:cut.start()]
        at = cut.start()
    yield data[at:]


def signature(shingles: np.ndarray) -> np.ndarray:
    """SIGN_BITS bits: the parity of a set's shingles by their upper bits.

    Two sets differ in as many shingles as their signatures differ in bits, at least.
    """
    odd = np.bincount((shingles >> np.uint64(64 - SIGN_BITS.bit_length() + 1)).astype(np.int64), minlength=SIGN_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(shingles.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """BANDS names, each of BAND_ROWS least shingles over equal ranges of hashes; ``shingles`` ascend, one at least.

    A range without a shingle takes the next one, the last range the first.
    """
    k = BANDS * BAND_ROWS
    starts = np.arange(k, dtype=np.uint64) * np.uint64((1 << 64) // k)
    least = shingles[np.searchsorted(shingles, starts) % len(shingles)].reshape(BAND_ROWS, BANDS)
    return _mix((least * _PLACES[:BAND_ROWS, None]).sum(0, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def prefix_size(n: int, percent: int) -> int:
    """n - ceil(percent n / 100) + 1."""
    return n - (percent * n + 99) // 100 + 1


def _sets_and_counts(docs: DataFrame, width: int) -> tuple[DataFrame, np.ndarray]:
    """Written stage (doc_id, n, s, s2) of all rows, and the summed shingle counters."""
    per_chunk = (1 << SKETCH_BITS) // SKETCH_CHUNKS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, counts, kind = Shingler(width), np.zeros(1 << SKETCH_BITS, np.int64), pa.null()
        names = ["doc_id", "n", "s", "s2", "chunk", "counts"]
        for key, texts in text_slices(batches, "doc_id"):
            sets = shingle.sets(texts)
            digests = [set_digest(s) for s in sets]
            every = np.concatenate(sets)
            counts += np.bincount((every >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
            kind = key.type
            yield pa.RecordBatch.from_arrays([
                key, pa.array([len(s) for s in sets], pa.int64()), pa.array([d[0] for d in digests], pa.int64()),
                pa.array([d[1] for d in digests], pa.int64()), pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names)
        if counts.any():
            parts = counts.reshape(SKETCH_CHUNKS, per_chunk)
            used = np.flatnonzero(parts.any(1))
            none = pa.nulls(len(used), pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.nulls(len(used), kind), none, none, none, pa.array(used, pa.int32()),
                pa.array([zlib.compress(parts[c].astype("<u4").tobytes(), 1) for c in used], pa.binary())], names)

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, blob in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(blob), "<u4").astype(np.int64)
                total[c] = total[c] + part if c in total else part
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                             ["chunk", "counts"])

    kind = dict(docs.dtypes)["doc_id"]
    both = stage(docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n long, s long, s2 long, chunk int, counts binary"), "shingle-sets")
    sums = (both.where("chunk is not null").select("chunk", "counts").repartition("chunk")
            .mapInArrow(add_up, "chunk int, counts binary").collect())  # SKETCH_CHUNKS rows of fixed size
    counts = np.zeros((SKETCH_CHUNKS, per_chunk), np.int64)
    for r in sums:
        counts[r.chunk] += np.frombuffer(bytes(r.counts), np.int64)
    return both.where("chunk is null").select("doc_id", "n", "s", "s2"), counts.ravel()


def _prefixes(docs: DataFrame, counts: np.ndarray, width: int, percent: int) -> DataFrame:
    """Written stage (g, n, s, tokens, spread, bands, sign): a node's group, size, prefix, salts per prefix shingle, bands and signature.

    A node appears once per task that sees it.
    """
    mean = max(1.0, counts.mean())
    limit = SALT_ROWS + 4 * mean
    order = docs.sparkSession.sparkContext.broadcast(np.minimum(counts, 2**32 - 1).astype(np.uint32))  # 4 MB

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, freq, done = Shingler(width), order.value, set()
        for _, texts in text_slices(batches, "doc_id"):
            rows = []
            for all_of in shingle.sets(texts):
                s, _ = set_digest(all_of)
                if not len(all_of) or s in done:
                    continue
                done.add(s)
                f = freq[(all_of >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                first = np.lexsort((all_of, f))[:prefix_size(len(all_of), percent)]
                tokens = all_of[first]
                g = xxhash.xxh64_intdigest(tokens.tobytes() + len(all_of).to_bytes(8, "little"))
                rows.append((g - (1 << 63), len(all_of), s, tokens.view(np.int64), (f[first] // limit + 1).astype(np.int32), band_keys(all_of).view(np.int64), signature(all_of)))
            if len(done) > 2_000_000:
                done.clear()
            if rows:
                c = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()),
                    pa.array(c[3], pa.list_(pa.int64())), pa.array(c[4], pa.list_(pa.int32())), pa.array(c[5], pa.list_(pa.int64())), pa.array(c[6], pa.list_(pa.int64()))],
                    ["g", "n", "s", "tokens", "spread", "bands", "sign"])

    return stage(docs.select("doc_id", "text").mapInArrow(
        run, "g long, n long, s long, tokens array<long>, spread array<int>, bands array<long>, sign array<long>"), "prefixes")


def _marks(of: DataFrame) -> np.ndarray:
    """Bits of fixed size (8 MB), set at the upper MARK_BITS bits of the longs in column h."""
    per_chunk = 1 << (MARK_BITS - 3 - MARK_CHUNKS.bit_length() + 1)

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(1 << (MARK_BITS - 3), np.uint8)
        for batch in batches:
            at = batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - MARK_BITS)
            np.bitwise_or.at(out, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7))).astype(np.uint8))
        parts = out.reshape(MARK_CHUNKS, per_chunk)
        used = np.flatnonzero(parts.any(1))
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([zlib.compress(parts[c].tobytes(), 1) for c in used], pa.binary())],
                                             ["chunk", "bits"])

    def either(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, blob in zip(batch.column("chunk").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(blob), np.uint8)
                total[c] = total[c] | part if c in total else part
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([zlib.compress(v.tobytes(), 1) for v in total.values()], pa.binary())],
                                             ["chunk", "bits"])

    out = np.zeros((MARK_CHUNKS, per_chunk), np.uint8)
    kind = "chunk int, bits binary"
    for r in of.select("h").mapInArrow(mark, kind).repartition("chunk").mapInArrow(either, kind).collect():  # MARK_CHUNKS rows of fixed size
        out[r.chunk] = np.frombuffer(zlib.decompress(bytes(r.bits)), np.uint8)
    return out.ravel()


def _whole_sets(docs: DataFrame, rows: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """Written stage (s, shingles) of the nodes in column s.

    A filter of fixed size over the doc_ids of one row per node keeps most other
    texts from being made sets again; the join with ``nodes`` decides.
    """
    one = (rows.withColumn("h", F.xxhash64("doc_id")).join(nodes.select("s"), "s", "left_semi")
           .groupBy("s").agg(F.min("h").alias("h")))
    wanted = docs.sparkSession.sparkContext.broadcast(_marks(one))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, marked, done = Shingler(width), wanted.value, set()
        for key, texts in text_slices(batches, "h"):
            at = key.to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - MARK_BITS)
            hit = marked[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1
            names, sets = [], []
            for all_of in shingle.sets([texts[i] for i in np.flatnonzero(hit)]):
                s, _ = set_digest(all_of)
                if s not in done and len(all_of):
                    done.add(s)
                    names.append(s)
                    sets.append(all_of.view(np.int64))
            if len(done) > 2_000_000:
                done.clear()
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["s", "shingles"])

    every = docs.select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(run, "s long, shingles array<long>")
    return stage(every.join(nodes.select("s"), "s", "left_semi").dropDuplicates(["s"]), "whole-sets")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Written stage of those (a, b) whose whole sets reach the similarity."""
    one = sets.select(F.col("s").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("s").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return stage(pairs.join(two, "b").join(one, "a").withColumn("i", both)
                 .where(100 * F.col("i") >= percent * (F.size("x") + F.size("y") - F.col("i"))).select("a", "b"), "links")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    A text's set: its distinct ``width``-word shingles; with fewer words the whole
    sequence as one; without words, or null, empty and linked with nothing. Rows
    link when 100 * intersection >= percent * union. component_id is the least
    doc_id reachable by links, itself included; a null doc_id is least only where
    no other is. Repeated rows are linked with their copies, rows of equal doc_id
    and other texts are separate. An empty table gives no rows.

    Sets are named by 128 bits; should the first 64 agree for different sets, the
    run stops with an error.
    """
    rows, counts = _sets_and_counts(docs, width)
    if rows.where("n > 0").groupBy("s").agg(F.min("s2").alias("x"), F.max("s2").alias("y")).where("x <> y").limit(1).count():
        raise ValueError("two shingle sets share a 64-bit name")
    nodes = _prefixes(docs, counts, width, percent)
    members = stage(nodes.select("g", "s", "n", "bands", "sign").distinct(), "members")
    posted = (nodes.select("g", "n", F.posexplode(F.arrays_zip("tokens", "spread")).alias("pos", "t"))
              .select(F.col("t.tokens").alias("token"), "g", F.shiftleft("n", 32).bitwiseOR(F.col("pos")).alias("np"),
                      F.when(F.col("t.spread") > 1, F.pmod(F.xxhash64("g"), F.col("t.spread")) + 1).otherwise(0).cast("int").alias("salt")))
    # lists of one group alone end here; several tasks may have posted the same group
    listed = Window.partitionBy("token", "salt")
    shared = stage(posted.withColumns({"lo": F.min("g").over(listed), "hi": F.max("g").over(listed)}).where("lo <> hi or salt > 0")
                   .select("token", "salt", "g", "np").distinct().select(
                       "token", "g", F.shiftright("np", 32).alias("n"), F.col("np").bitwiseAND(F.lit(0x7FFFFFFF)).alias("pos")), "postings")
    sets = found = None
    for propose in (_first_stars, _list_stars, _list_stars, _pairs_between):  # lists again: by then the large components hold their least edited copies
        pairs = stage(propose(shared, members, found, percent), "candidates")
        if pairs.isEmpty() and found is not None:
            continue
        ends = pairs.select(F.explode(F.array("a", "b")).alias("s")).distinct()
        more = _whole_sets(docs, rows, ends if sets is None else ends.join(sets.select("s"), "s", "left_anti"), width)
        sets = more if sets is None else sets.unionByName(more)
        links = _verify(pairs, sets, percent)
        if found is not None:
            links = links.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b")))
        found = components(links, "a", "b")
    known = found.select(F.col("node").alias("of"), F.col("component").alias("c"))  # other nodes stand alone
    out = rows.join(known, F.col("s") == F.col("of"), "left")
    out = stage(out.select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("c", "s")).alias("c")), "doc-nodes")
    least = out.where("c is not null").groupBy(F.col("c").alias("root")).agg(F.min("doc_id").alias("least"))
    return (out.join(least, F.col("c") == F.col("root"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")))


def _first_stars(shared: DataFrame, members: DataFrame, found: None, percent: int) -> DataFrame:
    """(a, b): every node against leaders of its bands, and the members of a group against one of them."""
    bands = members.select("s", "n", F.explode("bands").alias("band"))
    lead = (bands.groupBy("band").agg(F.min("s").alias("lo"), F.max("s").alias("hi"), F.min(F.struct(F.xxhash64("s").alias("h"), "s", "n")).alias("l"))
            .where("lo <> hi").select("band", F.col("l.s").alias("to"), F.col("l.n").alias("ln")))
    met = bands.join(lead, "band").where((F.col("s") != F.col("to")) & _near_sizes("n", "ln", percent)).select("s", "to")
    return _alike(met.distinct(), members, STAR_LEADERS, percent).unionByName(_own_stars(members)).distinct()


def _list_stars(shared: DataFrame, members: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """(a, b): one node of each group against leaders of its lists that are of another component.

    A list's leaders belong to the component that most of its groups are in: one
    drawn for each list by itself, and the one with the fewest prefix shingles that
    no other component has, which of near copies is the least edited.
    """
    _, post = _lists_between(shared, members, found)
    drawn, alone = F.xxhash64("g", "token").alias("h"), (_prefix("n", percent) - F.col("held")).alias("u")
    lead = (post.groupBy("token", "c1").agg((-F.count("*")).alias("k"), F.min(F.struct(drawn, "one", "n")).alias("x"), F.min(F.struct(alone, drawn, "one", "n")).alias("y"))
            .groupBy("token").agg(F.min(F.struct("k", "c1", "x", "y")).alias("l")).select("token", "l.*")
            .select("token", F.col("c1").alias("lc"), F.explode(F.array_distinct(F.array(
                *[F.struct(F.col(f"{l}.one").alias("to"), F.col(f"{l}.n").alias("ln")) for l in "xy"]))).alias("l"))
            .select("token", "lc", "l.to", "l.ln"))
    met = (post.join(lead, "token").where((F.col("c1") != F.col("lc")) & _near_sizes("n", "ln", percent))
           .select(F.col("one").alias("s"), "to"))
    return _alike(met.distinct(), members, LIST_LEADERS, percent).distinct()


def _alike(met: DataFrame, members: DataFrame, leaders: int, percent: int) -> DataFrame:
    """(a, b): every node s against those ``leaders`` of its leaders ``to`` that seem most alike, one at least.

    Of those that share a band and that signatures do not rule out: for sets too
    large for signatures those with which it shares the most bands, for others
    those whose signature differs least. Nothing is concluded from it. A node has
    a leader or two for each of its bands or prefix shingles at most.
    """
    one, two = (members.select(F.col("s").alias(s), F.col("n").alias("n_" + c), F.col("bands").alias("bands_" + c), F.col("sign").alias("sign_" + c))
                for s, c in (("s", "a"), ("to", "b")))
    size = F.col("n_a") + F.col("n_b")
    shared = F.size(F.array_intersect("bands_a", "bands_b"))
    alike = F.struct(F.when(size > SIGNED, shared).otherwise(BANDS + SIGN_BITS - F.col("differ")).alias("k"), "to")
    best = (met.join(one, "s").join(two, "to").withColumn("differ", _differ()).where((shared > 0) & _may_reach(size, F.col("differ"), percent))
            .select("s", alike.alias("l"))
            .withColumn("r", F.row_number().over(Window.partitionBy("s").orderBy(F.desc("l")))).where(F.col("r") <= leaders))
    return best.select(F.least("s", "l.to").alias("a"), F.greatest("s", "l.to").alias("b"))


def _differ():
    """Bits in which the signatures ``sign_a`` and ``sign_b`` differ."""
    return sum(F.bit_count(F.col("sign_a")[i].bitwiseXOR(F.col("sign_b")[i])) for i in range(SIGN_BITS // 64))


def _may_reach(size, differ, percent: int):
    """False where sets of ``size`` shingles together differ in too many, as they differ in ``differ`` at least."""
    return (100 + percent) * (size - differ) >= 2 * percent * size


def _own_stars(members: DataFrame) -> DataFrame:
    """(a, b): the members of each group of several against one of them."""
    one = members.groupBy("g").agg(F.min("s").alias("a"), F.count("*").alias("k")).where("k > 1")
    return members.join(one, "g").where("s <> a").select("a", F.col("s").alias("b"))


def _lists_between(shared: DataFrame, members: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(g, s, c) of all nodes, and the postings of lists that hold several components, with those of each group.

    c1 and c2 are the least and greatest component of a group, ``one`` a member of
    c1. ``held`` counts the lists that a group is in, ``before`` those of them whose
    shingle comes earlier: no group of another component shares more with it.
    """
    known = stage(members.join(found.withColumnRenamed("node", "s"), "s", "left").select("g", "s", F.coalesce("component", "s").alias("c")), "node-components")
    spans = (known.groupBy("g").agg(F.min(F.struct("c", "s")).alias("l"), F.max("c").alias("c2"))
             .select("g", F.col("l.c").alias("c1"), "c2", F.col("l.s").alias("one")))
    post = shared.join(spans, "g")
    mixed = post.groupBy("token").agg(F.min("c1").alias("lo"), F.max("c2").alias("hi")).where("lo <> hi").select("token")
    own = Window.partitionBy("g")
    post = post.join(mixed, "token", "left_semi").withColumns({
        "before": F.row_number().over(own.orderBy("pos")) - 1, "held": F.count("*").over(own)})
    return known, stage(post, "mixed-postings")


def _pairs_between(shared: DataFrame, members: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different components that may reach the similarity.

    A list of one component proposes nothing, and neither do groups within one
    component. Two bounds filter the pairs of groups. At a common shingle, at
    most the shorter rest from there on and the fewer shingles before it that are
    on such lists can be common. And ``k`` counts the prefix shingles that both have (every list that
    two components share is kept, so the count is whole); of the two prefixes one
    ends first in the order of shingles, and what is common beyond it lies in the
    rest of that set. Neither group has more than ``held`` of them to begin with.
    """
    known, post = _lists_between(shared, members, found)
    signs = members.groupBy("g").agg(F.when(F.count("*") == 1, F.min("sign")).alias("sign"))      # several sets have none in common
    post = post.join(signs, "g")
    a, b = (post.select("token", *[F.col(c).alias(c + k) for c in ("g", "n", "pos", "c1", "c2", "before", "held", "sign")]) for k in ("_a", "_b"))
    most = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) + F.least("before_a", "before_b")
    apart = ~((F.col("c1_a") == F.col("c2_a")) & (F.col("c1_b") == F.col("c2_b")) & (F.col("c1_a") == F.col("c1_b")))
    enough = percent * (F.col("n_a") + F.col("n_b"))
    rest = F.greatest(F.col("n_a") - _prefix("n_a", percent), F.col("n_b") - _prefix("n_b", percent))
    pairs = a.join(b, (a.token == b.token) & (F.col("g_a") < F.col("g_b")) & apart & _near_sizes("n_a", "n_b", percent)
                   & ((100 + percent) * most >= enough) & ((100 + percent) * (F.least("held_a", "held_b") + rest) >= enough)
                   & F.coalesce(_may_reach(F.col("n_a") + F.col("n_b"), _differ(), percent), F.lit(True)))
    pairs = (pairs.groupBy("g_a", "g_b", "n_a", "n_b").agg(F.count("*").alias("k"))
             .where((100 + percent) * (F.col("k") + rest) >= enough).select("g_a", "g_b"))
    own = known.groupBy("g").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 <> c2").select(F.col("g").alias("g_a"), F.col("g").alias("g_b"))
    left = known.select(F.col("g").alias("g_a"), F.col("s").alias("x"), F.col("c").alias("cx"))
    right = known.select(F.col("g").alias("g_b"), F.col("s").alias("y"), F.col("c").alias("cy"))
    return (pairs.unionByName(own).join(left, "g_a").join(right, "g_b").where("cx <> cy")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def _prefix(n: str, percent: int):
    """``prefix_size`` of a column."""
    return F.col(n) - F.ceil(F.col(n) * percent / F.lit(100)) + 1


def _near_sizes(a: str, b: str, percent: int):
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)
