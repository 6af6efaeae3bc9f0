"""Phrase collocations by Rabin-Karp fingerprints.

The words of a text are laid out as one byte string with single spaces; prefix polynomials over it give the fingerprint
of every run of words as a difference of two prefixes times an inverse power, for all runs at once in numpy. Only
fingerprints travel: a task sums what it has read by fingerprint, and the shuffle adds the counts. Words come first,
then pairs of frequent words, then runs of three to five words whose pairs are all frequent, because a run is no more
frequent than what it holds. "Frequent" is asked of a bitmap of bounded size; a full bitmap lets more runs through to
be counted, and loses none.

A last pass takes, for frequent fingerprints only, an occurrence pointer (text key and word number) and the least and
greatest of an independent 64-bit check of each occurrence. A fingerprint whose checks differ stands for several
phrases: those are counted again by their text. Phrases that are frequent, and only they, become text: the texts that
the pointers name are read again, and the words found there must give the fingerprint and the check.

Cuts, scores and the dropping of inner phrases are joins of the table of frequent phrases with itself.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

LONGEST = 5
#: Bytes of text worked on at once; a longer text is cut between words, with the words before the cut as context.
CHUNK = 1 << 18
#: Bits of a bitmap of frequent fingerprints: 16 for each, and no more than this (16 MB).
MOST_BITS = 1 << 27
#: Bits of a pointer that hold the number of the word; the others are those of the text's key.
WORD_BITS = 24
LAST_WORD = (1 << WORD_BITS) - 1
#: Languages whose totals are broadcast; with more they are joined.
MOST_LANGUAGES = 100_000

# Two primes below 2**31 and a power of two; bases are odd and larger than a byte.
_PRIMES = (2147483629, 2147483587)
_BASES = (1000003, 999983)
_BASE64, _MASK64 = 6364136223846793005, (1 << 64) - 1

_KIND = np.zeros(256, dtype=np.uint8)                  # 0 word, 1 white space, 2 end of a piece
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_OUTSIDE = re.compile(rb"[ \t.,;:!?\x0a-\x0d]")


@lru_cache(maxsize=2)
def _powers(size: int) -> list[tuple]:
    """For each modulus: powers of the base and of its inverse, up to ``size``."""
    def by_doubling(base, mod):
        out = np.ones(size, dtype=np.uint64)
        done = 1
        while done < size:
            step = pow(base, done, mod or 1 << 64)
            part = out[:min(done, size - done)] * np.uint64(step)
            out[done:done + len(part)] = part % np.uint64(mod) if mod else part
            done += len(part)
        return out
    return [(p, by_doubling(b, p), by_doubling(pow(b, -1, p), p)) for p, b in zip(_PRIMES, _BASES)] + [
        (0, by_doubling(_BASE64, 0), by_doubling(pow(_BASE64, -1, 1 << 64), 0))]


class Runs:
    """The words of a buffer, and the fingerprint and check of any run of them."""

    def __init__(self, buffer: bytes, lang: str, bits: int):
        a = _LOWER[np.frombuffer(buffer + b"\n", dtype=np.uint8)]
        kind = _KIND[a]
        word = kind == 0
        before = np.concatenate(([False], word[:-1]))
        after = before & ~word                                     # the byte that follows a word stands for the space
        keep = word | after
        self.bytes = a[keep]
        self.ends = np.flatnonzero(after[keep])
        self.bytes[self.ends] = 32
        self.starts = np.concatenate(([0], self.ends[:-1] + 1)) if len(self.ends) else self.ends
        self.at = np.flatnonzero(word & ~before)                   # where the words lie in the buffer
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.at]
        self.mix, self.mask = np.uint64(lang_bits(lang)), np.uint64((1 << bits) - 1)
        self.prefixes = []
        size = max(CHUNK, 1 << len(self.bytes).bit_length()) + 1
        values = self.bytes.astype(np.uint64) + np.uint64(1)
        for p, up, down in _powers(size):
            terms = values * up[:len(values)]
            self.prefixes.append((p, np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms % np.uint64(p) if p else terms))), down))

    def __len__(self) -> int:
        return len(self.ends)

    def whole(self, n: int):
        """Which runs of n words, by their first word, lie in one piece."""
        return self.piece[n - 1:] == self.piece[:len(self.piece) - n + 1]

    def _polynomial(self, which: int, i, n: int):
        p, prefix, down = self.prefixes[which]
        s, e = self.starts[i], self.ends[i + n - 1]
        sums = prefix[e] - prefix[s]
        return (sums % np.uint64(p)) * down[s] % np.uint64(p) if p else sums * down[s]

    def fingerprints(self, i, n: int):
        """62 bits, as int64, of the runs of n words that start at the words ``i``."""
        both = self._polynomial(0, i, n) << np.uint64(31) | self._polynomial(1, i, n)
        return ((both ^ self.mix) & self.mask).view(np.int64)

    def checks(self, i, n: int):
        return self._polynomial(2, i, n).view(np.int64)

    def text(self, i: int, n: int) -> str:
        return self.bytes[self.starts[i]:self.ends[i + n - 1]].tobytes().decode("utf-8", "replace")


def lang_bits(lang: str) -> int:
    """62 bits for a language, so that one bitmap serves all."""
    h = 0
    for b in lang.encode():
        h = (h * 0x100000001B3 + b + 1) & _MASK64
    h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 & _MASK64
    return (h ^ h >> 32) & ((1 << 62) - 1)


def parts_of(text: bytes, chunk: int = CHUNK):
    """(bytes, words of context, number of the first word) of a text: whole, or cut outside words."""
    if len(text) <= chunk:
        yield text, 0, 0
        return
    low, words = 0, []                                              # where the last words before the cut start
    number = 0
    while low < len(text):
        cut = _OUTSIDE.search(text, min(low + chunk, len(text)))
        high = cut.start() if cut else len(text)
        start = words[0] if words else low
        yield text[start:high], len(words), number - len(words)
        kind = _KIND[np.frombuffer(text[low:high], dtype=np.uint8)] == 0
        found = np.flatnonzero(kind & ~np.concatenate(([False], kind[:-1]))) + low
        number += len(found)
        words = (words + found[-(LONGEST - 1):].tolist())[-(LONGEST - 1):]
        low = high


def _chunks(batch, chunk: int):
    """Texts of one language put together: (lang, [(part, text key, words of context, number of the first word)]).

    Texts are taken from the Arrow buffer one at a time, so a task holds a chunk besides the batch.
    """
    langs, keys, texts = batch.column("lang").to_pylist(), batch.column("k").to_pylist(), batch.column("text")
    held: list = []
    size, lang = 0, None
    for i in sorted(range(len(keys)), key=lambda i: (langs[i], keys[i])):
        for part, context, first in parts_of(texts[i].as_py(), chunk):
            if held and (langs[i] != lang or size + len(part) > chunk):
                yield lang, held
                held, size = [], 0
            lang = langs[i]
            held.append((part, keys[i], context, first))
            size += len(part) + 1
    if held:
        yield lang, held


_COUNTS = "lang string, n int, fp long, f long"
_POINTERS = "lang string, n int, fp long, at long, low long, high long"


def _lit(bitmap, fps):
    """Which fingerprints have their bit in ``bitmap`` (bytes, a power of two of bits)."""
    slot = fps & (len(bitmap) * 8 - 1)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _eligible(runs: Runs, ns, words_lit, pairs_lit):
    """For each n, the first words of the runs to count."""
    every = np.arange(len(runs))
    if words_lit is not None:
        ok = _lit(words_lit, runs.fingerprints(every, 1))
    if pairs_lit is not None and len(runs) > 1:
        pair = np.zeros(len(runs), dtype=bool)
        i = np.flatnonzero(runs.whole(2))
        pair[i] = _lit(pairs_lit, runs.fingerprints(i, 2))
    for n in ns:
        if len(runs) < n:
            continue
        mine = runs.whole(n).copy()
        last = len(runs) - n + 1
        for j in range(n if words_lit is not None else 0):
            mine &= ok[j:last + j]
        for j in range(n - 1 if pairs_lit is not None else 0):
            mine &= pair[j:last + j]
        yield n, np.flatnonzero(mine)


def _scan(docs: DataFrame, ns, words_lit=None, pairs_lit=None, wanted=None, bits: int = 62, chunk: int = CHUNK) -> DataFrame:
    """By language, n and fingerprint: how often the runs of ``ns`` words occur (n = 0: all words), summed by task.

    With the bitmap ``wanted``: an occurrence pointer and the least and greatest check of those fingerprints instead.
    """
    spark = docs.sparkSession
    shared = [spark.sparkContext.broadcast(x) if x is not None else None for x in (words_lit, pairs_lit, wanted)]
    schema = _COUNTS if wanted is None else _POINTERS

    def scan(batches):
        import pyarrow as pa

        words, pairs, want = [x.value if x else None for x in shared]
        for batch in batches:
            for lang, held in _chunks(batch, chunk):
                runs = Runs(b"\n".join(h[0] for h in held), lang, bits)
                starts = np.cumsum([0] + [len(h[0]) + 1 for h in held[:-1]])
                doc = np.searchsorted(starts, runs.at, side="right") - 1
                number = np.arange(len(runs)) - np.searchsorted(runs.at, starts)[doc]
                context = np.array([h[2] for h in held])
                fresh = number >= context[doc] if context.any() else np.ones(len(runs), dtype=bool)
                rows = [[] for _ in schema.split(", ")[1:]]
                if 0 in ns:
                    for c, v in zip(rows, (0, 0, int(fresh.sum()))):
                        c.append(np.array([v], dtype=np.int64))
                for n, i in _eligible(runs, [n for n in ns if n], words, pairs):
                    i = i[fresh[i + n - 1]]                         # the others were counted before the cut
                    fp = runs.fingerprints(i, n)
                    if want is not None:
                        lit = _lit(want, fp)
                        i, fp = i[lit], fp[lit]
                    if not len(i):
                        continue
                    order = np.argsort(fp, kind="stable")
                    fp = fp[order]
                    edge = np.flatnonzero(np.concatenate(([True], fp[1:] != fp[:-1])))
                    if want is None:
                        found = [np.diff(np.append(edge, len(fp)))]
                    else:
                        check = runs.checks(i, n)[order]
                        at = np.minimum(number + np.array([h[3] for h in held])[doc], LAST_WORD)
                        at |= np.array([h[1] for h in held], dtype=np.int64)[doc] & ~np.int64(LAST_WORD)
                        found = [np.minimum.reduceat(at[i][order], edge), np.minimum.reduceat(check, edge),
                                 np.maximum.reduceat(check, edge)]
                    for c, v in zip(rows, (np.full(len(edge), n), fp[edge], *found)):
                        c.append(v)
                if rows[0]:
                    n, *rest = [np.concatenate(c) for c in rows]
                    names = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(n), np.int32)), pa.array([lang])).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([names, pa.array(n, pa.int32()), *[pa.array(r, pa.int64()) for r in rest]],
                                                     names=[c.split()[0] for c in schema.split(", ")])

    sums = [F.sum("f").alias("f")] if wanted is None else [F.min("at").alias("at"), F.min("low").alias("low"), F.max("high").alias("high")]
    return docs.select("lang", "k", "text").mapInArrow(scan, schema).groupBy("lang", "n", "fp").agg(*sums)


def _bitmap(values: DataFrame, name: str):
    """Bits of the longs in ``name``: 16 for each value, MOST_BITS at most, so its size on the driver has a bound."""
    n = values.count()
    bits = 1 << min(MOST_BITS.bit_length() - 1, max(16, (16 * n).bit_length()))
    slot = F.col(name).bitwiseAND(F.lit(bits - 1))
    found = (values.select(slot.alias("s")).groupBy(F.shiftright("s", 5).alias("i"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 31 as int))")).alias("b")).toArrow())   # bits / 32 rows at most
    out = np.zeros(bits // 32, dtype="<u4")
    out[found["i"].to_numpy()] = found["b"].to_numpy().astype("<u4")
    return out.view(np.uint8)


# ---------------------------------------------------------------- from fingerprints to phrases

_PHRASES = "lang string, n int, phrase string, f long"


def _materialise(docs: DataFrame, counted: DataFrame, bits: int, chunk: int) -> DataFrame:
    """The frequent fingerprints as phrases, read at their pointers; each must give its fingerprint and check again."""
    key = F.col("at").bitwiseAND(F.lit(~LAST_WORD))
    wanted = counted.select("lang", key.alias("key"), F.struct("n", "fp", "f", "at", "low").alias("run"))
    lit = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted.select(F.shiftright("key", WORD_BITS).alias("s")), "s"))

    def named(batches):
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array(_lit(lit.value, batch.column("k").to_numpy() >> WORD_BITS)))

    # of equal texts one is read; texts with equal pointers but other words fall out by the check
    texts = (docs.select("lang", "k", "k2", "text").mapInArrow(named, "lang string, k long, k2 long, text binary")
             .groupBy("lang", F.col("k").bitwiseAND(F.lit(~LAST_WORD)).alias("key"), "k", "k2")
             .agg(F.min("text").alias("text")))
    by_text = wanted.groupBy("lang", "key").agg(F.sort_array(F.collect_list("run")).alias("runs"))   # runs of one text

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                left = {}
                for x in r["runs"]:
                    left.setdefault(x["n"], []).append(x)
                for part, context, first in parts_of(r["text"], chunk):
                    runs = Runs(part, r["lang"], bits)
                    for n, xs in left.items():
                        at = np.array([x["at"] & LAST_WORD for x in xs]) - first
                        here = (at >= 0) & (at + n <= len(runs)) & (at + first < LAST_WORD)
                        places = list(zip(np.flatnonzero(here), at[here]))
                        if (at + first >= LAST_WORD).any() and len(runs) >= n:          # beyond what a pointer holds
                            fps = runs.fingerprints(np.arange(len(runs) - n + 1), n)
                            places += [(j, i) for j in np.flatnonzero(at + first >= LAST_WORD)
                                       for i in np.flatnonzero(fps == xs[j]["fp"])[:1]]
                        if places:
                            i = np.array([p for _, p in places])
                            fps, checks = runs.fingerprints(i, n), runs.checks(i, n)
                            out += [(r["lang"], n, runs.text(p, n), xs[j]["f"]) for (j, p), fp, c in zip(places, fps, checks)
                                    if fp == xs[j]["fp"] and c == xs[j]["low"]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), (pa.string(), pa.int32(), pa.string(), pa.int64()))],
                                                 names=["lang", "n", "phrase", "f"])

    return texts.join(by_text, ["lang", "key"]).select("lang", "text", "runs").mapInArrow(read, _PHRASES).distinct()


def _recount(docs: DataFrame, collided: DataFrame, least: int, bits: int, chunk: int) -> DataFrame:
    """Phrases of fingerprints that stand for several, counted by their text."""
    lit = docs.sparkSession.sparkContext.broadcast(_bitmap(collided, "fp"))
    schema = "lang string, n int, fp long, phrase string, c long"

    def texts(batches):
        import pyarrow as pa

        for batch in batches:
            for lang, held in _chunks(batch, chunk):
                for part, _, context, _ in held:
                    runs, out = Runs(part, lang, bits), {}
                    for n, i in _eligible(runs, range(1, LONGEST + 1), None, None):
                        i = i[i + n > context]
                        fps = runs.fingerprints(i, n)
                        for j in np.flatnonzero(_lit(lit.value, fps)):
                            key = (lang, n, int(fps[j]), runs.text(i[j], n))
                            out[key] = out.get(key, 0) + 1
                    if out:
                        cols = [*zip(*out), tuple(out.values())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(v, t) for v, t in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64()))],
                            names=["lang", "n", "fp", "phrase", "c"])

    return (docs.select("lang", "k", "text").mapInArrow(texts, schema)
            .join(collided.select("lang", "n", "fp"), ["lang", "n", "fp"], "left_semi")
            .groupBy("lang", "n", "phrase").agg(F.sum("c").alias("f")).where(F.col("f") >= least))


def frequent_phrases(documents: DataFrame, least: int, bits: int = 62, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(phrases: lang, n, phrase, f of all runs of one to five words found ``least`` times or more; totals: lang, words).

    ``bits`` of the fingerprints and the ``chunk`` of bytes worked on at once change no result.
    """
    text = F.coalesce("text", F.lit(""))
    docs = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.xxhash64(text).alias("k"),
                            F.xxhash64(F.lit(0x5EED), text).alias("k2"), F.encode(text, "UTF-8").alias("text"))
    many = F.col("f") >= least
    size = {"bits": bits, "chunk": chunk}
    one = stage(_scan(docs, (0, 1), **size).where(many | (F.col("n") == 0)), "phrase-words")
    words = one.where("n = 1")
    words_lit = _bitmap(words, "fp")
    pairs = stage(_scan(docs, (2,), words_lit, **size).where(many), "phrase-pairs")
    pairs_lit = _bitmap(pairs, "fp")
    longer = stage(_scan(docs, range(3, LONGEST + 1), None, pairs_lit, **size).where(many), "phrase-runs")
    frequent = words.unionByName(pairs).unionByName(longer)
    pointers = _scan(docs, range(1, LONGEST + 1), words_lit, pairs_lit, _bitmap(frequent, "fp"), **size)
    counted = stage(frequent.join(pointers, ["lang", "n", "fp"]), "phrase-pointers")
    phrases = _materialise(docs, counted.where("low = high"), bits, chunk)
    collided = counted.where("low <> high")
    if not collided.isEmpty():
        phrases = phrases.unionByName(_recount(docs, collided, least, bits, chunk))
    return stage(phrases, "phrases"), one.where("n = 0").select("lang", F.col("f").alias("words"))


def collocations(documents: DataFrame, least: int = 100, top: int = 2000, bits: int = 62, chunk: int = CHUNK) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to 5 words found ``least`` times or more scores floor(1000 a n / (l r)) at its worst cut; phrases
    inside a longer one that is as frequent are dropped. Exact: products are decimals of 38 digits.

    Null texts count as empty, a null lang as ``und``, equal rows count each for itself, doc_id and further columns are
    not read, texts of any length are counted whole, and an empty table gives no rows. Ties go by a, then by the bytes
    of the phrase.
    """
    phrases, totals = frequent_phrases(documents, least, bits, chunk)
    word = F.split("phrase", " ")
    several = phrases.where("n >= 2").select("lang", "n", "phrase", F.col("f").alias("a"), word.alias("w"))
    cut = several.select("lang", "n", "phrase", "a", "w", F.explode(F.expr("sequence(1, n - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("head"),
        F.array_join(F.expr("slice(w, k + 1, n - k)"), " ").alias("rest"))
    found = lambda part, f: phrases.select(F.col("lang").alias(f"{part}_lang"), F.col("phrase").alias(f"{part}_phrase"), F.col("f").alias(f))
    at = lambda part: (F.col("lang") == F.col(f"{part}_lang")) & (F.col(part) == F.col(f"{part}_phrase"))
    ends = cut.join(found("head", "l"), at("head")).join(found("rest", "r"), at("rest"))
    # one row for each language: sent to all tasks if its size is known to be small
    totals = F.broadcast(totals) if totals.count() <= MOST_LANGUAGES else totals
    score = F.expr("cast(1000 as decimal(38,0)) * cast(a as decimal(38,0)) * cast(words as decimal(38,0)) "
                   "div (cast(l as decimal(38,0)) * cast(r as decimal(38,0)))")
    scored = (ends.join(totals.withColumnRenamed("lang", "t_lang"), F.col("lang") == F.col("t_lang"))
              .select("lang", "phrase", "a", "k", "l", "r", F.col("words").alias("n"), score.alias("score"))
              .groupBy("lang", "phrase").agg(F.min("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("worst"), F.min("n").alias("n")))
    # a longer phrase as frequent holds one a word longer that is as frequent as well
    inner = (several.where("n >= 3").select("lang", "a", F.explode(F.expr(
                "array(array_join(slice(w, 1, n - 1), ' '), array_join(slice(w, 2, n - 1), ' '))")).alias("phrase"))
             .groupBy(F.col("lang").alias("i_lang"), F.col("phrase").alias("i_phrase")).agg(F.max("a").alias("longer")))
    kept = scored.join(inner, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("i_phrase"))
                       & (F.col("longer") >= F.col("a")), "left_anti").select(
        "lang", "phrase", "a", F.col("worst.l").alias("l"), F.col("worst.r").alias("r"), "n", F.col("worst.score").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # the first of each share of a language, then the first of those: no task ranks a language
    shares = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    best = (shares.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
            .where(F.col("rank") <= top).drop("share", "rank"))
    return (best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
