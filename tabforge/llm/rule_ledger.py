"""Quality rules as a bitmask ledger: every rule is evaluated once, policies are applied to the stored bits.

The ledger holds one row for each document: its measurements and ``failed``, a long with one bit for each rule that the
document fails. The names of the bits travel with the table as metadata of that column. A policy names rules, so it
needs neither texts nor a second pass over them, and neither does an ablation (what each rule of a policy does alone and
what would stay without it): those are sums over the distinct bit patterns, which are few whatever the corpus.
Measurements are stored too, so rules with other thresholds are re-evaluated from the ledger alone.

No step shuffles texts or documents; measuring is one pass over the texts, with numpy inside Arrow batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import content_key, packed, stage

#: Measurements of a text; words are ``[^\x20\x09-\x0D]+``, lines are split at \n and count if they hold a word.
MEASURES = (
    "n_words",          # words
    "word_chars",       # code points in words
    "n_symbols",        # characters of #*$%&|<>
    "n_lines",          # lines with a word
    "n_dup_lines",      # lines with a word that equal an earlier line
    "n_repeat_words",   # words in three-word windows found twice or more in the text
    "n_letter_words",   # words with a letter A-Z, a-z or a character beyond ASCII
    "n_capital_words",  # words with A-Z and without a-z and without a character beyond ASCII
    "n_ended_lines",    # lines with a word whose last character but white space is one of .!?"
)


@dataclass(frozen=True)
class Rule:
    """A document fails the rule where ``fails``, an SQL condition over the measurements, holds."""

    name: str
    fails: str


#: All rules of the ledger, in the order of their bits. Conditions are whole-number products, so they are exact.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 10 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("capitals", "2 * n_capital_words > n_words"),
    Rule("few_letters", "10 * n_letter_words < 8 * n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("many_duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("open_lines", "100 * n_ended_lines < 12 * n_lines"),
    Rule("very_many_words", "n_words > 100000"),
)


@dataclass(frozen=True)
class Policy:
    """A document stays if it fails no rule of ``never`` and at most ``allowed`` rules of ``some``."""

    version: str
    never: tuple[str, ...]
    some: tuple[str, ...] = ()
    allowed: int = 0


BASE = Policy("base-1", ("few_words", "repeated_words"))
DEFAULT = Policy("default-1", BASE.never + ("short_words", "long_words", "symbols", "capitals", "few_letters", "duplicate_lines"))
STRICT = Policy("strict-1", DEFAULT.never, ("many_duplicate_lines", "open_lines", "very_many_words"), 1)


# ---------------------------------------------------------------- measuring

def measure(text: bytes) -> tuple[int, ...]:
    """The measurements of one text in UTF-8. ``bytes.split()`` splits at just the white space of the word rule."""
    import numpy as np

    a = np.frombuffer(text, dtype=np.uint8)
    white = _WHITE[a]
    words = text.split()
    n = len(words)
    if n == 0:
        return (0, 0, int(_SYMBOL[a].sum()), 0, 0, 0, 0, 0, 0)
    chars = int(((a & 0xC0) != 0x80).sum()) - int(white.sum())
    starts = np.flatnonzero(~white & np.concatenate(([True], white[:-1])))
    has = lambda mask: np.logical_or.reduceat(mask[a], starts)
    upper, lower, other = has(_UPPER), has(_LOWER), has(_BEYOND)
    seen: set[bytes] = set()
    lines = dups = ended = 0
    for line in text.split(b"\n"):
        core = line.rstrip()
        if core:
            lines += 1
            dups += line in seen
            seen.add(line)
            ended += core[-1:] in b'.!?"'
    return (n, chars, int(_SYMBOL[a].sum()), lines, dups, repeated_words(words),
            int((upper | lower | other).sum()), int((upper & ~lower & ~other).sum()), ended)


def _mask(chars: bytes):
    import numpy as np

    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_WHITE, _SYMBOL = _mask(b" \t\n\x0b\x0c\r"), _mask(b"#*$%&|<>")
_UPPER, _LOWER, _BEYOND = _mask(bytes(range(65, 91))), _mask(bytes(range(97, 123))), _mask(bytes(range(128, 256)))


def repeated_words(words: Sequence[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that are found twice or more; windows are compared exactly."""
    import numpy as np

    if len(words) <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    key = ids
    for i in range(1, width):                    # numbers of ever longer windows, none above len(words) ** 2
        key = key[:-1] * len(number) + ids[i:]
        key = np.unique(key, return_inverse=True)[1] if i + 1 < width else key
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count[which] > 1
    covered = np.zeros(len(words), dtype=bool)
    for i in range(width):
        covered[i:i + len(again)] |= again
    return int(covered.sum())


def measured(docs: DataFrame, *keep: Column) -> DataFrame:
    """``keep`` and the measurements of ``docs.text`` (null: empty), in one pass without a shuffle."""
    src = docs.select(*keep, F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("__text"))
    names = [c for c in src.columns if c != "__text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "__text"]
                       + [f"{m} long" for m in MEASURES])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [measure(t) for t in batch.column("__text").to_pylist()]
            cols = list(zip(*found)) if found else [()] * len(MEASURES)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(c, pa.int64()) for c in cols],
                                             names=[*names, *MEASURES])

    return src.mapInArrow(run, schema)


# ---------------------------------------------------------------- ledger, policies, ablations

def failure_bits(rules: Sequence[Rule]) -> Column:
    """One long: bit i is set where rule i fails. At most 63 rules."""
    if len(rules) > 63:
        raise ValueError("a ledger holds at most 63 rules")
    bits = F.lit(0).cast("long")
    for i, r in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return bits.alias("failed", metadata={"rules": [r.name for r in rules]})


def build_ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The stored ledger of ``docs``: doc_id, k1, k2 (key of doc_id and text), measurements, failed.

    One row for each row of ``docs``, repeated rows and null ids included; a null or empty text has no words, so all
    its measurements are 0. Texts of any length are measured whole. An empty table gives an empty ledger; further
    columns are ignored.
    """
    k1, k2 = content_key(F.col("doc_id"), F.coalesce("text", F.lit("")))
    found = measured(docs, F.col("doc_id"), k1.alias("k1"), k2.alias("k2"))
    return stage(found.withColumn("failed", failure_bits(rules)), "rule-ledger")


def rejudge(ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The ledger with the bits of other rules, from its measurements alone."""
    return ledger.drop("failed").withColumn("failed", failure_bits(rules))


def mask_of(ledger: DataFrame, names: Sequence[str]) -> int:
    """The bits of the named rules; a rule that the ledger has not evaluated is an error."""
    known = ledger.schema["failed"].metadata["rules"]
    missing = [n for n in names if n not in known]
    if missing:
        raise ValueError(f"the ledger has no rule {', '.join(missing)}")
    return sum(1 << known.index(n) for n in dict.fromkeys(names))


def _stays(failed: Column, never: int, some: int, allowed: int) -> Column:
    return (failed.bitwiseAND(F.lit(never)) == 0) & (F.bit_count(failed.bitwiseAND(F.lit(some))) <= allowed)


def apply_policy(ledger: DataFrame, policy: Policy, out: str = "kept") -> DataFrame:
    """The ledger with ``out``: does the document stay under the policy?"""
    return ledger.withColumn(out, _stays(F.col("failed"), mask_of(ledger, policy.never), mask_of(ledger, policy.some),
                                         policy.allowed))


def filter_documents(docs: DataFrame, ledger: DataFrame, policy: Policy) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows equal in doc_id and text stay or go together."""
    gone = (apply_policy(ledger, policy).where("not kept")
            .groupBy(F.col("k1").alias("g1"), F.col("k2").alias("g2")).agg(F.count("*").alias("n")))
    k1, k2 = content_key(F.col("doc_id"), F.coalesce("text", F.lit("")))
    rows = docs.select(packed(docs), k1.alias("k1"), k2.alias("k2"))
    return rows.join(gone, (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2")), "left_anti").select("row.*")


def ablations(ledger: DataFrame, policy: Policy) -> DataFrame:
    """What each rule of a policy does: one row for each rule.

    rule, documents (all), dropped (by the policy), fails (documents failing the rule), words_lost (their words),
    only (dropped now, and kept if the rule were taken out), always and ever (does every, does any document fail it?).
    Summed over the distinct patterns of the policy's bits, combined in the tasks that read the ledger.
    """
    never, some = mask_of(ledger, policy.never), mask_of(ledger, policy.some)
    known = ledger.schema["failed"].metadata["rules"]
    pattern = F.col("failed").bitwiseAND(F.lit(never | some))
    patterns = ledger.groupBy(pattern.alias("pattern")).agg(F.count("*").alias("n"), F.sum("n_words").alias("words"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << known.index(r)).cast("long").alias("bit"))
                                for r in dict.fromkeys(policy.never + policy.some)])).alias("r")
    p, bit = F.col("pattern"), F.col("r.bit")
    gone = ~_stays(p, never, some, policy.allowed)
    without = _stays(p.bitwiseAND(F.bitwise_not(bit)), never, some, policy.allowed)
    fails = p.bitwiseAND(bit) != 0
    total = lambda cond, what="n": F.coalesce(F.sum(F.when(cond, F.col(what))), F.lit(0))
    return patterns.select("pattern", "n", "words", rules).groupBy(F.col("r.rule").alias("rule"), bit.alias("bit")).agg(
        F.sum("n").alias("documents"), total(gone).alias("dropped"), total(fails).alias("fails"),
        total(fails, "words").alias("words_lost"), total(gone & without).alias("only"),
        F.bit_and("pattern").alias("all_bits"), F.bit_or("pattern").alias("any_bits")).select(
        "rule", "documents", "dropped", "fails", "words_lost", "only",
        (F.col("all_bits").bitwiseAND(F.col("bit")) != 0).alias("always"),
        (F.col("any_bits").bitwiseAND(F.col("bit")) != 0).alias("ever"))
