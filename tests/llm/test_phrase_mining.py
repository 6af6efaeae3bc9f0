"""Phrase mining: counts, scores and dropped phrases against plain Python, colliding fingerprints, cuts in long texts."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tabforge.llm.phrase_mining import LONGEST, Runs, collocations, frequent_phrases, parts_of

from .helpers import ODD_TEXTS, ascii_lower

SCHEMA = "doc_id long, text string, lang string"


def pieces(text):
    for piece in re.split("[.,;:!?\n-\r]", ascii_lower(text or "")):
        w = re.findall("[^ \t]+", piece)
        if w:
            yield w


def counts(rows):
    f: dict = {}
    for _, text, lang in rows:
        mine = f.setdefault("und" if lang is None else lang, Counter())
        for w in pieces(text):
            for n in range(1, LONGEST + 1):
                mine.update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    return f


def plain(rows, least, top):
    out = []
    for lang, f in counts(rows).items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            inside = any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                         for q, b in cand.items())
            if not inside:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, ph.decode(), -a, x, r, n, -s) for i, (s, a, ph, x, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def texts(rnd, n):
    vocab = ["New", "york", "city", "the", "of", "a", "É", "x" * 40, "日本", "end.", "and,", "\n", "a\tb", "\x00", "b;c"]
    out = []
    for i in range(n):
        t = " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(40)))
        out.append((i, t + rnd.choice(["", " of the new york city hall", ". As a matter of fact, yes"]),
                    rnd.choice(["en", "fr", "", None])))
    return out


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("bits, chunk", [(62, 1 << 20), (62, 64), (9, 300)])
def test_against_plain_counts(spark, bits, chunk):
    rows = texts(random.Random(1), 250) + [(None, t, "en") for t in ODD_TEXTS] + [(3, "again and again and again", "fr")] * 12
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got, totals = frequent_phrases(df, 10, bits, chunk)
    f = counts(rows)
    assert found(got.select("lang", "phrase", "n", "f")) == sorted(
        (lang, " ".join(p), len(p), c) for lang, x in f.items() for p, c in x.items() if c >= 10)
    assert {r["lang"]: r["words"] for r in totals.collect()} == {
        lang: sum(c for p, c in x.items() if len(p) == 1) for lang, x in f.items()}
    assert found(collocations(df, 10, 25, bits, chunk)) == plain(rows, 10, 25)


def test_fingerprints_do_not_depend_on_the_place():
    rnd = random.Random(2)
    words = [rnd.choice(["a", "b", "the", "é", "long" * 9]) for _ in range(300)]
    runs = Runs("  ".join(words).encode(), "en", 62)
    assert len(runs) == 300
    for n in range(1, LONGEST + 1):
        i = np.arange(300 - n + 1)
        by_text: dict = {}
        for j, fp, c in zip(i, runs.fingerprints(i, n).tolist(), runs.checks(i, n).tolist()):
            by_text.setdefault(" ".join(words[j:j + n]), set()).add((fp, c))
            assert runs.text(j, n) == " ".join(words[j:j + n])
        assert all(len(v) == 1 for v in by_text.values())
        assert len(set.union(*by_text.values())) == len(by_text)


def test_cut_texts_keep_their_words():
    rnd = random.Random(3)
    text = " ".join(rnd.choice(["ab", "c.", "d", "e" * 30, "\n"]) for _ in range(400)).encode()
    whole = [Runs(text, "", 62).text(i, 1) for i in range(len(Runs(text, "", 62)))]
    seen = {}
    for part, context, first in parts_of(text, 50):
        runs = Runs(part, "", 62)
        assert context <= LONGEST - 1
        for i in range(context, len(runs)):
            assert first + i not in seen
            seen[first + i] = runs.text(i, 1)
    assert [seen[i] for i in range(len(seen))] == whole


def test_very_long_texts(spark):
    rows = [(1, "one two three four five " * 50_000, "en"), (2, "y" * 1_000_000 + " one two", "en"),
            (3, "\n".join(["same line"] * 200_000), "en")]
    got = found(collocations(spark.createDataFrame(rows, SCHEMA), 100, 2000))
    assert got == plain(rows, 100, 2000)


def test_exact_beyond_64_bits(spark):
    from tabforge.llm import phrase_mining as pm

    big = 9_000_000_000_000
    phrases = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big - 1), ("en", 2, "a b", big - 2)], pm._PHRASES)
    totals = spark.createDataFrame([("en", 5 * big)], "lang string, words long")
    before = pm.frequent_phrases
    pm.frequent_phrases = lambda *_: (phrases, totals)
    try:
        row = pm.collocations(None, 100).first()
    finally:
        pm.frequent_phrases = before
    assert row["score"] == 1000 * (big - 2) * 5 * big // (big * (big - 1))


def test_nulls_ties_repeats_and_empty_table(spark):
    rows = [(None, None, None), (1, "b a. d c.", None), (1, "b a. d c.", None), (2, "", "en")]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", n int, phrase string, k long")
    assert found(collocations(df, 2, 9)) == plain(rows, 2, 9)
    assert [r[2] for r in found(collocations(df, 2, 1))] == ["b a"]
    assert collocations(spark.createDataFrame([], SCHEMA)).count() == 0
