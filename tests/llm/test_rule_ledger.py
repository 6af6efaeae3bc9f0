"""The rule ledger: measurements against plain Python, policies, ablations and odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabforge.llm.rule_ledger import (BASE, DEFAULT, MEASURES, RULES, STRICT, Policy, Rule, ablations, apply_policy,
                                      build_ledger, filter_documents, measure, rejudge)

from .helpers import ODD_TEXTS, prose, words


def plain(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = Counter(windows)
    covered = {j for i, x in enumerate(windows) if count[x] > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered),
            sum(bool(re.search("[A-Za-z]|[^\x00-\x7f]", x)) for x in w),
            sum(bool(re.fullmatch("[\x00-`{-\x7f]*[A-Z][\x00-`{-\x7f]*", x)) for x in w),
            sum(x.rstrip(" \t\n\x0b\x0c\r")[-1] in '.!?"' for x in lines))


def texts():
    rnd = random.Random(5)
    some = ["SHOUT", "it", "| a |", "é", "É", "12", "#x", "end.", "\n", "\n", "the same line\n", "日本", "\t", "a b c", "a b c"]
    out = [" ".join(rnd.choice(some) for _ in range(rnd.randrange(60))) for _ in range(200)]
    return out + ODD_TEXTS + ["a a", "a a a", "a a a a", "a b a b a", "\x1c\x1d a\x85b a", "\na.\n", "x y z\nx y z"]


def test_measures_equal_plain_counts():
    for t in texts():
        assert measure((t or "").encode()) == plain(t), repr(t)


def test_very_long_texts():
    lines = "\n".join(f"line {i} of many words." for i in range(200_000))
    assert measure(lines.encode()) == plain(lines)
    for t in ("x" * 1_000_000, "word " * 300_000, "é" * 100_000):
        assert measure(t.encode())[:6] == plain(t)[:6]


@pytest.fixture(scope="module")
def ledger(spark):
    rnd = random.Random(6)
    docs = [(i, t, "x", i, 7) for i, t in enumerate(texts())]
    docs += [(None, "Null id", "y", 0, 0), (3, texts()[3], "again", 1, 1), (3, texts()[3], "again", 1, 1)]
    docs += [(1000 + i, prose(rnd, 120), "z", 0, 0) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string, failed string, n_words int, k1 int")
    return df, docs, build_ledger(df)


def test_one_row_and_every_bit_for_each_document(ledger):
    _, docs, led = ledger
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, tuple(r[m] for m in MEASURES), r["failed"]) for r in led.collect())
    want = []
    for i, t, *_ in docs:
        m = dict(zip(MEASURES, plain(t)))
        bits = sum(1 << b for b, r in enumerate(RULES) if eval(r.fails, {}, m))
        want.append((i is None, i or 0, plain(t), bits))
    assert got == sorted(want)


@pytest.mark.parametrize("policy", [BASE, DEFAULT, STRICT, Policy("soft", (), ("few_words", "symbols", "capitals"), 1)])
def test_policies_and_ablations(ledger, policy):
    df, docs, led = ledger
    bit = {r.name: 1 << i for i, r in enumerate(RULES)}
    rows = [(r["failed"], r["n_words"]) for r in led.collect()]

    def stays(failed, out=""):
        return (not any(failed & bit[n] for n in policy.never if n != out)
                and sum(bool(failed & bit[n]) for n in policy.some if n != out) <= policy.allowed)
    assert apply_policy(led, policy).where("kept").count() == sum(stays(f) for f, _ in rows)
    for r in ablations(led, policy).collect():
        fail = [(f, w) for f, w in rows if f & bit[r["rule"]]]
        assert r["documents"] == len(rows) and r["fails"] == len(fail) and r["words_lost"] == sum(w for _, w in fail)
        assert r["dropped"] == sum(not stays(f) for f, _ in rows)
        assert r["only"] == sum(not stays(f) and stays(f, r["rule"]) for f, _ in rows)
        assert (r["ever"], r["always"]) == (bool(fail), len(fail) == len(rows))
    left = filter_documents(df, led, policy)
    assert left.columns == df.columns and left.count() == sum(stays(f) for f, _ in rows)


def test_other_thresholds_need_no_text(ledger):
    _, _, led = ledger
    other = rejudge(led, [Rule("few_words", "n_words < 2"), Rule("none", "n_lines = 0")])
    assert apply_policy(other, Policy("x", ("few_words",))).where("kept").count() == led.where("n_words >= 2").count()
    with pytest.raises(ValueError, match="symbols"):
        apply_policy(other, DEFAULT)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    led = build_ledger(df)
    assert led.count() == 0 and filter_documents(df, led, DEFAULT).count() == 0
    assert ablations(led, DEFAULT).count() == 0


def test_clean_prose_stays(spark):
    rnd = random.Random(8)
    df = spark.createDataFrame([(i, prose(rnd, 60 + i)) for i in range(50)], "doc_id long, text string")
    assert apply_policy(build_ledger(df), DEFAULT).where(~F.col("kept")).count() == 0
