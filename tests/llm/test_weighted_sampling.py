from __future__ import annotations

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from tabforge.llm.weighted_sampling import edited_fingerprints, likeness, signatures

from .helpers import ODD_TEXTS, prose, words


def jaccard(a, b):
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_documents(spark):
    rnd = random.Random(8)
    rows = [(i, prose(rnd, rnd.randrange(1, 120), 60)) for i in range(80)]
    rows += [(200 + i, t) for i, t in enumerate(ODD_TEXTS)] + [rows[0], (None, "no id here"), (7, "another text of 7")]
    docs = spark.createDataFrame([(i, t, 1, "a") for i, t in rows], "doc_id long, text string, w int, tail string")
    got = edited_fingerprints(docs).collect()
    assert len(got) == len(rows)
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows if i not in (7,)})
    texts = [t for _, _, t in order]
    by = {r.edited_sha256: r for r in got}
    errors = []
    for k, (has, i, t) in enumerate(order):
        if not has or i in (6, 7, 8):
            continue  # ties of doc_id 7 go by content hash
        nxt = texts[(k + 1) % len(texts)]
        m = len(t) // 4
        edited = t[:len(t) - m] + nxt[:m]
        r = by[hashlib.sha256(edited.encode()).hexdigest()]
        assert r.n_chars == len(t)
        if words(t) and words(edited):
            errors.append(r.near_edited - jaccard(words(t), words(edited)))
        else:
            assert r.near_edited == (1.0 if not words(t) and not words(edited) else 0.0)
    assert abs(sum(errors) / len(errors)) < 0.03
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.09
    prints = {}
    for r in got:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[205 + 0] == {f for f in prints[205]}  # one print per text
    assert all(len(f) in (0, 512) for s in prints.values() for f in s)
    assert edited_fingerprints(docs.limit(0)).count() == 0


def test_collision_rate_is_generalised_jaccard(spark):
    """2,000 draws for known weighted sets: the share of equal samples is the similarity."""
    a = {f"t{i}": 1 + i % 5 for i in range(30)}
    b = {f"t{i}": 1 + (i * 3) % 7 for i in range(10, 40)}
    rows = [(1, t, a.get(t, 0), b.get(t, 0)) for t in sorted({*a, *b})]
    terms = spark.createDataFrame(rows, "k long, t string, w long, e long").withColumn("h", F.xxhash64("t"))
    one = signatures(terms, ["k"], ["w", "e"], samples=2000).select(likeness(F.col("w"), F.col("e")).alias("x")).first().x
    true = sum(min(a.get(t, 0), b.get(t, 0)) for t in {*a, *b}) / sum(max(a.get(t, 0), b.get(t, 0)) for t in {*a, *b})
    assert abs(one - true) < 0.035
