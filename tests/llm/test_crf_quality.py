from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tabforge.llm.crf_quality import fit_field, fold_of, line_features, marginals, score, train

from .helpers import ODD_TEXTS, prose


def make(rnd, good):
    lines = []
    for _ in range(rnd.randrange(1, 8)):
        if good or rnd.random() < 0.2:
            lines.append(prose(rnd, rnd.randrange(5, 20)).capitalize() + ".")
        else:
            lines.append(rnd.choice([" | ".join(prose(rnd, 6).split()), prose(rnd, 5).upper() + "!!", "$$$ " * 5]))
    return "\n".join(lines)


def test_marginals_against_all_label_sequences():
    rng = np.random.default_rng(1)
    n_lines = np.array([3, 1, 4, 2])
    unary, trans = rng.standard_normal(10), rng.standard_normal((2, 2))
    good, pairs, total = marginals(unary, trans, n_lines)
    at, expect, z_all, pair_all = 0, [], 0.0, np.zeros((2, 2))
    for n in n_lines:
        u, z, m, pr = unary[at:at + n], 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            p = np.exp(sum(u[i] * y[i] for i in range(n)) + sum(trans[y[i], y[i + 1]] for i in range(n - 1)))
            z += p
            m += p * np.array(y)
            for i in range(n - 1):
                pr[y[i], y[i + 1]] += p
        expect += list(m / z)
        pair_all += pr / z
        z_all += np.log(z)
        at += n
    assert np.allclose(good, expect) and np.allclose(pairs, pair_all) and np.isclose(total, z_all)


def test_held_out_accuracy_and_odd_rows(spark):
    rnd = random.Random(2)
    rows = [(i, make(rnd, i % 3 > 0), i % 3 > 0) for i in range(600)]
    odd = [(1000 + i, t, None) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id", None), rows[0]]
    docs = spark.createDataFrame([(i, t, "c") for i, t, _ in rows + odd], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(g)) for i, _, g in rows] + [(1003, None), (None, 1), (5000, 0), (0, 0)], "doc_id long, quality int")
    field = train(docs, labels)
    got = score(docs, field)
    assert got.select("row.*").columns == docs.columns
    out = got.select("row.doc_id", "score", (fold_of(F.col("row.doc_id")) == 1).alias("held")).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in out)
    true = {i: g for i, _, g in rows}
    held = [r for r in out if r.held and r.doc_id in true]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held) and len(held) > 100
    assert np.mean([(r.score >= 0.5) == true[r.doc_id] for r in held]) >= 0.9


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    assert train(docs, none) is None
    assert [r.score for r in score(docs, None).collect()] == [0.5, 0.5]
    x, chars, n = line_features(["good line.", "| bad |"])
    field = fit_field(x, chars, n, np.array([1, 0]), steps=5)
    assert score(docs.limit(0), field).count() == 0
