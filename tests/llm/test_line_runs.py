from __future__ import annotations

import random
from collections import Counter

from tabforge.llm.line_runs import drop_common_lines

from .helpers import ODD_TEXTS, ascii_lower

WHITE = " \t\n\x0b\x0c\r"


def brute(rows, min_docs, min_chars=1):
    key = lambda line: ascii_lower(line.strip(WHITE))
    docs = {(i, t or "") for i, t in rows}
    count = Counter(k for _, t in docs for k in {key(x) for x in t.split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or count[key(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rnd = random.Random(4)
    pool = ["Common line", " common LINE\t", "license", "É kept", "é kept", "", "  "] + [f"line {i}" for i in range(30)]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randrange(0, 9)))) for i in range(60)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [rows[0], (None, "license"), (None, None), (3, "license\nother")]
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, n_lines int, row string, k1 string")
    for batches, fanout in ((4, 2), (3, 3), (1, 2)):
        got = drop_common_lines(df, min_docs=6, batches=batches, fanout=fanout)
        assert sorted([(r.row.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.collect()], key=str) == brute(rows, 6)
    assert got.select("row.*").columns == df.columns


def test_empty_table(spark):
    assert drop_common_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
