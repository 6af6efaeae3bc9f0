from __future__ import annotations

import random

from tabforge.llm import components as module
from tabforge.llm.components import components

from .helpers import Roots, broadcast_rows


def test_random_graph_and_long_chain(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(40)] + [(7, None), (5, 5)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    roots = Roots({x for e in edges if None not in e for x in e})
    linked = [e for e in edges if None not in e and e[0] != e[1]]
    for a, b in linked:
        roots.join(a, b)
    assert got == {x: roots.find(x) for e in linked for x in e if roots.find(x) != x}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_many_edges_do_not_pass_the_driver(spark, monkeypatch):
    frames = []

    def kept(df, name, real=module.stage):
        frames.append(df)
        return real(df, name)

    monkeypatch.setattr(module, "stage", kept)
    monkeypatch.setattr(module, "LIGHT_EDGES", 10, raising=False)
    edges = [(100 * c + i, 100 * c + i + 1) for c in range(5) for i in range(50)]
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {(r.node, r.component) for r in got} == {(b, b - b % 100) for _, b in edges}
    assert len(frames) > 1
    for df in frames:
        df.collect()
        assert broadcast_rows(df._jdf.queryExecution().executedPlan()) == 0
