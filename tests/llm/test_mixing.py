from __future__ import annotations

import random

import pytest

from tabforge.llm.mixing import cyclic_weights, fill_targets, mix, route


def test_fill_targets():
    assert fill_targets([100, 100], [1, 1], 150, 2) == [75, 75]
    assert fill_targets([10, 100], [3, 1], 165, 2) == [20, 145]
    assert fill_targets([0, 50], [1, 1], 75, 2) == [0, 75]
    assert sum(fill_targets([5, 7, 900, 40], [3, 1, 2, 3], 1.5 * 952, 2)) == pytest.approx(1.5 * 952)


def test_route_prefers_unused_words_and_fills_overlapping_quotas():
    # pattern 0 in source 0 only, 1 in both, 2 in source 1 only
    take = route([10, 10, 10], [[0], [0, 1], [1]], [20, 10], 2)
    assert sum(take) == 30 and max(take) <= 20
    assert take == [10, 10, 10]
    assert sum(route([10], [[0]], [25], 2)) == 20  # no more than twice


def test_route_costs_match_brute_force():
    rnd = random.Random(5)
    for _ in range(30):
        supply = [rnd.randrange(1, 4) for _ in range(3)]
        member = [rnd.sample([0, 1], rnd.choice([1, 2])) for _ in supply]
        quota = [rnd.randrange(0, 6), rnd.randrange(0, 6)]

        def feasible(take):
            # words that fit: max flow between two sources by trying all splits
            need = [0, 0]
            free = 0
            for t, m in zip(take, member, strict=True):
                if len(m) == 1:
                    need[m[0]] += t
                else:
                    free += t
            return need[0] <= quota[0] and need[1] <= quota[1] and free <= sum(quota) - sum(need)

        best = None
        for a in range(2 * supply[0] + 1):
            for b in range(2 * supply[1] + 1):
                for c in range(2 * supply[2] + 1):
                    t = (a, b, c)
                    if feasible(t):
                        cost = sum(max(0, x - s) for x, s in zip(t, supply, strict=True))
                        best = max(best or (-1, 0), (sum(t), -cost))
        got = route(supply, member, quota, 2)
        assert feasible(got)
        assert (sum(got), -sum(max(0, x - s) for x, s in zip(got, supply, strict=True))) == best


def test_mix_overlap_nulls_and_repeats(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([["a"], ["b"], ["a", "b"], [None], None]), rnd.randrange(0, 40)) for i in range(400)]
    rows += [(5, ["a"], 7), (5, ["a"], 7), (None, ["b"], 3)]
    df = spark.createDataFrame(rows, "doc_id long, sources array<string>, size long")
    got = mix(df, cyclic_weights).collect()
    assert len(got) == len(rows) and {r.copies for r in got} <= {0, 1, 2}
    assert sorted(mix(df, cyclic_weights).collect(), key=str) == sorted(got, key=str)
    total = sum(r[2] for r in rows)
    assert abs(sum(r.size * r.copies for r in got) - 1.5 * total) < 200
    assert mix(df.limit(0), cyclic_weights).count() == 0


def test_taken_comes_near_each_target(spark):
    rnd = random.Random(2)
    rows = [(i, ["big" if i % 3 else f"s{i % 7}"], rnd.randrange(1, 30)) for i in range(3000)]
    got = mix(spark.createDataFrame(rows, "doc_id long, sources array<string>, size long"), cyclic_weights).collect()
    taken, target = {}, {}
    for r in got:
        taken[r.sources[0]] = taken.get(r.sources[0], 0) + r.size * r.copies
        target[r.sources[0]] = r.stats[0].target
    assert all(abs(taken[s] - target[s]) <= 16 for s in taken)
