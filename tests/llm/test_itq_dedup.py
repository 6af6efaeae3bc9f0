from __future__ import annotations

import numpy as np
import pytest

from tabforge.llm import itq_dedup
from tabforge.llm.itq_dedup import alike, near_vectors, parts_for, rounded, sign_codes, tables

from .helpers import Roots, broadcast_rows


def brute(rows, threshold=0.9):
    good = [(k, i, np.array(v, np.float64)) for k, (i, v) in enumerate(rows)
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    roots, links = Roots(range(len(rows))), [0] * len(rows)
    for x, (k, _, u) in enumerate(good):
        for m, _, v in good[:x]:
            if len(u) == len(v):
                a, b = u / np.abs(u).max(), v / np.abs(v).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[k] += 1
                    links[m] += 1
                    roots.join(k, m)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = roots.find(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return sorted(((i, links[k], least[roots.find(k)]) for k, (i, _) in enumerate(rows)), key=str)


def test_odd_vectors_and_copies(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((20, 8))
    rows = [(int(i), [float(x) for x in b + 0.05 * rng.standard_normal(8)]) for i, b in enumerate(np.repeat(base, 3, 0))]
    rows += [(100, None), (101, []), (102, [0.0] * 8), (103, [float("nan")] * 8), (104, [float("inf")] + [1.0] * 7), (105, [None] * 8),
             (106, rows[0][1]), (0, rows[0][1]), (None, rows[0][1]), (107, [1e200 * x for x in rows[0][1]]),
             (108, [1e-200 * x for x in rows[0][1]]), (109, [1.0, 2.0]), (110, [1.0, 2.1]), (111, [0.0] * 8)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rep int, component int")
    got = near_vectors(df, chunks=4, chunk_bits=8).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_empty_and_unlinkable(spark):
    shape = "vec_id long, embedding array<float>"
    assert near_vectors(spark.createDataFrame([], shape)).count() == 0
    assert [tuple(r) for r in near_vectors(spark.createDataFrame([(1, None)], shape)).collect()] == [(1, 0, 1, True)]


def test_recall_near_the_threshold(spark):
    """Pairs between cosine 0.9 and 0.95: at least 0.9 of them are found, none below 0.9."""
    rng = np.random.default_rng(9)
    base = rng.standard_normal((500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    noise = rng.standard_normal((500, 64))
    noise -= (noise * base).sum(1, keepdims=True) * base
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    cos = rng.uniform(0.88, 0.95, (500, 1))
    other = cos * base + np.sqrt(1 - cos**2) * noise
    rows = [(2 * i + k, [float(x) for x in v]) for i, pair in enumerate(zip(base, other, strict=True)) for k, v in enumerate(pair)]
    got = {r.vec_id: r.n_links for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    true = sum(1 for c in cos[:, 0] if c >= 0.9)
    found = sum(got[2 * i] for i in range(500))
    assert found <= true
    assert found >= 0.9 * true


def linked_at(spark, monkeypatch, bits, recall):
    """Whether two near vectors link whose codes differ in ``bits`` bits, none of the first chunk."""
    monkeypatch.setattr(itq_dedup, "learn_rotation", lambda sample, n, centre: (np.zeros(64), np.eye(64)))
    monkeypatch.setattr(itq_dedup, "recall_at", lambda *args: recall)
    rows = [(k, [1.0] * (64 - bits) + [s * 0.01] * bits) for k, s in ((1, 1), (2, -1))]
    return [r.n_links for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()] == [1, 1]


def test_radius_holds_22_bits(spark, monkeypatch):
    assert linked_at(spark, monkeypatch, 22, 1.0)


def test_low_recall_after_the_fallback_widens_the_radius(spark, monkeypatch):
    assert linked_at(spark, monkeypatch, 40, 0.0)


def test_filed_codes_do_not_pass_the_driver(spark, monkeypatch):
    """The joins for links broadcast fewer rows than there are vectors, those after it fewer than links, whatever Spark estimates."""
    frames = {}

    def kept(df, name, real=itq_dedup.stage):
        frames[name] = df
        return real(df, name)

    monkeypatch.setattr(itq_dedup, "stage", kept)
    rng = np.random.default_rng(5)
    units = np.repeat(rng.standard_normal((100, 64)), 10, 0) + 0.1 * rng.standard_normal((1000, 64))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(units)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert {r.n_links for r in got.collect()} == {9}
    links = frames["vec-links"]
    assert len(links.collect()) == 4500
    assert broadcast_rows(links._jdf.queryExecution().executedPlan()) < 1000
    assert broadcast_rows(got._jdf.queryExecution().executedPlan()) < 4500


def pairs_of(codes, units, chunks, width, threshold, radius):
    out = set()
    for b in range(len(units)):
        apart = codes[:b] ^ codes[b]
        near = np.zeros(b, bool)
        for t in range(chunks):
            near |= np.bitwise_count((apart >> np.uint64(t * width)) & np.uint64((1 << width) - 1)) <= 2
        near &= (np.bitwise_count(apart) <= radius) & (units[:b] @ units[b] >= threshold)
        out |= {(int(a), b) for a in np.flatnonzero(near)}
    return out


@pytest.mark.parametrize("width", [2, 8, 16])
@pytest.mark.parametrize("parts", [3, 4, 5, 6])
def test_tables_hold_each_near_pair_once(monkeypatch, parts, width):
    """All pairs of chunk distance 2 or less, each from one table, also in many blocks and tiles."""
    monkeypatch.setattr(itq_dedup, "TILE", 7)
    rng = np.random.default_rng(parts)
    units = np.repeat(rng.standard_normal((40, 24)), 5, 0) + 0.3 * rng.standard_normal((200, 24))
    units[:60] = np.eye(24)[rng.integers(0, 24, 60)] + 0.3 * rng.standard_normal((60, 24)) ** 5
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    codes = sign_codes(units, np.zeros(24), rng.standard_normal((24, 4 * width)))
    scale, small, rest = rounded(units)
    vectors = (scale[:, None] * small).astype(np.float32)
    found, of = [], tables(4, width, parts)
    for at, (_, same) in enumerate(of):
        key, block = codes & np.uint64(same), np.arange(len(units)) % 3
        for k in np.unique(key):
            for lo, hi in ((i, j) for j in range(3) for i in range(j + 1)):
                first = np.flatnonzero((key == k) & (block == lo))
                second = first if lo == hi else np.flatnonzero((key == k) & (block == hi))
                for x, y in alike(codes, vectors, rest, first, second, at, of, 0.8, 2 * width):
                    found += [tuple(sorted(p)) for p in zip(x.tolist(), y.tolist(), strict=True)]
    true = pairs_of(codes, units, 4, width, 0.8, 2 * width)
    assert len(found) == len(set(found))
    assert true <= set(found)
    assert len(true) > 100
    assert all(units[a] @ units[b] >= 0.8 - 2.1 * rest.max() - 0.01 for a, b in found)


def test_large_buckets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(itq_dedup, "BLOCK", 16)
    rng = np.random.default_rng(6)
    units = np.repeat(rng.standard_normal((4, 16)), 40, 0) + 0.05 * rng.standard_normal((160, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(units)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got.collect()), key=str) == brute(rows)


def test_buckets_stay_bounded():
    sizes = [10, 10**5, 10**6, 3 * 10**6]
    assert [parts_for(n, 16) for n in sizes] == [3, 3, 4, 5]
    assert parts_for(10**9, 16) == itq_dedup.MOST_PARTS
