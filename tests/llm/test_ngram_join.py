from __future__ import annotations

import random

from pyspark.sql import functions as F

from tabforge.llm import ngram_join
from tabforge.llm.ngram_join import jaccard_components, prefix_size

from .helpers import ODD_TEXTS, Roots, prose, shingles


def brute(rows, percent=75):
    sets, roots = [shingles(t) for _, t in rows], Roots(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            k = len(a & sets[j])
            if k and 100 * k >= percent * (len(a) + len(sets[j]) - k):
                roots.join(i, j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(roots.find(i), []).append(d)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in least.items()}
    return sorted(((d, len(s), least[roots.find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def edit(rnd, text, times):
    w = text.split(" ")
    for _ in range(times):
        w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
    return " ".join(w)


def test_prefix_size():
    assert [prefix_size(n, 75) for n in (1, 2, 3, 4, 5, 8, 100)] == [1, 1, 1, 2, 2, 3, 26]


def test_against_brute_force(spark, monkeypatch):
    rnd = random.Random(11)
    passage = prose(rnd, 60)
    rows = []
    for _ in range(25):
        base = prose(rnd, rnd.choice([3, 6, 9, 20, 60, 150])) + (" " + passage if rnd.random() < 0.4 else "")
        for _ in range(rnd.randrange(1, 5)):
            rows.append((len(rows), edit(rnd, base, rnd.randrange(0, 5))))
    hub = prose(rnd, 100)
    rows += [(500 + i, edit(rnd, hub, i % 4)) for i in range(60)] + [(600 + i, rows[0][1].upper()) for i in range(5)]
    rows += [(700 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, hub), (None, "lone text without any id at all"), (3, hub), rows[1]]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, s int, n int")
    expect = brute(rows)
    assert sorted(map(tuple, jaccard_components(docs).collect()), key=str) == expect
    monkeypatch.setattr(ngram_join, "SALT_ROWS", 1)  # every frequent shingle is salted
    monkeypatch.setattr(ngram_join, "STAR_LEADERS", 1)
    assert sorted(map(tuple, jaccard_components(docs).collect()), key=str) == expect


def test_stars_only_guide(spark, monkeypatch):
    """Without a star all links come from the join of groups."""
    rnd = random.Random(5)
    hub = prose(rnd, 60)
    rows = [(i, edit(rnd, hub, i % 5)) for i in range(40)] + [(100 + i, prose(rnd, 30)) for i in range(5)]
    for name in ("_first_stars", "_list_stars"):
        monkeypatch.setattr(ngram_join, name, lambda shared, members, found, percent: members.select(F.col("s").alias("a"), F.col("s").alias("b")).limit(0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_components(docs).collect()), key=str) == brute(rows)


def test_very_long_text(spark):
    rnd = random.Random(6)
    long = prose(rnd, 60_000)
    rows = [(1, long), (2, edit(rnd, long, 500)), (3, edit(rnd, long, 40_000)), (4, "word " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_components(docs).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_batches_of_texts_make_the_sets_of_each_text(monkeypatch):
    """Sets of words hashed side by side, in blocks of any size: as many shingles as tuples of words, equal for equal words."""
    from tabforge.llm import ngram_join as J
    rng = random.Random(4)
    texts = ["", " \t\n", "a", "A b", "a\x0bB c\td\ne", "É é x y z é", "x " * 300, "q" * 5000 + " w", *(
        " ".join(rng.choice(["ab", "Ab", "ba", "c", "ccc", "中"]) for _ in range(rng.randrange(60))) for _ in range(200))]
    words = [[w.decode().translate({c: c + 32 for c in range(65, 91)}) for w in t.encode().split()] for t in texts]
    tuples = [{tuple(w[i:i + min(5, len(w))]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    sets = J.Shingler(5).sets(texts)
    assert [len(s) for s in sets] == [len(t) for t in tuples]
    assert all((s[1:] > s[:-1]).all() for s in sets)
    for i in range(len(texts)):
        for k in range(i):
            assert len(set(sets[i].tolist()) & set(sets[k].tolist())) == len(tuples[i] & tuples[k])
    monkeypatch.setattr(J, "BLOCK_BYTES", 7)
    assert [s.tolist() for s in J.Shingler(5).sets(texts)] == [s.tolist() for s in sets]
    assert [J.Shingler(5)(t).tolist() for t in texts] == [s.tolist() for s in sets]


def test_signatures_keep_unlike_sets_from_being_paired(spark):
    """Groups on one list whose signatures differ in too many bits make no pair; like ones do, as do groups of several sets."""
    import numpy as np

    from tabforge.llm import ngram_join as J
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 1 << 64, 100, dtype=np.uint64))
    near = np.sort(np.concatenate([base[5:], rng.integers(0, 1 << 64, 5, dtype=np.uint64)]))
    far = [np.unique(rng.integers(0, 1 << 64, 100, dtype=np.uint64)) for _ in range(20)]
    sets = [base, near, *far]
    differ = [sum(bin(int(x) & (1 << 64) - 1).count("1") for x in J.signature(base) ^ J.signature(s)) for s in sets]
    assert all(d <= len(np.setxor1d(base, s)) for d, s in zip(differ, sets, strict=True)) and differ[0] == 0
    members = spark.createDataFrame([(i, i, 100, J.band_keys(s).view(np.int64).tolist(), J.signature(s).tolist()) for i, s in enumerate(sets)]
                                    + [(1, 99, 100, [0], J.signature(far[0]).tolist())], "g long, s long, n long, bands array<long>, sign array<long>")
    shared = spark.createDataFrame([(t, i, 100, t) for i in range(len(sets)) for t in range(26)], "token long, g long, n long, pos int")
    found = spark.createDataFrame([], "node long, component long")
    made = {(r.a, r.b) for r in J._pairs_between(shared, members, found, 75).collect()}
    assert {p for p in made if 1 not in p and 99 not in p} == set()
    assert {(0, 1), (0, 99), (1, 2), (2, 99), (1, 99)} <= made     # group 1 holds two sets: no signature speaks for both
    alone = members.where("s <> 99")
    assert {(r.a, r.b) for r in J._pairs_between(shared, alone, found, 75).collect()} == {(0, 1)}


def _cluster(spark):
    """Near copies 1, 2 and 10 to 14, of which the latter are one component; 1, 2 and 12 are on every list, the others on ten."""
    import numpy as np

    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 64, 100, dtype=np.uint64)
    sets = {s: np.unique(np.concatenate([base[2:], rng.integers(0, 1 << 64, 2, dtype=np.uint64)])) for s in (1, 2, 10, 11, 12, 13, 14)}
    members = spark.createDataFrame([(s, s, 100, ngram_join.band_keys(x).view(np.int64).tolist(), ngram_join.signature(x).tolist()) for s, x in sets.items()],
                                    "g long, s long, n long, bands array<long>, sign array<long>")
    shared = spark.createDataFrame([(t, s, 100, t) for s in sets for t in range(26 if s in (1, 2, 12) else 10)], "token long, g long, n long, pos int")
    return shared, members, spark.createDataFrame([(s, 10) for s in range(11, 15)], "node long, component long")


def test_leaders_of_lists_are_of_the_largest_component_and_little_edited(spark):
    """A lone node of a lesser name is no leader; the member on the most lists is one."""
    made = {(r.a, r.b) for r in ngram_join._list_stars(*_cluster(spark), 75).collect()}
    assert {(1, 12), (2, 12)} <= made


def test_groups_on_too_few_lists_make_no_rows(spark):
    """Equal sizes of 100 need 86 in common, so 12 of 26 prefix shingles: groups on ten lists meet no other, though signatures would let them."""
    pairs = ngram_join._pairs_between(*_cluster(spark), 75)
    assert {(r.a, r.b) for r in pairs.collect()} == {(1, 2), (1, 12), (2, 12)}
    rows = []

    def walk(p):
        if "Adaptive" in p.nodeName():
            return walk(p.executedPlan())
        if "Join" in p.nodeName() and "[token" in p.simpleString(9):
            rows.append(p.metrics().get("numOutputRows").get().value())
        if "QueryStage" in p.nodeName():
            walk(p.plan())
        for i in range(p.children().size()):
            walk(p.children().apply(i))
    walk(pairs._jdf.queryExecution().executedPlan())
    assert rows == [3 * 26]
