"""Lookups, global order without a
single-task window, and splits that are disjoint, exhaustive and exact."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.operators import lookup as D
from tabforge.operators import ordering as G
from tabforge.operators import split as K

from .conftest import rows


def test_dict_lookup_miss_and_null(spark):
    df = spark.createDataFrame([("Mr",), ("Mlle",), ("Col",), (None,)], "t string")
    got = [tuple(r) for r in df.select(D.dict_lookup("t", {"Mr": "Mr", "Mlle": "Miss"}),
                                       D.dict_lookup("t", {"Mr": "Mr"}, default="Rare"),
                                       D.replace_values("t", {"Col": "Colonel"})).collect()]
    assert got == [("Mr", "Mr", "Mr"), ("Miss", "Rare", "Mlle"), (None, "Rare", "Colonel"),
                   (None, "Rare", None)]


def test_first_per_key_and_table_lookup(spark):
    df = spark.createDataFrame([(3, "t1", "g3"), (1, "t1", "g1"), (2, "t2", "g2"), (4, None, "g4")],
                               "id int, ticket string, gid string")
    first = D.first_per_key(df, "ticket", "id", ["gid"])
    assert rows(first) == [("t1", "g1"), ("t2", "g2"), (None, "g4")]
    base = spark.createDataFrame([(10, "t1", "Alone"), (11, "t9", "Alone"), (12, "t2", "keep")],
                                 "id int, ticket string, gid string")
    out = D.table_lookup(base, first, "ticket", "gid", default=F.lit("Alone"),
                         when=F.col("gid") == "Alone")
    assert rows(out, "id", "gid") == [(10, "g1"), (11, "Alone"), (12, "keep")]


def test_keyed_update_duplicates_and_identity(spark):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], "k int, s string, v double")
    over = spark.createDataFrame([(1, "x", None), (1, "y", 9.0), (4, "z", 4.0)], "k int, s string, v double")
    out = D.keyed_update(base, over, "k", ["s", "v"])
    assert rows(out) == [(1, "y", 9.0), (2, "b", 2.0), (3, "c", 3.0)]   # no new rows, no dup rows
    empty = spark.createDataFrame([], "k int, s string, v double")
    assert rows(D.keyed_update(base, empty, "k", ["s", "v"])) == rows(base)


def test_semi_select_align_assign_truth(spark):
    df = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "k int, v int")
    keys = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert rows(D.select_keys(df, keys, "k")) == [(1, 5), (3, 7)]
    other = spark.createDataFrame([(1, 50), (3, 70)], "k int, w int")
    assert rows(D.align_assign(df, other, "k", {"w2": "w"})) == [(1, 5, 50), (2, 6, None), (3, 7, 70)]
    truth = spark.createDataFrame([(1, 5), (3, 0)], "k int, t int")
    assert rows(D.align_truth(df, truth, "k", "v", "t")) == [(1, 5, 5), (3, 7, 0)]


def test_global_prefix_many_ranges_matches_pandas(spark):
    data = [(i, (i * 37) % 11, float(i % 5)) for i in range(300)]
    df = spark.createDataFrame(data, "id int, a int, w double")
    out = G.global_prefix(df, [("a", False), ("id", True)], {"cw": F.col("w")}, ordinal="pos",
                          target_rows=40)
    got = {r["id"]: (r["pos"], r["cw"]) for r in out.collect()}
    pdf = pd.DataFrame(data, columns=["id", "a", "w"]).sort_values(["a", "id"], ascending=[False, True])
    pdf["pos"] = range(1, len(pdf) + 1)
    pdf["cw"] = pdf["w"].cumsum()
    for r in pdf.itertuples():
        assert got[r.id] == (r.pos, pytest.approx(r.cw))


def test_seeded_shuffle_is_a_permutation_and_stable(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    a = [r[0] for r in G.seeded_shuffle(df, "k", 1).collect()]
    b = [r[0] for r in G.seeded_shuffle(df, "k", 1).collect()]
    c = [r[0] for r in G.seeded_shuffle(df, "k", 2).collect()]
    assert a == b and a != c and sorted(a) == list(range(200))


def test_union_with_origin(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(2, 0.5)], "id int, f double")
    u = G.union_all([a, b], origin="part", labels=["train", "test"])
    assert rows(u, "id", "s", "f", "part") == [(1, "x", None, "train"), (2, None, 0.5, "test")]


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(i, ["a", "b", "c"][i % 3] if i < 240 else "d") for i in range(250)],
                                 "id int, s string")


def test_exact_and_stratified_holdout(people):
    out = K.exact_holdout(people, "id", 0.25, 7, target_rows=20)
    assert out.count() == 250 and out.where("split = 'test'").count() == 63   # floor(62.5 + .5)
    strat = K.exact_holdout(people, "id", 0.25, 7, by=["s"], target_rows=20)
    got = dict(rows(strat.where("split = 'test'").groupBy("s").count()))
    assert got == {"a": 20, "b": 20, "c": 20, "d": 3}       # round(80 * .25), round(10 * .25)


def test_null_stratum_is_a_stratum(spark):
    df = spark.createDataFrame([(i, None if i < 8 else "a") for i in range(16)], "id int, s string")
    out = K.exact_holdout(df, "id", 0.25, 1, by=["s"])
    got = dict(rows(out.where("split = 'test'").groupBy("s").count()))
    assert got == {None: 2, "a": 2}


def test_three_way_folds_positional(spark, people):
    t = K.three_way_split(people, "id", 0.2, 0.2, 3, target_rows=30)
    assert dict(rows(t.groupBy("split").count())) == {"test": 50, "valid": 50, "train": 150}
    f = K.kfold(people, "id", 4, 9, target_rows=30)
    sizes = sorted(r[1] for r in f.groupBy("fold").count().collect())
    assert sizes == [62, 62, 63, 63]
    sf = K.kfold(people, "id", 5, 9, by=["s"], target_rows=30)
    per = sf.groupBy("s", "fold").count().groupBy("s").agg(F.max("count") - F.min("count")).collect()
    assert all(r[1] <= 1 for r in per)
    o = G.row_ordinal(people, ["id"], "rn", target_rows=30)
    p = K.positional_split(o, "rn", 250, [("train", 0.75), ("valid", 0.05), ("test", 0.2)])
    assert dict(rows(p.groupBy("split").count())) == {"train": 187, "valid": 13, "test": 50}
    assert rows(p.where("split = 'valid'"), "id") == [(i,) for i in range(187, 200)]


def test_random_holdout_reproducible(people):
    a = rows(K.random_holdout(people, "id", 0.3, 1), "id", "split")
    assert a == rows(K.random_holdout(people, "id", 0.3, 1), "id", "split")
    n_test = sum(1 for _, s in a if s == "test")
    assert 40 < n_test < 110


def test_repeated_holdout_baseline(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(100)], "id int, y double")
    out = K.repeated_holdout_baseline(df, "id", "y", 5, 0.3)
    assert out.count() == 5 and out.where("mse is null").count() == 0


def test_ordinals_of_400k_rows_with_payload(spark):
    """Many ranges over real samples: every ordinal right, also with NULL keys, ties and payload columns."""
    n = 400_000
    df = spark.range(n).select(
        F.when(F.col("id") % 7 > 0, F.pmod(F.xxhash64("id"), F.lit(1000))).alias("a"), "id",
        F.concat(F.lit("p"), F.col("id")).alias("pay"), (F.col("id") * 0.5).alias("pay2"))
    out = G.global_prefix(df, [("a", False), ("id", True)], {"run": F.lit(1).cast("long")}, ordinal="pos")
    assert "_rb" not in out.columns and out.columns == [*df.columns, "run", "pos"]
    bad = out.select("a", "id", "pos", "run").toPandas()
    bad = bad.assign(na=bad["a"].isna()).sort_values(["na", "a", "id"], ascending=[True, False, True])
    assert (bad["pos"].to_numpy() == range(1, n + 1)).all() and (bad["run"] == bad["pos"]).all()
    only = G.row_ordinal(spark.range(n).select("id", F.lit("x").alias("pay")), ["id"])
    assert only.where("row_id <> id + 1").count() == 0 and only.count() == n
    same = G.row_ordinal(spark.range(200_000).select(F.lit(5).alias("k")), ["k"])
    assert same.select("row_id").distinct().count() == 200_000
