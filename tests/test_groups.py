"""Group statistics on frames with NULL keys, all-NULL groups,
single-row groups, ties and empty input; exact quantiles against NumPy."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabforge.operators import groups as E
from tabforge.operators import quantiles as Q

from .conftest import rows

PEOPLE = [
    (1, "a", "x", 1, 10.0), (2, "a", "x", 0, None), (3, "a", "y", 1, 30.0),
    (4, "b", "x", 1, None), (5, "b", "x", 0, None),   # group b/x: all NULL
    (6, "c", "z", 0, 5.0),                            # single-row group
    (7, None, "x", 1, 7.0),                           # NULL key
]
SCHEMA = "id int, g string, h string, y int, v double"


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, SCHEMA)


def test_group_size_null_key_and_sentinel(people):
    out = E.group_size(people, "g", "n")
    assert rows(out, "id", "n") == [(1, 3), (2, 3), (3, 3), (4, 2), (5, 2), (6, 1), (7, None)]
    out = E.group_size(people.withColumn("g", F.coalesce("g", F.lit("Alone"))), "g", "n",
                       sentinel=("g", "Alone"))
    assert dict(rows(out, "id", "n"))[7] == 1


def test_count_if_rate_and_loo(people):
    out = E.group_count_if(people, "g", F.col("y") == 1, "k")
    assert dict(rows(out, "id", "k")) == {1: 2, 2: 2, 3: 2, 4: 1, 5: 1, 6: 0, 7: None}
    rate = E.group_rate(people, "g", "y", 1)
    assert rows(rate.where("g = 'a'"), "rate") == [(2 / 3,)]
    loo = E.leave_one_out(people, "g", F.col("h") == "x", "y")
    got = {r["id"]: (r["loo_count"], r["loo_sum"], r["loo_rate"]) for r in loo.collect()}
    assert got[1] == (1, 0.0, 0.0)          # flagged: group a/x has 2, minus itself
    assert got[3] == (2, 1.0, 0.5)          # not flagged: full figures
    assert got[6] == (0, 0.0, None)         # zero denominator -> NULL


def test_group_median_fill_all_null_group_stays_null(people):
    out = E.group_median_fill(people, ["g", "h"], ["v"])
    got = dict(rows(out, "id", "v"))
    assert got[2] == 10.0 and got[4] is None and got[5] is None and got[6] == 5.0
    out = E.group_median_fill(people, ["g"], ["v"])
    assert dict(rows(out, "id", "v"))[2] == 20.0   # median of 10, 30


def test_mode_tie_lowest_and_empty(spark):
    df = spark.createDataFrame([("S",), ("C",), ("S",), ("C",), ("Q",), (None,)], "e string")
    assert E.mode_value(df, "e").first()["mode"] == "C"
    assert E.fill_with_mode(df, ["e"]).where("e is null").count() == 0
    empty = spark.createDataFrame([], "e string")
    assert E.mode_value(empty, "e").count() == 0
    assert E.fill_with_mode(empty, ["e"]).count() == 0


def test_simple_impute_strategies(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (10.0,), (11.0,), (None,)], "x double")
    med = E.simple_impute(df, ["x"], "median").where("x not in (1,3,10,11)").first()[0]
    assert med == 6.5                       # interpolated, not an element of the data
    assert E.simple_impute(df, ["x"], "mean").agg(F.sum("x")).first()[0] == pytest.approx(31.25)
    assert E.simple_impute(df, ["x"], "constant", 0.0).where("x = 0").count() == 1
    g = E.global_impute(spark.createDataFrame([(1, "a"), (None, "a"), (3, None)], "n int, s string"))
    assert rows(g) == [(1, "a"), (2, "a"), (3, "a")]


def test_corr_crosstab_histogram_profile(spark):
    df = spark.createDataFrame([(1.0, 2.0, "x", "p"), (2.0, 4.0, "y", "p"), (3.0, None, "x", "q"),
                                (4.0, 8.5, "x", "q")], "a double, b double, r string, c string")
    corr = {(r[0], r[1]): r[2] for r in E.corr_long(df, ["a", "b"]).collect()}
    exp = np.corrcoef([1, 2, 4], [2, 4, 8.5])[0, 1]
    assert corr[("a", "b")] == pytest.approx(exp) and corr[("a", "a")] == pytest.approx(1.0)
    ct = {r["r"]: (r["p"], r["q"], r["s"]) for r in E.crosstab(df, "r", "c", ["p", "q", "s"]).collect()}
    assert ct == {"x": (1, 2, 0), "y": (1, 0, 0)}
    h = rows(E.histogram(df, "a", 3), "bin", "n")
    assert h == [(0, 1), (1, 1), (2, 2)]    # the maximum lands in the last bin
    prof = {r["column"]: (r["dtype"], r["non_null"]) for r in E.profile(df).collect()}
    assert prof["b"] == ("double", 3)
    cw = dict(rows(E.count_where(df, F.col("a") > 1), "column", "n"))
    assert cw == {"a": 3, "b": 2, "r": 3, "c": 3}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60),
       st.sampled_from([0.0, 0.25, 0.5, 1 / 3, 0.9, 1.0]))
def test_quantile_refinement_matches_numpy(spark, values, p):
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "g int, x double")
    got = {r["g"]: r["q"] for r in Q.group_quantiles(df, ["g"], "x", {"q": p}, max_exact=4,
                                                     bins=4).collect()}
    for g in {i % 3 for i in range(len(values))}:
        exp = np.quantile([v for i, v in enumerate(values) if i % 3 == g], p)
        assert got[g] == pytest.approx(exp, rel=1e-9, abs=1e-9)


def test_quantile_skips_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert Q.group_quantiles(df, [], "x", {"m": 0.5}).first()["m"] == 2.0


def test_quantile_heavy_duplicates_and_global(spark):
    vals = [1.0] * 50 + [2.0] * 3 + [1e9]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = Q.group_quantiles(df, [], "x", {"m": 0.5, "q": 0.99}, max_exact=2, bins=2).first()
    assert r["m"] == 1.0 and r["q"] == pytest.approx(np.quantile(vals, 0.99))
    assert Q.global_cuts(df, "x", [1 / 3, 2 / 3], max_exact=2) == [1.0, 1.0]


def test_quantile_approx_switch(spark):
    vals = [float(i) for i in range(1001)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = Q.group_quantiles(df, [], "x", {"m": 0.5}, approx_accuracy=10_000).first()
    assert abs(r["m"] - 500.0) <= 1.0


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "x double")
    got = [(r["bin"], r["n"]) for r in E.histogram(df, "x", 10).orderBy("bin").collect()]
    assert got == [(0, 1), (1, 1), *[(i, 0) for i in range(2, 9)], (9, 1)]
