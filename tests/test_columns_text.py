"""B and H1-H7: row-local expressions on handwritten rows with edge cases."""

from pyspark.sql import functions as F

from tabforge.functions import columns as C
from tabforge.functions import text as T

from .conftest import rows


def test_ratios_and_zero_denominators(spark):
    df = spark.createDataFrame([(1, 10.0, 2.0), (2, 5.0, 0.0), (3, None, 4.0)], "id int, a double, b double")
    out = C.ratio_features(df, {"r": ("a", "b")}, optional={"r2": ("b", "a")}, add_optional=False)
    assert "r2" not in out.columns
    assert rows(out, "id", "r") == [(1, 5.0), (2, None), (3, None)]
    out = C.ratio_features(df, {"r": ("a", "b")}, optional={"r2": ("b", "a")})
    assert rows(out, "id", "r2") == [(1, 0.2), (2, 0.0), (3, None)]


def test_casts_and_rounding(spark):
    df = spark.createDataFrame([(2.9,), (-2.9,), (2.5,), (3.5,), (None,)], "x double")
    got = df.select(C.trunc_int("x").alias("t"), C.round_half_even_int("x").alias("r")).collect()
    assert [tuple(r) for r in got] == [(2, 3), (-2, -3), (2, 2), (3, 4), (None, None)]


def test_ceil_cap_null_becomes_cap(spark):
    df = spark.createDataFrame([(1.0,), (4.6,), (30.0,), (None,)], "x double")
    got = [r[0] for r in df.select(C.ceil_cap("x", 1.5, 5.0)).collect()]
    assert got == [1.0, 4.0, 5.0, 5.0]


def test_indicator_threshold_and_rule_chain(spark):
    df = spark.createDataFrame([("Woman", 0.0), ("Woman", 1.0), ("Boy", 1.0), ("Man", None)],
                               "kind string, rate double")
    rule = C.rule_chain([(F.col("kind") == "Woman", 1), (F.col("rate") == 0, 0)], 0)
    got = [tuple(r) for r in df.select(rule, C.indicator(F.col("rate") > 0.5),
                                       C.threshold("rate", 0.5)).collect()]
    assert got == [(0, 0, 0.0), (1, 1, 1.0), (0, 1, 1.0), (0, 0, None)]


def test_point_override_and_fills(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 5.0), (3, None, None)], "k int, v string, x double")
    got = rows(df.select("k", C.point_override("v", "k", {1: "z"}).alias("v")))
    assert got == [(1, "z"), (2, "b"), (3, None)]
    filled = C.fill_constant(df, {"x": 0.0, "v": "?"})
    assert rows(filled, "k", "v", "x") == [(1, "a", 0.0), (2, "b", 5.0), (3, "?", 0.0)]
    got = rows(df.select("k", C.fill_from("x", F.col("k").cast("double")).alias("x")))
    assert got == [(1, 1.0), (2, 5.0), (3, 3.0)]


def test_sentinel_and_nan(spark):
    df = spark.createDataFrame([(0.0,), (7.25,), (float("nan"),)], "fare double")
    got = [r[0] for r in df.select(C.nan_to_null(C.sentinel_to_null("fare"))).collect()]
    assert got == [None, 7.25, None]


def test_insert_constant_position(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert C.insert_constant(df, "z", 0, 1).columns == ["a", "z", "b"]


NAMES = [("Braund, Mr. Owen Harris",), ("O'Dwyer, Miss. Ellen",), ("no comma here",),
         ("Lastname,Mrs Without period",), (None,)]


def test_title_and_surname_regex(spark):
    df = spark.createDataFrame(NAMES, "name string")
    got = [tuple(r) for r in df.select(T.title("name"), T.surname("name")).collect()]
    assert got == [("Mr", "Braund"), ("Miss", "Dwyer"), ("", ""), ("", "Lastname"), (None, None)]


def test_split_chain(spark):
    df = spark.createDataFrame(NAMES, "name string")
    got = [tuple(r) for r in df.select(T.title_by_split("name"), T.surname_by_split("name")).collect()]
    assert got == [("Mr", "Braund"), ("Miss", "O'Dwyer"), (None, "no comma here"),
                   ("Mrs Without period", "Lastname"), (None, None)]


def test_first_char_drop_last_and_keys(spark):
    df = spark.createDataFrame([("C85", 1, 7.25), ("A5", 2, None), ("7", 3, 8.05)],
                               "ticket string, k int, fare double")
    got = [tuple(r) for r in df.select(T.first_char("ticket"), T.drop_last("ticket", 2),
                                       T.composite_key("ticket", "k", "fare")).collect()]
    assert got == [("C", "C", "C85-1-7.25"), ("A", "", "A5-2-nan"), ("7", "", "7-3-8.05")]
    sk = df.select(T.sentinel_key("ticket", F.col("k") > 1)).collect()
    assert [r[0] for r in sk] == ["C85", "Alone", "Alone"]


def test_composite_key_prints_numbers_as_the_reference(spark):
    values = [1e7, 12345678.9, 1e-4, 0.00012345, 1e-5, 1.5e-7, 1e16, 1e22, -2.5e9, 0.1, 7.0, 1e15, -1e-4]
    df = spark.createDataFrame([(i, v, "s1E5") for i, v in enumerate(values)], "i int, v double, t string")
    got = [r[0] for r in df.orderBy("i").select(T.composite_key("v", "t")).collect()]
    assert got == [f"{v!r}-s1E5" for v in values]
