"""SQL-checked queries for operators whose answer has a closed form: linear
models by normal equations, cross-validated errors, model-based imputation,
overrides, imputation strategies and small column operators.

Same conventions as ``prep``: whole tables, doubles rounded on both sides.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..models import boosting as B
from ..models import estimators as L
from ..models import gram as GR
from ..models import selection as M
from ..operators import groups as E
from ..operators import lookup as D
from ..operators import metrics as N
from ..operators import ordering as G
from ..operators import predict as P
from ..operators import split as K
from ..operators.ordering import seeded_hash_sql
from ..sources.tables import table
from .prep import SEGMENT_KIND, r6

QUERIES: dict[str, tuple] = {}


def query(name: str, sql: str):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def _centred_sums(label: str, features: list[str]) -> str:
    """SQL of the centred sums s_ij, t_i, the means and n over the rows of one group."""
    parts = [f"covar_pop({features[i]}, {features[j]}) * count(*) AS s{i + 1}{j + 1}" for i in range(3) for j in range(i, 3)]
    parts += [f"covar_pop({x}, {label}) * count(*) AS t{i + 1}" for i, x in enumerate(features)]
    parts += [f"avg({x}) AS m{i + 1}" for i, x in enumerate(features)] + [f"avg({label}) AS m0"]
    return ", ".join(parts)


def _solution(ridge: str = "0") -> str:
    """SQL of b1, b2, b3 from the sums (Cramer's rule), with ``ridge`` on the diagonal."""
    a, b, c = f"(s11 + {ridge})", "s12", "s13"
    d, e, f = f"(s22 + {ridge})", "s23", f"(s33 + {ridge})"
    det = f"({a} * ({d} * {f} - {e} * {e}) - {b} * ({b} * {f} - {e} * {c}) + {c} * ({b} * {e} - {d} * {c}))"
    return ", ".join([
        f"(t1 * ({d} * {f} - {e} * {e}) - {b} * (t2 * {f} - {e} * t3) + {c} * (t2 * {e} - {d} * t3)) / {det} AS b1",
        f"({a} * (t2 * {f} - {e} * t3) - t1 * ({b} * {f} - {e} * {c}) + {c} * ({b} * t3 - t2 * {c})) / {det} AS b2",
        f"({a} * ({d} * t3 - t2 * {e}) - {b} * ({b} * t3 - t2 * {c}) + t1 * ({b} * {e} - {d} * {c})) / {det} AS b3"])


# ---------------------------------------------------------------- L9, L10, M1, M9

@query("q_linear_closed", f"""
WITH s AS (SELECT {_centred_sums('l_extendedprice', LINE_FEATURES)} FROM lineitem),
f AS (SELECT 'ols' AS model, *, {_solution()} FROM s UNION ALL
      SELECT 'ridge' AS model, *, {_solution('1.0')} FROM s)
SELECT model, round(m0 - b1 * m1 - b2 * m2 - b3 * m3, 3) AS b0, round(b1, 3) AS b1, round(b2, 3) AS b2, round(b3, 3) AS b3
FROM f""")
def q_linear_closed(spark, d):
    g = GR.gram(table(spark, d, "lineitem", *LINE_FEATURES, "l_extendedprice"), LINE_FEATURES, "l_extendedprice")
    fits = {n: GR.SOLVERS[n](g, LINE_FEATURES) for n in ("ols", "ridge")}
    return spark.createDataFrame(
        [(n, *(round(float(x), 3) for x in (f.intercept, *f.coef))) for n, f in fits.items()],
        "model string, b0 double, b1 double, b2 double, b3 double")


_FOLD = f"CAST(({seeded_hash_sql('l_orderkey', 1)}) % 5 AS INTEGER)"


@query("q_cv_closed", f"""
WITH li AS (SELECT {', '.join(LINE_FEATURES)}, l_extendedprice, {_FOLD} AS fold FROM lineitem),
s AS (SELECT r.range AS out_fold, {_centred_sums('l_extendedprice', LINE_FEATURES)}
      FROM li JOIN range(5) r ON li.fold <> r.range GROUP BY r.range),
f AS (SELECT 'ols' AS model, *, {_solution()} FROM s UNION ALL
      SELECT 'ridge' AS model, *, {_solution('1.0')} FROM s),
v AS (SELECT model, fold, sqrt(avg(power(l_extendedprice - (m0 + b1 * (l_quantity - m1) + b2 * (l_discount - m2)
             + b3 * (l_tax - m3)), 2))) AS rmse
      FROM li JOIN f ON li.fold = f.out_fold GROUP BY model, fold)
SELECT model, fold, round(rmse, 4) AS rmse, round(avg(rmse) OVER w, 4) AS mean,
       round(stddev_pop(rmse) OVER w, 4) AS std, round(max(rmse) OVER w, 4) AS worst
FROM v WINDOW w AS (PARTITION BY model)""")
def q_cv_closed(spark, d):
    li = K.kfold(table(spark, d, "lineitem", "l_orderkey", *LINE_FEATURES, "l_extendedprice"), "l_orderkey", 5, 1, exact=False)
    scores = GR.cv_rmse(li, LINE_FEATURES, "l_extendedprice", "fold", ["ols", "ridge"])
    whole = scores.join(N.score_summary(scores, "rmse", ["model"]), "model")
    return whole.select("model", F.col("fold").cast("int").alias("fold"),
                        *[F.round(c, 4).alias(c) for c in ("rmse", "mean", "std", "worst")])


# With one feature every member of the linear family has a closed form in s (centred square sum), t and n: a soft
# threshold of t for the lasso, of t / sqrt(s) for the lasso on columns of unit length.
_ONE_FEATURE = {
    "ols": "t / s", "lars": "t / s", "omp": "t / s", "ridge": "t / (s + 1)",
    "lasso": "sign(t) * greatest(abs(t) - n, 0) / s", "multitask_lasso": "sign(t) * greatest(abs(t) - n, 0) / s",
    "elastic_net": "sign(t) * greatest(abs(t) - 0.5 * n, 0) / (s + 0.5 * n)",
    "multitask_elastic_net": "sign(t) * greatest(abs(t) - 0.5 * n, 0) / (s + 0.5 * n)",
    "lasso_lars": "sign(t) * greatest(abs(t) / sqrt(s) - n, 0) / sqrt(s)"}


@query("q_shortlist_closed", f"""
WITH li AS (SELECT l_quantity AS x, l_extendedprice / 100 AS y, {_FOLD} AS fold FROM lineitem),
s AS (SELECT r.range AS out_fold, var_pop(x) * count(*) AS s, covar_pop(x, y) * count(*) AS t, count(*) AS n,
             avg(x) AS mx, avg(y) AS my
      FROM li JOIN range(5) r ON li.fold <> r.range GROUP BY r.range),
f AS ({" UNION ALL ".join(f"SELECT '{m}' AS model, *, {w} AS w FROM s" for m, w in _ONE_FEATURE.items())}),
v AS (SELECT model, fold, sqrt(avg(power(y - my - w * (x - mx), 2))) AS rmse
      FROM li JOIN f ON li.fold = f.out_fold GROUP BY model, fold),
m AS (SELECT model, round(avg(rmse), 5) AS mean, round(stddev_pop(rmse), 5) AS std, round(max(rmse), 5) AS worst FROM v GROUP BY model)
SELECT *, row_number() OVER (ORDER BY mean, std DESC, model) AS place FROM m""")
def q_shortlist_closed(spark, d):
    """M3 on one feature: the linear family by five-fold RMSE, least mean first."""
    li = table(spark, d, "lineitem", "l_orderkey", "l_quantity", "l_extendedprice")
    li = K.kfold(li.withColumn("y", F.col("l_extendedprice") / 100), "l_orderkey", 5, 1, exact=False)
    scores = GR.cv_rmse(li, ["l_quantity"], "y", "fold", list(_ONE_FEATURE))
    mean = N.score_summary(scores, "rmse", ["model"]).select("model", *[F.round(c, 5).alias(c) for c in ("mean", "std", "worst")])
    # one row for each model
    return mean.withColumn("place", F.row_number().over(Window.orderBy("mean", F.col("std").desc(), "model")).cast("long"))


# The cuts are all values of a feature; a node's sums follow from one group-by, a cut's from a running sum.
_BOOST_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def _best_cut(cells: str, keys: str) -> str:
    return f"""
SELECT * FROM (
  SELECT *, power(greatest(abs(gl) - 0.5, 0), 2) / (hl + 2) + power(greatest(abs(gt - gl) - 0.5, 0), 2) / (ht - hl + 2)
            - power(greatest(abs(gt) - 0.5, 0), 2) / (ht + 2) AS gain
  FROM (SELECT {keys}, f, v, sum(g) OVER (PARTITION BY {keys}, f ORDER BY v) - g AS gl,
               sum(h) OVER (PARTITION BY {keys}, f ORDER BY v) - h AS hl,
               sum(g) OVER (PARTITION BY {keys}, f) AS gt, sum(h) OVER (PARTITION BY {keys}, f) AS ht FROM ({cells})))
WHERE hl >= 1 AND ht - hl >= 1
QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY gain DESC, f, v) = 1"""


def _cells(rows: str, keys: str) -> str:
    return " UNION ALL ".join(f"SELECT {keys}, {i} AS f, {c} AS v, sum(0.5 - y) AS g, CAST(count(*) AS DOUBLE) AS h "
                              f"FROM {rows} GROUP BY ALL" for i, c in enumerate(_BOOST_FEATURES))


def _leaf(g: str, h: str) -> str:
    return f"-0.3 * sign({g}) * greatest(abs({g}) - 0.5, 0) / ({h} + 2)"


@query("q_boost_tree", f"""
WITH li AS (SELECT 0 AS node, {', '.join(_BOOST_FEATURES)}, l_extendedprice / 1000 + 10 * l_quantity * (l_tax + l_discount) AS y FROM lineitem),
root AS ({_best_cut(_cells('li', 'node'), 'node')}),
sides AS (SELECT CASE WHEN CASE f WHEN 0 THEN l_quantity WHEN 1 THEN l_discount ELSE l_tax END < v THEN 1 ELSE 2 END AS node,
                 {', '.join(f'li.{c}' for c in _BOOST_FEATURES)}, y FROM li, root),
inner_ AS ({_best_cut(_cells('sides', 'node'), 'node')})
SELECT 'split' AS kind, node, f AS feature, round(v, 6) AS cut, round(gain / 1000, 2) AS gain, round({_leaf('gt', 'ht')}, 6) AS value
FROM (SELECT * FROM root UNION ALL SELECT * FROM inner_)
UNION ALL
SELECT 'leaf', 2 * node + 1, -1, 0, 0, round({_leaf('gl', 'hl')}, 6) FROM inner_
UNION ALL
SELECT 'leaf', 2 * node + 2, -1, 0, 0, round({_leaf('gt - gl', 'ht - hl')}, 6) FROM inner_""")
def q_boost_tree(spark, d):
    """L4: the first tree of a regularised booster (two levels, alpha 0.5, lambda 2), node by node."""
    li = table(spark, d, "lineitem", *_BOOST_FEATURES, "l_extendedprice").withColumn(
        "y", F.col("l_extendedprice") / 1000 + 10 * F.col("l_quantity") * (F.col("l_tax") + F.col("l_discount")))
    model = B.fit_boosted(li, _BOOST_FEATURES, "y", B.Params(n_estimators=1, max_depth=2, reg_alpha=0.5, reg_lambda=2.0))
    tree, rows, todo = model.rounds[0][0], [], [(0, 0)]
    while todo:
        at, number = todo.pop()
        inner = tree.left[at] >= 0
        rows.append(("split" if inner else "leaf", number, tree.feature[at], round(tree.cut[at], 6) if inner else 0.0,
                     round(tree.gain[at] / 1000, 2), round(tree.value[at], 6)))
        if inner:
            todo += [(tree.left[at], 2 * number + 1), (tree.right[at], 2 * number + 2)]
    return spark.createDataFrame(rows, "kind string, node int, feature int, cut double, gain double, value double")


_IMPUTE = ["l_quantity", "l_tax", "l_extendedprice"]


@query("q_impute_closed", f"""
WITH li AS (SELECT l_orderkey, l_linenumber, {', '.join(_IMPUTE)}, nullif(l_discount, 0) AS disc FROM lineitem),
s AS (SELECT {_centred_sums('disc', _IMPUTE)} FROM li WHERE disc IS NOT NULL),
f AS (SELECT *, {_solution()} FROM s)
SELECT l_orderkey, l_linenumber, round(disc, 6) AS disc,
       round(coalesce(disc, m0 + b1 * (l_quantity - m1) + b2 * (l_tax - m2) + b3 * (l_extendedprice - m3)), 6) AS disc_filled
FROM li, f""")
def q_impute_closed(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", *_IMPUTE, "l_discount")
    li = li.withColumn("disc", C.sentinel_to_null("l_discount")).drop("l_discount")
    features = VectorAssembler(inputCols=_IMPUTE, outputCol="features", handleInvalid="keep")
    out = M.model_impute(li, "disc", lambda known: Pipeline(stages=[features, L.linear("disc")]).fit(known), out="disc_filled")
    return out.select("l_orderkey", "l_linenumber", r6("disc").alias("disc"), r6("disc_filled").alias("disc_filled"))


# ---------------------------------------------------------------- P4: rows that the model must not touch

_KIND_SQL = "CASE " + " ".join(f"WHEN c_mktsegment = '{k}' THEN '{v}'" for k, v in SEGMENT_KIND.items()) + " END"


@query("q_override_rows", f"""
SELECT c_custkey, {_KIND_SQL} AS kind, true AS class_ok,
       CASE {_KIND_SQL} WHEN 'Woman' THEN 1.0 WHEN 'Man' THEN 0.0 END AS rule_prediction
FROM customer""")
def q_override_rows(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    c = c.withColumn("kind", D.dict_lookup("c_mktsegment", SEGMENT_KIND)).withColumn("label", (F.col("c_acctbal") > 4000).cast("double"))
    t = L.assemble(c.withColumn("c_nationkey", F.col("c_nationkey").cast("double")), ["c_nationkey", "c_acctbal"])
    rule = t.select("c_custkey", "kind", F.when(F.col("kind") == "Woman", 1.0).otherwise(0.0).alias("prediction"))
    boys = L.decision_tree("gini", 3).fit(t).transform(t.where(F.col("kind") == "Boy")).select("c_custkey", "prediction")
    out = P.override_predictions(rule, boys, "c_custkey", ["prediction"])
    return out.select("c_custkey", "kind", F.col("prediction").isin(0.0, 1.0).alias("class_ok"),
                      F.when(F.col("kind") != "Boy", F.col("prediction")).alias("rule_prediction"))


# ---------------------------------------------------------------- E3, E10, E15, B2, B18, D1, G2, G3, G8

@query("q_simple_impute", """
WITH li AS (SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS disc FROM lineitem),
s AS (SELECT quantile_cont(disc, 0.5) AS med, avg(disc) AS mean,
      (SELECT disc FROM li WHERE disc IS NOT NULL GROUP BY disc ORDER BY count(*) DESC, disc LIMIT 1) AS mode FROM li)
SELECT l_orderkey, l_linenumber, round(coalesce(disc, med), 6) AS by_median, round(coalesce(disc, mean), 6) AS by_mean,
       round(coalesce(disc, mode), 6) AS by_mode, round(coalesce(disc, -1.0), 6) AS by_constant
FROM li, s""")
def q_simple_impute(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_discount")
    names = {"by_median": "median", "by_mean": "mean", "by_mode": "most_frequent", "by_constant": "constant"}
    li = li.withColumns({n: C.sentinel_to_null("l_discount") for n in names}).drop("l_discount")
    for column, strategy in names.items():
        li = E.simple_impute(li, [column], strategy, fill_value=-1.0)
    return li.select("l_orderkey", "l_linenumber", *[r6(n).alias(n) for n in names])


@query("q_group_count_if", """
SELECT o_orderkey, count_if(o_totalprice > 100000) OVER (PARTITION BY o_custkey) AS n_large FROM orders""")
def q_group_count_if(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    return E.group_count_if(o, "o_custkey", F.col("o_totalprice") > 100000, "n_large").select("o_orderkey", "n_large")


@query("q_ratio_features", """
SELECT p_partkey, round(p_retailprice / nullif(p_size, 0), 6) AS price_per_size,
       round(p_size / nullif(p_retailprice, 0), 6) AS size_per_price,
       round(p_partkey / nullif(p_size - 1, 0), 6) AS key_per_size FROM part""")
def q_ratio_features(spark, d):
    p = table(spark, d, "part", "p_partkey", "p_retailprice", "p_size").withColumn("less", F.col("p_size") - 1)
    out = C.ratio_features(p, {"price_per_size": ("p_retailprice", "p_size"), "size_per_price": ("p_size", "p_retailprice")},
                           {"key_per_size": ("p_partkey", "less")}, add_optional=True)
    return out.select("p_partkey", *[r6(c).alias(c) for c in ("price_per_size", "size_per_price", "key_per_size")])


@query("q_replace_fill", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status,
       coalesce(nullif(o_orderpriority, '5-LOW'), 'none') AS priority FROM orders""")
def q_replace_fill(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    o = o.select("o_orderkey", D.replace_values("o_orderstatus", {"F": "done", "O": "open"}).alias("status"),
                 F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"))
    return C.fill_constant(o, {"priority": "none"})


@query("q_mean_std", """
SELECT l_returnflag, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std FROM lineitem GROUP BY l_returnflag""")
def q_mean_std(spark, d):
    out = E.mean_std(table(spark, d, "lineitem", "l_returnflag", "l_quantity"), "l_quantity", ["l_returnflag"])
    return out.select("l_returnflag", r6("mean").alias("mean"), r6("std").alias("std"))


@query("q_sort_concat", f"""
WITH u AS (SELECT 'c' AS origin, c_custkey AS id, c_acctbal AS bal FROM customer UNION ALL
           SELECT 's', s_suppkey, s_acctbal FROM supplier)
SELECT origin, id, row_number() OVER (ORDER BY origin DESC, bal, id) AS pos,
       row_number() OVER (ORDER BY {seeded_hash_sql('id', 3)}, id, origin) AS shuffled FROM u""")
def q_sort_concat(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_acctbal").toDF("id", "bal")
    s = table(spark, d, "supplier", "s_suppkey", "s_acctbal").toDF("id", "bal")
    u = G.union_all([c, s], "origin", ["c", "s"])
    u = G.global_prefix(u, [("origin", False), ("bal", True), ("id", True)], ordinal="pos")
    u = G.global_prefix(u.withColumn("h", G.seeded_order_key("id", 3)), ["h", "id", "origin"], ordinal="shuffled")
    return G.sort_mixed(u.select("origin", "id", "pos", "shuffled"), [("origin", False), ("pos", True)])
