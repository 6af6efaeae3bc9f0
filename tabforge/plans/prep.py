"""SQL-checked queries over the driver tables: table, feature and split
operators (SURVEY sections 2.1-2.8, 2.11, 2.12).

Each entry is ``name -> (builder(spark, sf_dir) -> DataFrame, oracle SQL)``.
Every query reads whole tables; computed doubles are rounded to 6 places on
both sides, and every output column is aliased identically in the SQL.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import columns as C
from ..functions import text as T
from ..operators import boxcox as BC
from ..operators import encode as J
from ..operators import groups as E
from ..operators import knn as KNN
from ..operators import lookup as D
from ..operators import metrics as N
from ..operators import ordering as G
from ..operators import predict as P
from ..operators import quantiles as Q
from ..operators import split as K
from ..operators.ordering import seeded_hash_sql
from ..session import scratch_dir
from ..sources import files as IO
from ..sources.tables import pixels, table

QUERIES: dict[str, tuple] = {}


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def _tag(sf_dir: str) -> str:
    """Short stable tag of an input folder for scratch paths."""
    return f"{zlib.crc32(sf_dir.encode()):08x}"


def r6(c) -> F.Column:
    return F.round(C.col(c).cast("double"), 6)


# The category -> kind dictionary used by the rule queries.
SEGMENT_KIND = {"HOUSEHOLD": "Woman", "FURNITURE": "Woman", "AUTOMOBILE": "Boy",
                "BUILDING": "Man", "MACHINERY": "Man"}
# Fallback class rates by priority (the 'class survival' map).
PRIORITY_RATE = {"1-URGENT": 1.0, "2-HIGH": 1.0, "3-MEDIUM": 0.0,
                 "4-NOT SPECIFIED": 0.0, "5-LOW": 0.0}
HOLDOUT_SEED = 7
HOLDOUT_CUT = int(round(0.3 * G.HASH_P))


def _case_map(col: str, mapping: dict, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {col} = '{k}' THEN " + (f"'{v}'" if isinstance(v, str) else repr(v))
                    for k, v in mapping.items())
    return f"CASE {arms} ELSE {default} END"


# ---------------------------------------------------------------- flagship (entry)

def rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum end-to-end slice on orders + customer:
    lookup (D1), sentinel to NULL (B17), group-median fill (E7), composite
    group key (H6) with the 'Alone' sentinel (H7) and group sizes (E1),
    hash hold-out (K1), train-only group rates (E3/E4) mapped to the test
    part with a class fallback (D3), rule prediction (B15/P1) and a
    per-(kind, part) report with accuracy (N1)."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
              "o_orderpriority")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_acctbal", "c_mktsegment")
    df = (o.join(c, o.o_custkey == c.c_custkey, "inner")
          .withColumn("kind", D.dict_lookup("c_mktsegment", SEGMENT_KIND))
          .withColumn("label", (F.col("o_orderstatus") == "F").cast("int"))
          .withColumn("acct", C.sentinel_to_null(F.round(F.col("c_acctbal") / 1000), 0.0))
          .withColumn("part", F.when(F.expr(seeded_hash_sql("o_orderkey", HOLDOUT_SEED))
                                     < F.lit(HOLDOUT_CUT), "test").otherwise("train"))
          .select("o_orderkey", "o_custkey", "o_orderpriority", "kind", "label", "acct", "part"))
    # five passes follow (median statistics and values, group sizes, rates, report):
    # stage the joined, narrowed frame once instead of re-running the join each time
    df = IO.stage_table(df, scratch_dir(spark, f"rule_base_{_tag(sf_dir)}"))
    df = E.group_median_fill(df, ["kind"], ["acct"])
    df = df.withColumn("group_id", T.composite_key("o_custkey", "o_orderpriority"))
    df = E.group_size(df, "group_id", "group_size",
                      sentinel=None).withColumn(
        "group_id", T.sentinel_key("group_id", (F.col("kind") == "Man") | (F.col("group_size") == 1)))
    train = df.where(F.col("part") == "train")
    rates = E.group_rate(train, "group_id", "label", 1, name="rate",
                         exclude=F.col("group_id") == "Alone")
    df = D.table_lookup(df, rates, "group_id", "rate", out="rate",
                        skip=F.col("group_id") == "Alone")
    fallback = D.dict_lookup("o_orderpriority", PRIORITY_RATE)
    df = df.withColumn("rate", F.when(F.col("group_id") == "Alone",
                                      F.when(F.col("part") == "train", F.col("label").cast("double"))
                                      .otherwise(fallback))
                       .otherwise(F.coalesce(F.col("rate"), fallback)))
    df = P.group_rule_prediction(df, "kind", "group_id", "rate")
    return df.groupBy("kind", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("prediction").alias("predicted_1"),
        r6(F.avg((F.col("prediction") == F.col("label")).cast("double"))).alias("accuracy"),
        r6(F.avg("acct")).alias("avg_acct"))


RULE_SQL = f"""
WITH b AS (
  SELECT o_orderkey, o_custkey, o_orderpriority,
         {_case_map('c_mktsegment', SEGMENT_KIND)} AS kind,
         CAST(o_orderstatus = 'F' AS INTEGER) AS label,
         nullif(round(c_acctbal / 1000), 0.0) AS acct,
         CASE WHEN {seeded_hash_sql('o_orderkey', HOLDOUT_SEED)} < {HOLDOUT_CUT}
              THEN 'test' ELSE 'train' END AS part
  FROM orders JOIN customer ON o_custkey = c_custkey),
m AS (SELECT kind, median(acct) AS macct FROM b GROUP BY kind),
f AS (SELECT b.*, coalesce(acct, macct) AS acct_f,
             CAST(o_custkey AS VARCHAR) || '-' || o_orderpriority AS gid0
      FROM b LEFT JOIN m USING (kind)),
s AS (SELECT gid0, count(*) AS gsize FROM f GROUP BY gid0),
g AS (SELECT f.*, CASE WHEN kind = 'Man' OR gsize = 1 THEN 'Alone' ELSE gid0 END AS group_id
      FROM f LEFT JOIN s USING (gid0)),
r AS (SELECT group_id, count_if(label = 1) / count(*) AS rate
      FROM g WHERE part = 'train' AND group_id <> 'Alone' GROUP BY group_id),
x AS (SELECT g.*,
        CASE WHEN group_id = 'Alone' THEN
               CASE WHEN part = 'train' THEN CAST(label AS DOUBLE)
                    ELSE {_case_map('o_orderpriority', PRIORITY_RATE)} END
             ELSE coalesce(r.rate, {_case_map('o_orderpriority', PRIORITY_RATE)}) END AS rate2
      FROM g LEFT JOIN r USING (group_id)),
p AS (SELECT *, CASE WHEN kind = 'Boy' AND rate2 = 1 THEN 1
                     WHEN kind = 'Woman' AND group_id <> 'Alone' AND rate2 = 0 THEN 0
                     WHEN kind = 'Woman' THEN 1 ELSE 0 END AS prediction FROM x)
SELECT kind, part, count(*) AS n, CAST(sum(prediction) AS BIGINT) AS predicted_1,
       round(avg(CAST(prediction = label AS DOUBLE)), 6) AS accuracy,
       round(avg(acct_f), 6) AS avg_acct
FROM p GROUP BY kind, part
"""

query("q_rule_predict", RULE_SQL)(rule_report)


# ---------------------------------------------------------------- B: column derivations

@query("q_derive_ratio", """
SELECT l_orderkey, l_linenumber,
       l_quantity + l_linenumber + 1 AS family_size,
       l_extendedprice / nullif(l_quantity, 0) AS price_per_unit,
       l_extendedprice / nullif(l_discount, 0) AS price_per_discount,
       CAST(trunc(l_extendedprice / (l_quantity * 10)) AS INTEGER) AS per_head_int,
       CAST(round_even(l_extendedprice / 1000, 0) AS INTEGER) AS price_k_even,
       CASE WHEN ceil(l_quantity / 1.5) < 5.0 THEN ceil(l_quantity / 1.5) ELSE 5.0 END AS qty_cat,
       CAST(l_returnflag = 'R' AS INTEGER) AS is_returned
FROM lineitem""")
def q_derive_ratio(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity",
               "l_extendedprice", "l_discount", "l_returnflag")
    return li.select(
        "l_orderkey", "l_linenumber",
        C.family_size("l_quantity", "l_linenumber").alias("family_size"),
        C.safe_ratio("l_extendedprice", "l_quantity").alias("price_per_unit"),
        C.safe_ratio("l_extendedprice", "l_discount").alias("price_per_discount"),
        C.trunc_int(F.col("l_extendedprice") / (F.col("l_quantity") * 10)).alias("per_head_int"),
        C.round_half_even_int(F.col("l_extendedprice") / 1000).alias("price_k_even"),
        C.ceil_cap("l_quantity", 1.5, 5.0).alias("qty_cat"),
        C.indicator(F.col("l_returnflag") == "R").alias("is_returned"))


@query("q_group_median_impute", """
WITH b AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
                  nullif(l_discount, 0) AS d, nullif(l_tax, 0) AS t FROM lineitem),
m AS (SELECT l_returnflag, l_linestatus, median(d) AS md, median(t) AS mt FROM b GROUP BY ALL)
SELECT l_orderkey, l_linenumber, round(coalesce(d, md), 6) AS discount,
       round(coalesce(t, mt), 6) AS tax
FROM b LEFT JOIN m USING (l_returnflag, l_linestatus)""")
def q_group_median_impute(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag",
               "l_linestatus", "l_discount", "l_tax")
    b = li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
                  C.sentinel_to_null("l_discount").alias("discount"),
                  C.sentinel_to_null("l_tax").alias("tax"))
    out = E.group_median_fill(b, ["l_returnflag", "l_linestatus"], ["discount", "tax"])
    return out.select("l_orderkey", "l_linenumber", r6("discount").alias("discount"),
                      r6("tax").alias("tax"))


@query("q_group_quantiles", """
SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 6) AS p50,
       round(quantile_cont(l_extendedprice, 0.1), 6) AS p10,
       round(quantile_cont(l_extendedprice, 0.99), 6) AS p99
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_group_quantiles(spark, d):
    li = table(spark, d, "lineitem", "l_returnflag", "l_linestatus", "l_extendedprice")
    q = Q.group_quantiles(li, ["l_returnflag", "l_linestatus"], "l_extendedprice",
                          {"p50": 0.5, "p10": 0.1, "p99": 0.99})
    return q.select("l_returnflag", "l_linestatus", r6("p50").alias("p50"),
                    r6("p10").alias("p10"), r6("p99").alias("p99"))


@query("q_mode_fill", """
WITH b AS (SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS seg,
                  nullif(c_nationkey, 0) AS nat FROM customer),
ms AS (SELECT seg AS v FROM b WHERE seg IS NOT NULL GROUP BY seg ORDER BY count(*) DESC, seg LIMIT 1),
mn AS (SELECT nat AS v FROM b WHERE nat IS NOT NULL GROUP BY nat ORDER BY count(*) DESC, nat LIMIT 1)
SELECT c_custkey, coalesce(seg, (SELECT v FROM ms)) AS segment,
       coalesce(nat, (SELECT v FROM mn)) AS nation
FROM b""")
def q_mode_fill(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    b = c.select("c_custkey", C.sentinel_to_null("c_mktsegment", "MACHINERY").alias("segment"),
                 C.sentinel_to_null("c_nationkey", 0).alias("nation"))
    return E.fill_with_mode(b, ["segment", "nation"])


@query("q_global_impute", """
WITH b AS (SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount,
                  nullif(l_tax, 0) AS tax, nullif(l_returnflag, 'N') AS returnflag FROM lineitem),
md AS (SELECT median(discount) AS v FROM b),
mt AS (SELECT avg(tax) AS v FROM b),
mr AS (SELECT returnflag AS v FROM b WHERE returnflag IS NOT NULL GROUP BY returnflag
       ORDER BY count(*) DESC, returnflag LIMIT 1)
SELECT l_orderkey, l_linenumber, round(coalesce(discount, (SELECT v FROM md)), 6) AS discount,
       round(coalesce(tax, (SELECT v FROM mt)), 6) AS tax,
       coalesce(returnflag, (SELECT v FROM mr)) AS returnflag
FROM b""")
def q_global_impute(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_discount", "l_tax",
               "l_returnflag")
    b = li.select("l_orderkey", "l_linenumber", C.sentinel_to_null("l_discount").alias("discount"),
                  C.sentinel_to_null("l_tax").alias("tax"),
                  C.sentinel_to_null("l_returnflag", "N").alias("returnflag"))
    b = E.global_impute(b, ["discount", "returnflag"])           # E9: median / mode
    b = E.simple_impute(b, ["tax"], strategy="mean")             # E10: mean
    return b.select("l_orderkey", "l_linenumber", r6("discount").alias("discount"),
                    r6("tax").alias("tax"), "returnflag")


# Language code -> name lookup (D1); others become 'Rare'.
LANG_NAME = {"en": "English", "de": "German", "fr": "French"}


@query("q_title_extract", """
SELECT doc_id,
       regexp_extract(text, ' ([A-Za-z]+)\\.', 1) AS title,
       regexp_extract(text, '([A-Za-z]+),', 1) AS surname,
       CASE WHEN strpos(text, ',') > 0
            THEN trim(split_part(split_part(text, ',', 2), '.', 1)) END AS title_split,
       trim(split_part(text, ',', 1)) AS surname_split,
       coalesce(CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German'
                          WHEN 'fr' THEN 'French' END, 'Rare') AS language
FROM documents""")
def q_title_extract(spark, d):
    doc = table(spark, d, "documents", "doc_id", "text", "lang")
    return doc.select("doc_id", T.title("text").alias("title"), T.surname("text").alias("surname"),
                      T.title_by_split("text").alias("title_split"),
                      T.surname_by_split("text").alias("surname_split"),
                      D.dict_lookup("lang", LANG_NAME, default="Rare").alias("language"))


@query("q_name_parts", """
SELECT c_custkey, substring(c_name, 1, 1) AS initial,
       substring(c_name, 1, greatest(length(c_name) - 2, 0)) AS name_short,
       substring(c_mktsegment, 1, greatest(length(c_mktsegment) - 12, 0)) AS seg_short
FROM customer""")
def q_name_parts(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment")
    return c.select("c_custkey", T.first_char("c_name").alias("initial"),
                    T.drop_last("c_name", 2).alias("name_short"),
                    T.drop_last("c_mktsegment", 12).alias("seg_short"))


@query("q_composite_key", """
WITH b AS (SELECT o_orderkey, o_orderstatus,
                  CAST(o_custkey AS VARCHAR) || '-' || o_orderpriority || '-' ||
                  CAST(CAST(floor(o_totalprice / 100000) AS DOUBLE) AS VARCHAR) AS gid0 FROM orders),
s AS (SELECT gid0, count(*) AS n FROM b WHERE o_orderstatus <> 'F' GROUP BY gid0),
g AS (SELECT b.o_orderkey, b.o_orderstatus, b.gid0,
             CASE WHEN o_orderstatus = 'F' THEN 1 ELSE s.n END AS group_size
      FROM b LEFT JOIN s ON b.gid0 = s.gid0 AND b.o_orderstatus <> 'F')
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' OR group_size = 1 THEN 'Alone' ELSE gid0 END AS group_id,
       CAST(group_size AS BIGINT) AS group_size
FROM g""")
def q_composite_key(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
              "o_totalprice")
    b = o.withColumn("gid0", T.composite_key(
        "o_custkey", "o_orderpriority", F.floor(F.col("o_totalprice") / 100000).cast("double")))
    # the 'F' rows form the sentinel group: excluded before grouping, size forced to 1
    b = b.withColumn("gkey", F.when(F.col("o_orderstatus") == "F", F.lit("Alone"))
                     .otherwise(F.col("gid0")))
    b = E.group_size(b, "gkey", "group_size", sentinel=("gkey", "Alone"))
    return b.select("o_orderkey",
                    T.sentinel_key("gid0", (F.col("o_orderstatus") == "F")
                                   | (F.col("group_size") == 1)).alias("group_id"),
                    "group_size")


@query("q_first_lookup", """
WITH f AS (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS p FROM orders GROUP BY o_custkey)
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN coalesce(f.p, 'none') ELSE c_mktsegment END AS label
FROM customer LEFT JOIN f ON c_custkey = f.o_custkey""")
def q_first_lookup(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, d, "customer", "c_custkey", "c_acctbal", "c_mktsegment")
    first = D.first_per_key(o, "o_custkey", "o_orderkey", ["o_orderpriority"]).withColumnRenamed(
        "o_custkey", "c_custkey")
    out = D.table_lookup(c.withColumn("label", F.col("c_mktsegment")), first, "c_custkey",
                         "o_orderpriority", out="label", default=F.lit("none"),
                         when=F.col("c_acctbal") > 0)
    return out.select("c_custkey", "label")


@query("q_group_rate_map", f"""
WITH b AS (SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
                  CASE WHEN {seeded_hash_sql('o_orderkey', HOLDOUT_SEED)} < {HOLDOUT_CUT}
                       THEN 'test' ELSE 'train' END AS part FROM orders),
r AS (SELECT o_custkey, count_if(y = 1) / count(*) AS rate, count(*) AS n
      FROM b WHERE part = 'train' GROUP BY o_custkey)
SELECT o_orderkey, part, round(coalesce(r.rate, {_case_map('o_orderpriority', PRIORITY_RATE)}), 6) AS rate,
       CAST(coalesce(r.n, 0) AS BIGINT) AS train_group_size
FROM b LEFT JOIN r USING (o_custkey)""")
def q_group_rate_map(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    b = K.random_holdout(o.withColumn("y", (F.col("o_orderstatus") == "F").cast("int")),
                         "o_orderkey", 0.3, HOLDOUT_SEED, out="part")
    rates = E.group_rate(b.where(F.col("part") == "train"), "o_custkey", "y", 1, name="rate")
    out = D.salted_left_join(b, rates, ["o_custkey"], spread=["o_orderkey"])     # one join brings both columns
    rate = F.coalesce("rate", D.dict_lookup("o_orderpriority", PRIORITY_RATE))
    return out.select("o_orderkey", "part", r6(rate).alias("rate"),
                      F.coalesce("rate_n", F.lit(0)).cast("long").alias("train_group_size"))


@query("q_leave_one_out", """
WITH b AS (SELECT event_id, user_id, event_type IN ('click', 'purchase') AS f,
                  CAST(event_type = 'purchase' AS DOUBLE) AS v FROM events),
g AS (SELECT user_id, count_if(f) AS n, sum(CASE WHEN f THEN v ELSE 0.0 END) AS s FROM b GROUP BY user_id),
x AS (SELECT event_id, CASE WHEN f THEN n - 1 ELSE n END AS cnt,
             CASE WHEN f THEN s - v ELSE s END AS sm FROM b JOIN g USING (user_id))
SELECT event_id, CAST(cnt AS BIGINT) AS loo_count, round(sm, 6) AS loo_sum,
       round(sm / nullif(cnt, 0), 6) AS loo_rate FROM x""")
def q_leave_one_out(spark, d):
    ev = table(spark, d, "events", "event_id", "user_id", "event_type")
    out = E.leave_one_out(ev, "user_id", F.col("event_type").isin("click", "purchase"),
                          (F.col("event_type") == "purchase").cast("double"))
    return out.select("event_id", F.col("loo_count").cast("long").alias("loo_count"),
                      r6("loo_sum").alias("loo_sum"), r6("loo_rate").alias("loo_rate"))


@query("q_update_override", """
WITH ov AS (SELECT l_orderkey AS o_orderkey, max(l_returnflag) AS status FROM lineitem
            WHERE l_returnflag = 'R' GROUP BY l_orderkey),
u AS (SELECT o.o_orderkey, coalesce(ov.status, o.o_orderstatus) AS status FROM orders o
      LEFT JOIN ov ON o.o_orderkey = ov.o_orderkey)
SELECT o_orderkey, CASE WHEN o_orderkey = 0 THEN 'X' WHEN o_orderkey = 1 THEN 'Y' ELSE status END AS status
FROM u""")
def q_update_override(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderstatus").withColumnRenamed(
        "o_orderstatus", "status")
    li = table(spark, d, "lineitem", "l_orderkey", "l_returnflag")
    ov = li.where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("status"))
    u = D.keyed_update(o, ov, "o_orderkey", ["status"])
    return u.select("o_orderkey", C.point_override("status", "o_orderkey", {0: "X", 1: "Y"})
                    .alias("status"))


def _corr_sql(cols):
    arms = []
    for a in cols:
        for b in cols:
            arms.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr "
                        f"FROM lineitem")
    return "\nUNION ALL\n".join(arms)


def q_corr_matrix(spark, d):
    li = table(spark, d, "lineitem", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    out = E.corr_long(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return out.select("col_a", "col_b", r6("corr").alias("corr"))


QUERIES["q_corr_matrix"] = (q_corr_matrix, _corr_sql(
    ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("q_crosstab", "SELECT o_orderstatus, " + ", ".join(
    f"count_if(o_orderpriority = '{p}') AS \"{p}\"" for p in PRIORITIES)
    + " FROM orders GROUP BY o_orderstatus")
def q_crosstab(spark, d):
    o = table(spark, d, "orders", "o_orderstatus", "o_orderpriority")
    return E.crosstab(o, "o_orderstatus", "o_orderpriority", PRIORITIES)


@query("q_histogram", """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin, count(*) AS n
      FROM events, s WHERE value IS NOT NULL GROUP BY ALL),
e AS (SELECT CAST(range AS INTEGER) AS bin, lo, hi FROM range(10), s)
SELECT e.bin, round(lo + e.bin * ((hi - lo) / 10), 6) AS lo, round(lo + (e.bin + 1) * ((hi - lo) / 10), 6) AS hi,
       coalesce(n, 0) AS n
FROM e LEFT JOIN b ON e.bin = b.bin""")
def q_histogram(spark, d):
    ev = table(spark, d, "events", "value")
    h = E.histogram(ev, "value", 10)
    return h.select("bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "n")


# ---------------------------------------------------------------- J: encoders and scalers

@query("q_label_encode", """
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS segment_code,
       CASE WHEN c_mktsegment = (SELECT min(c_mktsegment) FROM customer) THEN 1.0 ELSE 0.0 END AS segment_first,
       """ + ", ".join(f"CASE WHEN c_mktsegment = '{s}' THEN 1.0 ELSE 0.0 END AS \"seg_{s}\""
                       for s in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"])
       + " FROM customer")
def q_label_encode(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_mktsegment")
    enc, _ = J.label_encode(c, "c_mktsegment", "segment_code")
    enc = J.first_category_indicator(enc, "c_mktsegment", "segment_first")
    enc = J.one_hot_columns(enc, "c_mktsegment", prefix="seg_")
    return enc.drop("c_mktsegment")


@query("q_label_decode", """
SELECT c_custkey, c_mktsegment AS segment_back FROM customer""")
def q_label_decode(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_mktsegment")
    enc, model = J.label_encode(c, "c_mktsegment", "code")
    return J.label_decode(enc, "code", "segment_back", model).select("c_custkey", "segment_back")


@query("q_standard_scale", """
WITH s AS (SELECT avg(p_retailprice) AS mp, stddev_pop(p_retailprice) AS sp,
                  avg(p_size) AS ms, stddev_pop(p_size) AS ss FROM part WHERE p_size <= 25),
m AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part)
SELECT p_partkey, round((p_retailprice - mp) / sp, 6) AS price_std, round((p_size - ms) / ss, 6) AS size_std,
       round((p_retailprice - lo) / (hi - lo), 6) AS price_minmax
FROM part, s, m""")
def q_standard_scale(spark, d):
    p = table(spark, d, "part", "p_partkey", "p_retailprice", "p_size")
    train = p.where(F.col("p_size") <= 25)
    out = J.standard_scale(p, ["p_retailprice", "p_size"], fit_on=train, suffix="_std")
    out = J.minmax_scale(out, ["p_retailprice"], suffix="_mm")
    return out.select("p_partkey", r6("p_retailprice_std").alias("price_std"),
                      r6("p_size_std").alias("size_std"), r6("p_retailprice_mm").alias("price_minmax"))


@query("q_equal_bins", """
WITH s AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part),
b AS (SELECT p_partkey, CAST(least(greatest(ceil((p_retailprice - lo) / ((hi - lo) / 10)), 1), 10) AS INTEGER) AS bin,
             lo, hi FROM part, s)
SELECT p_partkey, bin,
       round(CASE WHEN bin = 1 THEN lo - (hi - lo) * 0.001 ELSE lo + (bin - 1) * ((hi - lo) / 10) END, 6) AS bin_lo,
       round(lo + bin * ((hi - lo) / 10), 6) AS bin_hi
FROM b""")
def q_equal_bins(spark, d):
    p = table(spark, d, "part", "p_partkey", "p_retailprice")
    out = J.equal_width_bins(p, "p_retailprice", 10, out="bin")
    return out.select("p_partkey", "bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"))


@query("q_quantile_bins", """
WITH q AS (SELECT quantile_cont(value, 1/3) AS c1, quantile_cont(value, 2/3) AS c2 FROM events)
SELECT event_id, CASE WHEN value <= c1 THEN 0 WHEN value <= c2 THEN 1 ELSE 2 END AS qbin,
       CASE WHEN value <= c1 THEN 1.0 ELSE 0.0 END AS qbin_0,
       CASE WHEN value > c1 AND value <= c2 THEN 1.0 ELSE 0.0 END AS qbin_1,
       CASE WHEN value > c2 THEN 1.0 ELSE 0.0 END AS qbin_2,
       CASE WHEN value > 6 THEN 1.0 ELSE 0.0 END AS over_6
FROM events, q""")
def q_quantile_bins(spark, d):
    ev = table(spark, d, "events", "event_id", "value")
    out = J.quantile_bins(ev, "value", 3, out="qbin")
    return out.withColumn("over_6", J.binarize("value", 6.0)).drop("value")


@query("q_binarize_two", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS status_code FROM orders""")
def q_binarize_two(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderstatus").withColumn(
        "status2", F.when(F.col("o_orderstatus") == "F", "F").otherwise("other"))
    enc, _ = J.label_encode(o, "status2", "status_code")
    return enc.select("o_orderkey", "status_code")


@query("q_pool_fit", """
WITH pool AS (SELECT c_acctbal AS bal FROM customer UNION ALL SELECT s_acctbal FROM supplier),
s AS (SELECT avg(bal) AS m, stddev_pop(bal) AS sd FROM pool)
SELECT 'customer' AS origin, c_custkey AS id, round((c_acctbal - m) / sd, 6) AS bal_std FROM customer, s
UNION ALL
SELECT 'supplier', s_suppkey, round((s_acctbal - m) / sd, 6) FROM supplier, s""")
def q_pool_fit(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_acctbal").select(
        F.lit("customer").alias("origin"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"))
    s = table(spark, d, "supplier", "s_suppkey", "s_acctbal").select(
        F.lit("supplier").alias("origin"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal"))
    pooled = G.union_all([c, s])
    scaler = J.StandardScale(["bal"], suffix="_std").fit(pooled)          # J14: fit on the pool
    fn = J.FunctionTransformer(lambda df: df.withColumn("bal_std", r6("bal_std")))  # J13
    return fn.transform(scaler.transform(pooled)).select("origin", "id", "bal_std")


@query("q_boxcox_fixed", """
SELECT event_id, CASE WHEN value > 0 THEN round((power(value, 0.5) - 1) / 0.5, 6) END AS bc_half,
       CASE WHEN value + 1 > 0 THEN round(ln(value + 1), 6) END AS bc_log1p FROM events""")
def q_boxcox_fixed(spark, d):
    ev = table(spark, d, "events", "event_id", "value")
    return ev.select("event_id", r6(BC.boxcox_expr("value", 0.5)).alias("bc_half"),
                     r6(BC.boxcox_expr("value", 0.0, shift=1.0)).alias("bc_log1p"))


# ---------------------------------------------------------------- G / B: rows and order

@query("q_concat_origin", """
WITH u AS (SELECT 0 AS src, 'customer' AS origin, c_custkey AS id, c_name AS name, c_nationkey AS nationkey,
                  c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
           UNION ALL
           SELECT 1, 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier)
SELECT origin, id, name, nationkey, acctbal, segment,
       CAST(row_number() OVER (ORDER BY src, id) AS BIGINT) AS row_id FROM u""")
def q_concat_origin(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    s = table(spark, d, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    c = c.toDF("id", "name", "nationkey", "acctbal", "segment")
    s = s.toDF("id", "name", "nationkey", "acctbal")
    u = G.union_all([c, s], origin="origin", labels=["customer", "supplier"])
    u = u.withColumn("src", F.when(F.col("origin") == "customer", 0).otherwise(1))
    return G.row_ordinal(u, ["src", "id"], "row_id").drop("src")


@query("q_dropna_split", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount <> 0 THEN 'train' ELSE 'predict' END AS part
FROM lineitem WHERE l_tax <> 0""")
def q_dropna_split(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_discount", "l_tax")
    b = li.select("l_orderkey", "l_linenumber", C.sentinel_to_null("l_discount").alias("disc"),
                  C.sentinel_to_null("l_tax").alias("tax")).dropna(subset=["tax"])   # B23
    return b.select("l_orderkey", "l_linenumber",                                  # B22
                    F.when(F.col("disc").isNotNull(), "train").otherwise("predict").alias("part"))


@query("q_dropna_any", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_tax <> 0 AND l_discount <> 0""")
def q_dropna_any(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return li.select("l_orderkey", "l_linenumber", C.sentinel_to_null("l_discount").alias("a"),
                     C.sentinel_to_null("l_tax").alias("b")).dropna().drop("a", "b")


def _strat_sql(stratum: str, ratio: float, seed: int) -> str:
    return f"""
WITH b AS (SELECT c_custkey, {stratum} AS s, {seeded_hash_sql('c_custkey', seed)} AS h FROM customer),
r AS (SELECT c_custkey, row_number() OVER (PARTITION BY s ORDER BY h, c_custkey) AS rn,
             count(*) OVER (PARTITION BY s) AS n FROM b)
SELECT c_custkey, CASE WHEN rn <= floor(n * {ratio} + 0.5) THEN 'test' ELSE 'train' END AS split FROM r"""


@query("q_stratified_split", _strat_sql("c_mktsegment", 0.25, 42))
def q_stratified_split(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_mktsegment")
    return K.exact_holdout(c, "c_custkey", 0.25, 42, by=["c_mktsegment"]).select("c_custkey", "split")


@query("q_income_strata_split", _strat_sql(
    "CASE WHEN ceil(c_acctbal / 1500.0) < 5.0 THEN ceil(c_acctbal / 1500.0) ELSE 5.0 END", 0.2, 42))
def q_income_strata_split(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_acctbal")
    b = c.withColumn("cat", C.ceil_cap("c_acctbal", 1500.0, 5.0))                    # K3
    return K.exact_holdout(b, "c_custkey", 0.2, 42, by=["cat"]).drop("cat").select("c_custkey", "split")


@query("q_three_way", f"""
WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY {seeded_hash_sql('c_custkey', 3)}, c_custkey) AS rn,
                  count(*) OVER () AS n FROM customer)
SELECT c_custkey, CASE WHEN rn <= floor(n * 0.2) THEN 'test' WHEN rn <= floor(n * 0.2) + floor(n * 0.2)
                       THEN 'valid' ELSE 'train' END AS split FROM r""")
def q_three_way(spark, d):
    c = table(spark, d, "customer", "c_custkey")
    return K.three_way_split(c, "c_custkey", 0.2, 0.2, 3)


@query("q_folds", f"""
WITH r AS (SELECT c_custkey, c_mktsegment,
                  row_number() OVER (ORDER BY {seeded_hash_sql('c_custkey', 5)}, c_custkey) AS rn,
                  row_number() OVER (PARTITION BY c_mktsegment ORDER BY {seeded_hash_sql('c_custkey', 5)}, c_custkey) AS srn
           FROM customer)
SELECT c_custkey, CAST((rn - 1) % 5 AS INTEGER) AS fold, CAST((srn - 1) % 5 AS INTEGER) AS strat_fold FROM r""")
def q_folds(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_mktsegment")
    f = K.kfold(c, "c_custkey", 5, 5)
    f = K.kfold(f, "c_custkey", 5, 5, by=["c_mktsegment"], out="strat_fold")
    return f.select("c_custkey", "fold", "strat_fold")


@query("q_positional_split", """
WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS rn, count(*) OVER () AS n FROM customer)
SELECT c_custkey, CAST(rn AS BIGINT) AS row_id,
       CASE WHEN rn <= CAST(floor(n * 0.75) AS BIGINT) THEN 'train'
            WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'valid' ELSE 'test' END AS split FROM r""")
def q_positional_split(spark, d):
    c = table(spark, d, "customer", "c_custkey")
    o = G.row_ordinal(c, ["c_custkey"], "row_id")
    n = c.count()
    return K.positional_split(o, "row_id", n, [("train", 0.75), ("valid", 0.05), ("test", 0.20)])


@query("q_repeat_holdout", "\nUNION ALL\n".join(f"""
SELECT {r} AS rep, round(avg(CASE WHEN t THEN (c_acctbal - m) * (c_acctbal - m) END), 6) AS mse,
       count_if(t) AS n_test
FROM (SELECT c_acctbal, {seeded_hash_sql('c_custkey', r)} < {int(round(0.3 * G.HASH_P))} AS t FROM customer) b,
     (SELECT avg(c_acctbal) AS m FROM customer
      WHERE NOT ({seeded_hash_sql('c_custkey', r)} < {int(round(0.3 * G.HASH_P))})) s""" for r in range(50)))
def q_repeat_holdout(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_acctbal")
    out = K.repeated_holdout_baseline(c, "c_custkey", "c_acctbal", 50, 0.3)
    return out.select("rep", r6("mse").alias("mse"), "n_test")


@query("q_sort_mixed", f"""
SELECT p_partkey,
       CAST(row_number() OVER (ORDER BY p_size, p_retailprice DESC, p_partkey) AS BIGINT) AS sort_pos,
       CAST(row_number() OVER (ORDER BY {seeded_hash_sql('p_partkey', 11)}, p_partkey) AS BIGINT) AS shuffle_pos
FROM part""")
def q_sort_mixed(spark, d):
    p = table(spark, d, "part", "p_partkey", "p_size", "p_retailprice")
    a = G.global_prefix(p, [("p_size", True), ("p_retailprice", False), ("p_partkey", True)],
                        ordinal="sort_pos")
    a = a.withColumn("_h", G.seeded_order_key("p_partkey", 11))
    a = G.global_prefix(a, [("_h", True), ("p_partkey", True)], ordinal="shuffle_pos")
    return a.select("p_partkey", "sort_pos", "shuffle_pos")


@query("q_reshape_columns", """
SELECT 0 AS flag, s_suppkey AS supplier_id, s_nationkey, s_acctbal AS label FROM supplier""")
def q_reshape_columns(spark, d):
    s = table(spark, d, "supplier")
    numeric = C.columns_of_type(s, ["bigint", "int", "double"], exclude=["s_suppkey"])  # B10
    b = s.select("s_suppkey", "s_name", *numeric)                                     # B6
    b = b.drop("s_name")                                                               # B7
    b = C.with_label_last(b, "s_acctbal")                                              # B8
    b = b.withColumnRenamed("s_suppkey", "supplier_id")                                # B9
    return C.insert_constant(b, "flag", 0, 0)                                          # B5


@query("q_fill_from_column", """
SELECT l.l_orderkey, l.l_linenumber, round(coalesce(nullif(l.l_tax, 0), l.l_discount), 6) AS tax_filled,
       round(o.o_totalprice, 6) AS order_total
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def q_fill_from_column(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_tax", "l_discount")
    o = table(spark, d, "orders", "o_orderkey", "o_totalprice").withColumnRenamed("o_orderkey", "l_orderkey")
    b = li.withColumn("tax_filled", r6(C.fill_from(C.sentinel_to_null("l_tax"), "l_discount")))  # B19
    b = D.align_assign(b, o, "l_orderkey", {"order_total": "o_totalprice"})                     # D5
    return b.select("l_orderkey", "l_linenumber", "tax_filled", r6("order_total").alias("order_total"))  # D6


@query("q_threshold_filter", """
SELECT o_orderkey, CASE WHEN ln(o_totalprice) / 13 > 0.9 THEN 1.0 ELSE 0.0 END AS high,
       round(sqrt(o_totalprice), 6) AS root, round(exp(o_totalprice / 1e5), 6) AS growth,
       CAST(ceil(o_totalprice / 1e5) AS BIGINT) AS bucket
FROM orders WHERE o_orderstatus = 'F'""")
def q_threshold_filter(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    return o.where(F.col("o_orderstatus") == "F").select(                              # B21
        "o_orderkey", C.threshold(F.ln("o_totalprice") / 13, 0.9).alias("high"),      # B20
        r6(F.sqrt("o_totalprice")).alias("root"), r6(F.exp(F.col("o_totalprice") / 1e5)).alias("growth"),
        F.ceil(F.col("o_totalprice") / 1e5).cast("long").alias("bucket"))            # H8


@query("q_semi_select", """
SELECT c_custkey, c_nationkey FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def q_semi_select(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_nationkey")
    o = table(spark, d, "orders", "o_custkey", "o_orderpriority")
    keys = o.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return D.select_keys(c, keys, "c_custkey")


@query("q_count_where", """
SELECT 'o_orderkey' AS "column", count(o_orderkey) AS n FROM orders WHERE o_totalprice > 250000
UNION ALL SELECT 'o_totalprice', count(o_totalprice) FROM orders WHERE o_totalprice > 250000
UNION ALL SELECT 'o_orderstatus', count(o_orderstatus) FROM orders WHERE o_totalprice > 250000""")
def q_count_where(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_totalprice", "o_orderstatus")
    return E.count_where(o, F.col("o_totalprice") > 250000)


@query("q_truth_join", """
WITH p AS (SELECT doc_id, 1 - quality AS prediction FROM labels)
SELECT round(avg(CAST(p.prediction = l.toxic AS DOUBLE)), 6) AS accuracy, count(*) AS n
FROM p JOIN labels l USING (doc_id)""")
def q_truth_join(spark, d):
    lab = table(spark, d, "labels", "doc_id", "quality", "toxic")
    pred = lab.select("doc_id", (F.lit(1) - F.col("quality")).alias("pred"))
    j = D.align_truth(pred, lab, "doc_id", "pred", "toxic")                            # D7
    return N.accuracy(j, "prediction", "truth").select(r6("accuracy").alias("accuracy"), "n")  # N1


@query("q_group_size_nullkey", """
WITH b AS (SELECT l_orderkey, l_linenumber, nullif(l_linenumber, 1) AS k FROM lineitem),
s AS (SELECT k, count(*) AS n FROM b WHERE k IS NOT NULL GROUP BY k)
SELECT l_orderkey, l_linenumber, s.n AS group_size FROM b LEFT JOIN s ON b.k = s.k""")
def q_group_size_nullkey(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber")
    b = li.withColumn("k", C.sentinel_to_null("l_linenumber", 1))
    return E.group_size(b, "k", "group_size").select("l_orderkey", "l_linenumber", "group_size")


@query("q_profile", """
SELECT 'l_orderkey' AS "column", 'bigint' AS dtype, count(l_orderkey) AS non_null FROM lineitem
UNION ALL SELECT 'l_quantity', 'double', count(l_quantity) FROM lineitem
UNION ALL SELECT 'l_returnflag', 'string', count(nullif(l_returnflag, 'N')) FROM lineitem""")
def q_profile(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_quantity", "l_returnflag").withColumn(
        "l_returnflag", C.sentinel_to_null("l_returnflag", "N"))
    return E.profile(li)


@query("q_reduce", """
SELECT round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std,
       min(l_quantity) AS lo, max(l_quantity) AS hi, max(l_linenumber) + 1 AS n_classes FROM lineitem""")
def q_reduce(spark, d):
    li = table(spark, d, "lineitem", "l_quantity", "l_linenumber")
    return li.agg(r6(F.avg("l_quantity")).alias("mean"), r6(F.stddev_pop("l_quantity")).alias("std"),
                  F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"),
                  (F.max("l_linenumber") + 1).alias("n_classes"))


# ---------------------------------------------------------------- N: metrics

@query("q_confusion", """
WITH c AS (SELECT quality AS truth, toxic AS pred, count(*) AS n FROM labels GROUP BY ALL),
g AS (SELECT a.v AS truth, b.v AS pred FROM (VALUES (0), (1)) a(v), (VALUES (0), (1)) b(v))
SELECT g.truth, g.pred, coalesce(c.n, 0) AS n,
       CASE WHEN g.truth = g.pred THEN 0 ELSE coalesce(c.n, 0) END AS n_off
FROM g LEFT JOIN c ON g.truth = c.truth AND g.pred = c.pred""")
def q_confusion(spark, d):
    lab = table(spark, d, "labels", "quality", "toxic")
    m = N.confusion(lab, "quality", "toxic")
    return m.withColumn("n_off", N.off_diagonal("truth", "pred", "n"))


@query("q_rmse", """
WITH m AS (SELECT o_orderpriority, avg(o_totalprice) AS p FROM orders GROUP BY ALL),
e AS (SELECT m.p - o.o_totalprice AS err, o.o_totalprice AS y FROM orders o JOIN m USING (o_orderpriority))
SELECT round(avg(err * err), 2) AS mse, round(sqrt(avg(err * err)), 6) AS rmse,
       round(1 - sum(err * err) / (var_pop(y) * count(y)), 6) AS r2 FROM e""")
def q_rmse(spark, d):
    o = table(spark, d, "orders", "o_orderpriority", "o_totalprice")
    pred = E.with_group_stats(o, "o_orderpriority", {"p": F.avg("o_totalprice")})
    e = N.regression_errors(pred, "p", "o_totalprice")
    return e.select(F.round("mse", 2).alias("mse"), r6("rmse").alias("rmse"), r6("r2").alias("r2"))


@query("q_roc", """
WITH per AS (SELECT value AS threshold, count_if(event_type = 'purchase') AS p,
                    count_if(event_type <> 'purchase') AS q FROM events GROUP BY value),
t AS (SELECT sum(p) AS P, sum(q) AS N FROM per),
c AS (SELECT threshold, sum(p) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(q) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS fp FROM per)
SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(tp / P, 6) AS tpr,
       round(fp / N, 6) AS fpr FROM c, t""")
def q_roc(spark, d):
    ev = table(spark, d, "events", "value", "event_type").withColumn(
        "y", (F.col("event_type") == "purchase").cast("int"))
    r = N.roc_points(ev, "value", "y")
    return r.select("threshold", "tp", "fp", r6("tpr").alias("tpr"), r6("fpr").alias("fpr"))


# ---------------------------------------------------------------- H / D8 / P2: arrays and vectors

def _checksum(arr) -> F.Column:
    """Position-weighted sum: a scalar that changes if any element moves."""
    return r6(F.aggregate(F.zip_with(arr, F.sequence(F.lit(1), F.size(arr)),
                                     lambda x, i: x * i), F.lit(0.0), lambda a, b: a + b))


CHECKSUM_SQL = "round(list_sum(list_transform(range(1, len({a}) + 1), lambda i: {a}[i] * i)), 6)"


@query("q_pixels_scan", f"""
SELECT vec_id AS id, label, len(embedding) AS n_pixels,
       {CHECKSUM_SQL.format(a='list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / 255.0)')} AS checksum
FROM embeddings""")
def q_pixels_scan(spark, d):
    px = pixels(spark, d)
    scaled = px.withColumn("pixels", A.scale("pixels", 255.0))                       # H13
    return scaled.select("id", "label", F.size("pixels").alias("n_pixels"),
                         _checksum(F.col("pixels")).alias("checksum"))


def _shift_sql(a: str, w: int, dr: int, dc: int) -> str:
    return (f"list_transform(range(0, {w * w}), lambda i: CASE WHEN (i // {w}) - ({dr}) >= 0 AND "
            f"(i // {w}) - ({dr}) < {w} AND (i % {w}) - ({dc}) >= 0 AND (i % {w}) - ({dc}) < {w} "
            f"THEN {a}[((i // {w}) - ({dr})) * {w} + (i % {w}) - ({dc}) + 1] ELSE 0.0 END)")


@query("q_shift_augment", "WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)\n"
       + "\nUNION ALL\n".join(
           f"SELECT vec_id AS id, label, '{n}' AS move, {CHECKSUM_SQL.format(a=src)} AS checksum FROM e"
           for n, src in [("none", "v")] + [(n, _shift_sql("v", 8, dr, dc)) for n, dr, dc in A.FOUR_SHIFTS]))
def q_shift_augment(spark, d):
    px = pixels(spark, d)
    orig = px.select("id", "label", F.lit("none").alias("move"), "pixels")
    moved = px.select("id", "label", F.explode(A.shifted_copies("pixels", 8)).alias("m")).select(
        "id", "label", F.col("m.move").alias("move"), F.col("m.pixels").alias("pixels"))
    both = orig.unionByName(moved)                                                   # H16 + G11
    return both.select("id", "label", "move", _checksum(F.col("pixels")).alias("checksum"))


@query("q_pad_reshape", f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT vec_id, list_transform(range(0, 144), lambda i: CASE WHEN (i // 12) - 2 >= 0 AND (i // 12) - 2 < 8
        AND (i % 12) - 2 >= 0 AND (i % 12) - 2 < 8 THEN v[((i // 12) - 2) * 8 + (i % 12) - 2 + 1] ELSE 0.0 END) AS pv,
        v FROM e)
SELECT vec_id AS id, len(pv) AS n_padded, {CHECKSUM_SQL.format(a='pv')} AS checksum,
       round(list_sum(v[9:16]), 6) AS row1_sum, round(1.0 + 0.0 * len(v), 6) AS bias
FROM p""")
def q_pad_reshape(spark, d):
    px = pixels(spark, d)
    padded = px.withColumn("pv", A.pad("pixels", 8, 2))                             # H15
    rows = A.reshape_rows("pixels", 8)                                              # H14
    back = A.flatten_rows(rows)
    with_bias = A.prepend_bias("pixels")                                            # H12
    return padded.select(
        "id", F.size("pv").alias("n_padded"), _checksum(F.col("pv")).alias("checksum"),
        r6(A.array_sum(F.get(rows, 1))).alias("row1_sum"),
        r6(F.when(F.size(back) == F.size("pixels"), F.get(with_bias, 0))).alias("bias"))


SOFTMAX_SQL = ("list_transform(list_transform({a}, lambda x: exp(x - list_max({a}))), "
               "lambda y: y / list_sum(list_transform({a}, lambda x: exp(x - list_max({a})))))")


#: Ten class scores from a vector of any length: score k sums the values k, k + 10, k + 20, ...
CLASS_SCORES_SQL = ("list_transform(range(0, 10), lambda k: list_sum(list_transform("
                    "range(CAST(k AS BIGINT) + 1, len({v}) + 1, 10), lambda i: {v}[i])))")


def class_scores(v):
    """The same in Spark: values of the vector by index modulo 10, summed in order."""
    return F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: F.aggregate(
        F.filter(v, lambda x, i: i % 10 == k), F.lit(0.0), lambda a, x: a + x))


@query("q_softmax_xent", """
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
e AS (SELECT vec_id, label, """ + CLASS_SCORES_SQL.format(v="v") + """ AS z FROM v),
p AS (SELECT vec_id, label, """ + SOFTMAX_SQL.format(a="z") + """ AS pr FROM e)
SELECT vec_id, CAST(list_position(pr, list_max(pr)) - 1 AS INTEGER) AS argmax,
       round(list_max(pr), 6) AS p_max, round(-ln(pr[label + 1] + 1e-10), 6) AS xent
FROM p""")
def q_softmax_xent(spark, d):
    e = table(spark, d, "embeddings", "vec_id", "embedding", "label")
    z = e.select("vec_id", "label", class_scores(A.to_double_array("embedding")).alias("z"))
    p = A.with_softmax(z, "z", "pr")
    return p.select("vec_id", A.argmax("pr").alias("argmax"), r6(F.array_max("pr")).alias("p_max"),
                    r6(A.cross_entropy_term("pr", "label")).alias("xent"))


@query("q_xent_mean", """
WITH v AS (SELECT label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
e AS (SELECT label, """ + CLASS_SCORES_SQL.format(v="v") + """ AS z FROM v),
p AS (SELECT label, """ + SOFTMAX_SQL.format(a="z") + """ AS pr FROM e)
SELECT round(avg(-ln(pr[label + 1] + 1e-10)), 6) AS xent, round(avg(CAST(
    list_position(pr, list_max(pr)) - 1 = label AS DOUBLE)), 6) AS accuracy FROM p""")
def q_xent_mean(spark, d):
    e = table(spark, d, "embeddings", "embedding", "label")
    z = e.select("label", class_scores(A.to_double_array("embedding")).alias("z"))
    p = A.with_softmax(z, "z", "pr")
    return p.agg(r6(F.avg(A.cross_entropy_term("pr", "label"))).alias("xent"),
                 r6(F.avg((A.argmax("pr") == F.col("label")).cast("double"))).alias("accuracy"))


@query("q_prob_ensemble", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
m AS (SELECT vec_id, k AS model, list_resize(v[k * 10 + 1: k * 10 + 10], 10, 0.0) AS z FROM e, range(0, 7) t(k)),
p AS (SELECT vec_id, model, """ + SOFTMAX_SQL.format(a="z") + """ AS pr FROM m),
c AS (SELECT vec_id, i - 1 AS cls, sum(pr[i]) AS score FROM p, range(1, 11) r(i) GROUP BY vec_id, i),
r AS (SELECT vec_id, cls, score, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, cls) AS rn FROM c)
SELECT vec_id, CAST(cls AS INTEGER) AS prediction, round(score, 6) AS prediction_score FROM r WHERE rn = 1""")
def q_prob_ensemble(spark, d):
    e = table(spark, d, "embeddings", "vec_id", "embedding")
    v = A.to_double_array("embedding")
    # seven "models": softmax over consecutive 10-value slices of all 64 values, the last filled with 0
    part = lambda k: F.slice(F.concat(F.slice(v, k * 10 + 1, 10), F.array_repeat(F.lit(0.0), 10)), 1, 10)
    long = e.select("vec_id", F.posexplode(F.array(*[part(k) for k in range(7)])).alias("model", "z"))
    out = P.ensemble_argmax(A.with_softmax(long, "z", "pr"), "vec_id", "pr", n_classes=10)
    return out.select("vec_id", "prediction", r6("prediction_score").alias("prediction_score"))


@query("q_knn_vote", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pairs AS (SELECT a.vec_id AS q, b.vec_id AS nb, b.label, list_distance(a.v, b.v) AS d
          FROM e a JOIN e b ON a.vec_id <> b.vec_id),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d, nb) AS rn FROM pairs) WHERE rn <= 5),
z AS (SELECT q, max(CAST(d = 0 AS INTEGER)) AS hz FROM top GROUP BY q),
vu AS (SELECT q, label, count(*) AS s FROM top GROUP BY q, label),
vw AS (SELECT top.q, label, sum(CASE WHEN hz = 1 THEN CAST(d = 0 AS DOUBLE) ELSE 1.0 / d END) AS s
       FROM top JOIN z USING (q) GROUP BY top.q, label),
bu AS (SELECT q, label FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, label) AS rn FROM vu) WHERE rn = 1),
bw AS (SELECT q, label FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, label) AS rn FROM vw) WHERE rn = 1)
SELECT bu.q AS vec_id, CAST(bu.label AS INTEGER) AS prediction, CAST(bw.label AS INTEGER) AS prediction_w
FROM bu JOIN bw USING (q)""")
def q_knn_vote(spark, d):
    e = table(spark, d, "embeddings", "vec_id", "embedding", "label")
    nb = KNN.knn_neighbours(e, e, 5, "vec_id", "embedding", "label", exclude_self=True)
    v = KNN.knn_votes(nb, {"prediction": "uniform", "prediction_w": "distance"})
    return v.select(F.col("query_id").alias("vec_id"),
                                           F.col("prediction").cast("int").alias("prediction"),
                                           F.col("prediction_w").cast("int").alias("prediction_w"))


# ---------------------------------------------------------------- A: files

@query("q_csv_roundtrip", """
SELECT n_nationkey, n_name, n_regionkey FROM nation""")
def q_csv_roundtrip(spark, d):
    base = scratch_dir(spark, f"csv_roundtrip_{_tag(d)}")
    nat = table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    IO.write_csv(nat, f"{base}/nation")                                                # A6
    IO.write_keyed_csv(nat, f"{base}/keyed", "n_nationkey", "n_regionkey", "Survived")  # A7
    scores = nat.groupBy("n_regionkey").agg(F.avg("n_nationkey").alias("mean"),
                                             F.stddev_pop("n_nationkey").alias("std")).select(
        F.concat(F.lit("region "), F.col("n_regionkey").cast("string")).alias("name"), "mean", "std")
    IO.write_score_lines(scores, f"{base}/scores")                                     # A8
    back = IO.read_csv(spark, f"{base}/nation", schema="n_nationkey INT, n_name STRING, n_regionkey INT")  # A2
    keyed = IO.read_csv(spark, f"{base}/keyed", overrides={"Survived": "int"})         # A1 inferred
    return back.join(keyed.select(F.col("n_nationkey").cast("int").alias("n_nationkey"),
                                  F.col("Survived").alias("n_regionkey")), on=["n_nationkey", "n_regionkey"])


@query("q_csv_capped", """
SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 100""")
def q_csv_capped(spark, d):
    base = scratch_dir(spark, f"csv_capped_{_tag(d)}")
    o = table(spark, d, "orders", "o_orderkey", "o_orderstatus")
    IO.write_csv(o, f"{base}/orders")
    return IO.read_csv_head(spark, f"{base}/orders", 100, "o_orderkey",
                            schema="o_orderkey BIGINT, o_orderstatus STRING")          # A3


@query("q_materialize", """
SELECT p_type, count(*) AS n, round(avg(p_retailprice), 6) AS avg_price FROM part GROUP BY p_type""")
def q_materialize(spark, d):
    # the copy is keyed by its input files: their names, sizes and times
    path = scratch_dir(spark, f"materialized_part_by_type_{_tag(d)}")
    p = table(spark, d, "part", "p_type", "p_retailprice")
    builder = lambda: p.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"),
                                              r6(F.avg("p_retailprice")).alias("avg_price"))
    seen = IO.source_fingerprint(p)
    IO.materialize(spark, path, builder, fingerprint=seen)            # first call builds (or reuses)
    return IO.materialize(spark, path, builder, fingerprint=seen)     # second call reuses
