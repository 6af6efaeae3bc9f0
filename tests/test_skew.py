"""Skew: a sentinel group or NULL keys holding a third of all rows must not
land in one task of the join-back. Broadcasts are switched off so the join is
a shuffle join; rows per task are read with ``spark_partition_id()`` in the
join stage."""

import pytest
from pyspark.sql import functions as F

from tabforge.operators import groups as E
from tabforge.operators import lookup as D


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.enabled"]
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _max_task_share(df) -> float:
    """Largest share of rows in one output partition of the join stage."""
    sizes = df.rdd.glom().map(len).collect()
    return max(sizes) / sum(sizes)


def test_unsalted_join_would_concentrate(no_broadcast):
    df = _skewed(no_broadcast, "Alone")
    stats = df.where("key <> 'Alone'").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    assert _max_task_share(df.join(stats, "key", "left")) > 1 / 3   # what salting prevents


def _skewed(spark, hot):
    n = 24_000
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(
            F.concat(F.lit("g"), (F.col("id") % 97).cast("string"))).alias("key"),
        (F.col("id") % 7).cast("double").alias("v"))


def test_sentinel_group_is_spread(no_broadcast):
    df = _skewed(no_broadcast, "Alone")
    out = E.group_size(df, "key", "n", sentinel=("key", "Alone"))
    assert out.count() == 24_000
    assert _max_task_share(out) < 0.25          # unsalted: the 'Alone' task alone holds > 1/3
    sizes = {r["key"]: r["n"] for r in out.select("key", "n").distinct().collect()}
    assert sizes["Alone"] == 1 and sizes["g1"] == len(range(1, 24_000, 97)) - sum(
        1 for i in range(1, 24_000, 97) if i % 3 == 0)


def test_null_keys_are_spread(no_broadcast):
    df = _skewed(no_broadcast, None)
    out = E.group_size(df, "key", "n")
    assert out.where("key is null and n is not null").count() == 0
    assert _max_task_share(out) < 0.25


def test_lookup_skip_is_spread(no_broadcast):
    df = _skewed(no_broadcast, "Alone")
    table = df.where("key <> 'Alone'").groupBy("key").agg(F.avg("v").alias("rate"))
    out = D.table_lookup(df, table, "key", "rate", default=F.lit(-1.0), skip=F.col("key") == "Alone")
    assert out.where("key = 'Alone' and rate <> -1.0").count() == 0
    assert _max_task_share(out) < 0.25
