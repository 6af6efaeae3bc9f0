"""Connected components by alternating large-star and small-star rounds.

Edges live in written stages; each round is two grouped minima and two joins,
with no per-node adjacency list anywhere, so a node with millions of edges is
only a skewed join key (which Spark splits), never one task's list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Edges above which no side of a join is broadcast: compressed files make Spark take them for much smaller than they are.
LIGHT_EDGES = 100_000


def _star(pairs: DataFrame, light: bool) -> DataFrame:
    """(node, other) -> every other linked to the least id that ``node`` sees."""
    least = (pairs.groupBy("node").agg(F.min("other").alias("m"))
             .select("node", F.least("node", "m").alias("m")))
    return (pairs if light else pairs.hint("merge")).join(least, "node")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least id reachable; nodes without edges are absent.

    ``edges`` holds pairs of long ids in columns ``a`` and ``b``, in any order,
    repeated or not; pairs with a null or with equal ends are ignored.
    """
    cur = stage(edges.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other"))
                .where(f"{a} is not null and {b} is not null and {a} <> {b}").distinct(), "cc")
    light = cur.count() <= LIGHT_EDGES
    while not _is_star(cur):
        both = cur.unionByName(cur.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = _star(both, light).where("other > node").select(F.col("other").alias("node"), F.col("m").alias("other"))
        small = _star(large, light)
        nxt = (small.select(F.col("other").alias("node"), F.col("m").alias("other"))
               .unionByName(small.select("node", F.col("m").alias("other"))))
        cur = stage(nxt.where("node <> other").distinct(), "cc")
    return cur.select("node", F.col("other").alias("component"))


def _is_star(edges: DataFrame) -> bool:
    """True when every node has one edge, to an end that has none itself: its least reachable id."""
    ends = edges.select(F.col("node").alias("x"), F.lit(1).alias("out")).unionByName(
        edges.select(F.col("other").alias("x"), F.lit(0).alias("out")))
    seen = ends.groupBy("x").agg(F.sum("out").alias("outs"), F.count("*").alias("n"))
    return seen.where("outs > 1 or (outs = 1 and n > 1)").isEmpty()
