"""Mixing overlapping sources to target weights by min-cost flow.

1. Documents aggregate by membership pattern (the set of sources that hold
   them): one row per pattern with its words, a distributed sum.
2. On the driver, a min-cost flow routes words from patterns to source quotas.
   The k-th use of a pattern's words costs k - 1, a convex cost: nothing repeats
   while unused words of an admissible pattern are left. The network has one
   node per pattern and per source; the weights are configuration, one per
   source, so it is as small as that configuration.
3. A pattern that must supply w words out of s gives every document
   floor(w / s) times, and once more to the first documents of a seeded order
   whose words add up to the rest. The order is md5(seed, doc_id). Word totals
   per range of that order find the range where the rest runs out; only that
   one range is sorted, so no source is ever one task's list.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

#: Rows that one range of the seeded order holds on average.
RANGE_ROWS = 1000
MAX_RANGE_BITS = 16


def fill_targets(sizes: list[int], weights: list[float], budget: float, most: float) -> list[float]:
    """Share ``budget`` by weight; a share stops at ``most`` times its size and
    the excess is shared again by weight until none is above.

    Sources fill in the order of cap over weight, which is the order in which
    they reach their caps; equal ratios reach them together. Empty sources get 0.
    """
    order = sorted(range(len(sizes)), key=lambda i: most * sizes[i] / weights[i])
    out, left, weight = [0.0] * len(sizes), float(budget), float(sum(weights))
    for rank, i in enumerate(order):
        if most * sizes[i] / weights[i] <= left / weight:
            out[i] = float(most * sizes[i])
            left, weight = left - out[i], weight - weights[i]
        else:
            for j in order[rank:]:
                out[j] = left * weights[j] / weight
            break
    return out


def route(supply: list[int], member_of: list[list[int]], quota: list[int], most: int) -> list[int]:
    """Words to take from each pattern: least repetition cost among maximal flows.

    Successive cheapest paths with potentials. Arcs: start to pattern, once per
    repetition (capacity: its words, cost: repetitions before); pattern to each
    of its sources; source to end (capacity: its quota).
    """
    n_p, n_s = len(supply), len(quota)
    start, end = n_p + n_s, n_p + n_s + 1
    head: list[list[int]] = [[] for _ in range(end + 1)]
    to, cap, cost = [], [], []

    def arc(u: int, v: int, c: int, w: int) -> None:
        for a, b, x, y in ((u, v, c, w), (v, u, 0, -w)):
            head[a].append(len(to))
            to.append(b), cap.append(x), cost.append(y)

    first = []
    for p in range(n_p):
        first.append(len(to))
        for k in range(most):
            arc(start, p, supply[p], k)
        for s in member_of[p]:
            arc(p, n_p + s, most * supply[p], 0)
    for s in range(n_s):
        arc(n_p + s, end, quota[s], 0)
    pot = [0] * (end + 1)
    while True:
        far, via, heap = [math.inf] * (end + 1), [-1] * (end + 1), [(0, start)]
        far[start] = 0
        while heap:
            d, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for e in head[u]:
                if cap[e] > 0 and d + cost[e] + pot[u] - pot[to[e]] < far[to[e]]:
                    far[to[e]], via[to[e]] = d + cost[e] + pot[u] - pot[to[e]], e
                    heapq.heappush(heap, (far[to[e]], to[e]))
        if far[end] == math.inf:
            return [sum(cap[first[p] + 2 * k + 1] for k in range(most)) for p in range(n_p)]
        pot = [x + (d if d < math.inf else far[end]) for x, d in zip(pot, far, strict=True)]
        push, v = math.inf, end
        while v != start:
            push, v = min(push, cap[via[v]]), to[via[v] ^ 1]
        v = end
        while v != start:
            cap[via[v]] -= push
            cap[via[v] ^ 1] += push
            v = to[via[v] ^ 1]


def _order_key(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def mix(docs: DataFrame, weights, share: float = 1.5, most: int = 2, seed: int = 17,
        keep: tuple[str, ...] = ()) -> DataFrame:
    """Repetitions per document.

    ``docs``: doc_id, sources (array of source names, null names allowed), size
    (long >= 0); columns named in ``keep`` come along. ``weights``: a function from the list of sources (by code point,
    null last) to their weights, all above 0. ``share``: words to take in all,
    as a share of all words. ``most``: uses of one document at most.

    Returns doc_id, sources (sorted, null last), size, copies (0 to ``most``), and
    stats: a struct (source, words, target) for each of the row's sources.
    Repeated rows and equal doc_ids are separate documents; ties of the seeded
    order fall by size. Documents without words get the whole copies of their
    pattern and take no words. An empty table gives no rows. Words of a document
    in several sources count for each of them in ``words``, but are taken once
    per copy.
    """
    spark = docs.sparkSession
    base = stage(docs.select("doc_id", F.array_sort(F.array_distinct(F.coalesce("sources", F.array(F.lit(None).cast("string")))))
                             .alias("sources"), F.col("size").cast("long").alias("size"),
                             _order_key(seed).alias("ord"), *keep), "mix-docs")
    patterns = base.groupBy("sources").agg(F.sum("size").alias("words"), F.count("*").alias("n")).collect()
    patterns.sort(key=lambda r: [(x is None, x or "") for x in r.sources])
    names = sorted({s for r in patterns for s in r.sources}, key=lambda x: (x is None, x or ""))
    at = {s: i for i, s in enumerate(names)}
    words = [0] * len(names)
    for r in patterns:
        for s in r.sources:
            words[at[s]] += r.words
    total = sum(r.words for r in patterns)
    targets = fill_targets(words, list(weights(names)), share * total, most) if names else []
    take = route([r.words for r in patterns], [[at[s] for s in r.sources] for r in patterns],
                 [round(t) for t in targets], most)
    stat = "struct<source:string,words:bigint,target:double>"
    plan = spark.createDataFrame(
        [(i, list(r.sources), w // r.words if r.words else 0, w % r.words if r.words else 0,
          [(s, words[at[s]], targets[at[s]]) for s in r.sources])
         for i, (r, w) in enumerate(zip(patterns, take, strict=True))],
        f"pattern int, member array<string>, whole bigint, rest bigint, stats array<{stat}>")
    rows = sum(r.n for r in patterns)
    bits = min(MAX_RANGE_BITS, max(0, math.ceil(math.log2(max(1, rows / RANGE_ROWS)))))
    # the plan has one row per pattern, which the collect above has already bounded
    known = base.join(F.broadcast(plan), F.col("sources") == F.col("member")).drop("member").withColumn(
        "range", F.shiftright(F.conv(F.substring("ord", 1, 4), 16, 10).cast("int"), 16 - bits))
    totals = known.groupBy("pattern", "range").agg(F.sum("size").alias("w"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("pattern").orderBy("range")
    edge = (totals.withColumn("after", F.sum("w").over(upto))
            .withColumn("before", F.col("after") - F.col("w"))
            .select("pattern", "range", "before", "after"))
    known = known.join(edge, ["pattern", "range"])
    in_range = Window.partitionBy("pattern", "range").orderBy("ord", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inner = (known.where("after > rest and before <= rest")
             .withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(in_range), F.lit(0)))
             .withColumn("extra", (2 * F.col("before") + F.col("size") <= 2 * F.col("rest")) & (F.col("rest") > 0)))
    outer = known.where("not (after > rest and before <= rest)").withColumn("extra", (F.col("after") <= F.col("rest")) & (F.col("rest") > 0))
    both = outer.unionByName(inner)
    return both.select("doc_id", "sources", "size", (F.col("whole") + F.col("extra").cast("long")).alias("copies"), "stats", *keep)


def cyclic_weights(names: list, cycle: tuple[int, ...] = (3, 1, 2)) -> list[int]:
    return [cycle[i % len(cycle)] for i in range(len(names))]
