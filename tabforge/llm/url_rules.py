"""URL filter: listed host and path rules, then mined token rules.

FP-growth mines combinations of URL tokens together with a label item. Rules
``tokens -> bad`` that hold well above the share of bad labels, and not by
chance, are kept and indexed under their rarest token; a URL is compared only
with rules filed under one of its tokens.

Tokens held by just the same labelled rows say the same of them. One of each
such class is mined, so a long URL that repeats adds one item and not every
subset of its tokens; a rule then asks for any token of each of its classes.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

BAD = "label:bad"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one.

    ``rules``: (verdict, text); the text is a host and, from its first slash, a
    path. A rule fits its host and all subdomains when the path starts with its
    own. Equal lengths go by list order.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: -len(r[1]))[::-1]:
        h, slash, rest = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL, each with the part it comes from.

    Scheme, the host as a whole and each of its labels, path segments (runs of
    digits written as 0), file ending, query pairs, and whether there is a
    fragment. A null URL has none.
    """
    u = F.coalesce(url, F.lit(""))
    host, path = host_of(url), path_of(url)
    tagged = lambda tag, items: F.transform(F.filter(items, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))
    digits = F.regexp_replace(path, r"[0-9]+", "0")
    query = F.regexp_extract(u, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    return F.array_distinct(F.concat(
        tagged("scheme:", F.array(F.regexp_extract(u, r"(?s)^(.*?)://", 1))),
        tagged("host:", F.array(host)), tagged("name:", F.split(host, r"[.\-]")),
        tagged("path:", F.split(digits, "/")),
        tagged("end:", F.array(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))),
        tagged("query:", F.split(query, "&")),
        F.when(u.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))))


def mine_rules(labelled: DataFrame, min_support: float = 0.001, min_odds: float = 2.0, chance: float = 0.05,
               min_confidence: float = 0.0) -> DataFrame:
    """Rules ``tokens -> bad`` from (tokens, bad boolean): tokens, rarest, support, confidence, alike.

    Everything is relative to the share of bad rows. ``min_support`` is the
    share of the bad rows that hold the tokens, at least as many rows as a rule
    without a good row needs to be no accident. The odds of bad are at least
    ``min_odds`` times those of all labelled rows, and by the Chernoff bound
    over all token sets, any rule is an accident with a probability of
    ``chance`` at most; sets held by the same rows count once, and those of too
    few rows to ever be a rule do not count (Tarone 1990). ``support`` is the
    share of labelled rows. A rule goes when a part of its tokens is a rule of the same or a
    higher confidence. No labelled rows, none bad or all bad: no rules.
    ``tokens`` and ``rarest`` name each class of tokens held by the same rows by
    its least token, ``alike`` lists the classes. So URLs of any length that
    repeat as often as the floor add one item each.
    """
    rows = stage(labelled.select(F.monotonically_increasing_id().alias("row"), F.coalesce("bad", F.lit(False)).alias("bad"), "tokens")
                 .where(F.col("bad") | (F.size("tokens") > 0)), "url-rows")
    n, n_bad = rows.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    shape = "tokens array<string>, rarest string, support double, confidence double, alike array<array<string>>"
    if n_bad in (0, n):
        return rows.sparkSession.createDataFrame([], shape)
    base = n_bad / n
    least = max(1, math.ceil(min_support * n_bad), math.ceil(math.log(1 / chance) / -math.log(base)))
    alike = stage(alike_tokens(rows, least), "url-alike")
    others = alike.select("rep", F.explode("alike").alias("t")).where(F.col("t") != F.col("rep")).select("t")
    kept = (rows.select("row", F.explode("tokens").alias("t")).join(others, "t", "left_anti")
            .groupBy("row").agg(F.collect_list("t").alias("kept")))                         # the tokens of one URL
    items = F.coalesce("kept", F.array().cast("array<string>"))
    baskets = stage(rows.select("row", "bad").join(kept, "row", "left").select(
        F.when(F.col("bad"), F.concat(items, F.array(F.lit(BAD)))).otherwise(items).alias("items")), "url-baskets")
    # half a row less, as the share is rounded up to rows again
    sets = stage(FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / n)).fit(baskets).freqItemsets
                 .select(F.array_sort(F.array_remove("items", BAD)).alias("tokens"),
                         F.array_contains("items", BAD).alias("bad"), "freq").where(F.size("tokens") > 0), "url-sets")
    held = sets.where(~F.col("bad")).select("tokens", F.col("freq").alias("held"))
    parts = (held.where(F.size("tokens") > 1).select("held", "tokens", F.explode("tokens").alias("t"))
             .select(F.array_remove("tokens", F.col("t")).alias("tokens"), "held").distinct())
    own = held.join(parts, ["tokens", "held"], "left_anti")     # the largest of the sets held by the same rows
    # the floor ends here at the latest, as ever fewer sets are tried
    most = max(least, math.ceil(math.log(max(1, own.count()) / chance) / -math.log(base))) + 1
    by_rows = {r[0]: r[1] for r in own.groupBy(F.least("held", F.lit(most))).count().collect()}
    tried = sum(by_rows.values())
    while least < most and least * -math.log(base) < math.log(max(1, tried) / chance):
        tried -= by_rows.get(least, 0)
        least += 1
    odds = min_odds * base / (1 - base)
    c, b = F.col("confidence"), F.lit(base)
    excess = c * F.log(c / b) + F.when(c < 1, (1 - c) * F.log((1 - c) / (1 - b))).otherwise(0.0)
    rules = (sets.where("bad").join(held, "tokens")
             .withColumns({"support": F.col("freq") / n, "confidence": F.col("freq") / F.col("held")})
             .where((c >= max(min_confidence, odds / (1 + odds))) & (F.col("held") >= least)
                    & (F.col("held") * excess >= math.log(max(1, tried) / chance)))
             .select("tokens", "support", "confidence"))
    rules = stage(rules, "url-rules")
    # a rule's proper parts: leave out one token at a time (support only grows, so chains are covered)
    parts = rules.select("tokens", "confidence", F.explode("tokens").alias("t")).select(
        "tokens", "confidence", F.array_remove("tokens", F.col("t")).alias("part"))
    known = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("part_confidence"))
    covered = (parts.join(known, "part").where(F.col("part_confidence") >= F.col("confidence"))
               .select("tokens").distinct())
    rules = rules.join(covered, "tokens", "left_anti")
    single = held.where(F.size("tokens") == 1).select(F.col("tokens")[0].alias("t"), F.col("held").alias("freq"))
    rarest = (rules.select("tokens", F.explode("tokens").alias("t")).join(single, "t")
              .groupBy("tokens").agg(F.min(F.struct("freq", "t")).alias("r"))
              .select("tokens", F.col("r.t").alias("rarest")))
    classes = (rules.select("tokens", F.explode("tokens").alias("rep")).join(alike, "rep", "left").groupBy("tokens")
               .agg(F.sort_array(F.collect_list(F.struct("rep", F.coalesce("alike", F.array("rep")).alias("alike")))).alias("c")))
    return rules.join(rarest, "tokens").join(classes, "tokens").select(
        "tokens", "rarest", "support", "confidence", F.col("c.alike").alias("alike"))


def alike_tokens(rows: DataFrame, least: int) -> DataFrame:
    """(rep, alike) of each class of two tokens or more held by the same ``least`` rows or more; rep is the least of them.

    Rows are compared by their number and two 64-bit sums of hashes. A class is part of a URL, so it is no longer.
    """
    held = rows.select(F.explode("tokens").alias("t"), F.xxhash64("row").alias("a"), F.xxhash64(F.lit(1), "row").alias("b"))
    marks = held.groupBy("t").agg(F.count("*").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")).where(F.col("n") >= least)
    return (marks.groupBy("n", "a", "b").agg(F.min("t").alias("rep"), F.sort_array(F.collect_set("t")).alias("alike"))
            .where(F.size("alike") > 1).select("rep", "alike"))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, confidence, matched) of the best rule for each distinct url that has one.

    Best: highest confidence, then support, then tokens.
    """
    held = urls.where("url is not null").select("url").distinct().withColumn("tokens", url_tokens(F.col("url")))
    # filed under each token that can stand for the rarest
    rarest = F.expr("filter(alike, c -> array_contains(c, rarest))")[0]
    filed = rules.select(F.explode(rarest).alias("t"), F.col("tokens").alias("need"), "alike", "support", "confidence")
    hits = (held.select("url", "tokens", F.explode("tokens").alias("t")).join(filed, "t")
            .where(F.expr("forall(alike, c -> arrays_overlap(c, tokens))")))
    best = hits.groupBy("url").agg(F.max(F.struct("confidence", "support", "need")).alias("b"))
    return best.select(F.col("url").alias("hit_url"), F.col("b.confidence").alias("confidence"), F.col("b.need").alias("matched"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], **mining) -> DataFrame:
    """page_id, url, host, path, rule, verdict, matched, confidence for every page.

    ``pages``: page_id, url. ``labels``: page_id, bad (boolean; null rows are
    left out). The longest listed rule decides; without one, a page is blocked
    when a mined rule fits its URL and allowed otherwise. A null URL or one
    without :// has an empty host and path and fits no listed rule. Repeated
    pages are judged each; a page with several labels counts once per label.
    """
    good = labels.where("bad is not null").select(F.col("page_id").alias("label_id"), "bad")
    seen = (pages.select("page_id", "url").join(good, F.col("page_id") == F.col("label_id"))
            .select(url_tokens(F.col("url")).alias("tokens"), "bad"))
    mined = stage(mine_rules(seen, **mining), "url-mined")
    best = match_rules(pages, mined)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    out = (pages.select("page_id", "url").join(best, F.col("url") == F.col("hit_url"), "left")
           .withColumns({"host": host, "path": path}))
    rule, verdict = listed_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("matched").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return (out.withColumns({"rule": rule, "verdict": F.coalesce(verdict, learned)})
            .select("page_id", "url", "host", "path", "rule", "verdict", "matched", "confidence"))
