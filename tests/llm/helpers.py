from __future__ import annotations

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def prose(rnd: random.Random, n: int, vocabulary: int = 5000) -> str:
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def shingles(text, width=5):
    w = [x.lower() if x.isascii() else ascii_lower(x) for x in words(text)]
    if not w:
        return set()
    return {tuple(w)} if len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


class Roots:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


#: Texts that every operator on documents must stand.
ODD_TEXTS = [None, "", " ", "\n", "\n\n a\n", "word", "Two Words", "É Ünïcode ẞ İ line\nÉ ünïcode", "▁▁ x ▁", "a\x00b\x0bc\x85d",
             "日本語 テキスト 😀", "x" * 3000, "spaces" + " " * 500 + "end", "tab\tand\rreturn\r\nline"]


def broadcast_rows(plan):
    """Rows that the nodes of an executed plan (a py4j object) have sent through the driver."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return broadcast_rows(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return broadcast_rows(plan.plan())
    own = plan.metrics().apply("numOutputRows").value() if plan.nodeName() == "BroadcastExchange" else 0
    return own + sum(broadcast_rows(plan.children().apply(i)) for i in range(plan.children().size()))
