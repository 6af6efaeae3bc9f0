"""Conversation repair: the chart over all cuts, every edit sequence of short conversations, long and odd tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest

from tabforge.llm.conversation_repair import (ACCEPT, EMPTY, STEP, best, combine, cut_audit, damaged_and_repaired,
                                              parse_conversations, repair_conversations, row_cells, span_cells)

SCHEMA = "conv_id long, turn long, role string, text string"


def chart(kinds):
    """Full CYK: every span from every cut."""
    n = len(kinds)
    cell = {(i, i + 1): row_cells(k) for i, k in enumerate(kinds)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            ways = [combine(cell[i, k], cell[k, i + length]) for k in range(i + 1, i + length)]
            assert all(w == ways[0] for w in ways)               # closed under cutting
            cell[i, i + length] = ways[0]
    return cell[0, n] if n else EMPTY


def by_enumeration(kinds, inserts=3):
    """The least (cost, audit) over all edit sequences with at most ``inserts`` insertions in one place."""
    found = None
    slots = [0] * (len(kinds) + 1)
    for ops in itertools.product("KRD", repeat=len(kinds)):
        if any(k == "x" and o != "D" or k in "oO" and o == "K" for k, o in zip(kinds, ops)):
            continue
        for slots in itertools.product(range(inserts), repeat=len(kinds) + 1):
            audit = "".join("I" * s + o for s, o in itertools.zip_longest(slots, ops, fillvalue=""))
            out, i, ok = "", 0, True
            for a in audit:
                asked = "a" if out[-1:] == "u" else "u"
                if a == "I":
                    out += asked
                    continue
                k, i = kinds[i], i + 1
                out += k.lower() if a == "K" else asked if a == "R" else ""
            ok = re.fullmatch("(s?(ua)+)?", out)
            if ok:
                cost = sum({"K": 0, "R": 1, "D": 2, "I": 5}[a] for a in audit)
                cost += 5 * sum(k.isupper() and o != "D" for k, o in zip(kinds, ops))
                found = min(found or (cost, audit), (cost, audit))
    return found


def test_cells_equal_all_edit_sequences():
    rnd = random.Random(1)
    for n in (0, 1, 2, 3, 4):
        for _ in range(12):
            kinds = "".join(rnd.choice("ssuaoxSUAO") for _ in range(n))
            cells = span_cells(list(kinds))
            assert cells[best(cells)] == by_enumeration(kinds), kinds


def test_one_cut_a_span_is_the_whole_chart():
    rnd = random.Random(2)
    for _ in range(30):
        kinds = "".join(rnd.choice("suauaoxSUAO") for _ in range(rnd.randrange(14)))
        assert span_cells(list(kinds)) == chart(kinds)


def test_rows_that_repeat_are_parsed_by_doubling():
    for times in (1, 2, 7, 8, 9, 100, 1001):
        kinds = ["s", "u" + "x" * times, "a"]
        assert span_cells(kinds) == span_cells(list("".join(kinds)))


def test_cut_audit():
    assert cut_audit("IKDIIRDI", [1, 1, 2]) == ["IK", "D", "IIRDI"]
    assert cut_audit("KDDDDI", [5]) == ["KDDDDI"]


def plain(rows):
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256), from left to right."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0))
        mine = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in mine]
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, role, text in mine:
            core = text.strip(" \t\n\x0b\x0c\r")
            faults.append("b" if not core else "d" if (role, text) in seen else "" if core[-1] in ".!?" else "t")
            seen.add((role, text))
        ini = [r[:1] for _, r, _ in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:]))
        ways = {0: (0, "", [])}

        def inserted(ways):
            for _ in range(2):
                for (p, c), q in STEP.items():
                    if c != "s" and p in ways:
                        w = (ways[p][0] + 5, ways[p][1] + "I", ways[p][2] + [{"u": "user:", "a": "assistant:"}[c]])
                        if q not in ways or w < ways[q]:
                            ways[q] = w
            return ways
        ways = inserted(ways)
        for (_, role, text), fault in zip(mine, faults):
            nxt = {}
            for p, (cost, audit, lines) in ways.items():
                options = [(p, cost + 2, audit + "D", lines)]
                if fault in ("", "t"):
                    more = 5 if fault == "t" else 0
                    for (a, c), q in STEP.items():
                        if a == p and c == role[:1]:
                            options.append((q, cost + more, audit + "K", lines + [f"{role}:{text}"]))
                        if a == p and c != "s":
                            to = {"u": "user", "a": "assistant"}[c]
                            options.append((q, cost + more + 1, audit + "R", lines + [f"{to}:{text}"]))
                for q, *w in options:
                    if q not in nxt or tuple(w) < nxt[q]:
                        nxt[q] = tuple(w)
            ways = inserted(nxt)
        cost, audit, lines = min(ways[q] for q in ACCEPT if q in ways)
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(spark, rows, piece=1 << 15):
    df = spark.createDataFrame(rows, SCHEMA)
    summaries, out = repair_conversations(df, piece)
    lines = {}
    for r in out.collect():
        lines.setdefault(r["conv_id"], []).append((r["position"], f"{r['role']}:{r['text']}"))
    got = {}
    for r in summaries.collect():
        mine = sorted(lines.get(r["conv"], []))
        assert [p for p, _ in mine] == list(range(1, len(mine) + 1))
        got[r["conv"]] = (*r[1:], hashlib.sha256("\n".join(x for _, x in mine).encode()).hexdigest())
    return got


def conversation(rnd, conv, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", ""]
    texts = ["Yes.", "No!", "cut off", " ", "", "Why?\n", "é.", "Well. ", "a.b"]
    return [(conv, t, rnd.choice(roles), rnd.choice(texts) if rnd.random() < 0.4 else f"Line {conv} {t}{rnd.choice(['.', '!', ''])}")
            for t in rnd.sample(range(-3, 2 * n), n)]


def test_many_short_conversations(spark):
    rnd = random.Random(3)
    rows = [r for c in range(150) for r in conversation(rnd, c, rnd.randrange(1, 9))]
    assert repaired(spark, rows) == plain(rows)


@pytest.mark.parametrize("piece", [1 << 15, 7])
def test_one_conversation_over_many_partitions(spark, piece):
    rnd = random.Random(4)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = conversation(rnd, 5, 400) + conversation(rnd, 6, 30) + [r for c in range(7, 20) for r in conversation(rnd, c, 3)]
    try:
        assert repaired(spark, rows, piece) == plain(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_odd_rows(spark):
    long = "word " * 200_000
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."),
            (1, 1, "user", long + "."), (1, 2, "assistant", long), (1, 2, "assistant", long), (1, 3, "user", None),
            (2, None, "system", "S."), (2, 5, "user", "U."), (2, 9, "assistant", "A."),
            (3, 1, "user", "x" * 100_000), (4, 7, None, "."), (5, 1, "user", ""), (5, 1, "user", "")]
    assert repaired(spark, rows) == plain(rows)


def test_equal_rows_are_counted_once(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "assistant", "So.")] + [(1, 2, "user", "Again.")] * 3000
    assert repaired(spark, rows) == plain(rows)
    summaries, edits = parse_conversations(spark.createDataFrame(rows, SCHEMA))
    assert edits.count() == 3
    assert summaries.first()["duplicate"] == 2999


def test_ties_repeat_and_clashing_columns(spark):
    rows = [(1, 1, "user", "B."), (1, 1, "user", "A."), (1, 2, "assistant", "C.")]
    df = spark.createDataFrame([(*r, i, "x", "y") for i, r in enumerate(rows)], SCHEMA + ", conv long, edits string, k1 string")
    first = [sorted(map(tuple, part.collect())) for part in repair_conversations(df)]
    again = [sorted(map(tuple, part.collect())) for part in repair_conversations(df.orderBy(df.conv.desc()))]
    assert first == again
    assert damaged_and_repaired(df).count() == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert [part.count() for part in repair_conversations(df)] == [0, 0]
    assert damaged_and_repaired(df).count() == 0


def test_query_keeps_conversations_without_rows(spark):
    import zlib

    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = spark.createDataFrame([(conv, 0, "user", "Gone."), (None, None, "user", None)], SCHEMA)
    got = {r["conv_id"]: r for r in damaged_and_repaired(rows).collect()}
    assert tuple(got[conv])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert set(got) == {conv, None}
