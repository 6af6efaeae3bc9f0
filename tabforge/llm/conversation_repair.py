"""Conversation structure repair by weighted interval parsing (CYK) over the rows of a conversation.

The grammar of a sound conversation is ``(s?(ua)+)?`` over role initials. In Chomsky normal form its nonterminals
are X[p,q], "these rows, edited, take the automaton of the grammar from state p to state q":

    X[p,q] -> X[p,r] X[r,q]                      binary rules, cost 0
    X[p,q] -> row                                Keep 0, Rerole 1, Delete 2, an undeleted truncated row 5 more
    X[p,q] -> closure of inserted rows           Insert 5, also over the empty span

A cell holds the least (cost, audit) of a nonterminal over a span, where the audit is the edits' initials; equal costs
are settled by the ASCII order of the audits. Two audits of equal cost over one span never are prefixes of one another
(the longer one would hold more insertions), so the least of a whole is made of the least of its parts. The grammar is
closed under cutting: every cut of a span gives the same cell (the tests compare with the chart over all cuts), so the
chart is filled bottom-up by span length 1, 2, 4, ... with one cut a span, and a conversation costs its length, not
its cube.

Spark does the rest. Rows are reduced to keys and fault flags, counted where they are equal, ordered over the whole
table by range partitioning on (conversation, turn), and each task parses the runs it holds. A conversation that lies
on the edge of a partition leaves its cells; those are combined 16 at a time until one span is left. So a conversation
of any length is cut over many tasks, and none is gathered in one.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import content_key, stage, strip_white

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: States: 0 nothing yet, 1 after a system row, 2 after a user row, 3 after an assistant row.
STATES = range(4)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
ACCEPT = (0, 3)
LEGAL = {"su", "ua", "au"}
SIZE = len(STATES) ** 2
#: Rows parsed at once in a task; a longer run becomes several spans.
PIECE = 1 << 15
FAN_IN = 16


# ---------------------------------------------------------------- cells

def _closure() -> tuple:
    """The empty span: only insertions, each of the role that the state asks for."""
    cells = [[(0, "") if p == q else None for q in STATES] for p in STATES]
    for _ in STATES:
        for p in STATES:
            for (r, c), q in STEP.items():
                if c != "s" and cells[p][r] is not None:
                    found = (cells[p][r][0] + INSERT, cells[p][r][1] + "I")
                    if cells[p][q] is None or found < cells[p][q]:
                        cells[p][q] = found
    return tuple(x for row in cells for x in row)


def combine(left: tuple, right: tuple) -> tuple:
    """X[p,q] -> X[p,r] X[r,q], the least over r."""
    out = [None] * SIZE
    for p in STATES:
        for r in STATES:
            a = left[4 * p + r]
            if a is None:
                continue
            for q in STATES:
                b = right[4 * r + q]
                if b is None:
                    continue
                now, cost = out[4 * p + q], a[0] + b[0]
                if now is None or cost < now[0] or cost == now[0] and a[1] + b[1] < now[1]:
                    out[4 * p + q] = (cost, a[1] + b[1])
    return tuple(out)


EMPTY = _closure()


@lru_cache(maxsize=None)
def row_cells(kind: str) -> tuple:
    """One row. ``kind``: the role's initial (s, u, a, o for others), upper case if truncated, or x if it must go."""
    cells: list = [None] * SIZE
    extra = TRUNCATED if kind.isupper() else 0
    for p in STATES:
        cells[5 * p] = (DELETE, "D")
    if kind != "x":
        for (p, c), q in STEP.items():
            ways = [(KEEP + extra, "K")] if c == kind.lower() else []
            ways += [(REROLE + extra, "R")] if c != "s" else []
            for w in ways:
                if cells[4 * p + q] is None or w < cells[4 * p + q]:
                    cells[4 * p + q] = w
    return combine(combine(EMPTY, tuple(cells)), EMPTY)


@lru_cache(maxsize=1 << 14)
def _short_span(kinds: str) -> tuple:
    if len(kinds) == 1:
        return row_cells(kinds)
    half = 1 << (len(kinds) - 1).bit_length() - 1
    return combine(_short_span(kinds[:half]), _short_span(kinds[half:]))


@lru_cache(maxsize=1 << 10)
def _repeated(times: int) -> tuple:
    """``times`` rows that must all go, by doubling."""
    if times == 1:
        return row_cells("x")
    half = _repeated(times // 2)
    twice = combine(half, half)
    return combine(twice, row_cells("x")) if times % 2 else twice


def span_cells(kinds: list[str]) -> tuple:
    """The cells of consecutive rows, bottom-up by span length; equal short spans are parsed once a worker.

    An item of ``kinds`` is one row's kind, followed by an x for each further row equal to it.
    """
    cells, short = [], ""
    for k in kinds:
        if len(k) <= 8:
            short += k
        else:
            cells += [_short_span(x) for x in (short, k[0]) if x] + [_repeated(len(k) - 1)]
            short = ""
        while len(short) >= 8:
            cells.append(_short_span(short[:8]))
            short = short[8:]
    cells += [_short_span(x) for x in (short,) if x]
    while len(cells) > 1:
        cells = [combine(cells[i], cells[i + 1]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else EMPTY


def best(cells: tuple) -> int:
    """The accepting state of the least whole parse, which is also the index of its cell."""
    return min((q for q in ACCEPT if cells[q] is not None), key=lambda q: cells[q])


def cut_audit(audit: str, sizes: list[int]) -> list[str]:
    """The audit cut at groups of rows: insertions go with the row after them, the last with the last row."""
    out, at = [], 0
    for need in sizes:
        end = at
        while need:
            part = audit[end:end + need]
            end, need = end + len(part), part.count("I")
        out.append(audit[at:end])
        at = end
    out[-1] += audit[at:]
    return out


# ---------------------------------------------------------------- spans that tasks leave to be combined

class Span:
    """Cells of a run of one conversation, each with the states between its pieces, and what counts need of its ends."""

    __slots__ = ("pieces", "cells", "paths", "ends", "counts")

    def __init__(self, pieces, cells, paths, ends, counts):
        self.pieces, self.cells, self.paths, self.ends, self.counts = pieces, cells, paths, ends, counts

    def __add__(self, other: "Span") -> "Span":
        cells, paths = [None] * SIZE, [None] * SIZE
        for p in STATES:
            for r in STATES:
                for q in STATES:
                    a, b = self.cells[4 * p + r], other.cells[4 * r + q]
                    if a is None or b is None:
                        continue
                    found, at = (a[0] + b[0], a[1] + b[1]), 4 * p + q
                    if cells[at] is None or found < cells[at]:
                        cells[at] = found
                        paths[at] = self.paths[4 * p + r] + str(r) + other.paths[4 * r + q]
        (first, _, t0, t1), (ini, last, u0, u1) = self.ends, other.ends
        blank, dup, cut, illegal, turns = (a + b for a, b in zip(self.counts, other.counts))
        illegal += (self.ends[1] + ini) not in LEGAL
        turns -= t1 is not None and t1 == u0
        return Span(self.pieces + other.pieces, tuple(cells), paths,
                    (first, last, t0 if t0 is not None else u0, u1 if u1 is not None else t1),
                    (blank, dup, cut, illegal, turns))

    def gaps(self) -> int:
        low, high = self.ends[2:]
        return 0 if low is None else high - low + 1 - self.counts[4]


def read_run(rows: list, piece: int) -> tuple[Span, list[str]]:
    """Parse consecutive (turn, initial, fault, repeated, times) of one conversation: its span and the rows' kinds."""
    kinds, blank, dup, cut, illegal, turns = [], 0, 0, 0, 0, 0
    low = high = before = None
    for turn, ini, fault, again, times in rows:
        if fault == "b":
            blank, kind = blank + times, "x" * times
        elif again:
            dup, kind = dup + times, "x" * times
        else:
            dup += times - 1
            cut += fault == "t"
            kind = (ini.upper() if fault == "t" else ini) + "x" * (times - 1)
        kinds.append(kind)
        illegal += (times - 1) * ((ini + ini) not in LEGAL) + (before is not None and (before + ini) not in LEGAL)
        before = ini
        if turn is not None:
            turns += turn != high
            low, high = turn if low is None else low, turn
    cells = span_cells(kinds)
    return Span([piece], cells, [None if c is None else "" for c in cells], (rows[0][1], before, low, high),
                (blank, dup, cut, illegal, turns)), kinds


_SPAN = ("pieces array<long>, costs array<long>, audits array<string>, paths array<string>, first string, last string, "
         "low long, high long, blank long, duplicate long, truncated long, illegal long, turns long")


def _span_values(s: Span) -> dict:
    return dict(zip((x.split()[0] for x in _SPAN.split(", ")), (
        s.pieces, [None if c is None else c[0] for c in s.cells], [None if c is None else c[1] for c in s.cells],
        s.paths, *s.ends, *s.counts)))


def _span_of(r: dict) -> Span:
    cells = tuple(None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"]))
    return Span(list(r["pieces"]), cells, list(r["paths"]), (r["first"], r["last"], r["low"], r["high"]),
                tuple(r[c] for c in ("blank", "duplicate", "truncated", "illegal", "turns")))


_SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _summary_values(s: Span) -> dict:
    cost, audit = s.cells[best(s.cells)]
    return dict(zip((x.split()[0] for x in _SUMMARY.split(", ")), (s.gaps(), *s.counts[:4], cost, audit)))


# ---------------------------------------------------------------- Spark

def arrow_of(ddl: str):
    """The Arrow schema of a DDL string; only the driver can read one."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _parse(conv_type: str, most_rows: int):
    """mapInArrow over (conv, turn, k1, k2, initial, fault, again, times) in order: rows with edits, summaries, open spans."""
    schema = (f"what string, conv {conv_type}, piece long, turn long, k1 long, k2 long, edits string, "
              f"choices array<string>, {_SUMMARY}, span struct<{_SPAN.replace(' ', ':').replace(',:', ',')}>")
    names = ["what", "conv", "piece", "turn", "k1", "k2", "edits", "choices", *[x.split()[0] for x in _SUMMARY.split(", ")], "span"]

    arrow = arrow_of(schema)

    def parse(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out: list[dict] = []
        held = {"conv": None, "any": False, "span": None, "next": part << 24, "first": True}
        run: list = []

        def cut():
            """Parse the rows held as one more piece of the conversation's span in this task."""
            span, kinds = read_run([(r[0], *r[3:]) for r in run], held["next"])
            held["next"] += 1
            held["span"] = span if held["span"] is None else held["span"] + span
            last = (span, list(run), kinds)
            run.clear()
            return last

        def rows_of(span, rows, kinds, whole: bool):
            choices = [best(span.cells)] if whole else [i for i, c in enumerate(span.cells) if c is not None]
            sizes = [len(k) for k in kinds]
            cuts = {i: cut_audit(span.cells[i][1], sizes) for i in choices}
            for n, r in enumerate(rows):
                yield {"what": "row", "conv": held["conv"], "piece": span.pieces[0], "turn": r[0], "k1": r[1], "k2": r[2],
                       "edits": cuts[choices[0]][n] if whole else None,
                       "choices": None if whole else [cuts[i][n] if i in cuts else None for i in range(SIZE)]}

        def close(edge: bool):
            """The conversation ends here, or (edge) may go on in another task."""
            whole = not edge and held["span"] is None
            if run:
                out.extend(rows_of(*cut(), whole))
            if whole:
                out.append({"what": "summary", "conv": held["conv"], **_summary_values(held["span"])})
            else:
                out.append({"what": "span", "conv": held["conv"], "piece": part, "span": _span_values(held["span"])})
            held.update(span=None, first=False)

        def flush():
            cols = [pa.array([r.get(n) for r in out], type=arrow.field(n).type) for n in names]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, schema=arrow)

        for batch in batches:
            d = batch.to_pydict()
            for r in zip(d["conv"], d["turn"], d["k1"], d["k2"], d["initial"], d["fault"], d["again"], d["times"]):
                if held["any"] and r[0] != held["conv"]:
                    close(edge=held["first"])
                held["conv"], held["any"] = r[0], True
                run.append(r[1:])
                if len(run) >= most_rows:
                    out.extend(rows_of(*cut(), False))
                if len(out) >= 4096:
                    yield flush()
        if held["any"]:
            close(edge=True)
        if out:
            yield flush()

    return parse, schema


def _join_spans(open_spans: DataFrame, conv_type: str) -> DataFrame:
    """Spans of one conversation combined, 16 neighbours a round, until each conversation has one."""
    schema = f"conv {conv_type}, piece long, span struct<{_SPAN.replace(' ', ':').replace(',:', ',')}>"

    def add(key, group):
        import pyarrow as pa

        rows = sorted(group.to_pylist(), key=lambda r: r["piece"])        # FAN_IN at most
        whole = _span_of(rows[0]["span"])
        for r in rows[1:]:
            whole = whole + _span_of(r["span"])
        return pa.Table.from_pylist([{"conv": rows[0]["conv"], "piece": rows[0]["piece"] // FAN_IN,
                                      "span": _span_values(whole)}], schema=group.schema)

    cur = open_spans.select("conv", "piece", "span")
    while not cur.groupBy("conv").count().where("count > 1").isEmpty():
        cur = stage(cur.groupBy("conv", (F.col("piece") / FAN_IN).cast("long").alias("up")).applyInArrow(add, schema), "repair-spans")
    return cur


def row_faults(rows: DataFrame) -> DataFrame:
    """conv, turn, content key, role initial (s, u, a, else o) and row-local fault: b blank, t truncated, else empty."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    k1, k2 = content_key(role, text)
    core, ini = strip_white(text), F.substring(role, 1, 1)
    return rows.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), k1.alias("k1"), k2.alias("k2"),
        F.when(ini.isin("s", "u", "a"), ini).otherwise("o").alias("initial"),
        F.when(core == "", "b").when(~F.substring(core, -1, 1).isin(".", "!", "?"), "t").otherwise("").alias("fault"))


def parse_conversations(rows: DataFrame, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """(summaries, edits) of all conversations of ``rows`` (conv_id, turn, role, text; further columns are ignored).

    summaries: conv and one row each of gaps, blank, duplicate, truncated, illegal, cost, audit. edits: conv, turn, k1,
    k2 (``content_key`` of role and text) and the edits of these rows, one string for all rows equal in them.
    ``piece``: rows that a task parses at once; the results do not depend on it.

    Rows go by turn, nulls first, and within one turn by content key; equal rows are adjacent. A null role or text
    counts as one space, a null conv_id is a conversation of its own, and an empty table gives two empty tables.
    """
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    # rows equal in everything are counted before they travel
    counted = stage(row_faults(rows).groupBy("conv", "turn", "k1", "k2", "initial", "fault")
                    .agg(F.count("*").alias("times")), "repair-rows")
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    repeated = stage(counted.where("fault <> 'b'").groupBy("conv", "k1", "k2")
                     .agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
                     .select(F.col("conv").alias("r_conv"), F.col("k1").alias("r1"), F.col("k2").alias("r2"), "first"), "repair-repeated")
    again = F.coalesce(order > F.col("first"), F.lit(False)).alias("again")
    marked = counted.join(repeated, F.col("conv").eqNullSafe(F.col("r_conv")) & (F.col("k1") == F.col("r1"))
                          & (F.col("k2") == F.col("r2")), "left")
    keys = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "k1", "k2")]
    parse, schema = _parse(conv_type, piece)
    found = stage(marked.select("conv", "turn", "k1", "k2", "initial", "fault", again, "times")
                  .repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(parse, schema), "repair-parsed", partition_by="what")
    whole = _join_spans(found.where("what = 'span'"), conv_type)
    names = [x.split()[0] for x in _SUMMARY.split(", ")]

    ended = f"conv {conv_type}, {_SUMMARY}, taken array<struct<piece:long,cell:int>>"
    arrow = arrow_of(ended)

    def choose(batches):
        """A whole span: its summary, and for each of its pieces the cell that the least parse takes."""
        import pyarrow as pa

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                s = _span_of(r["span"])
                q = best(s.cells)
                path = [0, *map(int, s.paths[q]), q]
                out.append({"conv": r["conv"], **_summary_values(s), "taken": [
                    {"piece": x, "cell": 4 * path[i] + path[i + 1]} for i, x in enumerate(s.pieces)]})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    ends = stage(whole.mapInArrow(choose, ended), "repair-ends")
    summaries = found.where("what = 'summary'").select("conv", *names).unionByName(ends.select("conv", *names))
    taken = ends.select(F.explode("taken").alias("t")).select(F.col("t.piece").alias("t_piece"), F.col("t.cell").alias("cell"))
    rows_found = found.where("what = 'row'")
    open_rows = rows_found.where("edits is null").select("conv", "piece", "turn", "k1", "k2", "choices").join(
        taken, F.col("piece") == F.col("t_piece"))
    edits = rows_found.where("edits is not null").select("conv", "turn", "k1", "k2", "edits").unionByName(
        open_rows.select("conv", "turn", "k1", "k2", F.get("choices", F.col("cell")).alias("edits")))
    return summaries, edits


def apply_edits(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, position (from 1), edit (K, R or I), role, text.

    A conversation's rows come out in order in one partition, and so can be read as a stream; a task holds one row at
    a time, whatever the length of the conversation.
    """
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    k1, k2 = content_key(role, text)
    texts = rows.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), k1.alias("k1"), k2.alias("k2"),
                        F.lit(None).cast("string").alias("edits"), role.alias("role"), text.alias("text"))
    none = F.lit(None).cast("string")
    both = edits.select("conv", "turn", "k1", "k2", "edits", none.alias("role"), none.alias("text")).unionByName(texts)
    keys = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "k1", "k2")]
    # the edits of rows come just before the first of them
    ordered = both.repartition("conv").sortWithinPartitions(*keys, F.col("edits").asc_nulls_last())
    schema = f"conv_id {conv_type}, position long, edit string, role string, text string"

    arrow = arrow_of(schema)

    def edited(batches):
        import pyarrow as pa

        started, conv, state, position, todo = False, None, 0, 0, None
        for batch in batches:
            out: list[tuple] = []
            d = batch.select(["conv", "edits", "role", "text"]).to_pydict()
            for c, e, role, text in zip(d["conv"], d["edits"], d["role"], d["text"]):
                if not started or c != conv:
                    started, conv, state, position = True, c, 0, 0
                if e is not None:
                    todo = e
                    continue
                for op in todo or "":
                    if op == "D":
                        continue
                    asked = "assistant" if state == 2 else "user"
                    kept = (role, text) if op == "K" else (asked, text) if op == "R" else (asked, "")
                    state = STEP[state, kept[0][:1]]
                    position += 1
                    out.append((conv, position, op, *kept))
                todo = None                                  # further equal rows are told by the same edits
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*out), arrow)], schema=arrow)

    return ordered.mapInArrow(edited, schema)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of ``role:text`` lines, read as a stream from the rows of ``apply_edits``."""
    conv_type = repaired.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {conv_type}, repaired_sha256 string"

    arrow = arrow_of(schema)

    def digest(batches):
        import pyarrow as pa

        started, conv, sha, out = False, None, None, []
        for batch in batches:
            d = batch.select(["conv_id", "role", "text"]).to_pydict()
            for c, role, text in zip(d["conv_id"], d["role"], d["text"]):
                if not started or c != conv:
                    if started:
                        out.append({"conv_id": conv, "repaired_sha256": sha.hexdigest()})
                    started, conv, sha = True, c, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if started:
            out.append({"conv_id": conv, "repaired_sha256": sha.hexdigest()})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return repaired.mapInArrow(digest, schema)


def repair_conversations(rows: DataFrame, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """(summaries, repaired rows) of the conversations of ``rows``; see ``parse_conversations`` and ``apply_edits``."""
    summaries, edits = parse_conversations(rows, piece)
    return summaries, apply_edits(rows, edits)


def damage(rows: DataFrame) -> DataFrame:
    """The rows of the query, damaged by a checksum of conversation and turn; nulls count as one space."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm: Column = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text = F.coalesce("text", F.lit(" "))
    return (rows.select("conv_id", "turn", harm.alias("harm"),
                        F.when(harm == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
                        F.when(harm == 1, "").when(harm == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"))
            .where("harm <> 0")
            .withColumn("one", F.explode(F.array_repeat(F.lit(1), F.when(F.col("harm") == 3, 2).otherwise(1))))
            .drop("harm", "one"))


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """Damage, repair and digest every conversation; one row for each conv_id of the table, also where no row is left.

    Further columns of ``conversations`` are ignored; an empty table gives no rows.
    """
    rows = damage(conversations)
    summaries, repaired = repair_conversations(rows)
    names = [x.split()[0] for x in _SUMMARY.split(", ")]
    ids = conversations.select("conv_id").distinct()
    every = (ids.unionByName(summaries.select(F.col("conv").alias("conv_id"), *names), allowMissingColumns=True)
             .unionByName(digests(repaired), allowMissingColumns=True))
    zeros = [F.coalesce(F.max(c), F.lit("") if c == "audit" else F.lit(0)).alias(c) for c in names]
    return every.groupBy("conv_id").agg(*zeros, F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256(b"").hexdigest()))
                                        .alias("repaired_sha256"))
