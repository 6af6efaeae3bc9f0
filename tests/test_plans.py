"""Plan shape guards on the final adaptive plans: no cartesian products or
nested-loop joins, and no data-sized window without a partition spec."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry

from .conftest import SF001

QUERIES = ["q_rule_predict", "q_group_median_impute", "q_knn_vote", "q_sort_mixed", "q_roc",
           "q_stratified_split", "q_composite_key", "q_leave_one_out", "q_update_override"]


def _plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", QUERIES)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(entry.queries()[name](spark, SF001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def _top_level_lists(args: str) -> list[str]:
    """Split ``[a], [b], [c]`` into its top-level bracketed lists."""
    out, depth, cur = [], 0, []
    for ch in args:
        if ch == "[":
            depth += 1
            if depth == 1:
                cur = []
                continue
        elif ch == "]":
            depth -= 1
            if depth == 0:
                out.append("".join(cur))
                continue
        if depth >= 1:
            cur.append(ch)
    return out


@pytest.mark.parametrize("name", ["q_sort_mixed", "q_roc", "q_stratified_split", "q_knn_vote"])
def test_data_windows_are_partitioned(spark, name):
    plan = _plan(entry.queries()[name](spark, SF001))
    blocks = [b.strip() for b in plan.split("\n\n") if re.match(r"\(\d+\) Window\b", b.strip())]
    assert blocks
    partitioned = 0
    for b in blocks:
        args = re.search(r"Arguments: (.*)", b).group(1)
        lists = _top_level_lists(args)
        # [exprs], [partition spec], [order spec]; empty lists may be omitted,
        # so a lone second list is an order spec only if it has a direction
        part = lists[1] if len(lists) == 3 else (
            "" if len(lists) < 2 or re.search(r"\b(ASC|DESC)\b", lists[1]) else lists[1])
        if part.strip():
            partitioned += 1
            continue
        # an unpartitioned window is allowed only over the per-range totals
        # (one row per range), never over rows
        inputs = re.search(r"Input \[\d+\]: \[(.*)\]", b).group(1)
        assert "_rb" in inputs and ("_t_" in inputs or "_c#" in inputs), b
    assert partitioned >= 1
