"""Plan shapes the scale design relies on, checked on the registered queries.

Correctness is tested elsewhere; these tests pin what would hurt at
100 TB if it regressed silently: pair-emitting joins, row-at-a-time
Python, shuffles of the raw rows where a partial aggregate or a map-side
limit should come first, and scans that read unneeded columns.
"""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as E

from .conftest import SF0001, needs


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scan_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\]]*?>)(?:,|$|\s)", plan)


@needs(SF0001)
@pytest.mark.parametrize("key", sorted(set(E.queries()) - set(E.EXTRA)))
def test_no_pair_joins_and_no_row_at_a_time_python(spark, key):
    plan = _plan(E.queries()[key](spark, SF0001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # Python only as Arrow batches (ArrowEvalPython / MapInPandas)
    # Whatever is gathered into one partition is already reduced: one partial aggregate row per task.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "partial_" in lines[i + 1], lines[i + 1]


@needs(SF0001)
@pytest.mark.parametrize("key", ["word_count", "vocabulary_size", "max_norm_rating"])
def test_aggregates_combine_map_side_before_the_shuffle(spark, key):
    plan = _plan(E.queries()[key](spark, SF0001))
    # A partial aggregate feeds every hash exchange: a hot key costs one row per task.
    assert re.search(r"functions=\[partial_", plan)
    assert "Exchange hashpartitioning" in plan


@needs(SF0001)
def test_terms_are_counted_where_their_row_lies(spark):
    plan = _plan(E.queries()["doc_term_counts"](spark, SF0001))
    assert "hashpartitioning" not in plan and "Aggregate" not in plan and "Sort" not in plan.replace("sort_array", "")
    # the one exchange left spreads the texts of a file of few row groups, before they are split
    assert all("RoundRobinPartitioning" in line for line in plan.splitlines() if "Exchange" in line)


@needs(SF0001)
def test_stratified_sample_limits_map_side_and_never_shuffles_points_for_sizes(spark):
    plan = _plan(E.queries()["stratified_sample"](spark, SF0001))
    assert plan.count("WindowGroupLimit") >= 2  # partial (before the exchange) and final
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


@needs(SF0001)
def test_scans_are_pruned(spark):
    q = E.queries()
    word_scans = _scan_schemas(_plan(q["word_count"](spark, SF0001)))
    assert word_scans == ["struct<text:string>"]
    salted_scans = _scan_schemas(_plan(q["word_count_salted"](spark, SF0001)))
    assert salted_scans == ["struct<doc_id:bigint,text:string>"]  # the salt hashes (doc, word)
    rating_scans = sorted(_scan_schemas(_plan(q["user_mean_rating"](spark, SF0001))))
    # The user mean needs no product column: only the join keys and the rating are read.
    assert rating_scans == ["struct<l_orderkey:bigint,l_quantity:double>", "struct<o_orderkey:bigint,o_custkey:bigint>"]
    point_scans = _scan_schemas(_plan(q["cluster_sizes"](spark, SF0001)))
    assert point_scans == ["struct<label:int>"]


def test_hot_keys_never_land_in_one_task():
    """Runs scripts/skew_check.py (own Spark process, event log) on 600k rows per fixture."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    rows = 600_000
    out = subprocess.run(
        [sys.executable, os.path.join(root, "scripts", "skew_check.py"), str(rows)],
        capture_output=True, text=True, timeout=900, check=True,
    ).stdout
    found = {}
    for line in out.splitlines():
        m = re.match(r"(.*): largest single-task share of a full-data stage ([\d.]+)%, rows shuffled ([\d,]+) of", line)
        if m:
            found[m.group(1)] = (float(m.group(2)) / 100, int(m.group(3).replace(",", "")))
    assert len(found) == 5, out
    assert found["ratings, join (hot users split off)"][0] < 0.10
    assert found["ratings, lazy_join (plain shuffle join)"][0] > 0.20  # the failure mode the split avoids
    assert found["word count, hot word"][0] < 0.10
    assert found["stratified sample t=20, hot cluster"][1] < 5_000
    assert found["exact silhouette, hot cluster"][1] < 5_000
