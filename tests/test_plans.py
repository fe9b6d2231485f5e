"""Plan guards: the shapes the scale design depends on stay in place."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from tidemark.plans.catalog import QUERIES as CATALOG

from conftest import SF_SMALL

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
# Queries that run a streaming or write job while being built (checked elsewhere).
SIDE_EFFECTS = {"stream_vs_batch", "visible_after_compaction", "compaction_history", "gold_incremental", "history_last_5",
                "visible_after_replay", "visible_after_new_rows", "compaction_new_rows", "visible_arranged",
                "visible_arranged_replay", "sized_sink", "restart_delivery", "ingest_stamps"}


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(CATALOG) - SIDE_EFFECTS))
def test_no_pair_joins_or_python_in_plans(spark, name):
    plan = plan_of(E.queries()[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_gold_limits_before_shuffle(spark):
    plan = plan_of(E.queries()["gold_current"](spark, SF_SMALL))
    tree = plan.split("\n\n")[0]
    lines = [l for l in tree.splitlines() if "WindowGroupLimit" in l or "Exchange" in l]
    # bottom-up: a partial WindowGroupLimit sits below the first hash exchange
    assert "WindowGroupLimit" in lines[-1]
    assert "Partial" in plan


def test_event_mix_combines_map_side(spark):
    plan = plan_of(E.queries()["event_mix"](spark, SF_SMALL))
    assert "partial_count" in plan


def test_preview_is_top_n(spark):
    assert "TakeOrderedAndProject" in plan_of(E.queries()["silver_newest"](spark, SF_SMALL))
