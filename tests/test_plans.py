"""What no plan may contain, for every registered query."""

import pytest
from helpers import plan

from workload.queries import REGISTERED

SF = "/root/testdata/sf0.001"
# Python per row, every pair of rows, or a whole table sorted in one task.
FORBIDDEN = ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD")
# The plans that start by publishing are those of reading a lake back; one stands for them.
QUICK = [name for name in REGISTERED if "lake" not in name and name not in ("run_events", "share_replace", "time_travel", "stream_drain", "cdc_dedupe_stream")]


@pytest.mark.parametrize("name", [*QUICK, "lake_after_two_runs"])
def test_plan_has_no_forbidden_operator(spark, name):
    shown = plan(REGISTERED[name](spark, SF), "simple")
    assert [word for word in FORBIDDEN if word in shown] == []
