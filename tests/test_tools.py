"""The plan-report summary counts what PLANS.md claims."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from plan_report import summarize  # noqa: E402

PLAN = """== Physical Plan ==
AdaptiveSparkPlan (9)
+- TakeOrderedAndProject (8)
   +- HashAggregate (7)
      +- Exchange (6)
         +- HashAggregate (5)
            +- BroadcastHashJoin Inner BuildRight (4)
               :- Scan parquet  (1)
               +- BroadcastExchange (3)
                  +- Scan parquet  (2)

(1) Scan parquet
PushedFilters: [IsNotNull(l_orderkey)]

(5) HashAggregate
Functions [1]: [partial_count(1)]
"""


def test_summary_counts_shuffles_not_broadcasts():
    s = summarize(PLAN)
    assert s["shuffles"] == "1"
    assert s["joins"] == "BroadcastHashJoin Inner BuildRight"
    assert s["partial aggregates"] == "partial_count"
    assert s["top-k / limits"] == "TakeOrderedAndProject"
    assert s["pushed filters"] == "IsNotNull(l_orderkey)"
