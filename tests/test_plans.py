"""Shape of the physical plans: what must not appear at any scale."""

from __future__ import annotations

import re

from cellpulse.queries import views
from cellpulse.queries.catalog import CATALOG


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_panel_is_one_partial_aggregation(spark, folder):
    plan = plan_of(views.stages(spark, folder).build_panel())
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_features_move_wide_rows_twice(spark, folder):
    plan = plan_of(views.stages(spark, folder).build_features())
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#\d+(?:, (\w+)#\d+)?", plan)
    wide = [keys for keys in moved if keys[0] in ("cell_id", "time_window")]
    assert sorted(wide) == [("cell_id", ""), ("time_window", "_grid_row")]
    assert "SinglePartition" not in plan


def test_filters_and_columns_reach_the_scan(spark, folder):
    plan = plan_of(CATALOG["dash_filter"](spark, folder))
    assert "IsNotNull(time_window)" in plan
    assert max(len(s.split(",")) for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan)) <= 3


def test_dashboard_reads_the_folder_of_one_day(spark, folder):
    for name in ("dash_filter", "dash_metrics", "map_layer", "hotspots", "dash_performance", "dash_risk_counts"):
        scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan_of(CATALOG[name](spark, folder)))
        assert any("window_date" in s and ("=" in s or "subquery" in s) for s in scans), name
