"""Tables with a manifest, and the panel that grows by batches."""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cellpulse.plans.incremental import IncrementalPanel
from cellpulse.queries import views
from cellpulse.queries.catalog import CATALOG
from cellpulse.sources import manifest, tables
from helpers import settings

SCHEMA = "cell_id string, time_window timestamp_ntz, n long"


def rows(days: int, cells: int = 7):
    return [
        (f"c{i}", datetime(2024, 3, 1) + timedelta(hours=6 * w), i * w)
        for i in range(cells) for w in range(4 * days)
    ]


@pytest.fixture()
def stored(spark, tmp_path):
    df = spark.createDataFrame(rows(9), SCHEMA).repartition(6)
    manifest.write(df, str(tmp_path / "t"))
    return df, manifest.Stored(spark, str(tmp_path / "t"), df.schema)


def test_manifest_lists_every_file(stored):
    df, table = stored
    listed = table.manifest.collect()
    assert sum(r.rows for r in listed) == df.count() == table.rows.count()
    assert table.latest() == df.agg(F.max("time_window")).first()[0]
    assert all(r.first.date() == r.last.date() == r.window_date for r in listed)
    one = table.extent().first()
    assert (one.rows, one.folders) == (df.count(), 9) and one.files == len(listed)


def test_a_window_is_read_from_the_files_that_hold_it(stored):
    df, table = stored
    for time in (None, "2024-03-04 12:00:00"):
        found = table.at(time)
        wanted = df.where(F.col("time_window") == (F.lit(table.latest()) if time is None else F.lit(time)).cast("timestamp_ntz"))
        assert found.drop("window_date").exceptAll(wanted).isEmpty() and found.count() == wanted.count() == 7
        assert len(found.inputFiles()) < table.extent().first().files
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*window_date", plan)
    assert table.at("2030-01-01 00:00:00").count() == 0
    assert table.between("2024-03-03 18:00:00", "2024-03-05 00:00:00").count() == 7 * 6
    assert table.between("2030-01-01 00:00:00", "2024-01-01 00:00:00").count() == 0


def test_files_are_bounded_by_tasks_and_folders(spark, tmp_path):
    """Rows that are dealt by cell, each task with all days: not tasks times days files."""
    df = spark.createDataFrame(rows(30, 40), SCHEMA).repartition(16, "cell_id")
    sizes = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    with settings(spark, sizes):
        manifest.write(df, str(tmp_path / "t"))
        manifest.write(df.where("cell_id < 'c2'").withColumn("time_window", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")), str(tmp_path / "one"))
    table = manifest.Stored(spark, str(tmp_path / "t"), df.schema)
    assert table.extent().first().files <= 16 + 30
    # One day with all rows is spread over the tasks.
    hot = manifest.Stored(spark, str(tmp_path / "one"), df.schema)
    assert hot.extent().first().files > 4


def test_an_empty_table_has_no_latest_window(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    manifest.write(df, str(tmp_path / "t"))
    table = manifest.Stored(spark, str(tmp_path / "t"), df.schema)
    assert table.latest() is None and table.at().count() == 0 and table.extent().first().files == 0


def test_panel_months(spark, tmp_path):
    df = spark.createDataFrame(rows(50), SCHEMA)
    tables.write_panel(df, str(tmp_path / "p"))
    table = tables.stored_panel(spark, str(tmp_path / "p"), df.schema)
    assert {r.window_month for r in table.manifest.collect()} == {"2024-03", "2024-04"}
    assert table.between("2024-03-31 00:00:00", "2024-04-01 00:00:00").count() == 7 * 5


def test_no_dashboard_scan_is_unfiltered(spark, folder):
    for name in ("dash_filter", "dash_metrics", "map_layer", "map_points", "hotspots", "dash_performance", "dash_risk_counts", "dash_error_hist"):
        plan = CATALOG[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
        assert scans and all("window_date" in s for s in scans), name


# --- growing by batches ------------------------------------------------------------------------------


@pytest.fixture()
def chain(spark, folder):
    return views.stages(spark, folder)


def same(a, b) -> bool:
    rounded = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in a.dtypes]
    a, b = a.select(rounded), b.select(rounded)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_any_order_of_batches_gives_the_panel_of_all(spark, chain, tmp_path):
    grown = IncrementalPanel(spark, str(tmp_path / "s"), chain.anchored)
    parts = {f"b{i}": chain.incidents.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == i) for i in range(4)}
    for name in ("b3", "b1"):
        grown.add(parts[name], name)
    assert grown.panel().agg(F.sum("incident_count")).first()[0] < chain.panel.agg(F.sum("incident_count")).first()[0]
    for name in ("b0", "b1", "b2", "b3"):  # two of them again
        grown.add(parts[name], name)
    assert same(grown.panel(), chain.panel)
    assert {r.batch for r in grown.batches().collect()} == set(parts)


def test_a_batch_is_replaced_whole(spark, chain, tmp_path):
    grown = IncrementalPanel(spark, str(tmp_path / "s"), chain.anchored)
    grown.add(chain.incidents, "day")
    grown.add(chain.incidents.where("event_id < 100"), "day")
    few = chain.gridded.where("event_id < 100")
    assert grown.panel().agg(F.sum("incident_count")).first()[0] == few.count()


def test_compacting_changes_nothing(spark, chain, tmp_path):
    grown = IncrementalPanel(spark, str(tmp_path / "s"), chain.anchored)
    for i in range(3):
        grown.add(chain.incidents.where(F.col("event_id") % 3 == i), f"b{i}")
    grown.compact("old", ["b0", "b2"])
    assert same(grown.panel(), chain.panel)
    assert {r.batch for r in grown.batches().collect()} == {"old", "b1"}
    month = grown.panel(["2024-01"])
    assert same(month, chain.panel.where("date_format(time_window, 'yyyy-MM') = '2024-01'"))
    with pytest.raises(ValueError):
        grown.compact("b1", ["b1"])


def test_growing_needs_a_fixed_grid_and_plain_names(spark, chain, tmp_path):
    with pytest.raises(ValueError):
        IncrementalPanel(spark, str(tmp_path), replace(chain.config, origin=None))
    grown = IncrementalPanel(spark, str(tmp_path / "none"), chain.anchored)
    assert grown.batches().count() == 0
    with pytest.raises(FileNotFoundError):
        grown.panel()
    with pytest.raises(ValueError):
        grown.add(chain.incidents, "../other")
