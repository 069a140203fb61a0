from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from cellpulse.config import GridConfig
from cellpulse.operators import clean, grid, neighbors, panel
from helpers import random_panel, sorted_pandas, to_spark

INCIDENT = "ts timestamp_ntz, lat double, lon double, category string"


def incident(hour: int, lat: float, lon: float, category: str = "x", day: int = 1):
    return (dt.datetime(2024, 1, day, hour, 30), lat, lon, category)


def make_panel(spark, rows, config):
    df = clean.clean_incidents(spark.createDataFrame(rows, INCIDENT), config)
    return panel.grid_time_panel(grid.assign_windows(grid.assign_cells(df, config), config))


def test_cleaning_keeps_box_edges_and_counts(spark):
    rows = [
        incident(1, 41.6, -88.0), incident(1, 42.1, -87.5), incident(1, 42.1001, -87.5),
        (None, 41.7, -87.6, "x"), (dt.datetime(2024, 1, 1), None, -87.6, "x"), (dt.datetime(2024, 1, 1), 41.7, -87.6, None),
    ]
    df = spark.createDataFrame(rows, INCIDENT)
    assert clean.clean_incidents(df, GridConfig()).count() == 2
    assert tuple(clean.cleaning_counts(df, GridConfig()).first()) == (6, 3, 1, 2)


def test_slot_tie_goes_to_the_earlier_slot(spark):
    config = GridConfig(window_hours=12, cell_degrees=0.25)
    made = make_panel(spark, [incident(6, 41.7, -87.9), incident(7, 41.7, -87.9)], config).collect()
    assert [(r.time_slot, r.hour, r.incident_count) for r in made] == [("Night", 6.5, 2)]


@pytest.mark.parametrize("hour,slot", [(0, "Night"), (6, "Night"), (7, "Morning"), (12, "Morning"), (13, "Afternoon"), (18, "Afternoon"), (19, "Evening"), (23, "Evening")])
def test_slots(spark, hour, slot):
    df = grid.assign_windows(spark.createDataFrame([incident(hour, 41.7, -87.9)], INCIDENT), GridConfig())
    row = df.first()
    assert row.time_slot == slot
    assert row.time_window == dt.datetime(2024, 1, 1, hour // 6 * 6)
    assert (row.day_of_week, row.is_weekend) == (0, 0)


def test_weekend_is_saturday_and_sunday(spark):
    rows = [incident(1, 41.7, -87.9, day=d) for d in range(1, 8)]
    df = grid.assign_windows(spark.createDataFrame(rows, INCIDENT), GridConfig())
    assert [r.is_weekend for r in df.orderBy("ts").collect()] == [0, 0, 0, 0, 0, 1, 1]


def test_span_that_is_a_multiple_of_the_cell_reaches_one_index_more(spark):
    config = GridConfig(cell_degrees=0.25)
    df = spark.createDataFrame([incident(1, 41.5, -88.0), incident(1, 42.0, -87.5)], INCIDENT)
    assert max(r.grid_lat_idx for r in grid.assign_cells(df, config).collect()) == 2
    meta = grid.grid_metadata(df, config).first()
    assert (meta.n_lat_cells, meta.n_lon_cells, meta.total_cells) == (2, 2, 4)


def test_fixed_origin_needs_no_second_scan(spark):
    config = GridConfig(cell_degrees=0.25, origin=(41.5, -88.0))
    df = grid.assign_cells(spark.createDataFrame([incident(1, 41.8, -87.6)], INCIDENT), config)
    assert df.first().cell_id == "1_1"
    assert "Subquery" not in df._jdf.queryExecution().executedPlan().toString()


def brute_force(frame, radius):
    out = []
    for _, row in frame.iterrows():
        near = frame[
            (frame.time_window == row.time_window)
            & ((frame.grid_lat_idx - row.grid_lat_idx).abs() <= radius)
            & ((frame.grid_lon_idx - row.grid_lon_idx).abs() <= radius)
            & (frame.cell_id != row.cell_id)
        ].incident_count
        out.append((near.sum(), near.mean() if len(near) else 0.0, near.max() if len(near) else 0))
    return np.array(out, dtype=float)


@pytest.mark.parametrize("seed,radius", [(1, 1), (2, 1), (3, 2), (4, 3)])
def test_neighbors_equal_brute_force(spark, seed, radius):
    frame = random_panel(seed, cells=18).sort_values(["cell_id", "time_window"]).reset_index(drop=True)
    made = sorted_pandas(neighbors.neighbor_features(to_spark(spark, frame), radius), "cell_id", "time_window")
    assert len(made) == len(frame)
    np.testing.assert_allclose(made[["neighbor_sum", "neighbor_mean", "neighbor_max"]].astype(float), brute_force(frame, radius))
    assert list(made.columns[: len(frame.columns)]) == list(frame.columns)


def test_hot_cell_gives_the_same_counts(spark):
    rows = [incident(1, 41.65, -87.95)] * 3000 + [incident(h, 41.7 + h / 100, -87.9) for h in range(20)] * 10
    made = make_panel(spark, rows, GridConfig(cell_degrees=0.05))
    assert made.agg({"incident_count": "sum"}).first()[0] == 3200
    assert made.agg({"incident_count": "max"}).first()[0] == 3000
