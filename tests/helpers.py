"""Small fixtures shared by the tests."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pandas as pd

PANEL = (
    "cell_id string, time_window timestamp_ntz, grid_lat_idx int, grid_lon_idx int, cell_center_lat double, "
    "cell_center_lon double, incident_count long, hour double, day_of_week int, is_weekend int, time_slot string"
)


def panel_rows(cells: dict[str, list[int]], start: str = "2024-01-01") -> pd.DataFrame:
    """Consecutive six-hour windows with the given counts; a cell is named `lat_lon`."""
    rows = []
    for cell, values in cells.items():
        lat, lon = map(int, cell.split("_"))
        for i, value in enumerate(values):
            time = pd.Timestamp(start) + pd.Timedelta(hours=6 * i)
            rows.append(
                (cell, time, lat, lon, 41.6 + lat * 0.05, -88 + lon * 0.05, value, time.hour + 0.5, time.dayofweek,
                 int(time.dayofweek >= 5), "Night")
            )
    return pd.DataFrame(rows, columns=[c.split()[0] for c in PANEL.split(", ")])


def random_panel(seed: int, cells: int = 12, windows: int = 20, side: int = 5) -> pd.DataFrame:
    chance = np.random.default_rng(seed)
    names = {f"{chance.integers(side)}_{chance.integers(side)}" for _ in range(cells)}
    frame = panel_rows({name: list(chance.integers(1, 9, windows)) for name in sorted(names)})
    return frame[chance.random(len(frame)) < 0.7].reset_index(drop=True)


def to_spark(spark, frame: pd.DataFrame, schema: str = PANEL):
    return spark.createDataFrame(frame, schema)


def sorted_pandas(df, *keys: str) -> pd.DataFrame:
    return df.toPandas().sort_values(list(keys)).reset_index(drop=True)


@contextmanager
def settings(spark, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
