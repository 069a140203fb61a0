"""The cell by window panel and its summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cellpulse.config import SLOT_LABELS
from cellpulse.functions import calendar, spatial


KEY = ("grid_lat_idx", "grid_lon_idx", "time_window")
SLOTS = tuple(f"_slot{i}" for i in range(len(SLOT_LABELS)))


def partial_panel(gridded: DataFrame) -> DataFrame:
    """Sums, counts and minima per cell and window, from which `merged_panel` makes the rows of the panel.

    Partial rows of any parts of the incidents add up to those of all. Grouped by the integer indices, so a hot cell is
    folded to one row per task before the single shuffle.
    """
    code = calendar.slot_code(F.col("hour"))
    return gridded.groupBy(*KEY).agg(
        F.min("cell_center_lat").alias("cell_center_lat"),
        F.min("cell_center_lon").alias("cell_center_lon"),
        F.count("category").alias("incident_count"),
        F.sum("hour").alias("_hours"),
        F.count("hour").alias("_timed"),
        F.min("day_of_week").alias("day_of_week"),
        F.min("is_weekend").alias("is_weekend"),
        *[F.count_if(code == i).alias(name) for i, name in enumerate(SLOTS)],
    )


def merged_panel(partial: DataFrame) -> DataFrame:
    """The panel of partial rows, several of which may be of one cell and window."""
    totals = ("incident_count", "_hours", "_timed", *SLOTS)
    least = ("cell_center_lat", "cell_center_lon", "day_of_week", "is_weekend")
    whole = partial.groupBy(*KEY).agg(*[F.min(c).alias(c) for c in least], *[F.sum(c).alias(c) for c in totals])
    return _finished(whole.withColumn("hour", F.try_divide("_hours", "_timed")))


def grid_time_panel(gridded: DataFrame) -> DataFrame:
    """One row per cell and window that holds an incident.

    Every measure, the slot mode included, is a sum, a count or a minimum: one partial aggregation, one shuffle.
    """
    return _finished(partial_panel(gridded).withColumn("hour", F.try_divide("_hours", "_timed")))


def _finished(counted: DataFrame) -> DataFrame:
    """The mode is read off one counter per slot, the earliest slot winning a tie."""
    most = F.greatest(*SLOTS)
    mode = reduce(lambda when, i: when.when(F.col(SLOTS[i]) == most, i), range(1, len(SLOTS)),
                  F.when(F.col(SLOTS[0]) == most, 0))
    return counted.select(
        spatial.cell_name(F.col("grid_lat_idx"), F.col("grid_lon_idx")).alias("cell_id"),
        "time_window",
        "grid_lat_idx",
        "grid_lon_idx",
        "cell_center_lat",
        "cell_center_lon",
        "incident_count",
        "hour",
        "day_of_week",
        "is_weekend",
        calendar.slot_label(mode).alias("time_slot"),
    )


def incident_summary(gridded: DataFrame) -> DataFrame:
    """One row: incidents, cells, windows and the span of whole days.

    Incidents are folded to cells and windows first, so distinct counting never expands raw rows.
    """
    folded = gridded.groupBy("cell_id", "time_window").agg(
        F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    return folded.agg(
        F.sum("n").alias("incidents"),
        F.count_distinct("cell_id").alias("cells"),
        F.count_distinct("time_window").alias("windows"),
        whole_days("first_ts", "last_ts").alias("span_days"),
    )


def panel_summary(panel: DataFrame) -> DataFrame:
    """One row: observations, cells, windows, mean and largest count."""
    return panel.agg(
        F.count("*").alias("observations"),
        F.count_distinct("cell_id").alias("cells"),
        F.count_distinct("time_window").alias("windows"),
        F.sum("incident_count").alias("incidents"),
        F.avg("incident_count").alias("mean_count"),
        F.max("incident_count").alias("max_count"),
    )


def whole_days(first: str, last: str | None = None):
    """Completed days between the smallest `first` and the largest `last` of timestamp columns."""
    span = F.timestamp_diff("SECOND", F.min(first), F.max(last or first))
    return F.floor(span / 86400).cast("int")
