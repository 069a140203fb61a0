"""Mapping of points onto a regular grid and of timestamps onto fixed windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cellpulse.config import GridConfig
from cellpulse.functions import calendar, spatial


def data_bounds(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("lat").alias("lat_min"),
        F.max("lat").alias("lat_max"),
        F.min("lon").alias("lon_min"),
        F.max("lon").alias("lon_max"),
    )


def grid_metadata(df: DataFrame, config: GridConfig) -> DataFrame:
    """One row describing the grid that covers the data."""
    size = F.lit(float(config.cell_degrees))

    def cells(axis: str):
        return F.ceil((F.col(f"{axis}_max") - F.col(f"{axis}_min")) / size)

    return (
        data_bounds(df)
        .withColumns(
            {
                "cell_size_degrees": size,
                "cell_size_meters": F.lit(float(config.cell_meters)),
                "n_lat_cells": cells("lat"),
                "n_lon_cells": cells("lon"),
            }
        )
        .withColumn("total_cells", F.col("n_lat_cells") * F.col("n_lon_cells"))
    )


def assign_cells(df: DataFrame, config: GridConfig) -> DataFrame:
    """Adds cell indices, the cell name and the cell centre.

    Without a configured origin the minimum of the data is looked up by a scalar subquery: a scan
    that is aggregated before it is shuffled, with no join in the main plan.
    """
    if config.origin is None:
        corner = data_bounds(df).select(F.struct("lat_min", "lon_min")).scalar()
    else:
        corner = F.struct(
            F.lit(config.origin[0]).alias("lat_min"), F.lit(config.origin[1]).alias("lon_min")
        )
    lat0, lon0 = F.col("_corner.lat_min"), F.col("_corner.lon_min")
    size = config.cell_degrees
    return (
        df.withColumn("_corner", corner)
        .withColumns(
            {
                "grid_lat_idx": spatial.cell_index(F.col("lat"), lat0, size),
                "grid_lon_idx": spatial.cell_index(F.col("lon"), lon0, size),
            }
        )
        .withColumns(
            {
                "cell_id": spatial.cell_name(F.col("grid_lat_idx"), F.col("grid_lon_idx")),
                "cell_center_lat": spatial.cell_center(F.col("grid_lat_idx"), lat0, size),
                "cell_center_lon": spatial.cell_center(F.col("grid_lon_idx"), lon0, size),
            }
        )
        .drop("_corner")
    )


def assign_windows(df: DataFrame, config: GridConfig) -> DataFrame:
    """Adds the time window and the calendar parts of `ts`."""
    return (
        df.withColumns(
            {
                "time_window": calendar.window_start("ts", config.window_hours),
                "hour": F.hour("ts"),
                "day_of_week": calendar.monday_weekday("ts"),
                "day_of_month": F.dayofmonth("ts"),
                "month": F.month("ts"),
            }
        )
        .withColumns(
            {
                "is_weekend": calendar.weekend_flag(F.col("day_of_week")),
                "time_slot": calendar.slot_label(calendar.slot_code(F.col("hour"))),
            }
        )
    )
