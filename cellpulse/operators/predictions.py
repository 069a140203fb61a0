"""The table of predictions: projection, error and risk level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cellpulse.config import GridConfig
from cellpulse.functions import scores
from cellpulse.operators.split import split_at

# Columns of the predictions table; the second group is kept where present.
KEPT = (
    "cell_id", "time_window", "cell_center_lat", "cell_center_lon", "grid_lat_idx", "grid_lon_idx",
    "target", "hour", "day_of_week", "is_weekend",
)
KEPT_IF_PRESENT = (
    "cell_avg_incidents", "rolling_mean_14", "lag_1", "momentum", "neighbor_mean", "hour_avg_incidents",
    "month", "day_of_month",
)


def predictions(features: DataFrame, predicted: Column, config: GridConfig) -> DataFrame:
    """Kept columns, the prediction, its absolute error and the bounded risk level."""
    present = set(features.columns)
    return (
        features.select(*KEPT, *[c for c in KEPT_IF_PRESENT if c in present], predicted.alias("ultra_predicted"))
        .withColumns(
            {
                "ultra_error": scores.absolute_error(F.col("target"), F.col("ultra_predicted")),
                "risk_level": scores.bounded_risk(F.col("ultra_predicted"), config.bounded_risk_edges),
            }
        )
    )


def with_open_risk(df: DataFrame, config: GridConfig, predicted: str = "ultra_predicted") -> DataFrame:
    return df.withColumn("risk_level", scores.open_risk(F.col(predicted), config.open_risk_edges))


def recent_rows(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The last `rows` rows in the order of (window, cell); all rows without a number.

    The first of them is found from counts per window and per cell of one window; keeping what follows is
    then a comparison, instead of a sort that sends `rows` rows per task to one task.
    """
    total = 0 if rows is None else df.count()
    if rows is None or total <= rows:
        return df
    return split_at(df, [total - rows], ("older", "recent"), ("time_window", "cell_id")).part(df, "recent")


def residuals(df: DataFrame, predicted: str = "ultra_predicted") -> DataFrame:
    return df.select(
        "cell_id", "time_window", F.col(predicted).alias("predicted"),
        (F.col("target") - F.col(predicted)).alias("residual"),
    )


def top_predictions(df: DataFrame, k: int = 5, predicted: str = "ultra_predicted", error: str = "ultra_error") -> DataFrame:
    return (
        df.orderBy(F.desc(predicted), "cell_id", "time_window")
        .limit(k)
        .select("cell_id", "time_window", predicted, "target", error)
    )
