"""Row-wise features and the assembled feature matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cellpulse.config import GridConfig
from cellpulse.functions import calendar, spatial
from cellpulse.operators import ewma, history, neighbors, slots

# Columns of the matrix that are not model inputs.
NOT_FEATURES = (
    "cell_id", "time_window", "cell_center_lat", "cell_center_lon", "grid_lat_idx", "grid_lon_idx",
    "time_slot", "incident_count", "target", "target_binary",
)
# The names `calendar_columns` produces.
CALENDAR = (
    "month", "day_of_month", "week_of_year", "hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin", "month_cos",
)


def default_nulls(panel: DataFrame) -> DataFrame:
    """Noon, Monday and weekday where the calendar parts are missing."""
    return panel.withColumns(
        {
            "hour": F.coalesce("hour", F.lit(12.0)),
            "day_of_week": F.coalesce("day_of_week", F.lit(0)),
            "is_weekend": F.coalesce("is_weekend", F.lit(0)),
        }
    )


def calendar_columns() -> dict[str, Column]:
    parts = {
        "month": F.month("time_window"),
        "day_of_month": F.dayofmonth("time_window"),
        "week_of_year": F.weekofyear("time_window"),
    }
    cycles = (("hour", F.col("hour"), 24), ("day", F.col("day_of_week"), 7), ("month", parts["month"], 12))
    waves = {}
    for name, value, period in cycles:
        waves[f"{name}_sin"], waves[f"{name}_cos"] = calendar.cycle(value, period)
    return {**parts, **waves}


def temporal_features(panel: DataFrame) -> DataFrame:
    return default_nulls(panel).withColumns(calendar_columns())


def feature_columns(df: DataFrame) -> list[str]:
    """The model inputs of a feature matrix, in column order."""
    return [name for name in df.columns if name not in NOT_FEATURES]


def _history_matrix(panel: DataFrame, config: GridConfig) -> DataFrame:
    seen = slots.slot_features(
        neighbors.neighbor_features(default_nulls(panel), config.neighbor_radius), default_nulls(panel)
    )
    return (
        seen.withColumns(
            {
                **history.lag_columns(config.history),
                **history.cell_columns(),
                **history.momentum_columns(),
                **history.target_columns(),
            }
        )
        .withColumns(history.trend_columns())
    )


def base_names(config: GridConfig) -> list[str]:
    lags = [f"{kind}_{n}" for n in config.history for kind in ("lag", "rolling_mean", "rolling_max", "rolling_std")]
    return [
        "cell_id", "time_window", "grid_lat_idx", "grid_lon_idx", "cell_center_lat", "cell_center_lon",
        "incident_count", "hour", "day_of_week", "is_weekend", "time_slot",
        *CALENDAR, *lags,
        "neighbor_sum", "neighbor_mean", "neighbor_max",
        "cell_avg_incidents", "cell_std_incidents", "cell_max_incidents", "cell_total_incidents",
        "dow_avg_incidents", "hour_avg_incidents", "weekend_avg_incidents",
        "trend_short", "trend_long", "momentum", "target", "target_binary",
    ]


def feature_matrix(panel: DataFrame, config: GridConfig) -> DataFrame:
    """All base features; rows without a next observation are left out."""
    return (
        _history_matrix(panel, config)
        .where(F.col("target").isNotNull())
        .withColumns(calendar_columns())
        .select(*base_names(config))
    )


def advanced_columns(config: GridConfig) -> dict[str, Column]:
    """Distance, periodic, flag, volatility and interaction features of rows that have the base features."""
    hour = F.col("hour")
    first, second = calendar.cycle(hour, 24), calendar.cycle(hour, 24, harmonic=2)
    week = calendar.cycle(F.col("week_of_year"), 52)
    rush = calendar.hour_between(hour, 7, 9) | calendar.hour_between(hour, 16, 18)
    night = ((hour >= 22) | (hour <= 5)).cast("int")
    center = [F.lit(value) for value in config.city_center]
    distance = spatial.degree_distance(F.col("cell_center_lat"), F.col("cell_center_lon"), *center)
    volatility = {f"volatility_{n}": F.col(f"rolling_std_{n}") for n in config.volatility_windows}
    return {
        "dist_to_center": distance,
        "hour_fourier_1": first[0],
        "hour_fourier_2": first[1],
        "hour_fourier_3": second[0],
        "hour_fourier_4": second[1],
        "week_fourier_1": week[0],
        "week_fourier_2": week[1],
        "is_rush_hour": rush.cast("int"),
        "is_night": night,
        "is_prime_crime_time": calendar.hour_between(hour, 18, 23).cast("int"),
        **volatility,
        "trend_x_volatility": F.col("trend_short") * F.col("rolling_std_3"),
        "neighbor_x_hour": F.col("neighbor_mean") * hour,
        "cellavg_x_weekend": F.col("cell_avg_incidents") * F.col("is_weekend"),
        "dist_x_night": distance * night,
    }


# The added inputs in the order models expect them.
ADVANCED = (
    "dist_to_center", "hour_fourier_1", "hour_fourier_2", "hour_fourier_3", "hour_fourier_4",
    "week_fourier_1", "week_fourier_2", "is_rush_hour", "is_night", "is_prime_crime_time",
    "ewma_3", "ewma_7", "volatility_3", "volatility_7", "acceleration",
    "lag1_x_ewma3", "trend_x_volatility", "neighbor_x_hour", "cellavg_x_weekend", "dist_x_night",
    "lag1_percentile",
)


def advanced_matrix(panel: DataFrame, config: GridConfig) -> DataFrame:
    """Base and advanced features in one pass: every cell window reuses the exchange by cell."""
    base = _history_matrix(panel, config).where(F.col("target").isNotNull())
    return (
        history.rank_share(ewma.ewma_features(base, config.ewma_spans))
        .withColumns(calendar_columns())
        .withColumns(advanced_columns(config))
        .withColumn("lag1_x_ewma3", F.col("lag_1") * F.col("ewma_3"))
        .select(*base_names(config)[:-2], *ADVANCED, "target", "target_binary")
    )


def pairwise_interactions(features: DataFrame) -> DataFrame:
    """The ten older interaction features; a ratio is a / (b + 1)."""
    c = F.col
    return features.withColumns(
        {
            "cell_avg_x_hour": c("cell_avg_incidents") * c("hour"),
            "recent_to_longterm": c("rolling_mean_3") / (c("rolling_mean_14") + 1),
            "lag1_x_hour": c("lag_1") * c("hour"),
            "lag1_to_rolling_mean7": c("lag_1") / (c("rolling_mean_7") + 1),
            "neighbor_mean_x_lag3": c("neighbor_mean") * c("lag_3"),
            "rolling_mean_3_x_dow": c("rolling_mean_3") * c("day_of_week"),
            "trend_short_x_weekend": c("trend_short") * c("is_weekend"),
            "lag1_x_weekend": c("lag_1") * c("is_weekend"),
            "rolling_mean_3_squared": c("rolling_mean_3") * c("rolling_mean_3"),
            "lag_1_squared": c("lag_1") * c("lag_1"),
        }
    )


def incident_features(df: DataFrame) -> DataFrame:
    """Calendar parts and flags of single incidents; night is 20:00 to 06:59 here."""
    return df.withColumns(
        {"hour": F.hour("ts"), "day_of_week": calendar.monday_weekday("ts"), "month": F.month("ts")}
    ).withColumns(
        {
            "is_weekend": calendar.weekend_flag(F.col("day_of_week")),
            "is_night": ((F.col("hour") >= 20) | (F.col("hour") <= 6)).cast("int"),
        }
    )


def distance_from_mean(df: DataFrame) -> DataFrame:
    """Adds `dist_from_center`, the distance in degrees to the mean position of all rows."""
    middle = df.agg(F.struct(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))).scalar()
    return (
        df.withColumn("_middle", middle)
        .withColumn(
            "dist_from_center",
            spatial.degree_distance(F.col("lat"), F.col("lon"), F.col("_middle.lat"), F.col("_middle.lon")),
        )
        .drop("_middle")
    )


def align_features(df: DataFrame, expected: list[str]) -> DataFrame:
    """The expected model inputs in order, 0 for those the frame lacks, after the other columns."""
    present = set(df.columns)
    others = [name for name in df.columns if name not in expected]
    return df.select(
        *others,
        *[F.col(name) if name in present else F.lit(0.0).alias(name) for name in expected],
    )
