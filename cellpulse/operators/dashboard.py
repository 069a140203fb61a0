"""Parameterised views over a table of predictions that has the open risk level."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellpulse.config import RISK_LABELS
from cellpulse.operators.histograms import equal_width

P, E = "ultra_predicted", "ultra_error"


def at_time(df: DataFrame, time: str | datetime | None = None) -> Column:
    """Filter on one window, the latest by default.

    Of a stored table (`sources.manifest`) give the rows that `Stored.at` finds and their time: then only the files of
    that window are read, and no search for the latest one runs.
    """
    kind = df.schema["time_window"].dataType
    latest = F.lit(time).cast(kind) if time is not None else df.agg(F.max("time_window")).scalar()
    return F.col("time_window") == latest


def select_rows(
    df: DataFrame, time: str | datetime | None = None, levels: Sequence[str] = RISK_LABELS, min_prediction: float = 0.0
) -> DataFrame:
    return df.where(at_time(df, time) & F.col("risk_level").isin(*levels) & (F.col(P) >= min_prediction))


def metrics(df: DataFrame, threshold: float = 5.0, **filters) -> DataFrame:
    rows = select_rows(df, **filters)
    return rows.agg(
        F.sum(P).alias("total_predicted"),
        F.sum("target").alias("total_actual"),
        F.count_if(F.col(P) >= threshold).alias("high_risk_count"),
        F.avg(E).alias("avg_error"),
        (F.avg((F.col(E) < 0.5).cast("double")) * 100).alias("accuracy"),
        F.count("*").alias("n_cells"),
        *[F.count_if(F.col("risk_level") == level).alias(f"{level.lower()}_count") for level in RISK_LABELS],
    )


def _digest() -> Column:
    return F.md5(F.concat_ws(":", "cell_id", F.date_format("time_window", "yyyy-MM-dd HH:mm:ss")))


def map_layer(df: DataFrame, threshold: float = 5.0, sample: int | None = None, **filters) -> DataFrame:
    """Marker position, size, the figures of its label and alert flag, with the map centre on every row.

    More than `sample` rows are cut by the digest of their key, so the same rows are shown every time.
    """
    rows = select_rows(df, **filters)
    if sample is not None:
        rows = rows.orderBy(_digest(), "cell_id").limit(sample)
    center = rows.agg(F.struct(F.avg("cell_center_lat").alias("lat"), F.avg("cell_center_lon").alias("lon"))).scalar()
    return rows.withColumn("_center", center).select(
        "cell_id",
        "cell_center_lat",
        "cell_center_lon",
        P,
        (F.sqrt(P) * 5 + 3).alias("marker_size"),
        "target",
        "risk_level",
        (F.col(P) >= threshold).alias("high_risk"),
        F.col("_center.lat").alias("map_center_lat"),
        F.col("_center.lon").alias("map_center_lon"),
    )


def performance(df: DataFrame, time: str | datetime | None = None) -> DataFrame:
    """Actual and predicted value of every cell at one time with the shared axis end."""
    rows = df.where(at_time(df, time))
    end = rows.agg(F.greatest(F.max("target"), F.max(P))).scalar()
    return rows.select("cell_id", "target", P, E, "risk_level").withColumn("axis_max", end)


def risk_counts(df: DataFrame, time: str | datetime | None = None) -> DataFrame:
    return df.where(at_time(df, time)).groupBy("risk_level").agg(F.count("*").alias("n"))


def error_histogram(df: DataFrame, time: str | datetime | None = None, bins: int = 50) -> DataFrame:
    return equal_width(df.where(at_time(df, time)), E, bins)


def hotspots(df: DataFrame, n: int = 10, time: str | datetime | None = None) -> DataFrame:
    """The n cells with the highest prediction at one time; n rows reach the ranking window."""
    top = df.where(at_time(df, time)).orderBy(F.desc(P), "cell_id").limit(n)
    return top.select(
        F.row_number().over(Window.orderBy(F.desc(P), "cell_id")).alias("position"),
        "cell_id",
        P,
        "target",
        E,
        "risk_level",
    )


def window_list(df: DataFrame) -> DataFrame:
    return df.select("time_window").distinct().orderBy("time_window")


def overview(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_records"),
        F.to_date(F.min("time_window")).alias("first_date"),
        F.to_date(F.max("time_window")).alias("last_date"),
        F.count_distinct("time_window").alias("n_windows"),
    )


def heat_points(df: DataFrame) -> DataFrame:
    return df.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select("lat", "lon")


def map_center(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("lat").alias("center_lat"), F.avg("lon").alias("center_lon"))


def cluster_points(df: DataFrame, key: str, n: int | None = None) -> DataFrame:
    """All points, or the first n by key, with their popup text."""
    return (
        (df if n is None else df.orderBy(key).limit(n))
        .select(key, "lat", "lon", F.concat(F.lit("Category: "), F.coalesce("category", F.lit("Unknown"))).alias("popup"))
    )


def top_importance(importance: DataFrame, n: int = 20) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)
