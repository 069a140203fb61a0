"""Average activity of a weekday, an hour and a weekend flag, looked up for every row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cellpulse.operators.lookup import FREQUENT, spread_lookup


def slot_averages(df: DataFrame, key: str, name: str, value: str = "incident_count") -> DataFrame:
    """Mean of `value` per key, with the number of rows in `_rows`."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value).alias(name), F.count("*").alias("_rows"))


def slot_features(df: DataFrame, panel: DataFrame | None = None, frequent: int = FREQUENT) -> DataFrame:
    """Adds `dow_avg_incidents`, `hour_avg_incidents`, `weekend_avg_incidents`.

    Weekdays and weekend flags have 7 and 2 values, so those lookups are broadcast. The hour of a panel
    row is a mean, its distinct values grow with the data and one of them may hold a third of all rows:
    that lookup is a join which finds its frequent values in place.
    """
    source = df if panel is None else panel
    days = slot_averages(source, "day_of_week", "dow_avg_incidents").drop("_rows")
    weekends = slot_averages(source, "is_weekend", "weekend_avg_incidents").drop("_rows")
    hours = slot_averages(source, "hour", "hour_avg_incidents")
    known = df.join(F.broadcast(days), "day_of_week", "left").join(F.broadcast(weekends), "is_weekend", "left")
    return spread_lookup(known, hours, "hour", "_rows", ["cell_id", "time_window"], frequent).select(
        *df.columns, "dow_avg_incidents", "hour_avg_incidents", "weekend_avg_incidents"
    )
