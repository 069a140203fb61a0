"""Statistics as they were known before a row's window.

The features over a whole history let a row see its own future. These look at earlier windows only, so the values of
a row stay as they are when later rows come or go, and a model trained on them can be compared with one in use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

CELL = ("cell_avg_before", "cell_std_before", "cell_max_before", "cell_total_before")


def cell_statistics_before(panel: DataFrame, value: str = "incident_count") -> DataFrame:
    """Mean, sample deviation, maximum and total of the cell's earlier observations; 0 without any."""
    before = Window.partitionBy("cell_id").orderBy("time_window").rowsBetween(Window.unboundedPreceding, -1)
    figures = (F.avg(value), F.stddev_samp(value), F.max(value), F.sum(value))
    return panel.withColumns({n: F.coalesce(f.over(before).cast("double"), F.lit(0.0)) for n, f in zip(CELL, figures)})


def slot_average_before(panel: DataFrame, key: str, name: str, value: str = "incident_count") -> DataFrame:
    """Mean of `value` over all cells' rows with the same `key` in earlier windows; null without any.

    Folded to sums per (key, window), which is at most keys times windows however many cells there are; prefix sums
    run over those rows, and the panel looks its own (key, window) up.
    """
    folded = panel.where(F.col(key).isNotNull()).groupBy(key, "time_window").agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_n")
    )
    earlier = Window.partitionBy(key).orderBy("time_window").rowsBetween(Window.unboundedPreceding, -1)
    known = folded.select(
        key, "time_window", F.try_divide(F.sum("_sum").over(earlier), F.sum("_n").over(earlier)).alias(name)
    )
    return panel.join(known, [key, "time_window"], "left").select(*panel.columns, name)


def slot_features_before(panel: DataFrame, value: str = "incident_count") -> DataFrame:
    """The averages of the weekday, the hour of the window and the weekend flag over earlier windows."""
    hours = panel.withColumn("_hour", F.hour("time_window"))
    found = slot_average_before(hours, "_hour", "hour_avg_before", value)
    for key, name in (("day_of_week", "dow_avg_before"), ("is_weekend", "weekend_avg_before")):
        found = slot_average_before(found, key, name, value)
    return found.select(*panel.columns, "dow_avg_before", "hour_avg_before", "weekend_avg_before")


def rank_share_before(df: DataFrame, value: str = "lag_1", name: str = "lag1_percentile_before", by: Sequence[str] = ("cell_id",)) -> DataFrame:
    """Average rank of `value` among this and the earlier rows of the cell, divided by their number.

    Rows are counted per value: every row is told once for each distinct value of its cell that isn't larger (counts
    have few), and adds up how many earlier rows have it. A null value has no rank.
    """
    rows = df.where(F.col(value).isNotNull())
    values = rows.select(*by, F.col(value).alias("_value")).distinct()
    key = [*by, "time_window"]
    # Every row beside each distinct value of its cell: a running count of the rows that have that value.
    beside = rows.select(*key, F.col(value).alias("_own")).join(values, [*by])
    upto = Window.partitionBy(*by, "_value").orderBy("time_window").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = beside.withColumn("_n", F.sum((F.col("_own") == F.col("_value")).cast("int")).over(upto)).groupBy(*key).agg(
        F.sum(F.when(F.col("_value") < F.col("_own"), F.col("_n")).otherwise(0)).alias("_less"),
        F.sum(F.when(F.col("_value") == F.col("_own"), F.col("_n")).otherwise(0)).alias("_same"),
        F.sum("_n").alias("_all"),
    )
    share = (F.col("_less") + (F.col("_same") + 1) / F.lit(2.0)) / F.col("_all")
    return df.join(counted.select(*key, share.alias(name)), key, "left").select(*df.columns, name)
