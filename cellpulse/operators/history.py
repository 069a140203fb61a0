"""Features over the observed history of a cell.

All frames are ROWS frames: the previous observation is the previous window in which the cell had an
incident. A cell has at most one row per window, so a window partition is bounded by the number of
windows in the data and never by the number of incidents. Every function here shares one exchange by
`cell_id`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

HISTORY = (1, 3, 7, 14)


def _in_order() -> WindowSpec:
    return Window.partitionBy("cell_id").orderBy("time_window")


def _or_zero(column: Column) -> Column:
    return F.coalesce(column.cast("double"), F.lit(0.0))


def lag_columns(windows: Sequence[int] = HISTORY, value: str = "incident_count") -> dict[str, Column]:
    """lag, rolling mean, maximum and sample deviation of the observations before the current one."""
    columns, order = {}, _in_order()
    for n in windows:
        before = order.rowsBetween(-n, -1)
        columns[f"lag_{n}"] = _or_zero(F.lag(value, n).over(order))
        columns[f"rolling_mean_{n}"] = _or_zero(F.avg(value).over(before))
        columns[f"rolling_max_{n}"] = _or_zero(F.max(value).over(before))
        columns[f"rolling_std_{n}"] = _or_zero(F.stddev_samp(value).over(before))
    return columns


def cell_columns(value: str = "incident_count") -> dict[str, Column]:
    """Statistics of the whole history of the cell."""
    whole = _in_order().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return {
        "cell_avg_incidents": F.avg(value).over(whole),
        "cell_std_incidents": _or_zero(F.stddev_samp(value).over(whole)),
        "cell_max_incidents": F.max(value).over(whole),
        "cell_total_incidents": F.sum(value).over(whole),
    }


def momentum_columns(value: str = "incident_count") -> dict[str, Column]:
    """First and second difference; both are 0 where there is no earlier observation."""
    previous, before = F.lag(value, 1).over(_in_order()), F.lag(value, 2).over(_in_order())
    momentum = _or_zero(F.col(value) - previous)
    earlier = _or_zero(previous - before)
    return {
        "momentum": momentum,
        "acceleration": F.when(previous.isNull(), F.lit(0.0)).otherwise(momentum - earlier),
    }


def trend_columns() -> dict[str, Column]:
    """Differences of rolling means that are already in the frame."""
    return {
        "trend_short": F.col("rolling_mean_3") - F.col("rolling_mean_7"),
        "trend_long": F.col("rolling_mean_7") - F.col("rolling_mean_14"),
    }


def target_columns(value: str = "incident_count") -> dict[str, Column]:
    """The next observation of the cell, null on its last one."""
    upcoming = F.lead(value, 1).over(_in_order()).cast("double")
    return {"target": upcoming, "target_binary": F.coalesce((upcoming > 0).cast("int"), F.lit(0))}


def lag_features(panel: DataFrame, windows: Sequence[int] = HISTORY) -> DataFrame:
    return panel.withColumns(lag_columns(windows))


def cell_statistics(panel: DataFrame) -> DataFrame:
    return panel.withColumns(cell_columns())


def trend_features(panel: DataFrame) -> DataFrame:
    means = lag_columns((3, 7, 14))
    needed = {name: means[name] for name in means if name.startswith("rolling_mean")}
    momentum = {"momentum": momentum_columns()["momentum"]}
    return panel.withColumns({**needed, **momentum}).withColumns(trend_columns()).drop(*needed)


def target_feature(panel: DataFrame) -> DataFrame:
    return panel.withColumns(target_columns())


def rank_share(df: DataFrame, value: str = "lag_1", name: str = "lag1_percentile") -> DataFrame:
    """Average rank of `value` within the cell divided by the number of rows of the cell."""
    by_value = Window.partitionBy("cell_id").orderBy(value)
    ties = F.count("*").over(by_value.rangeBetween(Window.currentRow, Window.currentRow))
    rows = F.count("*").over(by_value.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn(name, (F.rank().over(by_value) + (ties - 1) / F.lit(2.0)) / rows)
