"""A panel with a row for every window: gaps between the observations of a cell are filled.

The observed panel has rows only where something happened, so "previous" means the previous observation and the next
count is never zero. On the filled panel every step is one window, and zero counts are data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cellpulse.config import GridConfig
from cellpulse.functions import calendar

#: What a cell keeps in all of its windows.
STATIC = ("grid_lat_idx", "grid_lon_idx", "cell_center_lat", "cell_center_lon")
#: Windows that one row of the scaffold is unfolded to: a bound, however long a cell's history is.
SLICE = 512


def scaffold(panel: DataFrame, config: GridConfig, static: Sequence[str] = STATIC, until: Column | None = None) -> DataFrame:
    """(cell_id, time_window, static columns) of every window from a cell's first to its last one, or to `until`.

    One aggregation by cell; its rows are cut into slices, dealt out, and unfolded where they lie.
    """
    hours = config.window_hours
    span = panel.groupBy("cell_id").agg(
        F.min("time_window").alias("_first"), F.max("time_window").alias("_last"), *[F.min(c).alias(c) for c in static]
    )
    last = F.col("_last") if until is None else F.greatest("_last", until)
    steps = (F.timestamp_diff("SECOND", "_first", last) / (3600 * hours)).cast("int")
    slices = span.withColumn("_steps", steps).withColumn("_from", F.explode(F.sequence(F.lit(0), F.col("_steps"), F.lit(SLICE))))
    dealt = slices.repartition("cell_id", "_from")
    step = F.explode(F.sequence(F.col("_from"), F.least(F.col("_steps"), F.col("_from") + SLICE - 1))).alias("_step")
    unfolded = dealt.select("cell_id", "_first", *static, step)
    window = F.timestamp_add("HOUR", F.col("_step") * hours, F.col("_first"))
    return unfolded.select("cell_id", window.alias("time_window"), *static)


def densify(
    panel: DataFrame, config: GridConfig, static: Sequence[str] = STATIC, fill: Mapping[str, Column] | None = None,
    until: Column | None = None,
) -> DataFrame:
    """`panel` with the missing windows of every cell between its first and last one (or `until`): counts 0, static
    columns carried, calendar columns from the window's start, other columns from `fill` or null.

    Observed rows are unchanged. A panel without rows stays without.
    """
    start = F.col("time_window")
    day = calendar.monday_weekday("time_window")
    known = {
        "incident_count": F.lit(0).cast("bigint"), "hour": F.hour(start).cast("double"), "day_of_week": day,
        "is_weekend": calendar.weekend_flag(day), "time_slot": calendar.slot_label(calendar.slot_code(F.hour(start))),
        **(fill or {}),
    }
    observed = [c for c in panel.columns if c not in ("cell_id", "time_window", *static)]
    joined = scaffold(panel, config, static, until).join(
        panel.select("cell_id", "time_window", F.struct(*observed).alias("_seen")), ["cell_id", "time_window"], "left"
    )
    kinds = dict(panel.dtypes)
    missing = F.col("_seen").isNull()
    return joined.select([
        F.when(missing, known.get(c, F.lit(None)).cast(kinds[c])).otherwise(F.col("_seen")[c]).alias(c) if c in observed else F.col(c)
        for c in panel.columns
    ])
