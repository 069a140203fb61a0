"""Activity of the neighbouring cells in the same window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def neighbor_features(panel: DataFrame, radius: int = 1, value: str = "incident_count") -> DataFrame:
    """Adds sum, mean and maximum of `value` over the cells within `radius` on both axes.

    The latitude axis is covered by copies: each row is sent to the 2r+1 grid rows that can see it,
    only the copy for its own grid row carrying the other columns. The longitude axis is covered by
    RANGE frames inside (window, grid row). That is one shuffle of 2r+1 slim copies, no self join, no
    join back and no pairs; a group holds at most 2r+1 rows per grid column, whatever the data size.
    """
    keys = ("time_window", "grid_lon_idx", value)
    carried = [name for name in panel.columns if name not in keys]
    copies = panel.select(
        *keys,
        F.struct(*carried).alias("_row"),
        F.explode(F.sequence(F.lit(-radius), F.lit(radius))).alias("_shift"),
    ).select(
        *keys,
        (F.col("_row.grid_lat_idx") + F.col("_shift")).alias("_grid_row"),
        F.when(F.col("_shift") == 0, F.col("_row")).alias("_row"),
    )

    own = F.col("_row").isNotNull()
    line = Window.partitionBy("time_window", "_grid_row").orderBy("grid_lon_idx")
    beside = line.rangeBetween(-radius, radius)
    west, east = line.rangeBetween(-radius, -1), line.rangeBetween(1, radius)
    own_value, other_value = F.when(own, F.col(value)), F.when(~own, F.col(value))

    def total(aggregate):
        parts = (
            aggregate(other_value).over(beside),
            aggregate(own_value).over(west),
            aggregate(own_value).over(east),
        )
        return [F.coalesce(part, F.lit(0)) for part in parts]

    sums, counts, peaks = total(F.sum), total(F.count), total(F.max)
    return (
        copies.withColumns(
            {
                "neighbor_sum": sums[0] + sums[1] + sums[2],
                "_neighbors": counts[0] + counts[1] + counts[2],
                "neighbor_max": F.greatest(*peaks),
            }
        )
        .where(own)
        .select(
            *[F.col(name) if name in keys else F.col(f"_row.{name}").alias(name) for name in panel.columns],
            "neighbor_sum",
            F.when(F.col("_neighbors") > 0, F.col("neighbor_sum") / F.col("_neighbors"))
            .otherwise(F.lit(0.0))
            .alias("neighbor_mean"),
            "neighbor_max",
        )
    )
