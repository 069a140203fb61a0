"""Aggregated views of incidents and of the panel."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from cellpulse.operators.ordered import median


def cell_totals(gridded: DataFrame) -> DataFrame:
    return gridded.groupBy("grid_lat_idx", "grid_lon_idx").agg(F.count("*").alias("n"))


def density_matrix(gridded: DataFrame, dense: bool = False) -> DataFrame:
    """Incidents of every cell that has any, in long form; `dense` adds the other cells of the same grid rows and
    columns with 0.

    The list of columns is as long as the grid is wide and comes from the cell totals, not from
    incidents; each grid row unfolds it once.
    """
    totals = cell_totals(gridded)
    if not dense:
        return totals
    wide = totals.agg(F.sort_array(F.collect_set("grid_lon_idx"))).scalar()
    cells = totals.select("grid_lat_idx").distinct().withColumn("grid_lon_idx", F.explode(wide))
    return cells.join(totals, ["grid_lat_idx", "grid_lon_idx"], "left").select(
        "grid_lat_idx", "grid_lon_idx", F.coalesce("n", F.lit(0)).alias("n")
    )


def density_pivot(gridded: DataFrame, columns: Sequence[int]) -> DataFrame:
    """The same as a wide table with one column per grid column, for grids narrow enough to print."""
    return (
        gridded.groupBy("grid_lat_idx").pivot("grid_lon_idx", list(columns)).agg(F.count(F.lit(1))).na.fill(0)
    )


def density_tiers(gridded: DataFrame, low: int = 10, high: int = 50) -> DataFrame:
    n = F.col("n")
    return cell_totals(gridded).agg(
        F.count("*").alias("unique_cells"),
        F.sum("n").alias("total_incidents"),
        F.avg("n").alias("avg_per_cell"),
        F.max("n").alias("max_in_cell"),
        F.count_if(n <= low).alias("low_density"),
        F.count_if((n > low) & (n <= high)).alias("medium_density"),
        F.count_if(n > high).alias("high_density"),
    )


def top_cells(gridded: DataFrame, k: int = 10) -> DataFrame:
    return cell_totals(gridded).orderBy(F.desc("n"), "grid_lat_idx", "grid_lon_idx").limit(k)


def daily_counts(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("day")).agg(F.count("*").alias("n"))


def peak_hour(df: DataFrame, hour: str = "hour") -> DataFrame:
    """The hour with most rows; the earliest on a tie."""
    counts = df.where(F.col(hour).isNotNull()).groupBy(F.col(hour).alias("peak_hour")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "peak_hour").limit(1)


def count_of_counts(panel: DataFrame, shown_up_to: int | None = None) -> DataFrame:
    """How many cell windows hold 1, 2, ... incidents; `shown_up_to` limits the display only."""
    spread = panel.groupBy("incident_count").agg(F.count("*").alias("n"))
    return spread if shown_up_to is None else spread.where(F.col("incident_count") <= shown_up_to)


def district_summary(df: DataFrame) -> DataFrame:
    """Count, centroid and marker radius of every district."""
    return (
        df.where(F.col("district").isNotNull())
        .groupBy("district")
        .agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.count("*").alias("n"))
        .withColumn("radius", F.col("n") / F.lit(10.0))
    )


def corr_matrix(df: DataFrame, columns: Sequence[str], pairs_per_scan: int = 200) -> DataFrame:
    """Pearson coefficients of every pair over the rows that have both values.

    All pairs of up to 20 columns share one aggregation; more are dealt out over several scans, since each
    pair needs six running figures per task.
    """
    pairs = list(combinations(columns, 2))

    def cell(a: str, b: str, r: Column) -> Column:
        return F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), r.alias("r"))

    parts = []
    for start in range(0, max(len(pairs), 1), pairs_per_scan):
        chunk = pairs[start : start + pairs_per_scan]
        row = df.agg(F.count("*").alias("rows"), *[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(chunk)])
        cells = [cell(x, y, F.col(f"r{i}")) for i, (a, b) in enumerate(chunk) for x, y in ((a, b), (b, a))]
        if start == 0:
            cells += [cell(c, c, F.lit(1.0)) for c in columns]
        parts.append(row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*"))
    return reduce(DataFrame.unionByName, parts)


def target_summary(features: DataFrame, exact: bool = True) -> DataFrame:
    """Mean, median, maximum and percentage above 0 of the target."""
    return features.agg(
        F.avg("target").alias("mean_target"),
        F.max("target").alias("max_target"),
        (F.avg((F.col("target") > 0).cast("double")) * 100).alias("pct_positive"),
    ).withColumn("median_target", median(features, "target", exact))


def temporal_trends(scored: DataFrame, predicted: str = "ultra_predicted", error: str = "ultra_error") -> DataFrame:
    """Predicted and actual totals and the mean error of every window."""
    return scored.groupBy("time_window").agg(
        F.sum(predicted).alias("predicted"), F.sum("target").alias("actual"), F.avg(error).alias("mean_error")
    )


def cell_risk(scored: DataFrame, predicted: str = "ultra_predicted") -> DataFrame:
    """Prediction total, mean, maximum and number of rows of every cell."""
    return scored.groupBy("cell_id").agg(
        F.sum(predicted).alias("total_risk"),
        F.avg(predicted).alias("mean_risk"),
        F.max(predicted).alias("max_risk"),
        F.count(predicted).alias("n"),
    )
