"""Binned summaries."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from cellpulse.operators.ordered import quantiles


def equal_width(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """All `bins` ranges between minimum and maximum with their counts; the last range is closed.

    A single value is widened by half a unit to each side; without values the ranges divide 0 to 1.
    """
    low, high = F.coalesce(F.min(column).cast("double"), F.lit(0.0)), F.coalesce(F.max(column).cast("double"), F.lit(1.0))
    half = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))
    extent = df.agg(F.struct((low - half).alias("lo"), (high + half).alias("hi"))).scalar()
    spread = F.col("_extent.hi") - F.col("_extent.lo")
    scaled = (F.col(column) - F.col("_extent.lo")) / F.when(spread > 0, spread).otherwise(F.lit(1.0))
    counts = (
        df.where(F.col(column).isNotNull())
        .select(column)
        .withColumn("_extent", extent)
        .groupBy(F.least(F.floor(scaled * bins), F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("_extent", extent)
    width = spread / bins
    return edges.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("_extent.lo") + F.col("bin") * width).alias("low"),
        (F.col("_extent.lo") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def error_by_prediction(
    df: DataFrame, predicted: str, error: str, bins: int = 10, exact: bool = True
) -> DataFrame:
    """Error mean and deviation over quantile ranges of the prediction; equal edges are merged."""
    shares = [i / bins for i in range(bins + 1)]
    edges = quantiles(df, [predicted], shares, exact).agg(F.sort_array(F.collect_set("value"))).scalar()
    below = F.size(F.filter("_edges", lambda edge: edge < F.col(predicted)))
    return (
        df.where(F.col(predicted).isNotNull())
        .select(predicted, error)
        .withColumn("_edges", edges)
        .groupBy((F.greatest(below, F.lit(1)) - 1).alias("bin"))
        .agg(
            F.count("*").alias("n"),
            F.avg(error).alias("mean_error"),
            F.stddev_samp(error).alias("std_error"),
        )
    )


def hex_density(df: DataFrame, x: str, y: str, grid: int = 35) -> DataFrame:
    """Counts per hexagon of two offset lattices, a point going to the nearer centre."""
    nx, ny = grid, int(grid / math.sqrt(3))
    extent = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).agg(
        F.struct(
            F.min(x).cast("double").alias("x0"), F.max(x).cast("double").alias("x1"),
            F.min(y).cast("double").alias("y0"), F.max(y).cast("double").alias("y1"),
        )
    ).scalar()
    e = F.col("_extent")

    def step(low: str, high: str, cells: int):
        span = e[high] - e[low]
        return F.when(span > 0, span).otherwise(F.lit(1.0)) / cells

    placed = (
        df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
        .withColumn("_extent", extent)
        .withColumns({"_sx": step("x0", "x1", nx), "_sy": step("y0", "y1", ny)})
        .withColumns({"_u": (F.col("_x") - e["x0"]) / F.col("_sx"), "_v": (F.col("_y") - e["y0"]) / F.col("_sy")})
        .withColumns({"_i": F.rint("_u"), "_j": F.rint("_v"), "_k": F.floor("_u") + 0.5, "_l": F.floor("_v") + 0.5})
    )

    def away(i: str, j: str):
        du, dv = F.col("_u") - F.col(i), F.col("_v") - F.col(j)
        return du * du + F.lit(3.0) * dv * dv

    even = away("_i", "_j") < away("_k", "_l")
    return placed.groupBy(
        (e["x0"] + F.when(even, F.col("_i")).otherwise(F.col("_k")) * F.col("_sx")).alias("x"),
        (e["y0"] + F.when(even, F.col("_j")).otherwise(F.col("_l")) * F.col("_sy")).alias("y"),
    ).agg(F.count("*").alias("n"))
