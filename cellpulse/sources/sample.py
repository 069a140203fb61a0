"""Sample incidents for trying the library out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cellpulse.functions import calendar

# Category weights, city centre, spread and share of resolved incidents.
CATEGORY_WEIGHTS = (
    ("Theft", 0.25), ("Burglary", 0.15), ("Assault", 0.20), ("Vandalism", 0.10), ("Robbery", 0.10),
    ("Vehicle Theft", 0.12), ("Drug Offense", 0.08),
)
CENTER = (40.7128, -74.0060)
SPREAD = 0.05
RESOLVED_SHARE = 0.6
FIRST_DAY = "2023-01-01 00:00:00"
DISTRICTS = 10


def sample_incidents(spark: SparkSession, rows: int = 1000, seed: int = 42) -> DataFrame:
    """`rows` seeded incidents of one year, generated by the executors."""
    draw, upto = F.col("_draw"), 0.0
    category = None
    for name, weight in CATEGORY_WEIGHTS:
        upto += weight
        category = F.when(draw < upto, name) if category is None else category.when(draw < upto, name)
    hours = F.floor(F.rand(seed) * 365) * 24 + F.floor(F.rand(seed + 1) * 24)
    return (
        spark.range(rows)
        .withColumn("_draw", F.rand(seed + 2))
        .select(
            F.timestamp_add("HOUR", hours.cast("int"), F.lit(FIRST_DAY).cast("timestamp_ntz")).alias("ts"),
            category.otherwise(CATEGORY_WEIGHTS[-1][0]).alias("category"),
            (F.lit(CENTER[0]) + F.randn(seed + 3) * SPREAD).alias("lat"),
            (F.lit(CENTER[1]) + F.randn(seed + 4) * SPREAD).alias("lon"),
            (F.floor(F.rand(seed + 5) * DISTRICTS) + 1).cast("int").alias("district"),
            (F.rand(seed + 6) < RESOLVED_SHARE).cast("int").alias("resolved"),
        )
        .withColumns({"hour": F.hour("ts"), "day_of_week": calendar.monday_weekday("ts"), "month": F.month("ts")})
    )
