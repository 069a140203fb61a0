"""Input views over the given tables, and the stage chain per table folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cellpulse.config import GridConfig
from cellpulse.plans.stages import Stages
from cellpulse.sources import tables
from cellpulse.sources.manifest import Stored
from cellpulse.staging import new_path, written

# Cells of 0.05 degrees, so that neighbours and histories occur at every scale factor.
CONFIG = GridConfig(cell_degrees=0.05, cell_meters=5550.0)

_stages: dict[tuple[str, str], Stages] = {}
_daily: dict[tuple[str, str], Stored] = {}


def events(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return spark.read.parquet(f"{folder}/events.parquet").withColumn("k", k)


def incidents(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as an incident; one key value gives missing, another zero coordinates."""

    def spread(steps, start: float):
        position = F.lit(start) + (steps % 5000).cast("double") / F.lit(10000.0)
        return F.when(F.col("k") == 0, None).when(F.col("k") == 1, F.lit(0.0)).otherwise(position)

    return events(spark, folder).select(
        "event_id",
        "ts",
        F.col("event_type").alias("category"),
        spread(F.col("user_id") * 7919, 41.6).alias("lat"),
        spread(F.floor(F.col("value") * 100), -88.0).alias("lon"),
        (F.col("user_id") % 10).cast("int").alias("district"),
        (F.col("k") % 4 == 0).cast("int").alias("resolved"),
    )


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Fixed class predictions of every event for the classification and fairness figures."""
    return events(spark, folder).select(
        "event_id",
        (F.col("k") % 4 == 0).cast("int").alias("y_true"),
        (F.col("value") >= 50).cast("int").alias("y_pred"),
        (F.col("value") >= 20).cast("int").alias("y_low"),
        (F.col("user_id") % 2).cast("int").alias("y_user"),
        (F.col("user_id") % 10).cast("int").alias("sensitive"),
        F.col("value").alias("score"),
        "event_type",
    )


def stages(spark: SparkSession, folder: str) -> Stages:
    """One chain per session and folder, so its written tables are shared by the queries that read them.

    The incidents are written once in their own columns: read through the view, every filter term would
    parse the event's JSON again, and none could reach the scan.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _stages:
        _stages[key] = Stages(written(incidents(spark, folder), "incidents"), CONFIG)
    return _stages[key]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to `digits` decimals. The shift keeps exact halves and negative zeros from depending on
    the last bit, which the order of a distributed sum may change."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(F.col(f"`{name}`") + F.lit(1e-9), digits) for name in doubles})


def daily_predictions(spark: SparkSession, folder: str) -> Stored:
    """The predictions, stored by day for the dashboard."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _daily:
        found, path = stages(spark, folder).predictions(), new_path(spark, "predictions-by-day")
        tables.write_predictions(found, path)
        _daily[key] = tables.stored_predictions(spark, path, found.schema)
    return _daily[key]
