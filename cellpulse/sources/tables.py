"""Readers and writers of the tables that pass between stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cellpulse.config import GridConfig
from cellpulse.functions import parsing, scores
from cellpulse.sources import manifest
from cellpulse.sources.manifest import Stored

# The columns of an incident file, read as text and parsed tolerantly.
INCIDENT_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("Primary Type", T.StringType()),
        T.StructField("Latitude", T.DoubleType()),
        T.StructField("Longitude", T.DoubleType()),
        T.StructField("Arrest", T.BooleanType()),
        T.StructField("Domestic", T.BooleanType()),
        T.StructField("District", T.IntegerType()),
        T.StructField("Beat", T.IntegerType()),
        T.StructField("Description", T.StringType()),
    ]
)
STANDARD_NAMES = {"Date": "ts", "Primary Type": "category", "Latitude": "lat", "Longitude": "lon"}

# Prediction and error columns a predictions table may carry, best first.
PREDICTION_COLUMNS = (("ultra_predicted", "ultra_error"), ("predicted_incidents", "prediction_error"))


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, rows: int | None = None
) -> DataFrame:
    """A CSV scan with a declared schema that the header must agree with; unreadable fields become null."""
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return df if rows is None else df.limit(rows)


def read_any_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file of unknown layout, every column as text."""
    return spark.read.option("header", True).csv(path)


def standard_incidents(df: DataFrame, names: Mapping[str, str] = STANDARD_NAMES) -> DataFrame:
    """Renames the critical columns and parses the timestamp text."""
    renamed = df.withColumnsRenamed(dict(names))
    if isinstance(renamed.schema["ts"].dataType, T.StringType):
        renamed = renamed.withColumn("ts", parsing.parse_timestamp(F.col("ts")))
    return renamed


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_panel(panel: DataFrame, path: str, time: str = "time_window") -> None:
    """Parquet, one folder per month, so that a time filter prunes folders, with a manifest of its files."""
    manifest.write(panel, path, "window_month", time)


def read_panel(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A panel stored by `write_panel`; the folder key is text."""
    return stored_panel(spark, path, schema).rows


def stored_panel(spark: SparkSession, path: str, schema: T.StructType) -> Stored:
    return Stored(spark, path, schema, "window_month")


def write_predictions(scored: DataFrame, path: str) -> None:
    """Parquet, one folder per day, for the dashboard's filter on one window, with a manifest of its files."""
    manifest.write(scored, path)


def stored_predictions(spark: SparkSession, path: str, schema: T.StructType) -> Stored:
    """Predictions stored by `write_predictions`."""
    return Stored(spark, path, schema)


def load_predictions(spark: SparkSession, paths: Sequence[str], config: GridConfig) -> DataFrame:
    """The first readable path, its prediction and error columns under fixed names, the open risk level.

    The error is computed when the file lacks it. Raises if no path can be used.
    """
    for path in paths:
        df = None
        for place in (f"{path}/data", path):  # a table with a manifest, or plain files
            try:
                df = spark.read.parquet(place)
                break
            except AnalysisException:
                continue
        if df is None:
            continue
        for predicted, error in PREDICTION_COLUMNS:
            if predicted not in df.columns:
                continue
            known = F.col(error) if error in df.columns else scores.absolute_error(F.col("target"), F.col(predicted))
            return df.withColumns(
                {
                    "ultra_predicted": F.col(predicted),
                    "ultra_error": known,
                    "risk_level": scores.open_risk(F.col(predicted), config.open_risk_edges),
                }
            )
    raise FileNotFoundError(f"no predictions in any of {list(paths)}")


REPORT = "section string, metric string, number double, text string"


def write_report(report: DataFrame, path: str) -> None:
    """The rows of a report (section, metric, number, text) as JSON lines; a report is a few dozen rows."""
    report.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT).json(path)
