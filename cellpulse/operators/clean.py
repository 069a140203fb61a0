"""Cleaning of raw incidents: columns `ts`, `lat`, `lon`, `category` plus whatever else is carried."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from cellpulse.config import GridConfig, OPTIONAL_COLUMNS

CRITICAL = ("ts", "lat", "lon", "category")


def keep_columns(
    df: DataFrame, required: Sequence[str], optional: Sequence[str] = OPTIONAL_COLUMNS
) -> DataFrame:
    """The required columns, then those optional ones that the input has."""
    present = set(df.columns)
    return df.select(*required, *[name for name in optional if name in present])


def in_range(config: GridConfig) -> Column:
    return F.col("lat").between(*config.lat_range) & F.col("lon").between(*config.lon_range)


def is_complete(critical: Sequence[str] = CRITICAL) -> Column:
    """Separate null tests, each of which can reach the scan."""
    return reduce(and_, [F.col(name).isNotNull() for name in critical])


def clean_incidents(df: DataFrame, config: GridConfig, critical: Sequence[str] = CRITICAL) -> DataFrame:
    """Rows with every critical value present and a position inside the configured box."""
    return df.where(is_complete(critical) & in_range(config))


def cleaning_counts(df: DataFrame, config: GridConfig, critical: Sequence[str] = CRITICAL) -> DataFrame:
    """One row: loaded, removed for a missing value, removed for position, kept; one scan."""
    complete = is_complete(critical)
    return df.agg(
        F.count("*").alias("loaded"),
        F.count_if(~complete).alias("incomplete"),
        F.count_if(complete & ~in_range(config)).alias("out_of_range"),
        F.count_if(complete & in_range(config)).alias("kept"),
    )
