"""Tolerant parsing: whatever cannot be read becomes null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The accepted timestamp layouts, first match wins.
TIMESTAMP_FORMATS = (
    "MM/dd/yyyy hh:mm:ss a",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
)


def parse_timestamp(text: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    tries = [F.try_to_timestamp(text, F.lit(layout)) for layout in formats]
    return F.coalesce(*tries).cast("timestamp_ntz")


def parse_number(text: Column) -> Column:
    return F.trim(text).try_cast("double")
