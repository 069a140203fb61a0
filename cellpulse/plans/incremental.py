"""A panel that grows by batches of incidents.

The state is one folder of partial rows per batch and month. Adding a batch again replaces its own folders, batches come
in any order and late ones are merged like all others, so the panel equals that of all incidents at once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cellpulse.config import GridConfig
from cellpulse.operators import grid, panel
from cellpulse.operators.clean import clean_incidents


@dataclass(frozen=True)
class IncrementalPanel:
    """Partial rows below `path`; `config.origin` must be set, since later batches can't move the grid."""

    spark: SparkSession
    path: str
    config: GridConfig

    def __post_init__(self):
        if self.config.origin is None:
            raise ValueError("set the origin of the grid: the corner of a batch is not that of all batches")

    def add(self, incidents: DataFrame, batch: str) -> None:
        """Folds a batch of raw incidents; a batch of the same name is replaced."""
        if not re.fullmatch(r"[\w-]+", batch):
            raise ValueError("a batch is named by letters, digits, _ and -")
        cleaned = clean_incidents(incidents, self.config)
        gridded = grid.assign_windows(grid.assign_cells(cleaned, self.config), self.config)
        partial = panel.partial_panel(gridded).withColumn("window_month", F.date_format("time_window", "yyyy-MM"))
        # A whole batch is one folder, so replacing it removes what it no longer has.
        partial.repartitionByRange("window_month", *panel.KEY).write.mode("overwrite").partitionBy("window_month").parquet(
            f"{self.path}/batch={batch}"
        )

    def partials(self) -> DataFrame | None:
        """All partial rows with their batch and month; None before the first batch."""
        try:
            found = self.spark.read.option("basePath", self.path).parquet(f"{self.path}/batch=*")
        except AnalysisException:
            return None
        return found.withColumns({"batch": F.col("batch").cast("string"), "window_month": F.col("window_month").cast("string")})

    def panel(self, months: list[str] | None = None) -> DataFrame:
        """The panel of all batches, or of some months: a filter on folders."""
        found = self.partials()
        if found is None:
            raise FileNotFoundError(f"no batch in {self.path}")
        if months is not None:
            found = found.where(F.col("window_month").isin(*months))
        return panel.merged_panel(found)

    def batches(self) -> DataFrame:
        """(batch, incidents, windows, first, last) of the batches."""
        found = self.partials()
        if found is None:
            schema = T.StructType.fromDDL("batch string, incidents long, windows long, first timestamp_ntz, last timestamp_ntz")
            return self.spark.createDataFrame([], schema)
        return found.groupBy("batch").agg(
            F.sum("incident_count").alias("incidents"), F.count_distinct("time_window").alias("windows"),
            F.min("time_window").alias("first"), F.max("time_window").alias("last"),
        )

    def compact(self, name: str, batches: list[str]) -> None:
        """Folds several batches into one of a new name; the old folders are deleted after it stands."""
        found = self.partials()
        if found is None or name in batches:
            raise ValueError("compact existing batches into a batch of another name")
        chosen = found.where(F.col("batch").isin(*batches)).drop("batch")
        sums = ("incident_count", "_hours", "_timed", *panel.SLOTS)
        least = ("cell_center_lat", "cell_center_lon", "day_of_week", "is_weekend")
        folded = chosen.groupBy("window_month", *panel.KEY).agg(
            *[F.min(c).alias(c) for c in least], *[F.sum(c).alias(c) for c in sums]
        )
        # Hidden until it is whole, so that no reader counts a batch twice.
        folded.write.mode("overwrite").partitionBy("window_month").parquet(f"{self.path}/_next-{name}")
        system = self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for old in batches:
            system.delete(self._path(f"batch={old}"), True)
        system.rename(self._path(f"_next-{name}"), self._path(f"batch={name}"))

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
