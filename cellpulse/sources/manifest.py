"""Tables stored by day or month with a manifest: which file holds which windows.

The manifest has one row per folder and file (rows, first and last window). The latest window, the extent and the
files that can hold a window are read from it, so a request never opens a file that has nothing for it.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Rows that a file should hold; a folder with more of them is spread over several files.
ROWS_PER_FILE = 4_000_000
FOLDERS = {"window_date": lambda time: F.to_date(time), "window_month": lambda time: F.date_format(time, "yyyy-MM")}


def write(df: DataFrame, path: str, folder: str = "window_date", time: str = "time_window", rows: int = ROWS_PER_FILE) -> None:
    """Parquet in one folder per day (`window_date`) or month (`window_month`) below `path`, and its manifest.

    One exchange by ranges of (folder, hash of the row): a task holds neighbouring folders, so the number of files is
    at most that of the tasks and folders together, and a folder that holds most rows is spread over many tasks.
    Rows without a time are in the folder of nulls and in no window. Overwrites the table at `path`.
    """
    placed = df.withColumn(folder, FOLDERS[folder](F.col(time)))
    spread = placed.repartitionByRange(folder, F.xxhash64(*df.columns))
    spread.write.mode("overwrite").option("maxRecordsPerFile", rows).partitionBy(folder).parquet(f"{path}/data")
    stored = df.sparkSession.read.schema(_schema(df.schema, folder)).parquet(f"{path}/data")
    listed = stored.groupBy(F.col(folder), F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.min(time).alias("first"), F.max(time).alias("last")
    )
    listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")


def _schema(schema: T.StructType, folder: str) -> T.StructType:
    kind = T.DateType() if folder == "window_date" else T.StringType()
    return T.StructType([f for f in schema.fields if f.name != folder] + [T.StructField(folder, kind)])


@dataclass(frozen=True)
class Stored:
    """A table that `write` stored. `schema` is that of the rows without the folder."""

    spark: SparkSession
    path: str
    schema: T.StructType
    folder: str = "window_date"
    time: str = "time_window"

    @property
    def manifest(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/manifest")

    @property
    def rows(self) -> DataFrame:
        """All rows, with the key of their folder."""
        return self._read(f"{self.path}/data")

    def _read(self, *files: str) -> DataFrame:
        reader = self.spark.read.schema(_schema(self.schema, self.folder)).option("basePath", f"{self.path}/data")
        return reader.parquet(*files)

    def latest(self) -> datetime | None:
        """The last window; None without rows. No data file is opened."""
        return self.manifest.agg(F.max("last")).first()[0]

    def extent(self) -> DataFrame:
        """One row: rows, first and last window, files and folders, from the manifest alone."""
        return self.manifest.agg(
            F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"),
            F.count("*").alias("files"), F.count_distinct(self.folder).alias("folders"),
        )

    def at(self, time: str | datetime | None = None) -> DataFrame:
        """The rows of one window, the latest by default: a scan of the files that can hold it."""
        wanted = self.latest() if time is None else time
        return self.between(wanted, wanted)

    def between(self, first: str | datetime | None, last: str | datetime | None) -> DataFrame:
        """The rows of all windows from `first` to `last`: a scan of the files and folders that can hold them."""
        kind = self.schema[self.time].dataType
        low, high = (F.lit(t).cast(kind) for t in (first, last))
        here = self.manifest.where((F.col("first") <= high) & (F.col("last") >= low))
        # At most as many names as the wanted span has files.
        files = [r["file"] for r in here.select("file").orderBy("file").collect()]
        if not files:
            return self.spark.createDataFrame([], _schema(self.schema, self.folder))
        folder = F.col(self.folder).between(FOLDERS[self.folder](low), FOLDERS[self.folder](high))
        return self._read(*files).where(folder & F.col(self.time).between(low, high))
