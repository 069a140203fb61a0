"""Written tables between the stages of a plan.

A stage that several later jobs read is written once to the shared checkpoint folder and read back,
so a lost executor costs one task and not the whole lineage, and readers keep Parquet column pruning
and filter pushdown.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names, or the context's checkpoint folder.

    Only a session whose driver and executors are one process may have neither; it gets a temporary folder as
    its checkpoint folder. Any other session without one is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="cellpulse-"))
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _cleaned(spark: SparkSession):
    """Shuffle files of what runs inside go when it ends: what follows reads the written table."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet below the shared folder and return a scan of it."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    with _cleaned(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_path = path
    return table


def discarded(*tables: DataFrame) -> None:
    """Delete the files of written tables that nothing will read again."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._written_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
