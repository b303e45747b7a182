"""Incremental work: which months still have to be processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pending_months(available: DataFrame, done: DataFrame | None, force: bool = False) -> DataFrame:
    """``type, month`` pairs that are available and not done yet; all of them with ``force``."""
    months = available.select("type", "month").distinct()
    if force or done is None:
        return months
    return months.join(done.select("type", "month").distinct(), ["type", "month"], "left_anti")


def is_stale(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """One row with ``stale``: whether an input (column ``modified``) is newer than the
    newest output, or there is no output."""
    newest_in = inputs.agg(F.max("modified").alias("newest_input"))
    newest_out = outputs.agg(F.max("modified").alias("newest_output"))
    # Both sides are single rows.
    paired = newest_in.withColumn("_one", F.lit(1)).join(newest_out.withColumn("_one", F.lit(1)), "_one")
    return paired.select(
        F.coalesce(F.col("newest_input") >= F.col("newest_output"), F.lit(True)).alias("stale")
    )


def file_times(spark: SparkSession, path: str) -> DataFrame:
    """``modified`` of every file of a table."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select(F.col("modificationTime").alias("modified"))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds any file Spark would read; asked of the file system, without a job."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return False
    folder = system.makeQualified(folder)
    files = system.listFiles(folder, True)
    while files.hasNext():
        file = files.next()
        inner = file.getPath().toString()[len(folder.toString()) :]
        # Names with a leading mark are no data, at any depth; nor are files of zero bytes.
        if file.getLen() and not any(part[:1] in ("_", ".") for part in inner.split("/")):
            return True
    return False
