"""The size manifest: expected sizes of dumps, and reports about local files against it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import base_name, is_daily


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``name size`` lines, separated by blanks."""
    parts = F.split(F.trim("value"), r"\s+")
    return (
        spark.read.text(path)
        .where(F.trim("value") != "")
        .select(parts[0].alias("name"), parts[1].cast("long").alias("size"))
    )


def parent_sizes(manifest: DataFrame) -> DataFrame:
    """``base, parts_size``: for every month (and year) the total size of its listed parts."""
    dashes = F.size(F.split("name", "-")) - 1
    return (
        manifest.where(dashes > 0)
        .select(F.explode(F.transform(F.sequence(F.lit(1), dashes), lambda i: F.array_join(F.slice(F.split("name", "-"), F.lit(1), i), "-"))).alias("base"), "size")
        .groupBy("base")
        .agg(F.sum("size").alias("parts_size"))
    )


def upsert_manifest(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Add newly found sizes; a name that is already listed keeps its size."""
    new = found.select("name", "size").join(manifest, "name", "left_anti")
    return manifest.select("name", "size").unionByName(new)


def order_manifest(manifest: DataFrame) -> DataFrame:
    """Monthly dumps first, by date; then daily dumps by name."""
    daily = is_daily(base_name(F.col("name")))
    key = F.when(daily, F.col("name")).otherwise(F.substring_index("name", "_", -1))
    return manifest.orderBy(daily, key, "name")


def coverage(expected: DataFrame, local: DataFrame, manifest: DataFrame) -> DataFrame:
    """Status of every expected dump (``name``, ``base``): what a download would have to fetch.

    ``yearly``   a local file covers the whole year
    ``unlisted`` the manifest does not know it
    ``missing``  listed, no local file
    ``stale``    listed, local size differs
    ``present``  listed, same size
    """
    years = local.where(~F.contains("base", F.lit("-"))).select(F.col("base").alias("_year"), F.lit(True).alias("_yearly")).distinct()
    have = local.groupBy("name").agg(F.max("size").alias("local_size"))
    listed = manifest.groupBy("name").agg(F.max("size").alias("listed_size"))
    return (
        expected.withColumn("_year", F.substring_index("base", "-", 1))
        .join(years, "_year", "left")
        .join(have, "name", "left")
        .join(listed, "name", "left")
        .select(
            "name",
            "local_size",
            "listed_size",
            F.when(F.col("_yearly"), "yearly")
            .when(F.col("listed_size").isNull(), "unlisted")
            .when(F.col("local_size").isNull(), "missing")
            .when(F.col("local_size") != F.col("listed_size"), "stale")
            .otherwise("present")
            .alias("status"),
        )
    )
