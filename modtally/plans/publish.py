"""Checked, versioned publication of the four result tables.

Every version is a complete folder. A small log names the published versions; readers
take the newest. Appending to the log is the switch: it is one committed write, so a
reader sees either the old four tables or the new ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.constraints import PRIMARY_KEY, check
from ..streaming.incremental import table_exists

TABLES = tuple(PRIMARY_KEY)

# Rankings read one community, best rate first; lookups read single ids. Range
# partitioning on both keys also spreads a community that fills many files.


def _layout(table: str) -> list[Column]:
    if table.startswith("aggregate_"):
        return [F.col("subreddit"), F.col("rate").desc(), F.col("last_id")]
    return [F.col("id")]


def stage(tables: dict[str, DataFrame], base: str, version: int) -> str:
    """Write all four tables of a version, sorted so that file statistics prune reads."""
    missing = [t for t in TABLES if t not in tables]
    if missing:
        raise ValueError(f"missing tables: {missing}")
    for name in TABLES:
        layout = _layout(name)
        tables[name].repartitionByRange(*layout).sortWithinPartitions(*layout).write.mode("overwrite").parquet(
            f"{base}/version={version}/{name}"
        )
    return f"{base}/version={version}"


def read_version(spark: SparkSession, base: str, version: int) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{base}/version={version}/{t}") for t in TABLES}


def publish(spark: SparkSession, base: str, version: int, checked: bool = True) -> None:
    """Check the staged tables and make them the live ones."""
    if checked:
        check(read_version(spark, base, version))
    spark.range(1).select(F.lit(version).cast("long").alias("version")).write.mode("append").json(f"{base}/published")


def live_version(spark: SparkSession, base: str) -> int | None:
    if not table_exists(spark, f"{base}/published"):
        return None
    return spark.read.schema("version bigint").json(f"{base}/published").agg(F.max("version")).first()[0]


def read_live(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    version = live_version(spark, base)
    if version is None:
        raise ValueError(f"nothing is published under {base}")
    return read_version(spark, base, version)


def create_views(spark: SparkSession, base: str) -> None:
    """Temporary views ``aggregate_comments, aggregate_posts, comments, posts`` of the live version."""
    for name, df in read_live(spark, base).items():
        df.createOrReplaceTempView(name)


def write_jdbc(tables: dict[str, DataFrame], url: str, schema: str, properties: dict[str, str]) -> None:
    """Copy the tables into an external database schema."""
    for name, df in tables.items():
        df.write.jdbc(url, f"{schema}.{name}", mode="overwrite", properties=properties)
