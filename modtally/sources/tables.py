"""Reading and writing the engine's own tables: parquet, and CSV for exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BLOCK_COLUMNS, BLOCKS, BLOCKS_BY_MONTH, CLASSIFIED, ENRICHED, ID_LIST, SLIM, SLIM_BY_MONTH
from .runs import read_monthly, read_runs


# Texts keep their blanks at both ends.
_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_by_month(df: DataFrame, path: str, rebalance: bool = False) -> None:
    """Parquet by type and month, for a table written once. Months that are replaced later belong into ``runs``.

    ``rebalance`` is for tables shuffled by another key: it gathers each month into few
    files of even size, splitting a large month and joining small ones.
    """
    if rebalance:
        df = df.hint("rebalance", "type", "month")
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("type", "month").parquet(path)


def read_slim(spark: SparkSession, path: str, item_type: str | None = None) -> DataFrame:
    # The schema keeps month names such as 2018-10 text; inferred, they would become dates.
    return read_monthly(spark, path, SLIM_BY_MONTH, item_type)


def read_blocks(spark: SparkSession, path: str, item_type: str | None = None) -> DataFrame:
    return read_monthly(spark, path, BLOCKS_BY_MONTH, item_type)


def read_block_months(spark: SparkSession, path: str, months: list[tuple[str, str]]) -> DataFrame:
    """Blocks of some months only."""
    return read_monthly(spark, path, BLOCKS_BY_MONTH, months=months)


def read_classified_run(spark: SparkSession, out: str, run: int, months: list[tuple[str, str]]) -> DataFrame:
    """What a run has classified, before the log names it."""
    return read_runs(spark, f"{out}/classified", CLASSIFIED, {m: run for m in months})


def write_slim_csv(items: DataFrame, path: str) -> None:
    """CSV with header, one directory per type and month."""
    fields = SLIM.fieldNames()
    items.select(*fields, "type", "month").write.mode("overwrite").partitionBy("type", "month").csv(
        path, **_CSV
    )


def read_slim_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan. Names such as ``null`` or ``NA`` stay text; ``True``/``False`` are accepted."""
    schema = T.StructType([f for f in SLIM_BY_MONTH.fields if f.name != "pos"])
    return spark.read.schema(schema).csv(path, header=True, nullValue="", escape='"')


def write_blocks_csv(blocks: DataFrame, path: str) -> None:
    blocks.select(*BLOCK_COLUMNS).orderBy("subreddit", "last_created_utc").write.mode("overwrite").csv(
        path, **_CSV
    )


def read_blocks_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Block tables of several months; the month comes from the file name."""
    read = spark.read.schema(BLOCKS).csv(paths, header=True, nullValue="", escape='"')
    name = F.col("_metadata.file_name")
    return read.select("*", F.regexp_extract(name, r"_([^_/]*)\.csv", 1).alias("month"))


def write_enriched_csv(df: DataFrame, path: str, item_type: str) -> None:
    df.select(*ENRICHED[item_type].fieldNames()).write.mode("overwrite").csv(path, **_CSV)


def read_enriched_csv(spark: SparkSession, path: str, item_type: str) -> DataFrame:
    """Texts ``null`` and ``na`` stay text; only an empty field is missing."""
    return spark.read.schema(ENRICHED[item_type]).csv(path, header=True, nullValue="", escape='"')


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ID_LIST).csv(path, header=True)


def write_ids(ids: DataFrame, path: str) -> None:
    ids.select("id").distinct().orderBy("id").write.mode("overwrite").csv(path, header=True)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """A file log: one base name per line, no header."""
    return spark.read.text(path).where("value <> ''").select(F.col("value").alias("basename"))


def append_names(names: DataFrame, path: str, known: DataFrame | None = None) -> None:
    """Add base names that are not in the log yet."""
    new = names.select(F.col(names.columns[0]).alias("basename")).distinct()
    if known is not None:
        new = new.join(known.select("basename"), "basename", "left_anti")
    new.write.mode("append").text(path)
