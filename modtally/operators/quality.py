"""Removal shares and the choice of usable months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Months whose share of removed items lies outside these bounds were recorded without
# removals, or with a flag that does not mean removal.
MIN_SHARE = 0.001
MAX_SHARE = 0.5


def removal_share(items: DataFrame, compat: bool = False) -> DataFrame:
    """Removed items, all items and their ratio per type and month.

    ``compat`` counts one more line per month (the header of a text file) and cuts the
    ratio to six decimals.
    """
    total: Column = F.col("total") + (1 if compat else 0)
    share = F.col("removed") / total
    if compat:
        share = F.floor(F.col("removed") * 1000000 / total) / 1000000
    return (
        items.groupBy("type", "month")
        .agg(F.count_if("is_removed").alias("removed"), F.count("*").alias("total"))
        .select("type", "month", "removed", total.alias("total"), share.alias("share"))
    )


def usable_months(
    shares: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE
) -> DataFrame:
    """Add ``usable``: whether the removal share of the month is plausible."""
    return shares.withColumn("usable", F.col("share").between(min_share, max_share))


def skip_list(judged: DataFrame) -> DataFrame:
    """Base names of the dumps of unusable months."""
    letter = F.when(F.col("type") == "posts", "S").otherwise("C")
    return judged.where(~F.col("usable")).select(F.concat(F.lit("R"), letter, F.lit("_"), "month").alias("basename"))
