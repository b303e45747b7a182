"""Positions of rows inside ordered groups, for groups of any size.

A window over a group sorts the whole group in one task. That is the right plan for
the many groups that fit one task, and the wrong one for a group that holds a large
part of the data. Groups above ``max_group_rows`` therefore take another path: they
are range-partitioned on (group, order), so a large group spreads over many tasks,
and the position follows from the partition sizes. Both paths give the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

# Rows of one group that a single task sorts without trouble.
MAX_GROUP_ROWS = 4_000_000


def large_groups(df: DataFrame, keys: Sequence[str], max_group_rows: int) -> DataFrame | None:
    """Keys of the groups above the limit, or None when there is none.

    Counting combines on the map side, so a large group costs no skewed shuffle. The
    result has at most ``rows / max_group_rows`` rows.
    """
    large = df.groupBy(*keys).count().where(F.col("count") > max_group_rows).select(*keys)
    large = materialise(large)
    return None if large.isEmpty() else large


def split_by_size(df: DataFrame, keys: Sequence[str], large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of small groups, rows of large groups). ``large`` is bounded by ``large_groups``."""
    keys = list(keys)
    return (
        df.join(F.broadcast(large), keys, "left_anti"),
        df.join(F.broadcast(large), keys, "left_semi"),
    )


def number_small_groups(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, (F.row_number().over(window) - 1).cast("long"))


def number_large_groups(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Zero-based position inside each large group without any per-group task.

    Range partitioning samples its bounds, so two runs may cut differently. The sorted
    partitions are materialised once and every later step reads that copy.
    """
    columns = [*(F.col(k) for k in keys), *order]
    ordered = materialise(df.repartitionByRange(*columns).sortWithinPartitions(*columns))

    row_id = F.monotonically_increasing_id()
    placed = ordered.withColumns(
        {"_part": F.spark_partition_id(), "_row": row_id.bitwiseAND((1 << 33) - 1)}
    )
    # One row per partition: how many rows lie before it.
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"),
    )
    ranked = placed.join(F.broadcast(before), "_part").withColumn("_rank", F.col("_before") + F.col("_row"))
    # One row per large group: the rank it starts at.
    starts = ranked.groupBy(*keys).agg(F.min("_rank").alias("_start"))
    return (
        ranked.join(F.broadcast(starts), list(keys))
        .withColumn(name, F.col("_rank") - F.col("_start"))
        .drop("_part", "_row", "_before", "_rank", "_start")
    )


def number_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str = "position",
    max_group_rows: int | None = MAX_GROUP_ROWS,
    counted_on: DataFrame | None = None,
) -> DataFrame:
    """Add the zero-based position of each row inside its group.

    ``counted_on`` may name a cheaper table with at least the rows of ``df`` per group,
    used only to find large groups. ``max_group_rows=None`` skips the search.
    """
    large = None
    if max_group_rows is not None:
        large = large_groups(counted_on if counted_on is not None else df, keys, max_group_rows)
    if large is None:
        return number_small_groups(df, keys, order, name)
    small_rows, large_rows = split_by_size(materialise(df), keys, large)
    return number_small_groups(small_rows, keys, order, name).unionByName(
        number_large_groups(large_rows, keys, order, name)
    )
