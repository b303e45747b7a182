"""Blocks of consecutive items per community and the removed-upvote rate of each block."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import id_to_int, int_to_id
from ..schemas import BLOCK_COLUMNS
from .ordering import MAX_GROUP_ROWS, number_in_group

# Items of different types and of different monthly dumps never share a block.
GROUP = ("type", "month", "subreddit")


def keep_last(items: DataFrame, keys: Sequence[str] = ("type", "month", "id")) -> DataFrame:
    """One row per id: the one that comes last in file order (column ``pos``).

    The rank filter lets Spark drop superseded copies before the shuffle, so an id with
    very many copies sends one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(F.col("pos").desc())
    return items.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank", "pos")


def number_blocks(
    items: DataFrame,
    n_rows: int = 1000,
    group: Sequence[str] = GROUP,
    max_group_rows: int | None = MAX_GROUP_ROWS,
    counted_on: DataFrame | None = None,
) -> DataFrame:
    """Add ``id_int``, ``position`` (zero-based, in event order) and ``block``."""
    keyed = items.withColumn("id_int", id_to_int(F.col("id")))
    numbered = number_in_group(
        keyed,
        group,
        [F.col("created_utc"), F.col("id_int")],
        max_group_rows=max_group_rows,
        counted_on=counted_on,
    )
    return numbered.withColumn("block", F.expr(f"position div {n_rows}"))


def sum_positive(score: Column) -> Column:
    return F.sum(F.when(score > 0, score).otherwise(F.lit(0)))


def count_positive(score: Column) -> Column:
    return F.count_if(score > 0)


def summarise_blocks(numbered: DataFrame, n_rows: int, group: Sequence[str] = GROUP) -> DataFrame:
    """One row per block. All buffers are fixed-width numbers, so Spark aggregates by hash.

    The top removed item is the one with the highest score; on equal scores the
    earliest. ``_order`` ranks by score first, then by earliness inside the block.
    """
    score, position = F.col("score"), F.col("position")
    counted = F.col("is_removed") & (score > 1)
    earliness = F.lit(n_rows - 1) - position % n_rows
    removed = numbered.withColumns(
        {
            "_removed_score": F.when(counted, score),
            "_order": F.when(counted, score * n_rows + earliness),
        }
    )
    return removed.groupBy(*group, "block").agg(
        sum_positive(score).alias("total_pos_upvotes"),
        F.count("score").alias("total_items"),
        F.max("created_utc").alias("last_created_utc"),
        F.max_by("id_int", "position").alias("_last_id"),
        F.sum("_removed_score").alias("num_pos_upvotes_removed"),
        F.count("_removed_score").alias("num_items_with_pos_upvotes_removed"),
        F.max("_removed_score").alias("score_of_max_pos_removed_item"),
        F.max_by("id_int", "_order").alias("_max_id"),
    )


def finish_blocks(summary: DataFrame, dropna: bool = True, group: Sequence[str] = GROUP) -> DataFrame:
    """Rate, id texts and the final column order.

    ``dropna`` keeps only blocks with at least one upvoted removed item; otherwise
    blocks without one are kept with zeros and an empty id.
    """
    if dropna:
        summary = summary.where("num_items_with_pos_upvotes_removed > 0")
    removed = F.coalesce("num_pos_upvotes_removed", F.lit(0))
    filled = summary.withColumns(
        {
            "last_id": int_to_id(F.col("_last_id")),
            # A removed item counts only with two upvotes or more, so the divisor is never 0 there.
            "rate": F.when(removed > 0, removed / F.col("total_pos_upvotes")).otherwise(F.lit(0.0)),
            "num_pos_upvotes_removed": removed,
            "score_of_max_pos_removed_item": F.coalesce("score_of_max_pos_removed_item", F.lit(0)),
            "id_of_max_pos_removed_item": int_to_id(F.col("_max_id")),
        }
    )
    extra = [c for c in group if c != "subreddit"]
    return filled.select(*extra, *BLOCK_COLUMNS)


def aggregate_blocks(
    items: DataFrame,
    n_rows: int = 1000,
    dropna: bool = True,
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Slim items -> block table: last copy of each id, blocks of ``n_rows``, statistics.

    One shuffle on the id for the copies, one on the community for the numbering; the
    block aggregation runs on the partitioning of the latter.
    """
    numbered = number_blocks(
        keep_last(items), n_rows, max_group_rows=max_group_rows, counted_on=items
    )
    return finish_blocks(summarise_blocks(numbered, n_rows), dropna)
