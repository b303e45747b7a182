"""Merging a short tail block into the full block before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import id_to_int
from ..schemas import BLOCK_COLUMNS
from ..session import materialise
from .ordering import MAX_GROUP_ROWS, large_groups, number_large_groups, split_by_size

_MERGED = [c for c in BLOCK_COLUMNS if c != "subreddit"]


def _neighbours_by_window(blocks: DataFrame, keys: list[str], order: list[Column], short: Column, full: Column) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return blocks.withColumns(
        {
            "_prev": F.lag(F.when(full, F.struct(*_MERGED))).over(window),
            "_next_short": F.coalesce(F.lead(short).over(window), F.lit(False)),
            "_last": F.lead(F.lit(True)).over(window).isNull(),
        }
    )


def _neighbours_by_position(blocks: DataFrame, keys: list[str], order: list[Column], short: Column, full: Column) -> DataFrame:
    """The same two columns for communities too large for one task: equi-joins on the
    neighbour's position, which spread evenly whatever the community."""
    numbered = materialise(number_large_groups(blocks, keys, order, "_position"))
    on = [*keys, "_position"]
    previous = numbered.where(full).select(
        *keys, (F.col("_position") + 1).alias("_position"), F.struct(*_MERGED).alias("_prev")
    )
    following = numbered.where(short).select(
        *keys, (F.col("_position") - 1).alias("_position"), F.lit(True).alias("_next_short")
    )
    # One row per large community.
    ends = numbered.groupBy(*keys).agg(F.max("_position").alias("_end"))
    return (
        numbered.join(previous, on, "left")
        .join(following, on, "left")
        .join(F.broadcast(ends), keys)
        .withColumns({"_next_short": F.coalesce("_next_short", F.lit(False)), "_last": F.col("_position") == F.col("_end")})
        .drop("_position", "_end")
    )


def _combined(field: str) -> Column:
    """Value of a merged row. The later block wins; on equal timestamps the roles swap."""
    earlier, own = F.col(f"_prev.{field}"), F.col(field)
    swapped = F.col("_prev.last_created_utc") >= F.col("last_created_utc")
    if field in ("last_created_utc", "last_id"):
        return F.when(swapped, earlier).otherwise(own)
    if field in ("score_of_max_pos_removed_item", "id_of_max_pos_removed_item"):
        score, prev_score = F.col("score_of_max_pos_removed_item"), F.col("_prev.score_of_max_pos_removed_item")
        take_prev = F.when(swapped, ~(score > prev_score)).otherwise(prev_score > score)
        return F.when(take_prev, earlier).otherwise(own)
    if field == "rate":
        removed = F.col("num_pos_upvotes_removed") + F.col("_prev.num_pos_upvotes_removed")
        return removed / (F.col("total_pos_upvotes") + F.col("_prev.total_pos_upvotes"))
    return own + earlier


def merge_rows(blocks: DataFrame, min_rows: int, n_rows: int, max_group_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Merged blocks under their community's exact name, with what a later merge needs to go on.

    ``_time, _month, _id``: the order key of the row's own block. ``_last``: nothing of the
    community follows. ``_open``: it is a full block and last, so a later short one would merge into it.
    """
    if min_rows > n_rows:
        raise ValueError(f"min_rows ({min_rows}) must not exceed n_rows ({n_rows})")
    extra = [c for c in ("type",) if c in blocks.columns]
    keys = [*extra, "subreddit"]
    month = F.col("month") if "month" in blocks.columns else F.lit(None).cast("string")
    # Equal times keep dump order: month first, then the id.
    keyed = blocks.withColumns({"_time": F.col("last_created_utc"), "_month": month, "_id": id_to_int(F.col("last_id"))})
    order = [F.col("_time"), F.col("_month"), F.col("_id")]
    short, full = F.col("total_items") < min_rows, F.col("total_items") == n_rows

    large = None if max_group_rows is None else large_groups(keyed, keys, max_group_rows)
    if large is None:
        placed = _neighbours_by_window(keyed, keys, order, short, full)
    else:
        small_rows, large_rows = split_by_size(keyed, keys, large)
        placed = _neighbours_by_window(small_rows, keys, order, short, full).unionByName(
            _neighbours_by_position(large_rows, keys, order, short, full)
        )
    merges = short & F.col("_prev").isNotNull()
    return placed.where(~(full & F.col("_next_short"))).select(
        *keys,
        *(F.when(merges, _combined(c)).otherwise(F.col(c)).alias(c) for c in _MERGED),
        "_time",
        "_month",
        "_id",
        "_last",
        (F.col("_last") & full).alias("_open"),
    )


def merge_short_tails(
    blocks: DataFrame,
    min_rows: int = 500,
    n_rows: int = 1000,
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Join all months of a community and merge each block of fewer than ``min_rows``
    items that directly follows a full block into that block.

    A merged block never absorbs another: the block after it follows a short one. So a
    look at the direct neighbours is enough, provided ``min_rows <= n_rows``.
    """
    extra = [c for c in ("type",) if c in blocks.columns]
    merged = merge_rows(blocks, min_rows, n_rows, max_group_rows)
    return merged.select(*extra, F.lower("subreddit").alias("subreddit"), *_MERGED)
