"""Connected components of a link table, by contraction: union-find spread over Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import discard, write_shared


def connected_components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id of ``links`` (columns ``a, b``); the component is its smallest id.

    Each round lets every node hook onto its neighbour of least hashed rank, follows the hooks
    two steps, and contracts the links to the distinct links between what is left. Hashed
    ranks keep chains short, so the links shrink by a constant factor a round whatever their
    shape. Group minima are combined before the shuffle; a hub's links are only ever reduced
    by such minima or joined to one row. Rounds are written to the shared folder.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    links = links.where("a <> b and a is not null and b is not null")
    left = write_shared(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    state = None
    while not left.isEmpty():
        both = left.select("a", "b").unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = both.groupBy("a").agg(F.min(rank("b")).alias("m")).select(F.col("a").alias("id"), F.least("m", rank("a"))["v"].alias("up"))
        hooked = write_shared(hooked, "hooks")
        over = hooked.select(F.col("id").alias("up"), F.col("up").alias("next"))
        parent = write_shared(hooked.join(over, "up").select("id", F.col("next").alias("up")), "parents")
        a = parent.select(F.col("id").alias("a"), F.col("up").alias("pa"))
        b = parent.select(F.col("id").alias("b"), F.col("up").alias("pb"))
        moved = left.join(a, "a").join(b, "b").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        contracted = write_shared(moved.where("a <> b").distinct(), "links")
        discard(left, hooked)
        left = contracted
        if state is None:
            state = parent
        else:
            step = parent.select(F.col("id").alias("up"), F.col("up").alias("next"))
            followed = write_shared(state.join(step, "up", "left").select("id", F.coalesce("next", "up").alias("up")), "state")
            discard(state, parent)
            state = followed
    discard(left)
    if state is None:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    least = state.groupBy("up").agg(F.min("id").alias("component"))
    return state.join(least, "up").select("id", "component")
