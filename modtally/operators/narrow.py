"""Reducing a very large table to a set of ids without shuffling the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The hashed bit set: at most 2^20 words of 64 bits, whatever the number of ids. A broadcast
# of two long columns takes about 40 bytes a row, so 42 MB at most.
FILTER_BITS = 1 << 26


def rows_with_ids(
    rows: DataFrame,
    ids: DataFrame,
    key: str = "id",
    filter_bits: int = FILTER_BITS,
    exact: bool = True,
) -> DataFrame:
    """Rows whose key is among ``ids``.

    The ids become a bit set of bounded size: it lets through every wanted row and a share
    of others, small while the ids are few against the bits, so that only those are shuffled
    for the exact join. Beyond that the filter saturates and the join alone decides.
    ``exact=False`` leaves the join to the caller. ``ids`` is read twice; pass a written table.
    """
    ids = ids.select(key)

    def hashed(df: DataFrame) -> DataFrame:
        slot = F.pmod(F.xxhash64(key), F.lit(filter_bits))
        return df.withColumns({"_word": F.shiftright(slot, 6), "_bit": slot.bitwiseAND(63).cast("int")})

    words = hashed(ids).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    likely = hashed(rows).join(F.broadcast(words), "_word").where(F.getbit("_bits", F.col("_bit")) == 1)
    likely = likely.select(*rows.columns)
    return likely.join(ids, key, "left_semi") if exact else likely
