"""Base-36 item ids. Ids are ordered by their integer value, never as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def id_to_int(text: Column) -> Column:
    """``'e8tm2x3'`` -> its integer value."""
    return F.conv(text, 36, 10).cast("long")


def int_to_id(number: Column) -> Column:
    """Lowercase base-36 text of an integer; a missing number gives ``''``."""
    magnitude = F.lower(F.conv(F.abs(number).cast("string"), 10, 36))
    signed = F.when(number < 0, F.concat(F.lit("-"), magnitude)).otherwise(magnitude)
    return F.coalesce(signed, F.lit(""))


def add_fullname_prefix(item_id: Column, item_type: str) -> Column:
    return F.concat(F.lit("t1_" if item_type == "comments" else "t3_"), item_id)


def strip_fullname_prefix(fullname: Column) -> Column:
    return F.substr(fullname, F.lit(4))


def normalise_link_id(link_id: Column) -> Column:
    """Parent post id from either form dumps carry: a fullname, or a bare integer."""
    return F.when(link_id.rlike("^[0-9]+$"), int_to_id(link_id.try_cast("long"))).otherwise(
        strip_fullname_prefix(link_id)
    )
