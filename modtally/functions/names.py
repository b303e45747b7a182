"""Dump file names: type, period and extension; date series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Extensions a dump may carry.
EXTENSIONS = (".gz", ".bz2", ".xz", ".zst")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def extension(name: Column) -> Column:
    """Lowercase, with the dot; empty when there is none."""
    return F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))


def base_name(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def item_type(base: Column) -> Column:
    """The second character tells submissions (``s``) from comments."""
    return F.when(F.lower(F.substring(base, 2, 1)) == "s", "posts").otherwise("comments")


def period(base: Column) -> Column:
    return F.regexp_extract(base, r"^[^_]*_(?:v2_)?(.*)$", 1)


def is_daily(base: Column) -> Column:
    """More than one dash: a dump of a single day."""
    return F.length(base) - F.length(F.translate(base, "-", "")) > 1


def month_of(period_text: Column) -> Column:
    """``2020-01`` of either ``2020-01`` or ``2020-01-31``; a yearly period stays as it is."""
    return F.substring_index(period_text, "-", 2)


def with_name_parts(files: DataFrame, name: str = "name") -> DataFrame:
    """Add ``base, ext, type, period, month, is_daily`` derived from a file name column."""
    base = base_name(F.col(name))
    return files.withColumns(
        {
            "base": base,
            "ext": extension(F.col(name)),
            "type": item_type(base),
            "period": period(base),
            "month": month_of(period(base)),
            "is_daily": is_daily(base),
        }
    )


def period_series(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every month (``2020-01``) or day (``2020-01-01``) from start to end, both included."""
    if start.count("-") != end.count("-") or start.count("-") not in (1, 2):
        raise ValueError(f"start and end must both be months or both be days: {start}, {end}")
    monthly = start.count("-") == 1
    suffix = "-01" if monthly else ""
    bounds = spark.range(1).select(F.lit(start + suffix).cast("date").alias("first"), F.lit(end + suffix).cast("date").alias("last"))
    return periods_between(bounds, "month" if monthly else "day")


def periods_between(bounds: DataFrame, unit: str) -> DataFrame:
    """Every ``month`` or ``day`` from column ``first`` to column ``last`` of each row, both included."""
    fmt = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}[unit]
    start, end = (F.date_trunc(unit, F.col(c)).cast("date") for c in ("first", "last"))
    days = bounds.select(F.explode(F.sequence(start, end, F.expr(f"interval 1 {unit}"))).alias("d"))
    return days.select(F.date_format("d", fmt).alias("period"))
