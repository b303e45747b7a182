"""Integrity checks on the published tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import BLOCK_COLUMNS

# Text lengths of the published tables.
NAME_LENGTH = 30
ID_LENGTH = 15
TEXT_LENGTH = 300

_BLOCK_LENGTHS = {"subreddit": NAME_LENGTH, "last_id": ID_LENGTH, "id_of_max_pos_removed_item": ID_LENGTH}

PRIMARY_KEY = {"aggregate_comments": "last_id", "aggregate_posts": "last_id", "comments": "id", "posts": "id"}
NOT_NULL = {
    "aggregate_comments": tuple(BLOCK_COLUMNS),
    "aggregate_posts": tuple(BLOCK_COLUMNS),
    "comments": ("id", "created_utc", "link_id"),
    "posts": ("id", "created_utc", "num_comments"),
}
MAX_LENGTH = {
    "aggregate_comments": _BLOCK_LENGTHS,
    "aggregate_posts": _BLOCK_LENGTHS,
    "comments": {"id": ID_LENGTH, "body": TEXT_LENGTH, "link_id": ID_LENGTH},
    "posts": {"id": ID_LENGTH, "title": TEXT_LENGTH},
}


class ConstraintViolation(Exception):
    """A table breaks a key, NOT NULL or length rule."""


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def violations(df: DataFrame, table: str) -> DataFrame:
    """``table, column, rule, violations``: one row per NOT NULL and length rule, one pass."""
    rules: list[tuple[str, str, Column]] = [
        *((c, "not null", F.col(c).isNull()) for c in NOT_NULL[table]),
        *((c, f"length <= {n}", F.coalesce(F.length(c) > n, F.lit(False))) for c, n in MAX_LENGTH[table].items()),
    ]
    counted = df.agg(*(F.count_if(broken).alias(f"r{i}") for i, (_, _, broken) in enumerate(rules)))
    rows = F.array(
        *(
            F.struct(F.lit(table).alias("table"), F.lit(c).alias("column"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations"))
            for i, (c, rule, _) in enumerate(rules)
        )
    )
    return counted.select(F.inline(rows))


def key_violations(df: DataFrame, table: str) -> DataFrame:
    key = PRIMARY_KEY[table]
    return duplicate_keys(df, key).agg(F.count("*").alias("violations")).select(
        F.lit(table).alias("table"), F.lit(key).alias("column"), F.lit("primary key").alias("rule"), "violations"
    )


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Every rule of every given table with the number of rows or keys that break it."""
    reports = [f(df, name) for name, df in tables.items() for f in (violations, key_violations)]
    return reduce(DataFrame.unionByName, reports)


def check(tables: dict[str, DataFrame]) -> None:
    """Raise when any rule is broken. The report has a fixed number of rows per table."""
    broken = constraint_report(tables).where("violations > 0").collect()
    if broken:
        raise ConstraintViolation("; ".join(f"{r.table}.{r.column} {r.rule}: {r.violations}" for r in broken))


def check_unique(df: DataFrame, key: str, what: str) -> None:
    if not duplicate_keys(df, key).isEmpty():
        raise ConstraintViolation(f"{what}: {key} is not unique")
