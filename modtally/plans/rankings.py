"""Paged top-k rankings of blocks, as DataFrame functions and as SQL table functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written

SORT_KEYS = {"rate": "rate", "date": "last_created_utc"}


def page(
    blocks: DataFrame,
    subreddit: str,
    created_before: int | None = None,
    created_after: int | None = None,
    rate_less: float | None = None,
    rate_more: float | None = None,
) -> DataFrame:
    """Blocks of one community inside the given bounds (inclusive; None = no bound)."""
    wanted: Column = F.col("subreddit") == subreddit
    if created_before is not None:
        wanted &= F.col("last_created_utc") <= created_before
    if created_after is not None:
        wanted &= F.col("last_created_utc") >= created_after
    if rate_less is not None:
        wanted &= F.col("rate") <= rate_less
    if rate_more is not None:
        wanted &= F.col("rate") >= rate_more
    return blocks.where(wanted)


def _best_first(by: str) -> list[Column]:
    # last_id makes the order of equal keys definite.
    return [F.col(SORT_KEYS[by]).desc(), F.col("last_id").desc()]


def _top(blocks: DataFrame, by: str, num_records: int | None) -> DataFrame:
    ranked = blocks.select(
        "subreddit",
        "rate",
        "last_created_utc",
        "id_of_max_pos_removed_item",
        "last_id",
        "total_items",
        F.col("score_of_max_pos_removed_item").alias("score"),
    )
    # Written once: every later step reads these rows, whose size Spark then knows.
    return written(_ordered(ranked, by, num_records), "top")


def _ordered(rows: DataFrame, by: str, num_records: int | None) -> DataFrame:
    ordered = rows.orderBy(*_best_first(by))
    return ordered if num_records is None else ordered.limit(num_records)


def _only(right: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of a large table whose key occurs among the ranked blocks, written once before the left join.

    The written keys have a known size, by which Spark broadcasts them or not.
    """
    return written(right.join(keys.select(F.col(keys.columns[0]).alias(key)), key, "left_semi"), "found")


def _trimmed(*names: str) -> list[Column]:
    return [F.trim(F.col(n)).alias(n) for n in names]


def top_comments(
    blocks: DataFrame,
    comments: DataFrame,
    posts: DataFrame,
    subreddit: str,
    num_records: int | None,
    by: str = "rate",
    **bounds,
) -> DataFrame:
    """The top blocks of a community with their top removed comment and its post's title.

    The k best blocks are found first; the text tables are then reduced to those ids.
    Joins stay LEFT because enrichment is never complete.
    """
    top = _top(page(blocks, subreddit, **bounds), by, num_records)
    found = _only(comments, "id", top.select("id_of_max_pos_removed_item")).select(
        F.col("id").alias("id_of_max_pos_removed_item"), "body", "created_utc", "link_id"
    )
    titles = _only(posts, "id", found.select("link_id")).select(F.col("id").alias("link_id"), "title")
    joined = top.join(found, "id_of_max_pos_removed_item", "left").join(titles, "link_id", "left")
    return (
        _ordered(joined, by, num_records)
        .select(
            *_trimmed("subreddit"),
            "rate",
            "last_created_utc",
            *_trimmed("id_of_max_pos_removed_item", "last_id"),
            "total_items",
            *_trimmed("body"),
            "created_utc",
            *_trimmed("link_id", "title"),
            "score",
        )
    )


def top_posts(
    blocks: DataFrame,
    posts: DataFrame,
    subreddit: str,
    num_records: int | None,
    by: str = "rate",
    **bounds,
) -> DataFrame:
    """The top blocks of a community with the title of their top removed post."""
    top = _top(page(blocks, subreddit, **bounds), by, num_records)
    found = _only(posts, "id", top.select("id_of_max_pos_removed_item")).select(
        F.col("id").alias("id_of_max_pos_removed_item"), "title", "num_comments", "created_utc"
    )
    return (
        _ordered(top.join(found, "id_of_max_pos_removed_item", "left"), by, num_records)
        .select(
            *_trimmed("subreddit"),
            "rate",
            "last_created_utc",
            *_trimmed("id_of_max_pos_removed_item", "last_id"),
            "total_items",
            *_trimmed("title"),
            "num_comments",
            "created_utc",
            "score",
        )
    )


# The SQL functions read these views; see publish.create_views.
_PARAMETERS = """
    subreddit STRING,
    num_records INT,
    created_before BIGINT DEFAULT NULL,
    created_after BIGINT DEFAULT NULL,
    rate_less DOUBLE DEFAULT NULL,
    rate_more DOUBLE DEFAULT NULL
"""

# The rank is taken in slices first and then in slices of what these kept, so that neither a
# large community nor a large number of rows meets in one task before the last cut.
# Spark rejects LIMIT with a parameter; without a limit no rank is needed at all.
_TOP = """
    page AS (
      SELECT b.*
      FROM {blocks} b
      WHERE b.subreddit = {name}.subreddit
        AND ({name}.created_before IS NULL OR b.last_created_utc <= {name}.created_before)
        AND ({name}.created_after IS NULL OR b.last_created_utc >= {name}.created_after)
        AND ({name}.rate_less IS NULL OR b.rate <= {name}.rate_less)
        AND ({name}.rate_more IS NULL OR b.rate >= {name}.rate_more)
    ),
    sliced AS (
      SELECT *, row_number() OVER (PARTITION BY pmod(xxhash64(last_id), 256) ORDER BY {key} DESC, last_id DESC) AS slice_rank
      FROM page
      WHERE {name}.num_records IS NOT NULL
    ),
    fewer AS (
      SELECT *, row_number() OVER (PARTITION BY pmod(xxhash64(last_id), 16) ORDER BY {key} DESC, last_id DESC) AS second_rank
      FROM sliced
      WHERE slice_rank <= {name}.num_records
    ),
    ranked AS (
      SELECT *, row_number() OVER (ORDER BY {key} DESC, last_id DESC) AS place
      FROM fewer
      WHERE second_rank <= {name}.num_records
    ),
    top AS (
      SELECT * EXCEPT (slice_rank, second_rank, place) FROM ranked WHERE place <= {name}.num_records
      UNION ALL
      SELECT * FROM page WHERE {name}.num_records IS NULL
    )
"""

_COMMENT_FUNCTION = """
CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters})
RETURNS TABLE (subreddit STRING, rate DOUBLE, last_created_utc BIGINT, id_of_max_pos_removed_item STRING,
               last_id STRING, total_items BIGINT, body STRING, created_utc BIGINT, link_id STRING,
               title STRING, score BIGINT)
RETURN
  WITH {top},
    found AS (
      SELECT * FROM comments WHERE id IN (SELECT id_of_max_pos_removed_item FROM top)
    )
  SELECT trim(t.subreddit), t.rate, t.last_created_utc, trim(t.id_of_max_pos_removed_item), trim(t.last_id),
         t.total_items, trim(c.body), c.created_utc, trim(c.link_id), trim(p.title), t.score_of_max_pos_removed_item
  FROM top t
  LEFT JOIN found c ON t.id_of_max_pos_removed_item = c.id
  LEFT JOIN (
    SELECT * FROM posts WHERE id IN (SELECT link_id FROM found)
  ) p ON c.link_id = p.id
  ORDER BY t.{key} DESC, t.last_id DESC
"""

_POST_FUNCTION = """
CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters})
RETURNS TABLE (subreddit STRING, rate DOUBLE, last_created_utc BIGINT, id_of_max_pos_removed_item STRING,
               last_id STRING, total_items BIGINT, title STRING, num_comments BIGINT, created_utc BIGINT,
               score BIGINT)
RETURN
  WITH {top}
  SELECT trim(t.subreddit), t.rate, t.last_created_utc, trim(t.id_of_max_pos_removed_item), trim(t.last_id),
         t.total_items, trim(p.title), p.num_comments, p.created_utc, t.score_of_max_pos_removed_item
  FROM top t
  LEFT JOIN (
    SELECT * FROM posts WHERE id IN (SELECT id_of_max_pos_removed_item FROM top)
  ) p ON t.id_of_max_pos_removed_item = p.id
  ORDER BY t.{key} DESC, t.last_id DESC
"""

# The names callers use.
SQL_FUNCTIONS = {
    "getCommentUpvoteRemovedRatesByRate": ("comments", "rate"),
    "getCommentUpvoteRemovedRatesByDate": ("comments", "date"),
    "getPostUpvoteRemovedRatesByRate": ("posts", "rate"),
    "getPostUpvoteRemovedRatesByDate": ("posts", "date"),
}


def create_sql_functions(spark: SparkSession) -> None:
    """Create the four ranking functions over the live views, for use as
    ``SELECT * FROM getCommentUpvoteRemovedRatesByRate('name', 10)``."""
    for name, (item_type, by) in SQL_FUNCTIONS.items():
        key = SORT_KEYS[by]
        text = _COMMENT_FUNCTION if item_type == "comments" else _POST_FUNCTION
        top = _TOP.format(blocks=f"aggregate_{item_type}", name=name, key=key)
        spark.sql(text.format(name=name, parameters=_PARAMETERS, top=top, key=key))
