"""Schemas of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

ITEM_TYPES = ("comments", "posts")

# Keys read from one raw JSON object. Scalars arrive as number or as text depending on
# the dump's age, so every key is read as text and cast afterwards.
RAW_KEYS = (
    "id",
    "created_utc",
    "subreddit",
    "score",
    "author",
    "body",
    "permalink",
    "promoted",
    "is_robot_indexable",
    "is_crosspostable",
    "link_id",
    "title",
    "num_comments",
)

# Keys kept beside the slim columns, so that enrichment never parses a dump again.
TEXT_KEYS = ("body", "link_id", "title", "num_comments")

SLIM = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("created_utc", T.LongType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("is_removed", T.BooleanType()),
    ]
)

# Position of a line among the files of its month.
POSITION = T.StructType(
    [
        T.StructField("period", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("line", T.LongType()),
    ]
)

_MONTH = [T.StructField("type", T.StringType()), T.StructField("month", T.StringType())]

CLASSIFIED = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("pos", POSITION),
        *SLIM.fields,
        *(T.StructField(k, T.StringType()) for k in TEXT_KEYS),
        T.StructField("outcome", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("raw", T.StringType()),
        *_MONTH,
    ]
)

SLIM_BY_MONTH = T.StructType([*SLIM.fields, T.StructField("pos", POSITION), *_MONTH])

BLOCKS = T.StructType(
    [
        T.StructField("subreddit", T.StringType()),
        T.StructField("total_pos_upvotes", T.LongType()),
        T.StructField("total_items", T.LongType()),
        T.StructField("last_created_utc", T.LongType()),
        T.StructField("last_id", T.StringType()),
        T.StructField("rate", T.DoubleType()),
        T.StructField("num_pos_upvotes_removed", T.LongType()),
        T.StructField("num_items_with_pos_upvotes_removed", T.LongType()),
        T.StructField("score_of_max_pos_removed_item", T.LongType()),
        T.StructField("id_of_max_pos_removed_item", T.StringType()),
    ]
)

BLOCKS_BY_MONTH = T.StructType([*BLOCKS.fields, *_MONTH])

COMMENTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("created_utc", T.LongType()),
        T.StructField("link_id", T.StringType()),
        T.StructField("score", T.LongType()),
    ]
)

POSTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("created_utc", T.LongType()),
        T.StructField("num_comments", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("score", T.LongType()),
    ]
)

ENRICHED = {"comments": COMMENTS, "posts": POSTS}

# Column order of the enriched tables is part of the contract: id, extra fields, score.
EXTRA_FIELDS = {
    "comments": ("body", "created_utc", "link_id"),
    "posts": ("created_utc", "num_comments", "title"),
}

ID_LIST = T.StructType([T.StructField("id", T.StringType())])

# What the job has done: the files of a month, read with the settings in ``detail``, and
# later stages of it. ``run`` orders the entries of one month.
DONE = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        *_MONTH,
        T.StructField("name", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("detail", T.StringType()),
        T.StructField("run", T.LongType()),
    ]
)

BLOCK_COLUMNS = BLOCKS.fieldNames()
