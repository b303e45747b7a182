"""The driver's tables in the roles of dumps, items, files and stored results.

``lineitem`` plays the comments (one dump; repeated keys are repeated ids), ``orders``
the posts (one dump per month), ``documents`` and ``pages`` give the texts.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modtally.functions import int_to_id
from modtally.session import scratch_path

COMMENT_MONTH = "2001-01"


_written: dict[tuple, object] = {}


def once(f):
    """Build a written table once per session and data folder; later queries read it."""

    @wraps(f)
    def cached(spark: SparkSession, sf_dir: str):
        key = (f.__name__, spark.sparkContext.applicationId, sf_dir)
        if key not in _written:
            _written[key] = f(spark, sf_dir)
        return _written[key]

    return cached


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores when the table is so small that fewer tasks would read it.

    A table that Spark reads in at least as many parts as there are cores stays as it is: dealt over
    a fixed number of partitions, a task would grow with the table.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def epoch(column: str) -> Column:
    return F.unix_seconds(F.col(column).cast("timestamp"))


# --- comments -----------------------------------------------------------------------

COMMENT_POS = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_quantity",
    "l_extendedprice",
)


def comment_source(spark: SparkSession, sf_dir: str, text_of: str | None = None) -> DataFrame:
    """``text_of`` names the key whose document's ``text`` is added. It is joined to the plain table, whose rows are the shorter ones."""
    item = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")
    if text_of:
        item = item.join(table(spark, sf_dir, "documents").select(F.col("doc_id").alias(text_of), "text"), text_of, "left")
    special = F.col("l_linenumber") == 7
    return item.select(
        F.lit("comments").alias("type"),
        F.lit(COMMENT_MONTH).alias("month"),
        int_to_id(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        epoch("l_shipdate").alias("created_utc"),
        F.concat(F.lit("Sub_"), F.col("l_suppkey")).alias("subreddit"),
        F.when(F.col("l_tax") != 0.08, F.col("l_quantity").cast("long") - 10).alias("score"),
        ((F.col("l_returnflag") == "R") & (F.col("l_partkey") % 11 == 0)).alias("is_removed"),
        F.when(special & (F.col("l_discount") == 0.1), "advert")
        .when(special & (F.col("l_discount") == 0.09), "no score")
        .otherwise("item")
        .alias("kind"),
        int_to_id(F.col("l_orderkey")).alias("link_id"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.struct(*COMMENT_POS).alias("pos"),
        *(["text"] if text_of else []),
    )


def comment_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slim comments straight from the table."""
    return (
        comment_source(spark, sf_dir)
        .where("kind = 'item'")
        .select("type", "month", "id", "created_utc", "subreddit", F.coalesce("score", F.lit(1)).alias("score"), "is_removed", "pos")
    )


def comment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same comments as raw JSON lines, with bodies, adverts and incomplete records."""
    joined = comment_source(spark, sf_dir, text_of="l_orderkey")
    escaped = F.col("l_linenumber") % 2 == 1
    removed, advert = F.col("is_removed"), F.col("kind") == "advert"
    rest = F.struct(
        "id",
        F.when(~advert, F.col("subreddit")).alias("subreddit"),
        F.when(removed & escaped, r"\[deleted\]").when(removed, "[deleted]").otherwise("someone").alias("author"),
        F.when(removed & escaped, r"\[removed\]")
        .when(removed, "[removed]")
        .otherwise(F.coalesce("text", F.concat(F.lit("part "), "l_partkey")))
        .alias("body"),
        F.concat(F.lit("t3_"), "link_id").alias("link_id"),
        F.when(advert, F.lit(True)).alias("promoted"),
    )
    created = F.when(escaped, F.concat(F.lit('"'), "created_utc", F.lit('"'))).otherwise(F.col("created_utc").cast("string"))
    score = F.when(F.col("kind") == "no score", "").otherwise(
        F.concat(F.lit('"score":'), F.coalesce(F.col("score").cast("string"), F.lit("null")), F.lit(","))
    )
    value = F.concat(F.lit('{"created_utc":'), created, F.lit(","), score, F.substr(F.to_json(rest), F.lit(2)))
    return joined.select(value.alias("value"), F.lit(f"RC_{COMMENT_MONTH}.zst").alias("file"), "type", "month", "pos")


# --- posts --------------------------------------------------------------------------


def post_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return spread(table(spark, sf_dir, "orders"), "o_orderkey").select(
        F.lit("posts").alias("type"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        int_to_id(key).alias("id"),
        epoch("o_orderdate").alias("created_utc"),
        F.col("o_orderpriority").alias("subreddit"),
        (F.floor(F.col("o_totalprice") / 1000) - 50).cast("long").alias("score"),
        ((F.col("o_orderstatus") == "F") & (key % 7 == 0)).alias("hidden"),
        (key % 13 == 0).alias("author_deleted"),
        (F.col("o_custkey") % 3 == 0).alias("old_flag"),
        (key % 997 == 5).alias("no_flag"),
        (F.col("o_custkey") % 50).alias("num_comments"),
        "o_orderkey",
        "o_custkey",
        F.struct("o_orderkey").alias("pos"),
    )


def post_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slim posts straight from the table."""
    return post_source(spark, sf_dir).select(
        "type", "month", "id", "created_utc", "subreddit", "score", (F.col("hidden") & ~F.col("author_deleted")).alias("is_removed"), "pos"
    )


def post_lines(spark: SparkSession, sf_dir: str, flawed: bool = False) -> DataFrame:
    """The same posts as raw JSON lines. ``flawed`` leaves out both removal flags here and there."""
    titles = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("o_custkey"), F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title")
    )
    joined = post_source(spark, sf_dir).join(titles, "o_custkey", "left")
    visible = (~F.col("hidden")).cast("string")
    # A JSON null counts as false, but it is not a missing key.
    robot = F.when(F.col("hidden") & (F.col("o_orderkey") % 2 == 0), "null").otherwise(visible)
    flag = F.when(F.col("old_flag"), F.concat(F.lit('"is_crosspostable":'), visible, F.lit(","))).otherwise(
        F.concat(F.lit('"is_robot_indexable":'), robot, F.lit(","))
    )
    if flawed:
        flag = F.when(F.col("no_flag"), "").otherwise(flag)
    rest = F.struct(
        "id",
        "created_utc",
        "subreddit",
        "score",
        F.when(F.col("author_deleted"), "[deleted]").otherwise("someone").alias("author"),
        F.coalesce("title", F.concat(F.lit("order  by "), "o_custkey")).alias("title"),
        "num_comments",
    )
    value = F.concat(F.lit("{"), flag, F.substr(F.to_json(rest), F.lit(2)))
    return joined.select(
        value.alias("value"), F.concat(F.lit("RS_"), "month", F.lit(".zst")).alias("file"), "type", "month", "pos"
    )


# --- files and the size manifest ----------------------------------------------------


def post_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One monthly dump per month of orders: ``name, size, m``."""
    by_month = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.sum(F.floor("o_totalprice").cast("long")).alias("size")
    )
    return by_month.select(
        F.concat(F.lit("RS_"), "month", F.lit(".zst")).alias("name"), "size", F.substring("month", 6, 2).cast("int").alias("m")
    )


@once
def comment_days_path(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "days")
    days = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("date"))
        .agg(F.sum(F.col("l_quantity").cast("long")).alias("size"))
    )
    days.select(F.date_format("date", "yyyy-MM-dd").alias("day"), "size", F.month("date").alias("m")).write.parquet(path)
    return path


def comment_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily dump per shipping day: ``day, size, m``. Several lists derive from it."""
    return spark.read.parquet(comment_days_path(spark, sf_dir))


def comment_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comment_days(spark, sf_dir).groupBy(F.substring("day", 1, 7).alias("month"), "m").agg(F.sum("size").alias("size"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = post_files(spark, sf_dir).select("name", "size")
    days = comment_days(spark, sf_dir).select(F.concat(F.lit("RC_"), "day", F.lit(".zst")).alias("name"), "size")
    months = comment_months(spark, sf_dir).where("m % 2 = 1").select(
        F.concat(F.lit("RC_"), "month", F.lit(".zst")).alias("name"), (F.col("size") + 7).alias("size")
    )
    return posts.unionByName(days).unionByName(months)


def local_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files on disk, some of them with another size than the manifest says."""
    off = lambda condition: F.col("size") + F.when(condition, 1).otherwise(0)
    posts = post_files(spark, sf_dir).where("m <> 11").select("name", off(F.col("m") % 5 == 0).alias("size"))
    months = comment_months(spark, sf_dir).where("m % 2 = 1").select(
        F.concat(F.lit("RC_"), "month", F.lit(".zst")).alias("name"), off(F.col("m") == 7).alias("size")
    )
    days = comment_days(spark, sf_dir).where("m % 2 = 0").select(
        F.concat(F.lit("RC_"), "day", F.lit(".zst")).alias("name"), off((F.col("m") == 4) & F.endswith("day", F.lit("-13"))).alias("size")
    )
    return posts.unionByName(months).unionByName(days)


def skip_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post_files(spark, sf_dir).where("m = 3").select(F.substring_index("name", ".", 1).alias("basename"))
