"""Registered queries: each runs a library operator over the driver's whole tables."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modtally.functions import (
    add_fullname_prefix,
    clean_text,
    id_to_int,
    int_to_id,
    normalise_link_id,
    periods_between,
    strip_fullname_prefix,
    with_name_parts,
)
from modtally.operators import blocks as B
from modtally.operators import constraints as C
from modtally.operators import enrich as E
from modtally.operators import quality as Q
from modtally.operators.merge import merge_short_tails
from modtally.operators.slim import classify, kept_items, quarantined, rejected_files
from modtally.plans import build
from modtally.plans import publish as P
from modtally.plans import rankings as R
from modtally.session import scratch_path, written
from modtally.sources import tables as io
from modtally.sources.dumps import cap_lines, complete_months, decode_lines, judge_files, read_dumps, readable_files
from modtally.sources.manifest import coverage, order_manifest, parent_sizes, upsert_manifest
from modtally.streaming.incremental import is_stale, pending_months

from . import roles
from .roles import once, table

COMMENT_ROWS, COMMENT_MIN = 100, 50
POST_ROWS, POST_MIN = 10, 5
COMMUNITY, PRIORITY = "sub_7", "1-urgent"
# Small enough that the test tables take the path for large groups.
LARGE = 200

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# --- stages shared by several queries ------------------------------------------------


def comment_blocks(spark: SparkSession, d: str) -> DataFrame:
    return B.aggregate_blocks(roles.comment_items(spark, d), COMMENT_ROWS)


def post_blocks(spark: SparkSession, d: str) -> DataFrame:
    return B.aggregate_blocks(roles.post_items(spark, d), POST_ROWS)


@once
def blocks_path(spark: SparkSession, d: str) -> str:
    """Block tables of both kinds by month, as the second stage writes them."""
    path = scratch_path(spark, "blocks")
    io.write_by_month(comment_blocks(spark, d), path, rebalance=True)
    io.write_by_month(post_blocks(spark, d), path, rebalance=True)
    return path


def written_blocks(spark: SparkSession, d: str, kind: str) -> DataFrame:
    return io.read_blocks(spark, blocks_path(spark, d), kind)


@once
def classified(spark: SparkSession, d: str) -> str:
    """Both kinds of raw lines, parsed once and written."""
    path = scratch_path(spark, "classified")
    classify(roles.comment_lines(spark, d)).write.option("compression", "zstd").parquet(f"{path}/comments")
    classify(roles.post_lines(spark, d)).write.option("compression", "zstd").parquet(f"{path}/posts")
    return path


@once
def published(spark: SparkSession, d: str) -> str:
    """All stages over the tables, staged, checked and published."""
    base = scratch_path(spark, "tables")
    merged = {
        "comments": merge_short_tails(written_blocks(spark, d, "comments"), COMMENT_MIN, COMMENT_ROWS).drop("type"),
        "posts": merge_short_tails(written_blocks(spark, d, "posts"), POST_MIN, POST_ROWS).drop("type"),
    }
    tables: dict[str, DataFrame] = {}
    for kind, blocks in merged.items():
        blocks.write.parquet(f"{base}/merged/{kind}")
        tables[f"aggregate_{kind}"] = blocks = spark.read.parquet(f"{base}/merged/{kind}")
        versions = E.stored_versions(spark.read.parquet(f"{classified(spark, d)}/{kind}"), kind)
        rows, _ = E.enrich(blocks, versions, kind, comments=tables.get("comments"))
        rows.write.parquet(f"{base}/enriched/{kind}")
        tables[kind] = spark.read.parquet(f"{base}/enriched/{kind}")
    P.stage(tables, base, 1)
    P.publish(spark, base, 1)
    return base


@once
def published_keep_all(spark: SparkSession, d: str) -> str:
    """Blocks without removed items kept, through merge, enrichment, checks and publication."""
    out = scratch_path(spark, "keep-all")
    settings = build.Settings(n_rows=COMMENT_ROWS, min_rows=COMMENT_MIN, dropna=False)
    io.write_by_month(B.aggregate_blocks(roles.comment_items(spark, d), COMMENT_ROWS, dropna=False), f"{out}/blocks")
    io.write_by_month(B.aggregate_blocks(roles.post_items(spark, d), COMMENT_ROWS, dropna=False), f"{out}/blocks")
    build.build_merged(spark, out, settings)
    parsed = classified(spark, d)
    both = spark.read.parquet(f"{parsed}/comments").drop("pos").unionByName(spark.read.parquet(f"{parsed}/posts").drop("pos"))
    # Any one order of the copies will do here.
    build.build_tables(spark, out, both.withColumn("pos", F.struct("created_utc", "body")), settings=settings)
    P.publish(spark, f"{out}/tables", 1)
    return f"{out}/tables"


def placed(df: DataFrame, *first: str) -> DataFrame:
    """Number the rows of a short result in the order it has."""
    return df.withColumn("_row", F.monotonically_increasing_id()).withColumn(
        "place", F.row_number().over(Window.orderBy(*first, "_row")).cast("long")
    ).drop("_row", *first)


def live(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return P.read_live(spark, published(spark, d))


# --- functions -----------------------------------------------------------------------


@query
def base36_roundtrip(spark, d):
    key = F.col("o_orderkey")
    ids = table(spark, d, "orders").select("o_orderkey", int_to_id(key * 7919 - 1000).alias("id"), int_to_id(key).alias("plain"))
    return ids.select("o_orderkey", "id", id_to_int(F.col("plain")).alias("back"))


@query
def clean_text_documents(spark, d):
    return roles.spread(table(spark, d, "documents"), "doc_id").select("doc_id", clean_text(F.col("text")).alias("body"))


@query
def clean_text_pages(spark, d):
    return roles.spread(table(spark, d, "pages"), "page_id").select("page_id", clean_text(F.col("html")).alias("title"))


@query
def link_id_normalise(spark, d):
    key = F.col("l_orderkey")
    full = add_fullname_prefix(int_to_id(key), "posts")
    raw = F.when(F.col("l_linenumber") % 2 == 0, full).otherwise(key.cast("string"))
    return table(spark, d, "lineitem").select(
        raw.alias("raw"), normalise_link_id(raw).alias("link_id"), strip_fullname_prefix(full).alias("bare")
    )


@query
def file_name_parts(spark, d):
    return with_name_parts(roles.local_files(spark, d)).drop("size")


@query
def period_series_months(spark, d):
    return periods_between(table(spark, d, "orders").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")), "month")


@query
def period_series_days(spark, d):
    return periods_between(table(spark, d, "orders").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")), "day")


# --- scan, slim ----------------------------------------------------------------------

_SLIM = ("id", "created_utc", "subreddit", "score", "is_removed")


@query
def slim_comments(spark, d):
    return kept_items(spark.read.parquet(f"{classified(spark, d)}/comments")).select(*_SLIM)


@query
def slim_posts(spark, d):
    return kept_items(spark.read.parquet(f"{classified(spark, d)}/posts")).select("month", *_SLIM)


@query
def slim_float_numbers(spark, d):
    """Times and scores written as decimals, and quoted flags, give the same items."""
    lines = roles.post_lines(spark, d).withColumn("value", F.regexp_replace("value", r'"(created_utc|score)":(-?\d+)', r'"$1":$2.0'))
    return kept_items(classify(lines)).select("month", *_SLIM)


@query
def outcome_report(spark, d):
    lines = roles.comment_lines(spark, d).drop("pos").unionByName(roles.post_lines(spark, d, flawed=True).drop("pos"))
    return classify(lines).groupBy("type", "outcome", "reason").agg(F.count("*").alias("lines"))


@query
def quarantine_lines(spark, d):
    return quarantined(classify(roles.comment_lines(spark, d))).select("file", "reason", F.get_json_object("raw", "$.id").alias("id"))


@query
def rejected_dump_files(spark, d):
    return rejected_files(classify(roles.post_lines(spark, d, flawed=True)))


@query
def slim_posts_of_usable_files(spark, d):
    return kept_items(classify(roles.post_lines(spark, d, flawed=True))).select("month", *_SLIM)


def _raw_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents as raw lines of an ISO-8859-1 dump, one file per language."""
    return table(spark, d, "documents").select(
        "doc_id", F.encode("text", "ISO-8859-1").cast("string").alias("value"), F.col("lang").alias("file")
    )


@query
def encoding_fallback(spark, d):
    return decode_lines(_raw_documents(spark, d)).select("doc_id", F.col("value").alias("text"))


@query
def encoding_fallback_whole_file(spark, d):
    return decode_lines(_raw_documents(spark, d), whole_file=True).select("doc_id", F.col("value").alias("text"))


@query
def line_cap(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM").alias("file"),
        F.struct(F.floor(F.col("o_orderkey") / 1000).alias("start"), F.col("o_orderkey").alias("line")).alias("pos"),
    )
    return cap_lines(rows, 40).select("file", "o_orderkey")


def _dump(spark: SparkSession, d: str, codec: str, extension: str) -> DataFrame:
    """Write the raw comment lines as a compressed dump and scan it again."""
    path = f"{scratch_path(spark, 'dump')}/RC_{roles.COMMENT_MONTH}"
    roles.comment_lines(spark, d).select("value").write.option("compression", codec).text(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{extension}").load(path).select("path")
    # One path per written file.
    lines = read_dumps(spark, [r.path for r in files.collect()])
    # Part files are not named like dumps.
    return lines.withColumns({"type": F.lit("comments"), "month": F.lit(roles.COMMENT_MONTH)})


def scanned(lines: DataFrame) -> DataFrame:
    """Items of scanned lines. The parsed lines are written first: the items and the files to leave out both
    come from them, and no dump is decoded twice."""
    parsed = classify(decode_lines(lines)).select(*_SLIM, "type", "month", "pos", "file", "outcome", "reason")
    return kept_items(written(parsed, "scanned"))


@query
def scan_gz(spark, d):
    return scanned(_dump(spark, d, "gzip", ".gz")).select(*_SLIM)


@query
def scan_bz2(spark, d):
    return scanned(_packed_dump(spark, d, ".bz2")).select(*_SLIM)


def packed_dump_paths(spark: SparkSession, d: str, extension: str, files: int | None = None) -> list[str]:
    """The same for codecs Spark cannot write, or only slowly (bz2): each task packs its lines into one file."""
    folder = scratch_path(spark, "dump")
    name = f"RC_{roles.COMMENT_MONTH}"

    def pack(batches):
        import bz2
        import lzma
        import uuid

        import zstandard
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(re.sub("^(file:)?/+", "file:///", folder))
        system.create_dir(base)
        file = f"{name}-{uuid.uuid4().hex}{extension}"
        with system.open_output_stream(f"{base}/{file}", compression=None) as raw:
            if extension == ".zst":
                packed = zstandard.ZstdCompressor().stream_writer(raw, closefd=False)
            else:
                packed = lzma.open(raw, "w", preset=0) if extension == ".xz" else bz2.open(raw, "w")
            with packed:
                for batch in batches:
                    packed.write("".join(batch["value"] + "\n").encode())
        yield pd.DataFrame({"path": [f"{folder}/{file}"]})

    lines = roles.comment_lines(spark, d).select("value")
    written = (lines if files is None else lines.repartition(files)).mapInPandas(pack, "path string")
    # One path per written file.
    return [r.path for r in written.collect()]


def _packed_dump(spark: SparkSession, d: str, extension: str) -> DataFrame:
    lines = read_dumps(spark, packed_dump_paths(spark, d, extension))
    return lines.withColumns({"type": F.lit("comments"), "month": F.lit(roles.COMMENT_MONTH)})


@query
def scan_zst(spark, d):
    return scanned(_packed_dump(spark, d, ".zst")).select(*_SLIM)


@query
def scan_xz(spark, d):
    return scanned(_packed_dump(spark, d, ".xz")).select(*_SLIM)


@query
def slim_csv_roundtrip(spark, d):
    path = scratch_path(spark, "slim-csv")
    io.write_slim_csv(roles.post_items(spark, d), path)
    return io.read_slim_csv(spark, path).select("type", "month", *_SLIM)


# --- blocks --------------------------------------------------------------------------


@query
def dedup_keep_last(spark, d):
    return B.keep_last(roles.comment_items(spark, d)).select(*_SLIM)


@query
def dedup_two_files_of_month(spark, d):
    """Two dumps of one month: the copy in the later file name counts, whatever its place there."""
    items = roles.comment_items(spark, d)
    file = lambda name: F.struct(F.lit("2001-01").alias("period"), F.lit(name).alias("name"), F.col("pos").alias("line"))
    first = items.withColumn("pos", file("RC_2001-01.zst"))
    second = items.where("score > 5").withColumns({"score": F.col("score") + 100, "pos": file("RC_v2_2001-01.zst")})
    return B.keep_last(second.unionByName(first)).select(*_SLIM)


@query
def block_number(spark, d):
    return B.number_blocks(B.keep_last(roles.comment_items(spark, d)), COMMENT_ROWS).select("id", "subreddit", "position", "block")


@query
def block_number_large_groups(spark, d):
    """The same numbers by the path for communities too large for one task."""
    numbered = B.number_blocks(B.keep_last(roles.comment_items(spark, d)), COMMENT_ROWS, max_group_rows=LARGE)
    return numbered.select("id", "subreddit", "position", "block")


@query
def block_aggregate(spark, d):
    return comment_blocks(spark, d)


@query
def block_aggregate_posts(spark, d):
    return post_blocks(spark, d)


@query
def block_aggregate_keep_all(spark, d):
    return B.aggregate_blocks(roles.comment_items(spark, d), COMMENT_ROWS, dropna=False)


@query
def positive_scores(spark, d):
    score = F.col("score")
    return roles.comment_items(spark, d).groupBy("subreddit").agg(
        B.sum_positive(score).alias("sum_pos"), B.count_positive(score).alias("count_pos")
    )


@query
def merge_short_tail(spark, d):
    return merge_short_tails(written_blocks(spark, d, "posts"), POST_MIN, POST_ROWS)


@query
def merge_short_tail_large_groups(spark, d):
    return merge_short_tails(written_blocks(spark, d, "posts"), POST_MIN, POST_ROWS, max_group_rows=50)


@query
def merge_short_tail_comments(spark, d):
    return merge_short_tails(written_blocks(spark, d, "comments"), COMMENT_MIN, COMMENT_ROWS)


# --- quality and files ---------------------------------------------------------------


@query
def removal_share_by_month(spark, d):
    return Q.removal_share(roles.post_items(spark, d))


@query
def removal_share_compat(spark, d):
    return Q.removal_share(roles.post_items(spark, d), compat=True)


@query
def usable_months(spark, d):
    return Q.usable_months(Q.removal_share(roles.post_items(spark, d)), 0.03, 0.09)


@query
def unusable_month_skip_list(spark, d):
    return Q.skip_list(Q.usable_months(Q.removal_share(roles.post_items(spark, d)), 0.03, 0.09))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    files = with_name_parts(roles.local_files(spark, d))
    return judge_files(files, roles.manifest(spark, d), roles.skip_names(spark, d))


@query
def manifest_check(spark, d):
    return _judged(spark, d).select("name", "size", "listed_size", "parts_size", "status")


@query
def daily_size_rollup(spark, d):
    return parent_sizes(roles.manifest(spark, d))


@query
def daily_months(spark, d):
    return complete_months(_judged(spark, d))


@query
def daily_months_incomplete(spark, d):
    """A month whose listed days are not all there waits, however well the others match."""
    files = with_name_parts(roles.local_files(spark, d))
    gone = F.col("is_daily") & F.endswith("name", F.lit("-09.zst")) & (F.substring("month", 6, 2).cast("int") % 4 == 0)
    return complete_months(judge_files(files.where(~gone), roles.manifest(spark, d)))


@query
def files_with_two_skip_lists(spark, d):
    unusable = Q.skip_list(Q.usable_months(Q.removal_share(roles.post_items(spark, d)), 0.03, 0.09))
    skip = roles.skip_names(spark, d).unionByName(unusable)
    files = with_name_parts(roles.local_files(spark, d))
    return judge_files(files, roles.manifest(spark, d), skip).groupBy("status").agg(F.count("*").alias("files"))


@query
def files_to_read(spark, d):
    return readable_files(_judged(spark, d)).select("name", "type", "month")


@query
def coverage_report(spark, d):
    months = period_series_months(spark, d)
    expected = months.select(
        F.concat(F.lit("RS_"), "period").alias("base"), F.concat(F.lit("RS_"), "period", F.lit(".zst")).alias("name")
    )
    listed = roles.manifest(spark, d).where(~F.endswith("name", F.lit("-06.zst")))
    return coverage(expected, with_name_parts(roles.local_files(spark, d)), listed)


@query
def manifest_upsert(spark, d):
    known = roles.post_files(spark, d).select("name", "size")
    return upsert_manifest(known, roles.manifest(spark, d).withColumn("size", F.col("size") + 1))


@query
def manifest_order(spark, d):
    return placed(order_manifest(roles.manifest(spark, d)))


@query
def months_to_process(spark, d):
    items = roles.post_items(spark, d)
    done = items.where(F.col("month") < "1998-01")
    return pending_months(items, done)


@query
def output_is_stale(spark, d):
    inputs = table(spark, d, "orders").select(F.col("o_orderdate").alias("modified"))
    outputs = table(spark, d, "lineitem").select(F.col("l_shipdate").alias("modified"))
    return is_stale(inputs, outputs)


# --- enrichment ----------------------------------------------------------------------


def stored_comments(spark: SparkSession, d: str) -> DataFrame:
    """A stored table of the removed comments: some without text, some without time."""
    number = id_to_int(F.col("id"))
    unique = B.keep_last(roles.comment_source(spark, d).where("kind = 'item' AND is_removed"))
    return unique.select(
        "id",
        F.when(number % 3 == 0, "[removed]").when(number % 3 == 1, F.concat(F.lit("stored "), "id")).otherwise("").alias("body"),
        F.when(number % 5 != 0, F.col("created_utc") + (number % 2) * 700000000).alias("created_utc"),
        "link_id",
        F.coalesce("score", F.lit(1)).alias("score"),
    )


def inaccessible_ids(spark: SparkSession, d: str) -> DataFrame:
    return B.keep_last(roles.comment_items(spark, d)).where(id_to_int(F.col("id")) % 17 == 0).select("id")


def comment_versions(spark: SparkSession, d: str) -> DataFrame:
    return E.stored_versions(spark.read.parquet(f"{classified(spark, d)}/comments"), "comments")


@query
def archived_comments(spark, d):
    stored = stored_comments(spark, d)
    return stored.select("id", E.archived(stored, "comments").alias("archived"))


@query
def ids_to_lookup(spark, d):
    blocks = live(spark, d)["aggregate_comments"]
    return E.ids_to_lookup(blocks, "comments", stored_comments(spark, d), inaccessible_ids(spark, d))


@query
def post_ids_to_lookup(spark, d):
    """Top posts and the parents of the stored comments."""
    return E.ids_to_lookup(live(spark, d)["aggregate_posts"], "posts", comments=stored_comments(spark, d))


@query
def post_ids_to_lookup_stored(spark, d):
    """Stored posts are final: their ids are not looked up again."""
    stored = roles.post_source(spark, d).where("o_orderkey % 4 = 0").select("id", "created_utc", "num_comments", F.col("id").alias("title"), "score")
    return E.ids_to_lookup(live(spark, d)["aggregate_posts"], "posts", stored, comments=stored_comments(spark, d))


@once
def classified_flawed(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "flawed")
    classify(roles.post_lines(spark, d, flawed=True)).write.parquet(path)
    return path


@query
def enrich_posts_flawed(spark, d):
    """Texts of usable files only, over all posts."""
    ids = roles.post_source(spark, d).select("id")
    return E.lookup(ids, E.stored_versions(spark.read.parquet(classified_flawed(spark, d)), "posts"), "posts")


@query
def ids_not_found(spark, d):
    wanted = E.ids_to_lookup(live(spark, d)["aggregate_posts"], "posts", comments=stored_comments(spark, d))
    found = roles.post_source(spark, d).where("score > 100").select("id")
    return E.ids_not_found(wanted, found)


@query
def inaccessible_update(spark, d):
    wanted = E.ids_to_lookup(live(spark, d)["aggregate_posts"], "posts", comments=stored_comments(spark, d))
    found = roles.post_source(spark, d).where("score > 100").select("id")
    return E.extend_inaccessible(inaccessible_ids(spark, d), E.ids_not_found(wanted, found))


@query
def resolve_versions(spark, d):
    return E.resolve_versions(E.normalise_fields(comment_versions(spark, d), "comments"))


@query
def resolve_versions_without_body(spark, d):
    versions = roles.comment_source(spark, d).select("id", "link_id", "created_utc", "pos")
    return E.resolve_versions(versions)


@query
def relookup_merge(spark, d):
    ids = E.ids_to_lookup(live(spark, d)["aggregate_comments"], "comments", stored_comments(spark, d))
    found = E.lookup(ids, comment_versions(spark, d), "comments")
    return E.merge_lookups(found, stored_comments(spark, d), "comments")


@query
def attach_score(spark, d):
    stored = stored_comments(spark, d).drop("score")
    return E.attach_score(stored, live(spark, d)["aggregate_comments"], "comments")


@query
def enrich_comments(spark, d):
    return live(spark, d)["comments"]


@query
def enrich_posts(spark, d):
    return live(spark, d)["posts"]


@query
def enriched_csv_roundtrip(spark, d):
    path = scratch_path(spark, "comments-csv")
    io.write_enriched_csv(live(spark, d)["comments"], path, "comments")
    return io.read_enriched_csv(spark, path, "comments")


@query
def id_list_roundtrip(spark, d):
    path = scratch_path(spark, "ids")
    io.write_ids(inaccessible_ids(spark, d).unionByName(inaccessible_ids(spark, d)), path)
    return placed(io.read_ids(spark, path).withColumn("_file", F.col("_metadata.file_name")), "_file")


# --- publication and rankings --------------------------------------------------------


@query
def published_comment_blocks(spark, d):
    return live(spark, d)["aggregate_comments"]


@query
def published_post_blocks(spark, d):
    return live(spark, d)["aggregate_posts"]


@query
def published_blocks_keep_all(spark, d):
    return P.read_live(spark, published_keep_all(spark, d))["aggregate_comments"]


@query
def blocks_csv_roundtrip(spark, d):
    """Exported blocks, and whether each follows the row before it in name and time."""
    path = scratch_path(spark, "blocks-csv")
    io.write_blocks_csv(live(spark, d)["aggregate_posts"], path)
    rows = placed(io.read_blocks_csv(spark, path).drop("month").withColumn("_file", F.col("_metadata.file_name")), "_file")
    key = F.struct("subreddit", "last_created_utc")
    return rows.withColumn("in_order", F.coalesce(F.lag(key).over(Window.orderBy("place")) <= key, F.lit(True))).drop("place")


@query
def unique_key_report(spark, d):
    return C.duplicate_keys(roles.comment_items(spark, d), "id")


@query
def constraint_report(spark, d):
    unclean = roles.comment_source(spark, d, text_of="l_partkey").select(
        "id", F.col("text").alias("body"), F.when(F.col("kind") == "item", F.col("created_utc")).alias("created_utc"), "link_id", "score"
    )
    return C.constraint_report({**live(spark, d), "comments": unclean})


@query
def top_comments_by_rate(spark, d):
    t = live(spark, d)
    return placed(R.top_comments(t["aggregate_comments"], t["comments"], t["posts"], COMMUNITY, 2, by="rate"))


@query
def top_comments_by_date(spark, d):
    t = live(spark, d)
    return placed(R.top_comments(t["aggregate_comments"], t["comments"], t["posts"], COMMUNITY, 2, by="date"))


@query
def top_comments_paged(spark, d):
    t = live(spark, d)
    bounds = {"created_before": 960000000, "rate_more": 0.01, "rate_less": 0.9}
    return placed(R.top_comments(t["aggregate_comments"], t["comments"], t["posts"], COMMUNITY, 1, by="date", **bounds))


@query
def top_comments_unlimited(spark, d):
    t = live(spark, d)
    return placed(R.top_comments(t["aggregate_comments"], t["comments"], t["posts"], COMMUNITY, None, by="rate", created_after=880000000))


@query
def top_posts_by_rate(spark, d):
    t = live(spark, d)
    return placed(R.top_posts(t["aggregate_posts"], t["posts"], PRIORITY, 10, by="rate"))


@query
def top_posts_by_date(spark, d):
    t = live(spark, d)
    return placed(R.top_posts(t["aggregate_posts"], t["posts"], PRIORITY, 10, by="date"))


def _sql(spark: SparkSession, d: str, call: str) -> DataFrame:
    P.create_views(spark, published(spark, d))
    R.create_sql_functions(spark)
    return placed(spark.sql(f"SELECT * FROM {call}"))


@query
def top_comments_by_rate_sql(spark, d):
    return _sql(spark, d, f"getCommentUpvoteRemovedRatesByRate('{COMMUNITY}', 2)")


@query
def top_comments_by_date_sql(spark, d):
    return _sql(spark, d, f"getCommentUpvoteRemovedRatesByDate('{COMMUNITY}', 1, created_before => 960000000)")


@query
def top_posts_by_rate_sql(spark, d):
    return _sql(spark, d, f"getPostUpvoteRemovedRatesByRate('{PRIORITY}', 10)")


@query
def top_posts_by_date_sql(spark, d):
    return _sql(spark, d, f"getPostUpvoteRemovedRatesByDate('{PRIORITY}', NULL, rate_more => 0.2D)")
