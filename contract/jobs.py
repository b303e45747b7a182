"""Registered queries of the batch job itself: broken archives, parts of files, stopped jobs, incremental merges."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modtally.operators import blocks as B
from modtally.plans import build
from modtally.session import scratch_path
from modtally.sources import runs
from modtally.sources import tables as io
from modtally.sources.dumps import read_dumps
from modtally.sources.tables import read_names

from . import roles
from .queries import _SLIM, POST_MIN, POST_ROWS, query, scanned
from .roles import once

POST_SETTINGS = build.Settings(n_rows=POST_ROWS, min_rows=POST_MIN)

# Which months' dumps are cut short, and which have a changed byte in the middle.
CUT, CHANGED = 3, 5


def write_dumps(spark: SparkSession, lines: DataFrame, frames: int = 0, faults: bool = False) -> str:
    """Raw lines as one dump per file name, in four codecs by month; ``frames``: bytes of text per frame or block.

    ``faults`` damages some: every third month is cut short, every fifth of the others changed.
    """
    folder = scratch_path(spark, "raw")

    def pack(data: bytes, extension: str) -> bytes:
        import bz2
        import gzip
        import lzma

        import zstandard

        packer = {
            ".zst": zstandard.ZstdCompressor(write_checksum=True).compress,
            ".xz": lambda d: lzma.compress(d, preset=0),
            ".gz": gzip.compress,
            ".bz2": bz2.compress,
        }[extension]
        size = frames or max(len(data), 1)
        return b"".join(packer(data[low : low + size]) for low in range(0, max(len(data), 1), size))

    def write(file: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(re.sub("^(file:)?/+", "file:///", folder))
        system.create_dir(base)
        name = file["file"].iloc[0]
        month = int(re.search(r"-(\d\d)", name)[1])
        extension = (".zst", ".xz", ".gz", ".bz2")[month % 4] if faults else ".zst" if month % 2 else ".xz"
        data = pack("".join(v + "\n" for v in file.sort_values("value")["value"]).encode(), extension)
        if faults and month % CUT == 0:
            data = data[: 2 * len(data) // 3]
        elif faults and month % CHANGED == 0:
            half = len(data) // 2
            data = data[:half] + bytes([data[half] ^ 0x55]) + data[half + 1 :]
        with system.open_output_stream(f"{base}/{name.split('.')[0]}{extension}", compression=None) as out:
            out.write(data)
        return pd.DataFrame({"name": [name]})

    # One group per dump, as large as its compressed file.
    lines.select("file", "value").groupBy("file").applyInPandas(write, "name string").count()
    return folder


@once
def post_dumps(spark: SparkSession, d: str) -> str:
    return write_dumps(spark, roles.post_lines(spark, d))


@query
def broken_dump_files(spark, d):
    """Monthly dumps in four codecs, some cut short or changed: each costs its own items only, and is read no second time."""
    raw, out = write_dumps(spark, roles.post_lines(spark, d), faults=True), scratch_path(spark, "broken")
    build.ingest(spark, raw, out)
    status = build.ingest(spark, raw, out).select("base", "status")
    logged = read_names(spark, f"{out}/broken_files").groupBy(F.col("basename").alias("base")).agg(F.count("*").alias("logged"))
    items = io.read_slim(spark, f"{out}/slim").groupBy(F.concat(F.lit("RS_"), "month").alias("base")).agg(F.count("*").alias("items"))
    filled = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return status.join(items, "base", "left").join(logged, "base", "left").select("base", "status", filled("items"), filled("logged"))


@query
def scan_frames(spark, d):
    """Dumps of many zst frames and xz blocks, cut anywhere in a line and read in parts."""
    raw = write_dumps(spark, roles.post_lines(spark, d), frames=5_000)
    lines = read_dumps(spark, [raw], part_bytes=2_000)
    return scanned(lines).select("month", *_SLIM)


class Stopped(Exception):
    pass


@contextmanager
def stopped_at(name: str, after: int):
    """Let ``build.<name>`` work ``after`` times, then stop the job there."""
    real, calls = getattr(build, name), [0]

    def limited(*args, **kw):
        if calls[0] == after:
            raise Stopped(name)
        calls[0] += 1
        return real(*args, **kw)

    setattr(build, name, limited)
    try:
        yield
    except Stopped:
        pass
    finally:
        setattr(build, name, real)


@query
def stopped_and_resumed(spark, d):
    """A job over capped months is run again without the cap, and stopped at three places before it may finish."""
    raw, out = post_dumps(spark, d), scratch_path(spark, "stopped")
    build.ingest(spark, raw, out, settings=build.Settings(n_rows=POST_ROWS, min_rows=POST_MIN, max_lines=3))
    build.build_blocks(spark, out, POST_SETTINGS)
    for name, after in (("write_run", 1), ("log_done", 0)):
        with stopped_at(name, after):
            build.ingest(spark, raw, out, settings=POST_SETTINGS)
    build.ingest(spark, raw, out, settings=POST_SETTINGS)
    with stopped_at("log_done", 0):
        build.build_blocks(spark, out, POST_SETTINGS)
    build.build_blocks(spark, out, POST_SETTINGS)
    return io.read_blocks(spark, f"{out}/blocks", "posts")


def _add_blocks(spark: SparkSession, out: str, blocks: DataFrame) -> None:
    """Blocks of some months, as the second stage leaves them."""
    # One entry per month.
    months = sorted((r.type, r.month) for r in blocks.select("type", "month").distinct().collect())
    run = runs.next_run(spark, out)
    runs.write_run(blocks, f"{out}/blocks", run, months, rebalance=True)
    runs.log_done(spark, out, "blocks", [(*m, None, None, f"of={run}") for m in months], run)


def _post_blocks(spark: SparkSession, d: str) -> DataFrame:
    return B.aggregate_blocks(roles.post_items(spark, d), POST_ROWS)


@query
def merge_incremental(spark, d):
    """Three updates, each with later months; the last one reads no block of the earlier ones."""
    out, blocks = scratch_path(spark, "merge"), _post_blocks(spark, d)
    for low, high in (("", "1994-06"), ("1994-06", "1996-11"), ("1996-11", "9")):
        _add_blocks(spark, out, blocks.where((F.col("month") >= low) & (F.col("month") < high)))
        build.build_merged(spark, out, POST_SETTINGS)
    return build.build_merged(spark, out, POST_SETTINGS)


@query
def merge_replaced_month(spark, d):
    """A month of half its items is replaced by the whole one, and a month between others comes late."""
    out, blocks, items = scratch_path(spark, "merge"), _post_blocks(spark, d), roles.post_items(spark, d)
    half = B.aggregate_blocks(items.where("month = '1995-03' AND score % 2 = 0"), POST_ROWS)
    _add_blocks(spark, out, blocks.where("month NOT IN ('1995-03', '1996-02')").unionByName(half))
    build.build_merged(spark, out, POST_SETTINGS)
    for month in ("1996-02", "1995-03"):
        _add_blocks(spark, out, blocks.where(F.col("month") == month))
        build.build_merged(spark, out, POST_SETTINGS)
    return build.build_merged(spark, out, POST_SETTINGS)
