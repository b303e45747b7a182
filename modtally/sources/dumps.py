"""Finding, checking and scanning raw dumps."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import with_name_parts
from ..functions.names import EXTENSIONS, file_name
from .archives import ends_whole, extension, fault, fewer_parts, parts_of
from .lines import DumpLines
from .manifest import parent_sizes

# Codecs the JVM text reader handles itself. A bz2 file is even split into blocks.
JVM_EXTENSIONS = (".gz", ".bz2")

# Positions that count as one chunk of a file.
CHUNK_LINES = 1 << 16

# Every part is a task: parts smaller than those of ``spark.sql.files.maxPartitionBytes`` are so many a core at most.
PARTS_PER_CORE = 32


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, name, size, modified`` plus the name parts. File contents are not read."""
    listed = (
        spark.read.format("binaryFile")
        .load(root)
        .select("path", file_name(F.col("path")).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )
    return with_name_parts(listed)


def judge_files(files: DataFrame, manifest: DataFrame | None = None, skip: DataFrame | None = None) -> DataFrame:
    """Add ``status`` to a file list (``name, size`` and name parts).

    ``ready``          read it
    ``daily``          part of a month; see ``complete_months``
    ``skipped``        its base name is on a skip list
    ``size_mismatch``  neither the listed size nor the sum of its listed parts
    ``unsupported``    no dump extension

    ``mark_broken`` adds ``broken``: read before, and damaged or cut short.

    A file that the manifest does not list is ready. ``month_days`` counts the days that the
    manifest lists for the file's month.
    """
    judged = files
    if manifest is None:
        judged = judged.withColumn("month_days", F.lit(None).cast("long"))
    else:
        days = with_name_parts(manifest.select("name").distinct()).where(F.col("is_daily") & F.col("ext").isin(*EXTENSIONS))
        days = days.groupBy("type", "month").agg(F.count_distinct("base").alias("month_days"))
        judged = judged.join(days, ["type", "month"], "left").select(*files.columns, "month_days")
    if skip is None:
        judged = judged.withColumn("_skip", F.lit(False))
    else:
        names = skip.select(F.col(skip.columns[0]).alias("base"), F.lit(True).alias("_skip")).distinct()
        judged = judged.join(names, "base", "left")
    if manifest is None:
        judged = judged.withColumns({"listed_size": F.lit(None).cast("long"), "parts_size": F.lit(None).cast("long")})
    else:
        listed = manifest.groupBy(F.col("name").alias("_listed")).agg(F.max("size").alias("listed_size"))
        judged = judged.join(listed, F.concat("base", "ext") == F.col("_listed"), "left").drop("_listed")
        judged = judged.join(parent_sizes(manifest), "base", "left")
    mismatch = (
        (F.coalesce("listed_size", F.lit(0)) != 0)
        & (F.col("listed_size") != F.col("size"))
        & (F.coalesce("parts_size", F.lit(0)) != F.col("size"))
    )
    return judged.withColumn(
        "status",
        F.when(~F.col("ext").isin(*EXTENSIONS), "unsupported")
        .when(F.col("is_daily"), "daily")
        .when(F.coalesce("_skip", F.lit(False)), "skipped")
        .when(mismatch, "size_mismatch")
        .otherwise("ready"),
    ).drop("_skip")


def mark_broken(judged: DataFrame, broken: DataFrame) -> DataFrame:
    """Status ``broken`` for files of a given ``name, size``; a file of another size is a new one."""
    known = broken.select("name", "size", F.lit(True).alias("_broken")).distinct()
    return (
        judged.join(known, ["name", "size"], "left")
        .withColumn("status", F.when(F.coalesce("_broken", F.lit(False)) & F.col("status").isin("ready", "daily"), "broken").otherwise(F.col("status")))
        .select(judged.columns)
    )


def complete_months(judged: DataFrame) -> DataFrame:
    """Months that exist only as daily files: ``type, month, num_days, complete``.

    A month is complete when every day that the manifest lists is there and the manifest
    confirms the size of every daily file. Until then it waits for its other days.
    """
    confirmed = F.coalesce(F.col("listed_size") == F.col("size"), F.lit(False))
    daily = judged.where("status = 'daily'").groupBy("type", "month").agg(
        F.count("*").alias("num_days"),
        (F.bool_and(confirmed) & (F.count_distinct("base") == F.coalesce(F.max("month_days"), F.lit(0)))).alias("complete"),
    )
    monthly = judged.where("status <> 'daily' AND status <> 'unsupported'").select("type", "month").distinct()
    return daily.join(monthly, ["type", "month"], "left_anti")


def readable_files(judged: DataFrame) -> DataFrame:
    """The files to scan: ready ones, and the daily files of complete months."""
    months = complete_months(judged).where("complete").select("type", "month")
    daily = judged.where("status = 'daily'").join(months, ["type", "month"], "left_semi")
    return judged.where("status = 'ready'").unionByName(daily)


def _native(path: str) -> bool:
    """Whether the JVM decodes it. Hadoop knows its codecs by lowercase extensions."""
    return extension(path) in JVM_EXTENSIONS and path.endswith(extension(path))


def read_dumps(
    spark: SparkSession,
    paths: Sequence[str],
    max_lines: int = 0,
    spread: int | None = None,
    part_bytes: int | None = None,
    broken: dict[str, str] | None = None,
) -> DataFrame:
    """Lines of compressed dumps: ``value, file, type, month, pos, error``; blank lines left out.

    ``paths`` may hold patterns and folders; a path that matches no file is an error.
    ``pos`` orders lines within a month: by period, then file name, then place in the file.
    It is taken before any shuffle. ``max_lines`` reads only the first lines of each file
    (0 = all). ``spread`` deals the lines of files that cannot be split over that many
    partitions, so that parsing and writing use all cores; by default over the cores that
    such files leave idle, and 0 leaves the lines where they are.

    Files of several zst frames or xz blocks are read in parts of ``part_bytes`` compressed
    bytes or more, by default those of ``spark.sql.files.maxPartitionBytes``; small ones are
    joined where they are more than ``PARTS_PER_CORE``. The cuts are found in headers, one task a file. A zst or xz file that is damaged or ends too early has
    a row without a value that names the ``error``. ``broken`` (path to reason) names files
    known to be so: they are not opened and have that row only.
    """
    by_ext = lambda p: p[p.rfind(".") :].lower()
    named = [p for p in paths if re.search(r"\.[A-Za-z]\w{1,4}$", p)]
    files = find_files(spark, paths) if all(by_ext(p) in EXTENSIONS for p in named) else []
    bad = [p for p in (*named, *(f.path for f in files)) if by_ext(p) not in EXTENSIONS]
    if bad:
        raise ValueError(f"not dumps: {bad}")
    broken = broken or {}
    native = [f.path for f in files if _native(f.path) and f.path not in broken]
    custom = [f.path for f in files if not _native(f.path) and f.path not in broken]
    # With a cap only the first lines are decoded, so a file stays one part.
    cuts = [(p, 0, -1) for p in custom] if max_lines else find_parts(spark, custom, part_bytes)
    cores = spark.sparkContext.defaultParallelism
    if spread is None:
        spread = cores if len(cuts) + sum(not p.endswith(".bz2") for p in native) in range(1, cores) else 0
    parts = []
    none = F.lit(None).cast("string").alias("error")
    if native:
        text = spark.read.option("lineSep", "\n").text(native)
        parts.append(
            text.select(
                "value",
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_name").alias("_name"),
                F.col("_metadata.file_block_start").alias("_start"),
                F.monotonically_increasing_id().alias("_line"),
                none,
            ).where(F.col("value").rlike(r"\S"))
        )
        if max_lines:
            # Decoded by the JVM all the same; the cut follows from counts of lines.
            parts = [cap_lines(parts[0], max_lines, F.col("_start"), F.col("_line"))]
    if custom:
        spark.dataSource.register(DumpLines)
        lines = spark.read.format("dump_lines").option("parts", json.dumps(cuts)).option("max_lines", str(max_lines)).load()
        parts.append(
            lines.select(
                F.col("value").cast("string").alias("value"),
                F.col("path").alias("file"),
                F.col("name").alias("_name"),
                F.col("start").alias("_start"),
                F.col("line").alias("_line"),
                "error",
            )
        )
    if broken:
        # One row per broken file.
        rows = [(None, f.path, f.name, 0, 0, broken[f.path]) for f in files if f.path in broken]
        parts.append(spark.createDataFrame(rows, "value string, file string, _name string, _start long, _line long, error string"))
    if not parts:
        return spark.createDataFrame(
            [], "value string, file string, type string, month string, pos struct<period:string,name:string,start:bigint,line:bigint>, error string"
        )
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    # Name parts are worked out once per file, not per line; one row per file.
    names = spark.createDataFrame([(f.name,) for f in files], "_name string").distinct()
    parsed = with_name_parts(names, "_name").select("_name", "type", "month", "period")
    unknown = F.raise_error(F.concat(F.lit("no name parts for "), "file"))
    placed = lines.join(F.broadcast(parsed), "_name", "left").select(
        "value",
        "file",
        F.when(F.col("type").isNull(), unknown).otherwise(F.col("type")).alias("type"),
        "month",
        F.struct(F.col("period"), F.col("_name").alias("name"), F.col("_start").alias("start"), F.col("_line").alias("line")).alias("pos"),
        "error",
    )
    return placed.repartition(spread) if spread else placed


def _per_file(spark: SparkSession, paths: Sequence[str], work, schema: str) -> DataFrame:
    """``work`` on every path, a task each: ``work(path)`` gives rows."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string")

    def run(batches):
        for batch in batches:
            rows = [row for path in batch["path"] for row in work(path)]
            yield pd.DataFrame(rows, columns=names)

    names = [f.split(" ")[0] for f in schema.split(", ")]
    return listed.repartition(len(paths)).mapInPandas(run, schema)


def find_parts(spark: SparkSession, paths: Sequence[str], part_bytes: int | None = None) -> list[tuple[str, int, int]]:
    """``path, start, end`` of the parts that files are read in; one entry per ``part_bytes`` of a file at most.

    Parts are joined where all files together have more than ``PARTS_PER_CORE`` a core, up to
    ``spark.sql.files.maxPartitionBytes`` each, so that tasks do not grow in number with the files.
    """
    usual = int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b"))
    least = part_bytes or usual
    if not paths:
        return []
    sizes = {r.path: r.length for r in spark.read.format("binaryFile").load(list(paths)).select("path", "length").collect()}
    small = [(p, 0, -1) for p in sorted(sizes) if sizes[p] < 2 * least]
    large = [p for p in sorted(sizes) if sizes[p] >= 2 * least]
    if not large:
        return small
    cut, join = parts_of, fewer_parts
    tasks = PARTS_PER_CORE * spark.sparkContext.defaultParallelism
    # A file's share of the tasks.
    most = {p: math.ceil(max(tasks * sizes[p] / sum(sizes.values()), sizes[p] / usual)) for p in large}
    cuts = _per_file(spark, large, lambda path: [(path, *c) for c in join(cut(path, sizes[path], least), most[path])], "path string, start long, end long")
    return small + sorted(tuple(r) for r in cuts.collect())


def broken_ends(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Files for the JVM's decoders that these would take for short or empty ones, by their first and last bytes."""
    check = ends_whole
    native = [p for p in paths if _native(p)]
    return _faults(spark, native, check) if native else {}


def broken_inside(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """The same by decoding whole files, for use after the JVM has failed on one of them."""
    check = fault
    native = [p for p in paths if _native(p)]
    return _faults(spark, native, check) if native else {}


def _faults(spark: SparkSession, paths: list[str], check) -> dict[str, str]:
    found = _per_file(spark, paths, lambda path: [(path, reason)] if (reason := check(path)) else [], "path string, reason string")
    # One row per broken file.
    return {r.path: r.reason for r in found.collect()}


def find_files(spark: SparkSession, paths: Sequence[str]) -> list[Row]:
    """``path, name`` of every file behind paths, folders and patterns; one entry per dump. File contents are not read."""
    if not paths:
        return []
    listed = spark.read.format("binaryFile").load(list(paths)).select("path", F.col("_metadata.file_name").alias("name"))
    return sorted(set(listed.collect()))


def cap_lines(lines: DataFrame, max_lines: int, start: Column | None = None, line: Column | None = None) -> DataFrame:
    """The first ``max_lines`` lines of each file of an already scanned table (0 = all).

    A line's place is ``start`` (of its part of the file) and ``line``, by default those of ``pos``.

    Lines are counted in chunks of a fixed number of positions; a running sum over the
    chunk counts tells which chunks are needed, and only lines inside one chunk are ranked.
    So no task ever sorts a whole file.
    """
    if not max_lines:
        return lines
    start, line = F.col("pos.start") if start is None else start, F.col("pos.line") if line is None else line
    placed = lines.withColumns({"_at": start, "_in": line}).withColumn("_chunk", F.expr(f"_in div {CHUNK_LINES}"))
    chunk = ["file", "_at", "_chunk"]
    in_file = Window.partitionBy("file").orderBy("_at", "_chunk")
    needed = (
        placed.groupBy(*chunk)
        .count()
        .withColumn("_before", F.sum("count").over(in_file) - F.col("count"))
        .where(F.col("_before") < max_lines)
        .drop("count")
    )
    rank = F.row_number().over(Window.partitionBy(*chunk).orderBy("_in"))
    return (
        placed.join(needed, chunk)
        .withColumn("_rank", F.col("_before") + rank)
        .where(F.col("_rank") <= max_lines)
        .select(*lines.columns)
    )


def decode_lines(lines: DataFrame, whole_file: bool = False) -> DataFrame:
    """Turn raw lines into text: UTF-8, with ISO-8859-1 as the fallback.

    The fallback is chosen per line. ``whole_file=True`` applies it to every line of a
    file that has at least one invalid line, at the price of a second scan.
    """
    raw = F.col("value")
    latin = F.decode(raw.cast("binary"), "ISO-8859-1")
    if not whole_file:
        return lines.withColumn("value", F.when(F.is_valid_utf8(raw), raw).otherwise(latin))
    flags = lines.groupBy("file").agg(F.bool_and(F.is_valid_utf8(raw)).alias("_valid"))
    # One row per dump file, so the flags always fit every executor.
    return lines.join(F.broadcast(flags), "file").withColumn("value", F.when(F.col("_valid"), raw).otherwise(latin)).drop("_valid")
