"""Merged blocks kept up to date month by month.

A short block merges into the full block right before it, so of all earlier months only a
community's last block can still change. Each update therefore writes two tables under its run:
the merged rows of the communities it touched, and the state of every community: the order key of
its last block, and that block itself while it is full and may still take in a short one
(``open``). The next update reads the new months and the open blocks of their communities. The
table is the rows that are not open of all updates since the last full merge, and the open blocks
of the newest state.

All months are merged anew where that does not hold: a month that was merged before has other
blocks, other settings, or a new month whose blocks do not all follow what its communities have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import id_to_int
from ..operators.merge import merge_rows
from ..schemas import BLOCK_COLUMNS, BLOCKS
from ..session import remove
from ..sources import tables as io
from ..sources.runs import current_runs, log_done, next_run, read_done

_KEY = ("type", "subreddit")
_FIELDS = [c for c in BLOCK_COLUMNS if c != "subreddit"]
_PLACE = ("_time", "_month", "_id")
_TEXT, _LONG = T.StringType(), T.LongType()
_WHERE = T.StructType([T.StructField(n, t) for n, t in zip((*_KEY, *_PLACE), (_TEXT, _TEXT, _LONG, _TEXT, _LONG), strict=True)])
_BLOCK = [f for f in BLOCKS.fields if f.name != "subreddit"]
ROWS = T.StructType([*_WHERE.fields, *_BLOCK, T.StructField("_last", T.BooleanType()), T.StructField("_open", T.BooleanType())])
STATE = T.StructType([*_WHERE.fields, T.StructField("open", T.StructType(_BLOCK))])


def _rows_path(out: str, run: int) -> str:
    return f"{out}/merged/rows/run={run}"


def _state_path(out: str, run: int) -> str:
    return f"{out}/merged/state/run={run}"


def _runs(spark: SparkSession, out: str) -> list[int]:
    """The full merge that counts and the updates after it; one entry per update."""
    return sorted(r.run for r in read_done(spark, out, "merged").select("run").distinct().collect())


def read_merged(spark: SparkSession, out: str) -> DataFrame:
    """``type`` and the block columns of all merged rows."""
    runs = _runs(spark, out)
    if not runs:
        raise ValueError(f"nothing is merged under {out}")
    every = spark.read.schema(T.StructType([*ROWS.fields, T.StructField("run", _LONG)])).parquet(f"{out}/merged/rows")
    closed = every.where(F.col("run").isin(runs) & ~F.col("_open")).select("type", F.lower("subreddit").alias("subreddit"), *_FIELDS)
    still_open = spark.read.schema(STATE).parquet(_state_path(out, runs[-1])).where("open is not null")
    return closed.unionByName(still_open.select("type", F.lower("subreddit").alias("subreddit"), *(F.col(f"open.{c}").alias(c) for c in _FIELDS)))


def _state(rows: DataFrame) -> DataFrame:
    block = F.when(F.col("_open"), F.struct(*_FIELDS))
    return rows.where("_last").select(*_WHERE.fieldNames(), block.alias("open"))


def _follows(fresh: DataFrame, state: DataFrame) -> bool:
    """Whether every new block comes after all its community has."""
    own = F.struct(F.col("last_created_utc").alias("_time"), F.col("month").alias("_month"), id_to_int(F.col("last_id")).alias("_id"))
    first = fresh.groupBy(*_KEY).agg(F.min(own).alias("_first"))
    known = state.select(*_KEY, F.struct(*_PLACE).alias("_known"))
    return first.join(known, list(_KEY)).where(F.col("_first") <= F.col("_known")).isEmpty()


def update(spark: SparkSession, out: str, detail: str, min_rows: int, n_rows: int, max_group_rows: int | None, force: bool = False) -> DataFrame:
    """Bring the merged table up to the newest blocks. ``detail`` names the settings."""
    blocks = current_runs(spark, out, "blocks")
    wanted = {m: f"{detail} of={r}" for m, r in blocks.items()} or {("all", "all"): f"{detail} of=0"}
    have = {(r.type, r.month): r.detail for r in read_done(spark, out, "merged").collect()}
    changed = [m for m in have if wanted.get(m) != have[m]]
    new = sorted(m for m in wanted if m not in have)
    if not (force or changed or new):
        _sweep(spark, out)
        return read_merged(spark, out)
    last = _runs(spark, out)
    run = next_run(spark, out)
    path = f"{out}/blocks"
    fresh = None
    if last and not (force or changed):
        fresh = io.read_block_months(spark, path, new)
        state = spark.read.schema(STATE).parquet(_state_path(out, last[-1]))
        if not _follows(fresh, state):
            fresh = None
    if fresh is None:
        rows = _write_rows(merge_rows(io.read_blocks(spark, path), min_rows, n_rows, max_group_rows), out, run)
        _state(rows).write.mode("overwrite").parquet(_state_path(out, run))
        logged = sorted(wanted)
    else:
        touched = fresh.select(*_KEY).distinct()
        waiting = state.where("open is not null").join(touched, list(_KEY), "left_semi")
        carried = waiting.select(*_KEY, F.col("_month").alias("month"), *(F.col(f"open.{c}").alias(c) for c in _FIELDS))
        rows = _write_rows(merge_rows(fresh.unionByName(carried.select(fresh.columns)), min_rows, n_rows, max_group_rows), out, run)
        untouched = state.join(touched, list(_KEY), "left_anti").select(state.columns)
        untouched.unionByName(_state(rows)).write.mode("overwrite").parquet(_state_path(out, run))
        logged = new
    log_done(spark, out, "merged", [(*m, None, None, wanted[m]) for m in logged], run)
    _sweep(spark, out)
    return read_merged(spark, out)


def _write_rows(rows: DataFrame, out: str, run: int) -> DataFrame:
    path = _rows_path(out, run)
    rows.write.mode("overwrite").partitionBy("type").parquet(path)
    spark = rows.sparkSession
    return spark.read.schema(ROWS).parquet(path)


def _sweep(spark: SparkSession, out: str) -> None:
    """Delete rows of updates before the last full merge, states but the newest, and what stopped updates left."""
    runs = _runs(spark, out)
    kept = {_rows_path("", r) for r in runs} | {_state_path("", runs[-1])}
    for part in ("rows", "state"):
        pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/merged/{part}/run=*")
        for status in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or ():
            path = status.getPath().toString()
            if "/" + "/".join(path.rsplit("/", 3)[1:]) not in kept:
                remove(spark, path)
