"""Monthly tables whose months are replaced in one step, and the log that makes the switch.

A run writes the months it processed into folders of its own, ``type=/month=/run=``, and touches
nothing that is there. One committed append to the log of finished work then names the run that
counts for each month, also where it has no rows. Readers take the runs from the log, so a job that
is stopped anywhere leaves the old rows of a month or the new ones, never a part of either; what it
left behind is not read, and is deleted by the next run that finishes.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DONE
from ..session import remove
from ..streaming.incremental import table_exists

# Which stage's log entries name the runs of a table.
STAGE_OF = {"classified": "slim", "slim": "slim", "quarantine": "slim", "blocks": "blocks"}

Month = tuple[str, str]


def _entries(spark: SparkSession, out: str) -> list[Row]:
    """The log of finished work: a few short rows per dump, so small however large the data are."""
    path = f"{out}/done"
    return spark.read.schema(DONE).parquet(path).collect() if table_exists(spark, path) else []


def _newest(entries: list[Row], stage: str) -> list[Row]:
    entries = [e for e in entries if e.stage == stage]
    last: dict[Month, int] = {}
    for e in entries:
        last[e.type, e.month] = max(e.run, last.get((e.type, e.month), 0))
    return [e for e in entries if e.run == last[e.type, e.month]]


def read_done(spark: SparkSession, out: str, stage: str) -> DataFrame:
    """Newest entries of a stage in the log of finished work: a row per file, or per month.

    A month's entries of one run replace those of earlier runs.
    """
    return spark.createDataFrame(_newest(_entries(spark, out), stage), DONE).drop("stage")


def next_run(spark: SparkSession, out: str) -> int:
    return max((e.run for e in _entries(spark, out)), default=0) + 1


def log_done(spark: SparkSession, out: str, stage: str, rows: list[tuple], run: int | None = None) -> None:
    """The switch: rows ``type, month, name, size, detail`` under a run number, in one file that is there or not."""
    run = next_run(spark, out) if run is None else run
    spark.createDataFrame([(stage, *r, run) for r in rows], DONE).coalesce(1).write.mode("append").parquet(f"{out}/done")


def current_runs(spark: SparkSession, out: str, stage: str) -> dict[Month, int]:
    """The run that counts, per month; one entry per month, so it always fits the driver."""
    return {(e.type, e.month): e.run for e in _newest(_entries(spark, out), stage)}


def _folder(path: str, month: Month, run: int) -> str:
    return f"{path}/type={month[0]}/month={month[1]}/run={run}"


def write_run(df: DataFrame, path: str, run: int, months: Iterable[Month], rebalance: bool = False) -> None:
    """Parquet of one run by type and month; not read before the log names the run.

    ``rebalance`` is for tables shuffled by another key: it gathers each month into few
    files of even size, splitting a large month and joining small ones.
    """
    # A stopped run had the same number if it never reached the log.
    for month in months:
        remove(df.sparkSession, _folder(path, month, run))
    if rebalance:
        df = df.hint("rebalance", "type", "month")
    placed = df.withColumn("run", F.lit(run).cast("long"))
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("type", "month", "run").parquet(path)


def read_runs(spark: SparkSession, path: str, schema: T.StructType, runs: dict[Month, int]) -> DataFrame:
    """The rows of the given runs. Literal months and runs reach the scan as a partition filter."""
    if not runs or not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    names = [f"{t}/{m}/{r}" for (t, m), r in runs.items()]
    table = spark.read.schema(T.StructType([*schema.fields, T.StructField("run", T.LongType())])).parquet(path)
    return table.where(F.concat_ws("/", "type", "month", "run").isin(names)).select(*schema.fieldNames())


def read_monthly(spark: SparkSession, path: str, schema: T.StructType, item_type: str | None = None, months: Iterable[Month] | None = None) -> DataFrame:
    """A monthly table: the runs its log names, or all rows of a table that was written without runs."""
    out, _, name = path.rpartition("/")
    if name in STAGE_OF and table_exists(spark, f"{out}/done"):
        runs = current_runs(spark, out, STAGE_OF[name])
        if months is not None:
            runs = {m: runs[m] for m in months if m in runs}
        if item_type is not None:
            runs = {m: r for m, r in runs.items() if m[0] == item_type}
        return read_runs(spark, path, schema, runs)
    df = spark.read.schema(schema).parquet(path)
    return df if item_type is None else df.where(F.col("type") == item_type)


def leftovers(spark: SparkSession, path: str, runs: dict[Month, int]) -> list[str]:
    """Run folders of a table that its log does not name: replaced months and stopped runs."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/type=*/month=*/run=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    kept = {_folder("", month, run) for month, run in runs.items()}
    # One entry per month and run.
    paths = [status.getPath().toString() for status in found or ()]
    return sorted(p for p in paths if "/" + "/".join(p.rsplit("/", 3)[1:]) not in kept)


def sweep(spark: SparkSession, out: str, tables: Iterable[str]) -> None:
    """Delete what no log entry names."""
    runs: dict[str, dict[Month, int]] = {}
    for name in tables:
        stage = STAGE_OF[name]
        runs[stage] = runs[stage] if stage in runs else current_runs(spark, out, stage)
        for folder in leftovers(spark, f"{out}/{name}", runs[stage]):
            remove(spark, folder)
