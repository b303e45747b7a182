"""The batch job: raw dumps -> slim items -> blocks -> merged blocks -> enriched tables.

Every stage writes a table and the next one reads it, so no dump is parsed twice and a
lost executor never costs more than the running stage. A stage writes beside what is there and
switches by one entry in the log of finished work (``sources.runs``), so a job may be stopped
anywhere: the next plain build goes on and gives what an undisturbed one gives.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.blocks import aggregate_blocks
from ..operators.constraints import check_unique
from ..operators.enrich import enrich, extend_inaccessible, stored_versions
from ..operators.ordering import MAX_GROUP_ROWS
from ..operators.slim import broken_files, classify, kept_items, quarantined, rejected_files
from ..schemas import CLASSIFIED, ID_LIST, ITEM_TYPES
from ..sources import tables as io
from ..sources.dumps import broken_ends, broken_inside, decode_lines, judge_files, list_files, mark_broken, read_dumps, readable_files
from ..sources.runs import log_done, next_run, read_done, read_monthly, sweep, write_run
from ..streaming.incremental import pending_months, table_exists
from . import merged as merging
from . import publish as publication


@dataclass(frozen=True)
class Settings:
    """``max_lines`` reads only so many lines of each file; such months are read again once the cap is lifted."""

    n_rows: int = 1000
    min_rows: int = 500
    dropna: bool = True
    max_lines: int = 0
    whole_file: bool = False
    force: bool = False
    strict: bool = False
    update_inaccessible: bool = False
    max_group_rows: int = MAX_GROUP_ROWS

    @property
    def reading(self) -> str:
        return f"lines={self.max_lines} whole_file={self.whole_file}"

    @property
    def blocking(self) -> str:
        return f"rows={self.n_rows} dropna={self.dropna}"

    @property
    def merging(self) -> str:
        return f"{self.blocking} min={self.min_rows}"


# For a sample run into a folder of its own.
TEST_SETTINGS = Settings(n_rows=100, min_rows=50, max_lines=100_000, force=True)


STAGE_TABLES = ("classified", "slim", "quarantine")
# What the log says of an unusable file, after the settings it was read with.
BROKEN, REJECTED = " | broken=", " | rejected"


def _name_unusable(spark: SparkSession, out: str, done: DataFrame) -> None:
    """Name rejected and broken files in their logs; what the log of finished work says is added here, at once or in the next run."""
    for mark, log in ((REJECTED, f"{out}/unusable_files"), (BROKEN, f"{out}/broken_files")):
        # One name per unusable file.
        names = {r.name.rpartition(".")[0] for r in done.where(F.contains("detail", F.lit(mark))).select("name").collect()}
        if names and table_exists(spark, log):
            names -= {r.basename for r in io.read_names(spark, log).collect()}
        if names:
            io.append_names(spark.createDataFrame([(n,) for n in sorted(names)], "basename string"), log)


def ingest(
    spark: SparkSession,
    raw: str,
    out: str,
    manifest: DataFrame | None = None,
    skip: DataFrame | None = None,
    settings: Settings = Settings(),
) -> DataFrame:
    """Stage 1. Returns the judged file list; writes ``slim``, ``classified`` and the file logs.

    A month is read when one of its readable files is new, has another size, or was last
    read with other settings; then all its readable files are read and its rows replaced.
    A file that is damaged or cut short gives no item and costs no other file anything: it
    has status ``broken`` until its size changes, and stands in the log ``broken_files``.
    """
    done = read_done(spark, out, "slim")
    _name_unusable(spark, out, done)
    judged = judge_files(list_files(spark, raw), manifest, skip)
    log = f"{out}/unusable_files"
    if table_exists(spark, log):
        judged = judged.join(io.read_names(spark, log).select(F.col("basename").alias("base")), "base", "left_anti")
    if not settings.force:
        judged = mark_broken(judged, done.where(F.contains("detail", F.lit(BROKEN))))
    readable = readable_files(judged)
    if not settings.force:
        same = done.where(F.substring_index("detail", " | ", 1) == settings.reading).select("type", "month", "name", "size")
        readable = readable.join(pending_months(readable.join(same, ["type", "month", "name", "size"], "left_anti"), None), ["type", "month"], "left_semi")
    # A scan needs its paths; the list has one entry per dump.
    todo = readable.select("type", "month", "path", "name", "size").collect()
    if not todo:
        sweep(spark, out, STAGE_TABLES)
        return judged
    months = sorted({(r.type, r.month) for r in todo})
    known = judged.where("status = 'broken'").select("type", "month", "name", "size").collect()

    run = next_run(spark, out)
    paths = [r.path for r in todo]
    classified = _write_classified(spark, out, paths, run, months, settings)
    write_run(kept_items(classified, settings.strict), f"{out}/slim", run, months)
    write_run(quarantined(classified), f"{out}/quarantine", run, months, rebalance=True)
    # One row per unusable file.
    marks = {r.file.rsplit("/", 1)[-1]: BROKEN + r.reason for r in broken_files(classified).collect()}
    marks |= {r.file.rsplit("/", 1)[-1]: REJECTED for r in rejected_files(classified).collect()}
    entries = [(r.type, r.month, r.name, r.size, settings.reading + marks.get(r.name, "")) for r in todo]
    # Files found broken before stay known when their month is read again without them.
    entries += [(r.type, r.month, r.name, r.size, f"{settings.reading}{BROKEN}before") for r in known if (r.type, r.month) in set(months)]
    log_done(spark, out, "slim", entries, run)
    _name_unusable(spark, out, read_done(spark, out, "slim"))
    sweep(spark, out, STAGE_TABLES)
    return judged


def _write_classified(spark: SparkSession, out: str, paths: list[str], run: int, months: list[tuple[str, str]], settings: Settings) -> DataFrame:
    """Parse the dumps once and write every line with its outcome."""
    broken = {} if settings.max_lines else broken_ends(spark, paths)

    def write() -> None:
        lines = decode_lines(read_dumps(spark, paths, settings.max_lines, broken=broken), settings.whole_file)
        write_run(classify(lines), f"{out}/classified", run, months)

    try:
        write()
    except Exception:
        # The JVM's decoders fail the job on a damaged file; all such files are looked for at once.
        found = broken_inside(spark, [p for p in paths if p not in broken])
        if not found:
            raise
        broken.update(found)
        write()
    return io.read_classified_run(spark, out, run, months)


def _only(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Literal months reach the scan as partition filters."""
    wanted = F.lit(False)
    for item_type in ITEM_TYPES:
        months = [m for t, m in pairs if t == item_type]
        if months:
            wanted |= (F.col("type") == item_type) & F.col("month").isin(months)
    return df.where(wanted)


def read_classified(spark: SparkSession, out: str, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Every parsed line with its outcome; the columns are pruned by whoever reads it."""
    return read_monthly(spark, f"{out}/classified", CLASSIFIED, months=pairs)


def build_blocks(spark: SparkSession, out: str, settings: Settings = Settings()) -> None:
    """Stage 2: blocks of the months that were read after their blocks were made."""
    of_run = F.concat(F.lit(f"{settings.blocking} of="), "run").alias("detail")
    months = read_done(spark, out, "slim").select("type", "month", of_run).distinct()
    if not settings.force:
        months = months.join(read_done(spark, out, "blocks"), ["type", "month", "detail"], "left_anti")
    # At most one entry per dump.
    todo = months.collect()
    pairs = sorted((r.type, r.month) for r in todo)
    if not pairs:
        sweep(spark, out, ("blocks",))
        return
    run = next_run(spark, out)
    slim = _only(io.read_slim(spark, f"{out}/slim"), pairs)
    blocks = aggregate_blocks(slim, settings.n_rows, settings.dropna, settings.max_group_rows)
    write_run(blocks, f"{out}/blocks", run, pairs, rebalance=True)
    log_done(spark, out, "blocks", [(r.type, r.month, None, None, r.detail) for r in todo], run)
    sweep(spark, out, ("blocks",))


def build_merged(spark: SparkSession, out: str, settings: Settings = Settings()) -> DataFrame:
    """Stage 3: one block table per type over all months; only new months are read where that is enough."""
    return merging.update(spark, out, settings.merging, settings.min_rows, settings.n_rows, settings.max_group_rows, settings.force)


def stored_inaccessible(spark: SparkSession, out: str, version: int | None) -> dict[str, DataFrame]:
    """The lists of ids without text that earlier builds stored."""
    paths = {t: f"{out}/inaccessible/version={version}/{t}" for t in ITEM_TYPES}
    return {t: io.read_ids(spark, p) for t, p in paths.items() if version is not None and table_exists(spark, p)}


def build_tables(
    spark: SparkSession,
    out: str,
    classified: DataFrame,
    live: dict[str, DataFrame] | None = None,
    inaccessible: dict[str, DataFrame] | None = None,
    settings: Settings = Settings(),
    version: int = 1,
    fresh: list[tuple[str, str]] | None = None,
) -> dict[str, DataFrame]:
    """Stage 4: enrich the top items from the classified lines and stage all four tables.

    Comments come before posts, because posts also need the comments' parents. ``fresh``
    names the months read since the live tables were made: texts are looked up there, and
    in older months only for ids that no earlier build asked for.
    """
    merged = merging.read_merged(spark, out)
    inaccessible = inaccessible or {}
    tables: dict[str, DataFrame] = {}
    for item_type in ITEM_TYPES:
        blocks = merged.where(F.col("type") == item_type).drop("type")
        # Blocks without a removed item have no top id.
        named = blocks.where("id_of_max_pos_removed_item <> ''")
        check_unique(named, "id_of_max_pos_removed_item", f"{item_type} blocks")
        known = inaccessible.get(item_type, spark.createDataFrame([], ID_LIST))
        recent, older = classified, None
        if live is not None and fresh is not None:
            recent = _only(classified, fresh)
            asked = live[f"aggregate_{item_type}"].select(F.col("id_of_max_pos_removed_item").alias("id"))
            if item_type == "posts":
                asked = asked.unionByName(live["comments"].select(F.col("link_id").alias("id")))
            older = stored_versions(classified, item_type), asked
        rows, missing = enrich(
            blocks,
            stored_versions(recent, item_type),
            item_type,
            existing=None if live is None else live[item_type],
            inaccessible=known,
            comments=tables.get("comments"),
            older=older,
        )
        path = f"{out}/enriched/version={version}/{item_type}"
        rows.write.mode("overwrite").parquet(path)
        tables[item_type] = spark.read.parquet(path)
        tables[f"aggregate_{item_type}"] = blocks
        # The list is kept for the next build, which does not look these ids up again.
        listed = extend_inaccessible(known, missing) if settings.update_inaccessible else known
        io.write_ids(listed, f"{out}/inaccessible/version={version}/{item_type}")
    publication.stage(tables, f"{out}/tables", version)
    return publication.read_version(spark, f"{out}/tables", version)


def build(
    spark: SparkSession,
    raw: str,
    out: str,
    manifest: DataFrame | None = None,
    skip: DataFrame | None = None,
    inaccessible: dict[str, DataFrame] | None = None,
    settings: Settings = Settings(),
) -> dict[str, DataFrame]:
    """All stages, then publication. Returns the live tables."""
    ingest(spark, raw, out, manifest, skip, settings)
    build_blocks(spark, out, settings)
    build_merged(spark, out, settings)
    base = f"{out}/tables"
    previous = publication.live_version(spark, base)
    live = None if previous is None else publication.read_version(spark, base, previous)
    version = 1 if previous is None else previous + 1
    inaccessible = {**stored_inaccessible(spark, out, previous), **(inaccessible or {})}
    months = read_done(spark, out, "slim").select("type", "month", "run").distinct()
    last = read_done(spark, out, "published").agg(F.max("run")).first()[0]
    fresh = None if previous is None or last is None or settings.force else [(r.type, r.month) for r in months.where(F.col("run") > last).collect()]
    build_tables(spark, out, read_classified(spark, out), live, inaccessible, settings, version, fresh)
    publication.publish(spark, base, version)
    log_done(spark, out, "published", [("all", "all", None, None, f"version={version}")])
    return publication.read_live(spark, base)
