"""A job stopped at any write or deletion leaves nothing that the next plain run does not put right."""

import random
from contextlib import contextmanager
from unittest.mock import patch

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from modtally.operators.merge import merge_short_tails
from modtally.plans import build as B
from modtally.plans import merged as M
from modtally.schemas import BLOCKS_BY_MONTH
from modtally.sources import runs
from modtally.sources import tables as io
from test_batch_job import comment, dump, post
from test_blocks import base36

SETTINGS = B.Settings(n_rows=5, min_rows=3)


class Stop(Exception):
    pass


@contextmanager
def stop_at(part):
    """Fail the job before it writes to or deletes a path that holds ``part``."""

    def watched(real, at):
        def call(*args, **kw):
            if part in str(args[at]):
                raise Stop
            return real(*args, **kw)

        return call

    with (
        patch.object(DataFrameWriter, "parquet", watched(DataFrameWriter.parquet, 1)),
        patch.object(DataFrameWriter, "text", watched(DataFrameWriter.text, 1)),
        patch.object(runs, "remove", watched(runs.remove, 1)),
        patch.object(M, "remove", watched(M.remove, 1)),
    ):
        yield


def job(spark, raw, out, settings=SETTINGS):
    B.ingest(spark, str(raw), out, settings=settings)
    B.build_blocks(spark, out, settings)
    return B.build_merged(spark, out, settings)


def tables(spark, out):
    slim = io.read_slim(spark, f"{out}/slim").drop("pos")
    classified = B.read_classified(spark, out).select("id", "file", "outcome", "month")
    return [sorted(map(repr, df.collect())) for df in (slim, classified, io.read_blocks(spark, f"{out}/blocks"), M.read_merged(spark, out))]


@pytest.fixture(scope="module")
def before(spark, tmp_path_factory):
    """A finished job over capped files, and the tables of an undisturbed job without the cap."""
    folder = tmp_path_factory.mktemp("stopped")
    raw = folder / "raw"
    dump(raw, "RC_2018-01.zst", [comment(i) for i in range(23)])
    dump(raw, "RC_2018-02.xz", [comment(100 + i) for i in range(31)])
    flawed = post(99)
    del flawed["is_robot_indexable"]
    dump(raw, "RS_2018-01.zst", [post(i) for i in range(12)])
    dump(raw, "RS_2018-02.zst", [post(20), post(21), post(22), flawed])
    (raw / "RC_2018-03.zst").write_bytes((raw / "RC_2018-01.zst").read_bytes()[:-9])
    old, clean = str(folder / "old"), str(folder / "clean")
    job(spark, raw, old, B.Settings(n_rows=5, min_rows=3, max_lines=3))
    job(spark, raw, clean)
    return folder, raw, old, tables(spark, clean)


def test_nothing_is_lost_wherever_it_stops(spark, before):
    """One job after another over the same folders, each stopped one step later; the last one is not."""
    folder, raw, out, want = before
    was = tables(spark, out)
    steps = ["/classified", "/slim", "/quarantine", "/done", "/unusable_files", "/classified/", "/blocks", "/done", "/blocks/", "/merged/rows", "/merged/state", "/done"]
    for part in steps:
        with pytest.raises(Stop), stop_at(part):
            job(spark, raw, out)
        # Until a table's switch its old rows are whole, from then on the new ones are.
        assert all(now in (a, b) for now, a, b in zip(tables(spark, out), was, want, strict=True)), part
    job(spark, raw, out)
    assert tables(spark, out) == want
    assert sorted(r.basename for r in io.read_names(spark, f"{out}/unusable_files").collect()) == ["RS_2018-02"]
    for name, stage in runs.STAGE_OF.items():
        assert runs.leftovers(spark, f"{out}/{name}", runs.current_runs(spark, out, stage)) == []


def test_a_later_month_alone_is_merged(spark, tmp_path):
    """The blocks of the months before are unreadable, and nothing misses them."""
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    dump(raw, "RC_2018-01.zst", [comment(i) for i in range(23)])
    dump(raw, "RS_2018-01.zst", [post(i, subreddit=f"S{i % 3}") for i in range(30)])
    job(spark, raw, out)
    for part in (tmp_path / "out" / "blocks").rglob("*.parquet"):
        part.write_bytes(b"unreadable")
    dump(raw, "RC_2018-02.zst", [comment(2_000_000 + i) for i in range(13)])
    got = sorted(map(repr, job(spark, raw, out).collect()))
    clean = str(tmp_path / "clean")
    assert got == sorted(map(repr, job(spark, raw, clean).collect()))
    # A second update without news changes nothing.
    assert sorted(map(repr, job(spark, raw, out).collect())) == got


@pytest.mark.parametrize("limit", [3, 4_000_000])
def test_updates_equal_a_full_merge(spark, tmp_path, limit):
    """Months one by one, with short and full ends, late and replaced ones."""
    out, rnd, now = str(tmp_path / "out"), random.Random(limit), {}
    for step, month in enumerate(["2018-01", "2018-02", "2018-04", "2018-03", "2018-02", "2018-05"]):
        rows = []
        for name in ("a", "A", "b", f"only{step}"):
            for i in range(rnd.randint(0, 3)):
                n = 5 if i else rnd.choice([1, 2, 4, 5, 5])
                time = int(month[5:]) * 100 + i
                rows.append((name, 20 * n, n, time, base36(time), 0.25, 5 * n, n, 9 - i, base36(time + 7), "comments", month))
        rnd.shuffle(rows)
        blocks = spark.createDataFrame(rows, BLOCKS_BY_MONTH)
        now[month] = rows
        run = runs.next_run(spark, out)
        runs.write_run(blocks, f"{out}/blocks", run, [("comments", month)])
        runs.log_done(spark, out, "blocks", [("comments", month, None, None, "x")], run)
        got = M.update(spark, out, "x", 3, 5, limit)
        full = merge_short_tails(spark.createDataFrame(sum(now.values(), []), BLOCKS_BY_MONTH), 3, 5)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, full.select(got.columns).collect())), step
        updates = len(M._runs(spark, out))
        assert updates == {0: 1, 1: 2, 2: 3, 3: 1, 4: 1, 5: 2}[step] or month == "2018-03"
