"""Work that must not grow faster than the tables: tasks, decoding passes, shuffles."""

import lzma
import os

import pytest
import zstandard
from contract import jobs, queries, roles  # noqa: F401  (jobs registers its queries)
from modtally.sources import archives, dumps

DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver tables")


@pytest.mark.parametrize("extension", ["xz", "zst"])
def test_small_parts_are_joined(spark, tmp_path, extension):
    """Files of very many frames make a fixed number of tasks a core, and give the same lines."""
    pack = lzma.compress if extension == "xz" else zstandard.ZstdCompressor().compress
    lines = [f"line {i:05d} " + "x" * (i % 70) for i in range(6000)]
    text = "".join(f"{x}\n" for x in lines).encode()
    path = tmp_path / f"RC_2018-01.{extension}"
    path.write_bytes(b"".join(pack(text[low : low + 700]) for low in range(0, len(text), 700)))
    most = dumps.PARTS_PER_CORE * spark.sparkContext.defaultParallelism
    assert len(range(0, len(text), 700)) > 2 * most
    read = dumps.read_dumps(spark, [str(path)], part_bytes=1, spread=0)
    assert 1 < read.rdd.getNumPartitions() <= most
    assert [r.value for r in read.orderBy("pos").collect()] == lines


def test_joined_parts_keep_their_bounds():
    cuts = [(0, 10), (10, 25), (25, 30), (30, 44), (44, -1)]
    assert archives.fewer_parts(cuts, 5) == archives.fewer_parts(cuts, 9) == cuts
    assert archives.fewer_parts(cuts, 2) == [(0, 30), (30, -1)]
    assert archives.fewer_parts(cuts, 1) == [(0, -1)]


@needs_tables
@pytest.mark.parametrize("name", ["scan_gz", "scan_bz2", "scan_zst", "scan_xz", "scan_frames"])
def test_dumps_are_decoded_once(spark, name):
    """What the result is computed from is the parsed table alone."""
    plan = queries.QUERIES[name](spark, DIR)._jdf.queryExecution().toString()
    assert "dump_lines" not in plan and "from_json" not in plan and "FileScan text" not in plan


def test_a_table_read_in_many_parts_is_not_dealt_again(spark, tmp_path):
    """One large file: Spark splits it, so it needs no shuffle over a fixed number of partitions."""
    path = str(tmp_path / "t.parquet")
    spark.range(8_000_000).selectExpr("id", "xxhash64(id) AS a").coalesce(1).write.parquet(path)
    table = spark.read.parquet(path)
    assert len(table.inputFiles()) == 1 and table.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert "Exchange" not in roles.spread(table, "id")._jdf.queryExecution().executedPlan().toString()
    small = spark.range(10)
    small.coalesce(1).write.parquet(str(tmp_path / "s.parquet"))
    assert roles.spread(spark.read.parquet(str(tmp_path / "s.parquet")), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


@needs_tables
def test_parsed_lines_are_packed(spark):
    files = os.listdir(queries.classified(spark, DIR).removeprefix("file:") + "/comments")
    assert any(f.endswith(".zstd.parquet") for f in files)


@needs_tables
def test_texts_are_joined_to_the_plain_table(spark):
    """The rows that the join shuffles are those of the table, not the longer ones made from them."""
    plan = roles.comment_lines(spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sub_" in plan and plan.index("Sub_") < plan.index("Join LeftOuter")
    below = plan[plan.index("Join LeftOuter") :]
    assert "Sub_" not in below
