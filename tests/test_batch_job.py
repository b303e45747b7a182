"""The batch job in the situations where data could be lost or a partial result kept."""

import json
import lzma
import zstandard

import pytest
from pyspark.sql import functions as F

from modtally.operators.blocks import keep_last
from modtally.operators.slim import classify, kept_items, quarantined
from modtally.plans import build as B
from modtally.sources import tables as io
from modtally.sources.dumps import read_dumps


def comment(i, **more):
    removed = i % 3 == 0
    return {
        "id": f"c{i}",
        "created_utc": 1500000000 + i,
        "subreddit": "Alpha",
        "score": 5 + i % 4,
        "body": "[removed]" if removed else f"text {i}",
        "author": "[deleted]" if removed else "someone",
        "link_id": "t3_p1",
        **more,
    }


def post(i, **more):
    return {"id": f"p{i}", "created_utc": 1500000000 + i, "subreddit": "Alpha", "score": 7, "author": "u", "is_robot_indexable": i % 2 > 0, "title": f"T{i}", "num_comments": i, **more}


def dump(folder, name, rows):
    folder.mkdir(exist_ok=True)
    data = "\n".join(map(json.dumps, rows)).encode()
    (folder / name).write_bytes(lzma.compress(data) if name.endswith("xz") else zstandard.compress(data))
    return (folder / name).stat().st_size


def slim(spark, out, item_type="comments"):
    return io.read_slim(spark, f"{out}/slim", item_type).count()


def test_a_capped_month_is_read_again(spark, tmp_path):
    dump(tmp_path / "raw", "RC_2018-01.zst", [comment(i) for i in range(60)])
    out = str(tmp_path / "out")
    counts = []
    for cap in (3, 3, 0, 0, 3, 0):
        B.ingest(spark, str(tmp_path / "raw"), out, settings=B.Settings(max_lines=cap))
        counts.append(slim(spark, out))
    assert counts == [3, 3, 60, 60, 3, 60]


def test_daily_files_arrive_one_by_one(spark, tmp_path):
    raw, out, days = tmp_path / "raw", str(tmp_path / "out"), ["2018-01-01", "2018-01-02", "2018-01-03"]
    sizes = [(f"RC_{d}.xz", dump(tmp_path / "all", f"RC_{d}.xz", [comment(100 * k + i) for i in range(10)])) for k, d in enumerate(days)]
    manifest = spark.createDataFrame(sizes, "name string, size long")
    dump(raw, "RC_2017-01.zst", [comment(i) for i in range(5)])
    counts = []
    for name, _ in sizes:
        (raw / name).write_bytes((tmp_path / "all" / name).read_bytes())
        B.ingest(spark, str(raw), out, manifest)
        counts.append(slim(spark, out))
    assert counts == [5, 5, 35]


def test_a_file_added_to_a_done_month_is_read(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    dump(raw, "RC_2018-01.zst", [comment(i) for i in range(10)])
    B.ingest(spark, str(raw), out)
    B.build_blocks(spark, out, B.Settings(n_rows=5, min_rows=2))
    dump(raw, "RC_v2_2018-01.zst", [comment(i) for i in range(5, 20)])
    B.ingest(spark, str(raw), out)
    B.build_blocks(spark, out, B.Settings(n_rows=5, min_rows=2))
    assert slim(spark, out) == 25
    assert io.read_blocks(spark, f"{out}/blocks").agg(F.sum("total_items")).first()[0] == 20


def test_a_month_without_rows_keeps_nothing_old(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    dump(raw, "RS_2018-01.zst", [post(i) for i in range(5)])
    dump(raw, "RC_2018-01.zst", [comment(i) for i in range(9)])
    settings = B.Settings(n_rows=5, min_rows=2, force=True)
    B.ingest(spark, str(raw), out, settings=settings)
    B.build_blocks(spark, out, settings)
    assert slim(spark, out, "posts") == 5
    flawed = post(9)
    del flawed["is_robot_indexable"]
    dump(raw, "RS_2018-01.zst", [*(post(i) for i in range(5)), flawed])
    B.ingest(spark, str(raw), out, settings=settings)
    B.build_blocks(spark, out, settings)
    assert slim(spark, out, "posts") == 0 and slim(spark, out) == 9
    assert io.read_blocks(spark, f"{out}/blocks", "posts").isEmpty()


def test_months_without_blocks_are_done(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    dump(raw, "RC_2018-01.zst", [comment(3 * i + 1) for i in range(9)])
    dump(raw, "RC_2018-02.zst", [comment(i) for i in range(9)])
    settings = B.Settings(n_rows=5, min_rows=2)
    B.ingest(spark, str(raw), out, settings=settings)
    B.build_blocks(spark, out, settings)
    runs = B.read_done(spark, out, "blocks").select("month", "run").collect()
    B.build_blocks(spark, out, settings)
    assert sorted(r.month for r in runs) == ["2018-01", "2018-02"]
    assert B.read_done(spark, out, "blocks").select("month", "run").collect() == runs


def test_rejected_files_give_no_text(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    dump(raw, "RC_2018-01.zst", [comment(i) for i in range(30)])
    flawed = post(2)
    del flawed["is_robot_indexable"]
    dump(raw, "RS_2018-01.zst", [post(1), flawed])
    dump(raw, "RS_2018-02.zst", [post(i) for i in range(10, 40)])
    tables = B.build(spark, str(raw), out, settings=B.Settings(n_rows=10, min_rows=5))
    # The comments' parent p1 stands only in the rejected file.
    assert tables["posts"].where("id = 'p1'").isEmpty() and not tables["posts"].isEmpty()


def test_keep_all_publishes_and_stored_lists_are_used(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    dump(raw, "RC_2018-01.zst", [*(comment(i) for i in range(20)), *(comment(3 * i + 1) for i in range(20, 60))])
    dump(raw, "RS_2018-01.zst", [post(i) for i in range(10, 40)])
    settings = B.Settings(n_rows=10, min_rows=5, dropna=False, update_inaccessible=True)
    tables = B.build(spark, str(raw), out, settings=settings)
    assert tables["aggregate_comments"].where("id_of_max_pos_removed_item = ''").count() >= 2
    assert [r.id for r in B.stored_inaccessible(spark, out, 1)["posts"].collect()] == ["p1"]
    again = B.build(spark, str(raw), out, settings=B.Settings(n_rows=10, min_rows=5, dropna=False))
    assert again["posts"].count() == tables["posts"].count()
    assert [r.id for r in B.stored_inaccessible(spark, out, 2)["posts"].collect()] == ["p1"]


def test_merged_follows_the_newest_settings(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    dump(raw, "RC_2018-01.zst", [comment(i) for i in range(40)])
    small, large = B.Settings(n_rows=5, min_rows=2), B.Settings(n_rows=20, min_rows=2)
    counts = []
    B.ingest(spark, str(raw), out)
    for settings in (small, large, small):
        B.build_blocks(spark, out, settings)
        counts.append(B.build_merged(spark, out, settings).count())
    assert counts[0] == counts[2] > counts[1]


def test_two_files_of_a_month_are_ordered_by_name(spark, tmp_path):
    for name, score in (("RC_v2_2018-02.xz", 50), ("RC_2018-02.xz", 40)):
        dump(tmp_path / "raw", name, [comment(i, score=score) for i in range(6)])
    lines = read_dumps(spark, [str(tmp_path / "raw" / "RC_*.xz")])
    items = keep_last(kept_items(classify(lines)))
    assert [r.score for r in items.collect()] == [50] * 6
    assert lines.select("pos").distinct().count() == 12


def test_patterns_and_missing_files(spark, tmp_path):
    dump(tmp_path / "raw", "RC_2018-01.xz", [comment(i) for i in range(4)])
    dump(tmp_path / "raw", "RC_2018-02.zst", [comment(i) for i in range(3)])
    assert read_dumps(spark, [str(tmp_path / "raw")]).count() == 7
    assert read_dumps(spark, [str(tmp_path / "raw" / "RC_*.zst")]).where("month = '2018-02'").count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_dumps(spark, [str(tmp_path / "raw" / "RC_2019-*.xz")])


def test_one_file_is_parsed_by_all_cores(spark, tmp_path):
    dump(tmp_path / "raw", "RC_2018-01.zst", [comment(i) for i in range(400)])
    lines = read_dumps(spark, [str(tmp_path / "raw" / "RC_2018-01.zst")])
    assert lines.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    plan = classify(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("from_json") < plan.index("REPARTITION_BY_NUM") < plan.index("BatchScan")


def test_values_are_judged_by_value_not_by_form(spark):
    rows = [
        comment(1, id="1y2p0ij32e8e7"),
        comment(2, id="1y2p0ij32e8e8"),
        comment(3, id="0000000000000000z"),
        comment(4, created_utc=1500000000.0, score=5.0),
        comment(5, created_utc="1.5e9", score="-3"),
        comment(6, score=5.5),
        comment(7, created_utc=1500000000.25),
    ]
    lines = spark.createDataFrame([(json.dumps(r), "f", "comments", "m", i) for i, r in enumerate(rows)], "value string, file string, type string, month string, pos int")
    kept = {r.pos: r for r in kept_items(classify(lines)).collect()}
    assert sorted(kept) == [0, 2, 3, 4]
    assert (kept[3].created_utc, kept[3].score, kept[4].created_utc, kept[4].score) == (1500000000, 5, 1500000000, -3)
    assert {r.reason for r in quarantined(classify(lines)).collect()} == {"bad value"}


def test_quoted_flags_are_true(spark):
    flags = ["false", "0", "", False, 0, None, True]
    lines = spark.createDataFrame(
        [(json.dumps(post(1, is_robot_indexable=f)), "f", "posts", "m", i) for i, f in enumerate(flags)], "value string, file string, type string, month string, pos int"
    )
    removed = {r.pos: r.is_removed for r in kept_items(classify(lines)).collect()}
    assert removed == {0: False, 1: False, 2: True, 3: True, 4: True, 5: True, 6: False}


def test_a_later_build_reads_no_old_texts(spark, tmp_path):
    """The old month's texts are gone, and nothing misses them."""
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    settings = B.Settings(n_rows=10, min_rows=5, update_inaccessible=True)
    dump(raw, "RC_2018-01.zst", [comment(i) for i in range(40)])
    dump(raw, "RS_2018-01.zst", [post(i) for i in range(10)])
    first = B.build(spark, str(raw), out, settings=settings)
    before = {r.id: r.body for r in first["comments"].collect()}
    for part in (tmp_path / "out" / "classified" / "type=comments" / "month=2018-01").rglob("*.parquet"):
        part.write_bytes(b"unreadable")
    dump(raw, "RC_2018-02.zst", [comment(i) for i in range(100, 140)])
    after = {r.id: r.body for r in B.build(spark, str(raw), out, settings=settings)["comments"].collect()}
    assert before.items() <= after.items() and len(after) > len(before)
    assert any(int(i[1:]) >= 100 for i in after)


def test_new_ids_of_old_months_are_found(spark, tmp_path):
    """Other blocks have other top items; those are looked up in the old months."""
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    dump(raw, "RC_2018-01.zst", [comment(i) for i in range(60)])
    B.build(spark, str(raw), out, settings=B.Settings(n_rows=30, min_rows=5))
    tables = B.build(spark, str(raw), out, settings=B.Settings(n_rows=6, min_rows=5))
    tops = {r.id for r in tables["aggregate_comments"].selectExpr("id_of_max_pos_removed_item AS id").collect()}
    assert tops <= {r.id for r in tables["comments"].collect()} and len(tops) > 5
