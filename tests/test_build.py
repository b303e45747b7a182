"""The batch job from compressed files to rankings, on a few hand-made dumps."""

import bz2
import gzip
import json
import lzma
import random
from pathlib import Path

import pytest
import zstandard
from pyspark.sql import functions as F

from modtally.plans import build as B
from modtally.plans import publish as P
from modtally.plans import rankings as R
from modtally.sources import tables as io
from test_blocks import base36, expected_blocks

SETTINGS = B.Settings(n_rows=20, min_rows=10, update_inaccessible=True)


def pack(lines, extension):
    data = "\n".join(lines).encode()
    return {"gz": gzip.compress, "bz2": bz2.compress, "xz": lzma.compress, "zst": zstandard.compress}[extension](data)


def comment(rnd, month, i):
    removed = rnd.random() < 0.25
    return {
        "id": base36(1000 + i),
        "created_utc": 1500000000 + i // 3,
        "subreddit": rnd.choice(["Alpha", "beta", "null"]),
        "score": rnd.choice([None, -2, 1, 2, 5, 9]),
        "body": "[removed]" if removed else f"text &amp; é {i}",
        "author": "[deleted]" if removed else "someone",
        "link_id": f"t3_{base36(500 + i % 40)}",
    }


def post(rnd, i):
    return {
        "id": base36(500 + i),
        "created_utc": str(1500000000 + i),
        "subreddit": rnd.choice(["Alpha", "beta"]),
        "score": rnd.randrange(0, 9),
        "author": "someone",
        "is_robot_indexable": rnd.random() < 0.5,
        "title": f"Title  &lt;{i}&gt;",
        "num_comments": i,
    }


@pytest.fixture(scope="module")
def dumps(tmp_path_factory):
    rnd = random.Random(5)
    raw = tmp_path_factory.mktemp("raw")
    months = [("2018-01", "gz"), ("2018-02", "bz2"), ("2018-03", "xz"), ("2018-04", "zst")]
    comments = {m: [comment(rnd, m, 150 * k + j) for j in range(150)] for k, (m, _) in enumerate(months)}
    for m, extension in months:
        lines = [json.dumps(c) for c in comments[m]]
        # A repeated id: the last copy counts.
        lines.append(json.dumps({**comments[m][0], "score": 9}))
        comments[m].append({**comments[m][0], "score": 9})
        (raw / f"RC_{m}.{extension}").write_bytes(pack(lines, extension))
    posts = [post(rnd, i) for i in range(60)]
    (raw / "RS_2018-01.zst").write_bytes(pack(map(json.dumps, posts), "zst"))
    flawed = [{"id": "zz", "author": "u", "score": 1, "created_utc": 1, "subreddit": "Alpha"}, *posts[:3]]
    (raw / "RS_2017-01.zst").write_bytes(pack(map(json.dumps, flawed), "zst"))
    (raw / "RC_2018-05.zst").write_bytes(pack(["{}"], "zst"))
    (raw / "readme.txt").write_text("no dump")
    return raw, comments, posts


@pytest.fixture(scope="module")
def built(spark, dumps, tmp_path_factory):
    raw, comments, posts = dumps
    out = str(tmp_path_factory.mktemp("out"))
    skip = spark.createDataFrame([("RC_2018-05",)], "basename string")
    return out, B.build(spark, str(raw), out, skip=skip, settings=SETTINGS)


def test_blocks_equal_the_definition(spark, dumps, built):
    _, comments, _ = dumps
    out, _ = built
    rows = [
        (m, int(c["id"], 36), c["created_utc"], c["subreddit"], 1 if c["score"] is None else c["score"], c["body"] == "[removed]")
        for m, items in comments.items()
        for c in items
    ]
    blocks = io.read_blocks(spark, f"{out}/blocks", "comments").select("type", "month", *[c for c in io.BLOCK_COLUMNS])
    assert sorted(map(tuple, blocks.collect())) == expected_blocks(rows, 20)


def test_rejected_file_contributes_nothing(spark, built):
    out, _ = built
    assert [r.basename for r in io.read_names(spark, f"{out}/unusable_files").collect()] == ["RS_2017-01"]
    assert io.read_slim(spark, f"{out}/slim", "posts").select("month").distinct().collect() == [("2018-01",)]


def test_tables_are_complete_and_enriched(built):
    _, tables = built
    tops = {r[0] for r in tables["aggregate_comments"].select("id_of_max_pos_removed_item").collect()}
    assert {r.id for r in tables["comments"].collect()} == tops
    title = tables["posts"].where("title like 'Title <1>'").first()
    assert title is None or title.num_comments == 1
    assert tables["posts"].where("title like '%&lt;%' or title like '%  %'").isEmpty()


@pytest.mark.parametrize("by", ["rate", "date"])
@pytest.mark.parametrize("limit", [3, 1000, None])
def test_sql_functions_equal_the_dataframe_functions(spark, built, by, limit):
    out, t = built
    P.create_views(spark, f"{out}/tables")
    R.create_sql_functions(spark)
    number = "NULL" if limit is None else limit
    suffix = "Rate" if by == "rate" else "Date"
    sql = spark.sql(f"SELECT * FROM getCommentUpvoteRemovedRatesBy{suffix}('beta', {number}, rate_more => 0.1D)")
    df = R.top_comments(t["aggregate_comments"], t["comments"], t["posts"], "beta", limit, by=by, rate_more=0.1)
    assert sql.columns == df.columns
    assert sql.collect() == df.collect() and df.count() > 0
    sql = spark.sql(f"SELECT * FROM getPostUpvoteRemovedRatesBy{suffix}('beta', {number}, NULL, 1500000000)")
    df = R.top_posts(t["aggregate_posts"], t["posts"], "beta", limit, by=by, created_after=1500000000)
    assert sql.columns == df.columns
    assert sql.collect() == df.collect() and df.count() > 0


def test_bounds_are_inclusive(built):
    _, t = built
    every = R.top_posts(t["aggregate_posts"], t["posts"], "beta", None, by="date").collect()
    last, first = every[0].last_created_utc, every[-1].last_created_utc
    call = lambda **b: R.top_posts(t["aggregate_posts"], t["posts"], "beta", None, **b).count()
    assert call(created_before=last, created_after=first) == len(every)
    assert call(created_before=last - 1) == len(every) - 1
    rates = sorted(r.rate for r in every)
    assert call(rate_less=rates[0], rate_more=rates[0]) == rates.count(rates[0])
    assert R.top_posts(t["aggregate_posts"], t["posts"], "Beta", None).count() == 0


def test_top_k_reads_the_texts_of_k_rows_only(built):
    _, t = built
    plan = R.top_comments(t["aggregate_comments"], t["comments"], t["posts"], "beta", 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "SortMergeJoin" not in plan


def test_second_run_publishes_again_and_touches_no_done_month(spark, dumps, built):
    raw, _, posts = dumps
    out, before = built
    counts = {k: v.count() for k, v in before.items()}
    done = {f: f.stat().st_mtime_ns for f in Path(out, "slim").rglob("*.parquet")}
    rnd = random.Random(9)
    (raw / "RC_2018-06.gz").write_bytes(pack([json.dumps(comment(rnd, "2018-06", 5000 + i)) for i in range(200)], "gz"))
    skip = spark.createDataFrame([("RC_2018-05",)], "basename string")
    after = B.build(spark, str(raw), out, skip=skip, settings=SETTINGS)
    assert P.live_version(spark, f"{out}/tables") == 2
    assert all(f.stat().st_mtime_ns == t for f, t in done.items())
    assert after["aggregate_comments"].count() > counts["aggregate_comments"]
    assert after["aggregate_posts"].count() == counts["aggregate_posts"]
    # The first version stays readable for whoever still reads it.
    assert {k: v.count() for k, v in P.read_version(spark, f"{out}/tables", 1).items()} == counts


def test_merged_blocks_are_rebuilt_only_when_older(spark, built):
    out, _ = built
    merged = lambda: {f: f.stat().st_mtime_ns for f in Path(out, "merged").rglob("*.parquet")}
    before = merged()
    B.build_merged(spark, out, SETTINGS)
    assert merged() == before
    B.build_merged(spark, out, B.Settings(n_rows=20, min_rows=10, force=True))
    assert merged() != before


def test_a_broken_version_is_not_published(spark, built, tmp_path):
    _, t = built
    base = str(tmp_path / "tables")
    P.stage(t, base, 1)
    P.publish(spark, base, 1)
    broken = {**t, "comments": t["comments"].unionByName(t["comments"])}
    P.stage(broken, base, 2)
    with pytest.raises(Exception, match="primary key"):
        P.publish(spark, base, 2)
    assert P.live_version(spark, base) == 1


def test_all_tables_must_be_there(spark, built, tmp_path):
    _, t = built
    with pytest.raises(ValueError, match="posts"):
        P.stage({k: v for k, v in t.items() if k != "posts"}, str(tmp_path), 1)
    with pytest.raises(ValueError):
        P.read_live(spark, str(tmp_path / "none"))


def test_settings_of_the_sample_run(spark, dumps, tmp_path):
    raw, _, _ = dumps
    skip = spark.createDataFrame([("RC_2018-05",)], "basename string")
    settings = B.Settings(max_lines=10, n_rows=5, min_rows=2)
    B.ingest(spark, str(raw), str(tmp_path), skip=skip, settings=settings)
    counts = io.read_slim(spark, f"{tmp_path}/slim").groupBy("type", "month").count().collect()
    assert counts and all(r["count"] == 10 for r in counts)
    B.build_blocks(spark, str(tmp_path), settings)
    merged = B.build_merged(spark, str(tmp_path), settings)
    assert merged.where(F.col("subreddit") != F.lower("subreddit")).isEmpty()
