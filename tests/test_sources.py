import bz2
import gzip
import json
import lzma

import pytest
import zstandard
from pyspark.sql import functions as F

from modtally.operators.blocks import keep_last
from modtally.sources.dumps import (
    cap_lines,
    complete_months,
    decode_lines,
    judge_files,
    list_files,
    read_dumps,
    readable_files,
)
from modtally.sources.manifest import coverage, order_manifest, parent_sizes, read_manifest, upsert_manifest
from modtally.sources.tables import append_names, read_enriched_csv, read_ids, read_names, read_slim_csv, write_enriched_csv, write_ids, write_slim_csv
from modtally.functions import with_name_parts

PACK = {
    "gz": gzip.compress,
    "bz2": bz2.compress,
    "xz": lzma.compress,
    "zst": zstandard.compress,
    "ZST": zstandard.compress,
    "GZ": gzip.compress,
}


def write(path, data, extension):
    target = path / f"RC_2018-01.{extension}"
    target.write_bytes(PACK[extension](data))
    return str(target)


def texts(df):
    return [r.value for r in df.orderBy("pos").collect()]


@pytest.mark.parametrize("extension", PACK)
def test_every_codec(spark, tmp_path, extension):
    body = [json.dumps({"n": i, "t": "é " * (i % 7)}, ensure_ascii=False) for i in range(3000)]
    # Blank lines are skipped, the last line has no line feed.
    data = ("\n\n".join(body[:2000]) + "\n \n" + "\n".join(body[2000:])).encode()
    lines = read_dumps(spark, [write(tmp_path, data, extension)])
    assert texts(lines) == body
    assert {(r.type, r.month) for r in lines.select("type", "month").distinct().collect()} == {("comments", "2018-01")}


def test_concatenated_streams(spark, tmp_path):
    for extension in ("gz", "bz2", "xz", "zst"):
        target = tmp_path / f"RC_2019-01.{extension}"
        target.write_bytes(PACK[extension](b"one\ntwo\n") + PACK[extension](b"three\nfour"))
        assert texts(read_dumps(spark, [str(target)])) == ["one", "two", "three", "four"], extension


def test_long_window_zstd(spark, tmp_path):
    settings = zstandard.ZstdCompressionParameters.from_level(1, window_log=28, enable_ldm=True)
    data = b"\n".join(b"line %d" % i for i in range(50_000))
    target = tmp_path / "RS_2020-06.zst"
    packer = zstandard.ZstdCompressor(compression_params=settings).compressobj()
    target.write_bytes(packer.compress(data) + packer.flush())
    lines = read_dumps(spark, [str(target)])
    assert texts(lines) == data.decode().split("\n")
    assert lines.first().type == "posts"


def test_line_longer_than_a_chunk(spark, tmp_path, monkeypatch):
    long = "x" * (9 << 20)
    assert texts(read_dumps(spark, [write(tmp_path, f"a\n{long}\nb".encode(), "xz")])) == ["a", long, "b"]


def test_position_follows_file_order_across_splits_and_files(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        paths = []
        for day in ("2018-01-02", "2018-01-01", "2018-01-10"):
            target = tmp_path / f"RC_{day}.bz2"
            target.write_bytes(bz2.compress("\n".join(f"{day} {i:05d} {i * 7919 % 100003}" for i in range(20_000)).encode(), 1))
            paths.append(str(target))
        lines = read_dumps(spark, paths)
        assert lines.rdd.getNumPartitions() > 3
        got = texts(lines.repartition(7))
        assert got == sorted(got) and len(got) == 60_000
        assert {r.month for r in lines.select("month").distinct().collect()} == {"2018-01"}
        # The last copy in file order wins, whatever the partitioning.
        last = keep_last(lines.withColumn("id", F.lit("same")).repartition(5), ["type", "month", "id"])
        assert last.first().value.startswith("2018-01-10 19999")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_line_cap(spark, tmp_path):
    data = "\n".join(str(i) for i in range(500)).encode()
    a, b = tmp_path / "RC_2018-01.gz", tmp_path / "RC_2018-02.xz"
    a.write_bytes(gzip.compress(b"\n" + data))
    b.write_bytes(lzma.compress(data))
    expected = [str(i) for i in range(30)] * 2
    assert texts(read_dumps(spark, [str(a), str(b)], max_lines=30)) == expected
    assert texts(cap_lines(read_dumps(spark, [str(a), str(b)]), 30)) == expected
    assert cap_lines(read_dumps(spark, [str(a), str(b)]), 0).count() == 1000


@pytest.mark.parametrize("limit", [1, 7, 8, 250, 999, 5000])
def test_line_cap_over_many_chunks(spark, monkeypatch, limit):
    monkeypatch.setattr("modtally.sources.dumps.CHUNK_LINES", 8)
    rows = spark.range(1200).selectExpr(
        "if(id % 3 = 0, 'small', 'large') AS file",
        "struct(id div 400 AS start, id * 3 AS line) AS pos",
        "id AS n",
    )
    expected = sorted([n for n in range(1200) if n % 3 == 0][:limit] + [n for n in range(1200) if n % 3][:limit])
    assert sorted(r.n for r in cap_lines(rows.repartition(5), limit).collect()) == expected


def test_encoding_fallback(spark, tmp_path):
    data = b"ascii\n" + "café".encode("latin-1") + b"\n" + "naïve".encode() + b"\n"
    for extension in ("gz", "zst"):
        lines = read_dumps(spark, [write(tmp_path, data, extension)])
        assert texts(decode_lines(lines)) == ["ascii", "café", "naïve"]
        # As one encoding for the whole file: the UTF-8 line reads as two Latin letters.
        assert texts(decode_lines(lines, whole_file=True)) == ["ascii", "café", "naïve".encode().decode("latin-1")]
    good = read_dumps(spark, [write(tmp_path, "naïve\nplain".encode(), "xz")])
    assert texts(decode_lines(good, whole_file=True)) == ["naïve", "plain"]


def test_unknown_extension_is_refused(spark):
    with pytest.raises(ValueError):
        read_dumps(spark, ["/somewhere/RC_2018-01.txt"])


def test_no_files(spark):
    assert read_dumps(spark, []).count() == 0


def files(spark, rows):
    return with_name_parts(spark.createDataFrame(rows, "name string, size bigint"))


def test_file_selection(spark):
    rows = [
        ("RC_2018-01.zst", 10),  # size as listed
        ("RC_2018-02.zst", 11),  # listed with another size
        ("RC_2018-03.zst", 30),  # the sum of its listed days
        ("RC_2018-04.zst", 5),  # not listed
        ("RC_2018-05.zst", 5),  # on the skip list
        ("RC_2018-06-01.zst", 7),
        ("RC_2018-06-02.zst", 8),
        ("RC_2018-07-01.zst", 9),  # not the listed size
        ("RC_2018-01-05.zst", 1),  # its month exists as a file
        ("RC_2018-08.txt", 5),
        ("RC_2018-09.ZST", 3),
    ]
    manifest = spark.createDataFrame(
        [("RC_2018-01.zst", 10), ("RC_2018-02.zst", 12), ("RC_2018-03.zst", 31), ("RC_2018-03-01.zst", 10), ("RC_2018-03-02.zst", 20),
         ("RC_2018-06-01.zst", 7), ("RC_2018-06-02.zst", 8), ("RC_2018-07-01.zst", 8), ("RC_2018-01-05.zst", 1), ("RC_2018-09.zst", 3)],
        "name string, size bigint",
    )
    skip = spark.createDataFrame([("RC_2018-05",)], "basename string")
    judged = judge_files(files(spark, rows), manifest, skip)
    status = {r["name"]: r.status for r in judged.collect()}
    assert status == {
        "RC_2018-01.zst": "ready",
        "RC_2018-02.zst": "size_mismatch",
        "RC_2018-03.zst": "ready",
        "RC_2018-04.zst": "ready",
        "RC_2018-05.zst": "skipped",
        "RC_2018-06-01.zst": "daily",
        "RC_2018-06-02.zst": "daily",
        "RC_2018-07-01.zst": "daily",
        "RC_2018-01-05.zst": "daily",
        "RC_2018-08.txt": "unsupported",
        "RC_2018-09.ZST": "ready",
    }
    months = {r.month: (r.num_days, r.complete) for r in complete_months(judged).collect()}
    assert months == {"2018-06": (2, True), "2018-07": (1, False)}
    read = sorted(r["name"] for r in readable_files(judged).collect())
    assert read == ["RC_2018-01.zst", "RC_2018-03.zst", "RC_2018-04.zst", "RC_2018-06-01.zst", "RC_2018-06-02.zst", "RC_2018-09.ZST"]


def test_selection_without_lists(spark):
    judged = judge_files(files(spark, [("RS_2018-01.xz", 4)]))
    assert [r.status for r in judged.collect()] == ["ready"]


def test_listing_reads_names_and_sizes(spark, tmp_path):
    (tmp_path / "RS_2018-01.xz").write_bytes(b"12345")
    row = list_files(spark, str(tmp_path)).first()
    assert (row["name"], row["size"], row["type"], row["month"]) == ("RS_2018-01.xz", 5, "posts", "2018-01")


def test_manifest(spark, tmp_path):
    path = tmp_path / "sizes"
    path.write_text("RS_2018-11.zst 36\n\nRC_2020-01-02.zst  5\nRC_2020-01-01.zst 4\nRC_2019-12.zst 7\n")
    manifest = read_manifest(spark, str(path))
    assert {r.base: r.parts_size for r in parent_sizes(manifest).collect()} == {"RC_2020-01": 9, "RC_2020": 9, "RS_2018": 36, "RC_2019": 7}
    assert [r["name"] for r in order_manifest(manifest).collect()] == ["RS_2018-11.zst", "RC_2019-12.zst", "RC_2020-01-01.zst", "RC_2020-01-02.zst"]
    found = spark.createDataFrame([("RS_2018-11.zst", 99), ("RS_2018-12.zst", 1)], "name string, size bigint")
    assert {r["name"]: r["size"] for r in upsert_manifest(manifest, found).collect()}["RS_2018-11.zst"] == 36
    assert upsert_manifest(manifest, found).count() == 5


def test_coverage(spark):
    expected = spark.createDataFrame([(f"RC_{p}.zst", f"RC_{p}") for p in ("2007-12", "2018-01", "2018-02", "2018-03", "2018-04")], "name string, base string")
    local = files(spark, [("RC_2007.bz2", 1), ("RC_2018-01.zst", 5), ("RC_2018-02.zst", 5)])
    manifest = spark.createDataFrame([("RC_2018-01.zst", 5), ("RC_2018-02.zst", 6), ("RC_2018-03.zst", 6)], "name string, size bigint")
    got = {r["name"][3:10]: r.status for r in coverage(expected, local, manifest).collect()}
    assert got == {"2007-12": "yearly", "2018-01": "present", "2018-02": "stale", "2018-03": "missing", "2018-04": "unlisted"}


def test_csv_keeps_texts_that_look_missing(spark, tmp_path):
    rows = [("1", "null", 5, "a", 1), ("2", 'na, "quoted" \\ back\\"', 5, "b", None), ("3", None, 5, "c", 2), ("4", " blanks ", 5, "d", 3)]
    df = spark.createDataFrame(rows, "id string, body string, created_utc bigint, link_id string, score bigint")
    write_enriched_csv(df, str(tmp_path / "c"), "comments")
    assert sorted(map(tuple, read_enriched_csv(spark, str(tmp_path / "c"), "comments").collect())) == rows


def test_slim_csv(spark, tmp_path):
    rows = [("a", 5, "null", -1, True, "comments", "2018-01"), ("b", 6, "NA", 2, False, "posts", "2018-02")]
    df = spark.createDataFrame(rows, "id string, created_utc bigint, subreddit string, score bigint, is_removed boolean, type string, month string")
    write_slim_csv(df, str(tmp_path / "s"))
    assert sorted(map(tuple, read_slim_csv(spark, str(tmp_path / "s")).collect())) == rows
    (tmp_path / "t" / "type=comments" / "month=2018-03").mkdir(parents=True)
    (tmp_path / "t" / "type=comments" / "month=2018-03" / "x.csv").write_text("id,created_utc,subreddit,score,is_removed\nq,7,nan,3,True\n")
    assert [tuple(r) for r in read_slim_csv(spark, str(tmp_path / "t")).collect()] == [("q", 7, "nan", 3, True, "comments", "2018-03")]


def test_lists(spark, tmp_path):
    write_ids(spark.createDataFrame([("b",), ("a",), ("b",)], "id string"), str(tmp_path / "ids"))
    assert [r.id for r in read_ids(spark, str(tmp_path / "ids")).collect()] == ["a", "b"]
    log = str(tmp_path / "log")
    append_names(spark.createDataFrame([("x",)], "n string"), log)
    append_names(spark.createDataFrame([("x",), ("y",)], "n string"), log, read_names(spark, log))
    assert sorted(r.basename for r in read_names(spark, log).collect()) == ["x", "y"]
