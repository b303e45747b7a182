"""Broken archives and files read in parts."""

import bz2
import gzip
import json
import lzma
import struct

import pytest
import zstandard

from modtally.plans import build as B
from modtally.sources import archives as A
from modtally.sources import tables as io
from modtally.sources.runs import current_runs
from modtally.sources.dumps import broken_ends, broken_inside, find_parts, list_files, read_dumps
from test_batch_job import comment, dump

PACK = {"gz": gzip.compress, "bz2": lambda d: bz2.compress(d, 1), "xz": lzma.compress, "zst": zstandard.compress}


def damaged(data, kind):
    half = len(data) // 2
    return {
        "half": data[:half],
        "no end": data[:-5],
        "flipped": data[:half] + bytes([data[half] ^ 0x55]) + data[half + 1 :],
        "empty": b"",
        "other": b"this is no archive at all " * 9,
    }[kind]


KINDS = ["half", "no end", "flipped", "empty", "other"]


def rows(n, start=0):
    return [comment(start + i, body=f"text {i} {i * 7919 % 100003}") for i in range(n)]


@pytest.mark.parametrize("extension", PACK)
@pytest.mark.parametrize("kind", KINDS)
def test_faults_are_found(tmp_path, extension, kind):
    data = "\n".join(map(json.dumps, rows(3000))).encode()
    path = tmp_path / f"x.{extension}"
    path.write_bytes(PACK[extension](data))
    assert A.fault(str(path)) is None
    if extension in ("gz", "bz2"):
        assert A.ends_whole(str(path)) is None
    if (extension, kind) == ("zst", "flipped"):
        # Without a checksum a flipped bit inside a literal is another text, no fault.
        path.write_bytes(zstandard.ZstdCompressor(write_checksum=True).compress(data))
        data = path.read_bytes()
        path.write_bytes(damaged(data, kind))
    else:
        path.write_bytes(damaged(path.read_bytes(), kind))
    assert A.fault(str(path)).split(":")[0] in ("truncated", "damaged")


# Spark lists no file of zero bytes; such a dump counts as missing.
@pytest.mark.parametrize("kind", [k for k in KINDS if k != "empty"])
def test_a_broken_file_costs_that_file_only(spark, tmp_path, kind):
    """Four codecs, one whole and one broken file each: no item of the broken ones, one log entry each."""
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    month, broken = 0, []
    for extension in PACK:
        for whole in (True, False):
            month += 1
            data = "\n".join(map(json.dumps, rows(900, 1000 * month))).encode()
            packed = PACK[extension](data)
            if extension == "zst":
                packed = zstandard.ZstdCompressor(write_checksum=True).compress(data)
            (raw / f"RC_2018-{month:02d}.{extension}").write_bytes(packed if whole else damaged(packed, kind))
            broken += [] if whole else [f"RC_2018-{month:02d}"]
    B.ingest(spark, str(raw), out)
    counts = {r.month: r["count"] for r in io.read_slim(spark, f"{out}/slim").groupBy("month").count().collect()}
    assert counts == {f"2018-{m:02d}": 900 for m in (1, 3, 5, 7)}
    assert sorted(r.basename for r in io.read_names(spark, f"{out}/broken_files").collect()) == broken
    judged = {r["base"]: r.status for r in B.ingest(spark, str(raw), out).collect()}
    assert {b for b, status in judged.items() if status == "broken"} == set(broken)


def test_a_broken_file_is_read_once_it_is_replaced(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    dump(raw, "RC_2018-01.zst", rows(50))
    dump(raw, "RC_v2_2018-01.zst", rows(300, 100))
    whole = (raw / "RC_v2_2018-01.zst").read_bytes()
    (raw / "RC_v2_2018-01.zst").write_bytes(whole[:-200])
    settings = B.Settings(n_rows=5, min_rows=2)
    counts = []
    for step in range(4):
        if step == 2:
            (raw / "RC_v2_2018-01.zst").write_bytes(whole)
        before = current_runs(spark, out, "slim")
        B.ingest(spark, str(raw), out, settings=settings)
        counts.append((io.read_slim(spark, f"{out}/slim").count(), current_runs(spark, out, "slim") != before))
    assert counts == [(50, True), (50, False), (350, True), (350, False)]


def frames(extension, blocks, pieces):
    """Every piece is a frame or block of its own."""
    if extension == "xz":
        return b"".join(lzma.compress(p) for p in pieces)
    skipped = struct.pack("<II", A.ZST_SKIPPED + 3, 5) + b"12345"
    return skipped + b"".join(zstandard.ZstdCompressor(write_checksum=i % 2 > 0, write_content_size=i % 3 > 0).compress(p) for i, p in enumerate(pieces))


@pytest.mark.parametrize("extension", ["xz", "zst"])
def test_parts_of_a_file_give_its_lines(spark, tmp_path, extension):
    """Cuts inside lines, at line ends, in lines longer than a frame, and blank lines at the cuts."""
    text = "\n".join([f"line {i} " + "x" * (i * 37 % 90) for i in range(4000)] + ["long " + "y" * 40_000, "", "  ", "last"]).encode()
    at, pieces, n = 0, [], 0
    while at < len(text):
        step = 700 + 911 * n % 4000
        if n % 5 == 0:
            step = text.find(b"\n", at + step) + 1 - at or step
        pieces.append(text[at : at + step])
        at, n = at + step, n + 1
    path = tmp_path / f"RC_2018-01.{extension}"
    path.write_bytes(frames(extension, None, pieces))
    want = [x for x in text.decode().split("\n") if x.strip()]
    assert b"".join(A.decoded(str(path), A.open_file(str(path)))) == text
    for least in (1, 300, 5000):
        cuts = find_parts(spark, [str(path)], least)
        assert least > 1 or len(cuts) == len(pieces)
        lines = read_dumps(spark, [str(path)], part_bytes=least)
        assert [r.value for r in lines.orderBy("pos").collect()] == want
    assert read_dumps(spark, [str(path)], part_bytes=1, spread=0).rdd.getNumPartitions() == len(pieces)
    assert [r.value for r in read_dumps(spark, [str(path)], max_lines=7, part_bytes=1).orderBy("pos").collect()] == want[:7]


def test_blocks_of_one_xz_stream(spark, tmp_path):
    """Several blocks under one index, as parallel packers write them."""
    pieces = [b"".join(b"row %d of %d\n" % (i, k) for i in range(500)) for k in range(5)] + [b"end"]
    blocks, records = [], []
    for p in pieces:
        stream = lzma.compress(p)
        raw = tmp_path / "one.xz"
        raw.write_bytes(stream)
        with A.open_file(str(raw), seekable=True) as f:
            [(offset, size, content, header)] = A.xz_index(f, len(stream))
        blocks.append(stream[offset : offset + -(-size // 4) * 4])
        records.append((size, content))
    index = b"\x00" + A._number(len(records)) + b"".join(A._number(a) + A._number(b) for a, b in records)
    index += bytes(-len(index) % 4)
    index += struct.pack("<I", A.zlib.crc32(index))
    tail = struct.pack("<I", len(index) // 4 - 1) + header[6:8]
    path = tmp_path / "RC_2018-01.xz"
    path.write_bytes(header + b"".join(blocks) + index + struct.pack("<I", A.zlib.crc32(tail)) + tail + b"YZ" + bytes(8))
    assert lzma.decompress(path.read_bytes()[:-8]) == b"".join(pieces)
    assert len(find_parts(spark, [str(path)], 1)) == len(pieces)
    got = [r.value for r in read_dumps(spark, [str(path)], part_bytes=1).orderBy("pos").collect()]
    assert got == b"".join(pieces).decode().split("\n")


@pytest.mark.parametrize("extension", ["xz", "zst"])
def test_a_broken_part_breaks_the_file(spark, tmp_path, extension):
    pieces = [b"".join(b'{"n": %d}\n' % (1000 * k + i) for i in range(400)) for k in range(6)]
    data = frames(extension, None, pieces)
    path = tmp_path / f"RC_2018-01.{extension}"
    path.write_bytes(data[:-10])
    assert read_dumps(spark, [str(path)], part_bytes=1).where("error is not null").count() >= 1


def test_native_checks(spark, tmp_path):
    for extension in ("gz", "bz2"):
        whole = PACK[extension](b"one\ntwo\n" * 500)
        (tmp_path / f"RC_2018-01.{extension}").write_bytes(whole)
        (tmp_path / f"RC_2018-02.{extension}").write_bytes(damaged(whole, "no end"))
    paths = [r.path for r in list_files(spark, str(tmp_path)).collect()]
    short = lambda found: sorted(p.rsplit("/", 1)[-1] for p in found)
    assert short(broken_ends(spark, paths)) == ["RC_2018-02.bz2"]
    assert short(broken_inside(spark, paths)) == ["RC_2018-02.bz2", "RC_2018-02.gz"]
