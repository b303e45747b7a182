import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from modtally.operators.merge import merge_short_tails
from modtally.schemas import BLOCK_COLUMNS, BLOCKS
from modtally.sources.tables import read_blocks_csv

# Blocks of two communities and their merged rows (blocks of 100, merged below 50).
GOLDEN_IN = [
    ("dankmemes", 513, 100, 1541031732, "e8tltrt", 0.01364522417153996, 7, 1, 7, "e8tlqub"),
    ("dankmemes", 1458, 100, 1541032375, "e8tmgfc", 0.04663923182441701, 68, 1, 68, "e8tmfi9"),
    ("dankmemes", 163, 29, 1541032582, "e8tmnqw", 0.147239263803681, 24, 3, 15, "e8tmm8g"),
    ("worldnews", 2368, 100, 1538352759, "e6xv4q0", 0.0059121621621621625, 14, 2, 12, "e6xuy4c"),
    ("worldnews", 801, 100, 1538353526, "e6xvy2b", 0.004993757802746567, 4, 2, 2, "e6xvn5c"),
    ("worldnews", 331, 39, 1538354077, "e6xwiaj", 0.006042296072507553, 2, 1, 2, "e6xwh8b"),
    ("worldnews", 812, 100, 1541031365, "e8tlghr", 0.0024630541871921183, 2, 1, 2, "e8tlami"),
    ("worldnews", 4404, 100, 1541031847, "e8tlxvj", 0.003860127157129882, 17, 1, 17, "e8tlvn7"),
]
GOLDEN_MERGED = [
    ("dankmemes", 1621, 129, 1541032582, "e8tmnqw", 0.0567550894509562, 92, 4, 68, "e8tmfi9"),
    ("worldnews", 1132, 139, 1538354077, "e6xwiaj", 0.00530035335689046, 6, 3, 2, "e6xwh8b"),
]


def rows_of(df):
    return sorted(tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in df.select(*BLOCK_COLUMNS).collect())


@pytest.mark.parametrize("limit", [None, 1])
def test_golden_rows(spark, limit):
    merged = merge_short_tails(spark.createDataFrame(GOLDEN_IN, BLOCKS), 50, 100, max_group_rows=limit)
    untouched = [r for r in GOLDEN_IN if r[2] == 100 and r[4] not in ("e8tmgfc", "e6xvy2b")]
    expected = [tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in untouched + GOLDEN_MERGED]
    assert rows_of(merged) == sorted(expected)


@pytest.mark.skipif("BLOCKS_GOLDEN_DIR" not in os.environ, reason="needs a folder with monthly/ and merged/ block CSVs")
def test_golden_folder(spark):
    root = os.environ["BLOCKS_GOLDEN_DIR"]
    monthly = read_blocks_csv(spark, sorted(glob.glob(f"{root}/monthly/*.csv")))
    expected = read_blocks_csv(spark, sorted(glob.glob(f"{root}/merged/*.csv")))
    assert rows_of(merge_short_tails(monthly, 50, 100)) == rows_of(expected)


def stated(rows, minimum, full):
    """The rule over a list: short blocks join the full block directly before them."""
    out = []
    previous_raw = None
    for row in sorted(rows, key=lambda r: (r[0], r[3], int(r[4], 36))):
        joins = (
            previous_raw is not None
            and previous_raw[0] == row[0]
            and row[2] < minimum
            and previous_raw[2] == full
        )
        if joins:
            full_row = out.pop()
            late, early = (row, full_row) if full_row[3] < row[3] else (full_row, row)
            best = early if early[8] > late[8] else late
            removed, positive = row[6] + full_row[6], row[1] + full_row[1]
            out.append((row[0], positive, row[2] + full_row[2], late[3], late[4], removed / positive, removed, row[7] + full_row[7], best[8], best[9]))
        else:
            out.append(row)
        previous_raw = row
    return sorted(tuple(round(v, 12) if isinstance(v, float) else v for v in (r[0].lower(), *r[1:])) for r in out)


def random_blocks(seed, count):
    rnd = random.Random(seed)
    ids = rnd.sample(range(36**3, 36**4), count)
    encode = lambda n: "".join("0123456789abcdefghijklmnopqrstuvwxyz"[n // 36**k % 36] for k in (3, 2, 1, 0))
    rows = []
    for i in ids:
        positive, removed = rnd.randrange(20, 90), rnd.randrange(2, 20)
        rows.append((rnd.choice(["One", "two", "Three"]), positive, rnd.choice([10, 10, 10, 7, 4, 3, 1]), rnd.randrange(count // 3), encode(i).lstrip("0"), removed / positive, removed, 1, rnd.randrange(2, 6), encode(i)))
    return rows


@pytest.mark.parametrize("minimum", [5, 10])
@pytest.mark.parametrize("limit", [None, 20])
def test_merge_equals_the_stated_rule(spark, minimum, limit):
    rows = random_blocks(minimum, 400)
    merged = merge_short_tails(spark.createDataFrame(rows, BLOCKS), minimum, 10, max_group_rows=limit)
    expected = stated(rows, minimum, 10)
    assert len(expected) < len(rows)
    assert rows_of(merged) == expected


def test_equal_times_keep_dump_order(spark):
    full = ("a", 20, 10, 7, "zz", 0.1, 2, 1, 2, "z1")
    short = ("a", 10, 2, 7, "11", 0.2, 2, 1, 2, "12")
    df = spark.createDataFrame([(*full, "2018-01"), (*short, "2018-02")], [*BLOCK_COLUMNS, "month"])
    merged = merge_short_tails(df, 5, 10)
    # At equal times the full block counts as the later one.
    assert [(r.total_items, r.last_id, r.id_of_max_pos_removed_item) for r in merged.collect()] == [(12, "zz", "z1")]


def test_types_do_not_mix(spark):
    full = ("a", 20, 10, 7, "zz", 0.1, 2, 1, 2, "z1")
    short = ("a", 10, 2, 8, "11", 0.2, 2, 1, 2, "12")
    df = spark.createDataFrame([(*full, "posts"), (*short, "comments")], [*BLOCK_COLUMNS, "type"])
    assert merge_short_tails(df, 5, 10).count() == 2


def test_chaining_parameters_are_refused(spark):
    with pytest.raises(ValueError):
        merge_short_tails(spark.createDataFrame([], BLOCKS), 11, 10)


def test_no_blocks(spark):
    assert merge_short_tails(spark.createDataFrame([], BLOCKS), 5, 10).where(F.lit(True)).count() == 0
