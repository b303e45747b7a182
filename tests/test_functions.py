import html
import re

import pytest
from pyspark.sql import functions as F

from modtally.functions import (
    add_fullname_prefix,
    clean_text,
    id_to_int,
    int_to_id,
    normalise_link_id,
    period_series,
    strip_backslashes,
    with_name_parts,
)


def values(spark, column, data, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_base36_both_ways(spark):
    ids = ["0", "z", "10", "e8tm2x3", "zzzzzzz", "E8TM"]
    assert values(spark, id_to_int, ids) == [int(i, 36) for i in ids]
    numbers = [0, 35, 36, 123456789012, -37, None]
    assert values(spark, int_to_id, numbers, "bigint") == ["0", "z", "10", "1kpqzg2c", "-11", ""]


def test_leading_zeros_are_not_kept(spark):
    assert values(spark, lambda c: int_to_id(id_to_int(c)), ["00abc"]) == ["abc"]


TEXTS = [
    "a &amp; b &lt;c&gt;",
    "  leading\tand\n\ntrailing  ",
    "no break   em 　 wide",
    "sep\x1c\x1d\x1e\x1fend",
    "&nbsp;&nbsp;x&nbsp;",
    "&amp;copy; once only",
    "&copy &notit; &#x41;&#66; &unknown;",
    "x" * 299 + "\U0001f600\U0001f600",
    "y " * 400,
    "",
    "&#xD800;",
]


def test_clean_text_equals_its_definition(spark):
    expected = [re.sub(r"\s+", " ", html.unescape(t)).strip()[:300] for t in TEXTS]
    assert values(spark, clean_text, TEXTS) == expected
    assert values(spark, clean_text, [None]) == [None]


def test_link_ids(spark):
    assert values(spark, normalise_link_id, ["t3_abc", "1234", None]) == ["abc", "ya", None]
    assert values(spark, lambda c: add_fullname_prefix(c, "comments"), ["abc"]) == ["t1_abc"]
    assert values(spark, lambda c: add_fullname_prefix(c, "posts"), ["abc"]) == ["t3_abc"]


def test_strip_backslashes(spark):
    assert values(spark, strip_backslashes, [r"\[removed\]", r"a\\b"]) == ["[removed]", "ab"]


def test_name_parts(spark):
    names = ["RC_2018-09.xz", "RS_2020-01-31.ZST", "RC_2008.bz2", "RS_v2_2010-02.xz", "notes.txt"]
    df = with_name_parts(spark.createDataFrame([(n,) for n in names], "name string"))
    got = {r["name"]: (r["base"], r["ext"], r["type"], r["period"], r["month"], r["is_daily"]) for r in df.collect()}
    assert got["RC_2018-09.xz"] == ("RC_2018-09", ".xz", "comments", "2018-09", "2018-09", False)
    assert got["RS_2020-01-31.ZST"] == ("RS_2020-01-31", ".zst", "posts", "2020-01-31", "2020-01", True)
    assert got["RC_2008.bz2"][3:] == ("2008", "2008", False)
    assert got["RS_v2_2010-02.xz"][2:5] == ("posts", "2010-02", "2010-02")


def test_period_series(spark):
    series = lambda a, b: [r[0] for r in period_series(spark, a, b).orderBy("period").collect()]
    assert series("2019-11", "2020-02") == ["2019-11", "2019-12", "2020-01", "2020-02"]
    assert series("2020-02-28", "2020-03-01") == ["2020-02-28", "2020-02-29", "2020-03-01"]
    assert series("2020-05", "2020-05") == ["2020-05"]
    with pytest.raises(ValueError):
        period_series(spark, "2020-01", "2020-01-05")
