import pytest

from modtally.operators import enrich as E
from modtally.operators.constraints import ConstraintViolation, check, check_unique, constraint_report
from modtally.schemas import BLOCKS, COMMENTS, POSTS
from modtally.session import materialise

VERSION = "id string, body string, created_utc bigint, link_id string, pos bigint"


def blocks(spark, *tops):
    return spark.createDataFrame([("a", 9, 10, 5, f"l{i}", 0.5, 4, 1, score, i) for i, score in tops], BLOCKS)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_first_version_with_text_wins_else_the_last(spark):
    rows = [
        ("x", "[removed]", 1, "t3_p", 1),
        ("x", "first", 2, "t3_p", 2),
        ("x", "\\[removed\\]", 3, "t3_p", 3),
        ("x", "second", 4, "t3_p", 4),
        ("y", "[removed]", 5, "t3_p", 5),
        ("y", "\\[removed\\]", 6, "t3_p", 6),
        ("z", "only", 7, "t3_p", 7),
    ]
    df = spark.createDataFrame(rows, VERSION)
    got = {r.id: (r.body, r.created_utc) for r in E.resolve_versions(df).collect()}
    assert got == {"x": ("first", 2), "y": ("\\[removed\\]", 6), "z": ("only", 7)}
    got = {r.id: r.created_utc for r in E.resolve_versions(df.drop("body")).collect()}
    assert got == {"x": 4, "y": 6, "z": 7}


def test_archived(spark):
    rows = [
        ("old", "[removed]", 1609257599, "p", 1),
        ("new", "[removed]", 1609257600, "p", 1),
        ("text", "still here", 1700000000, "p", 1),
        ("blank time", "[removed]", None, "p", 1),
        ("no body", None, None, "p", 1),
    ]
    df = spark.createDataFrame(rows, COMMENTS)
    got = {r.id: r.a for r in df.select("id", E.archived(df, "comments").alias("a")).collect()}
    assert got == {"old": True, "new": False, "text": True, "blank time": False, "no body": True}


def test_ids_to_lookup(spark):
    tops = blocks(spark, ("a", 2), ("b", 3), ("c", 4), ("", 5))
    stored = spark.createDataFrame([("a", "text", 5, "p", 2)], COMMENTS)
    dead = spark.createDataFrame([("b",)], "id string")
    assert ids(E.ids_to_lookup(tops, "comments")) == ["a", "b", "c"]
    assert ids(E.ids_to_lookup(tops, "comments", stored, dead)) == ["c"]
    assert ids(E.ids_to_lookup(tops, "comments", None, dead)) == ["a", "c"]
    # As before: without any final row the list of inaccessible ids is not applied.
    assert ids(E.ids_to_lookup(tops, "comments", None, dead, compat=True)) == ["a", "b", "c"]
    assert ids(E.ids_to_lookup(tops, "comments", stored, dead, compat=True)) == ["c"]
    parents = spark.createDataFrame([("k", "x", 1, "p9", 1), ("m", "x", 1, "a", 1)], COMMENTS)
    assert ids(E.ids_to_lookup(tops, "posts", comments=parents)) == ["a", "b", "c", "p9"]


def test_enrich_keeps_what_is_final_and_looks_up_the_rest(spark):
    tops = blocks(spark, ("a", 2), ("b", 3), ("c", 4), ("d", 5))
    stored = spark.createDataFrame(
        [("a", "final", 5, "p", 0), ("b", "[removed]", 1700000000, "p", 0), ("gone", "[removed]", 1700000000, "q", 0)], COMMENTS
    )
    versions = spark.createDataFrame(
        [("a", "other", 6, "t3_z", 1), ("b", "back&amp;again", 1700000001, "t3_p", 2), ("c", "new\n text", 8, "t3_r", 3)], VERSION
    )
    rows, missing = E.enrich(tops, versions, "comments", stored)
    assert rows.columns == ["id", "body", "created_utc", "link_id", "score"]
    assert sorted(map(tuple, rows.collect())) == [
        ("a", "final", 5, "p", 2),
        ("b", "back&again", 1700000001, "p", 3),
        ("c", "new text", 8, "r", 4),
        ("gone", "[removed]", 1700000000, "q", None),
    ]
    assert ids(missing) == ["d"]
    dead = spark.createDataFrame([("old",), ("d",)], "id string")
    assert ids(E.extend_inaccessible(dead, missing)) == ["d", "old"]


def test_enrich_posts(spark):
    tops = blocks(spark, ("a", 2))
    versions = spark.createDataFrame(
        [("a", 5, "7", "T&lt;1&gt;", 1), ("par", 6, "8", "parent", 2), ("unused", 6, "8", "x", 3)],
        "id string, created_utc bigint, num_comments string, title string, pos bigint",
    )
    comments = spark.createDataFrame([("k", "x", 1, "par", 1)], COMMENTS)
    stored = spark.createDataFrame([("s", 1, 2, "stored", 9)], POSTS)
    rows, missing = E.enrich(tops, versions, "posts", stored, comments=comments)
    assert sorted(map(tuple, rows.collect())) == [("a", 5, 7, "T<1>", 2), ("par", 6, 8, "parent", None), ("s", 1, 2, "stored", None)]
    assert ids(missing) == []


def test_other_fields_are_refused(spark):
    stored = spark.createDataFrame([("a", "x")], "id string, extra string")
    with pytest.raises(ValueError, match="extra"):
        E.enrich(blocks(spark, ("a", 2)), None, "comments", stored)


def test_constraints(spark):
    good = spark.createDataFrame([("a", "x", 1, "p", None)], COMMENTS)
    check({"comments": good})
    bad = spark.createDataFrame([("a", "x" * 301, 1, "p", None), ("a", None, None, "p" * 16, 1)], COMMENTS)
    report = {(r.column, r.rule): r.violations for r in constraint_report({"comments": bad}).collect()}
    assert report[("id", "primary key")] == 1
    assert report[("body", "length <= 300")] == 1
    assert report[("created_utc", "not null")] == 1
    assert report[("link_id", "length <= 15")] == 1
    assert report[("id", "not null")] == 0
    with pytest.raises(ConstraintViolation, match="primary key"):
        check({"comments": bad})
    with pytest.raises(ConstraintViolation):
        check_unique(bad, "id", "comments")
    check_unique(good, "id", "comments")


def test_materialise_pins_partitions(spark):
    df = materialise(spark.range(100).repartition(3))
    first = [r.id for r in df.collect()]
    assert first == [r.id for r in df.collect()] and len(set(first)) == 100
