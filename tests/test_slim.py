import json

import pytest

from modtally.operators.slim import classify, kept_items, quarantined, rejected_files

COMMENT = {"id": "c1", "created_utc": 1500000000, "subreddit": "Abc", "score": 5, "body": "hello", "author": "someone"}
POST = {"id": "p1", "created_utc": 1500000000, "subreddit": "Abc", "score": 5, "author": "someone", "is_robot_indexable": True}


def without(record, *keys):
    return {k: v for k, v in record.items() if k not in keys}


def lines(spark, rows):
    """rows: (type, record or raw text[, file])"""
    data = [
        (r[1] if isinstance(r[1], str) else json.dumps(r[1]), r[2] if len(r) > 2 else "f", r[0], "2018-01", i)
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(data, "value string, file string, type string, month string, pos int")


def one(spark, kind, record):
    return classify(lines(spark, [(kind, record)])).first()


@pytest.mark.parametrize(
    "change, removed",
    [
        ({}, False),
        ({"body": "[removed]"}, False),
        ({"author": "[deleted]"}, False),
        ({"body": "[removed]", "author": "[deleted]"}, True),
        ({"body": "\\[removed\\]", "author": "\\[deleted\\]"}, True),
        ({"body": "[removed] ", "author": "[deleted]"}, False),
    ],
)
def test_removed_comments(spark, change, removed):
    row = one(spark, "comments", {**COMMENT, **change})
    assert (row.outcome, row.is_removed) == ("keep", removed)


@pytest.mark.parametrize(
    "change, removed",
    [
        ({}, False),
        ({"is_robot_indexable": False}, True),
        ({"is_robot_indexable": None}, True),
        ({"is_robot_indexable": 0}, True),
        ({"is_robot_indexable": False, "author": "[deleted]"}, False),
        # Presence of the first flag decides, even when it is null.
        ({"is_robot_indexable": None, "is_crosspostable": True}, True),
        ({"is_robot_indexable": True, "is_crosspostable": False}, False),
    ],
)
def test_removed_posts(spark, change, removed):
    row = one(spark, "posts", {**POST, **change})
    assert (row.outcome, row.is_removed) == ("keep", removed)


@pytest.mark.parametrize("flag, removed", [(True, False), (False, True), (None, True)])
def test_older_posts_use_the_other_flag(spark, flag, removed):
    row = one(spark, "posts", {**without(POST, "is_robot_indexable"), "is_crosspostable": flag})
    assert (row.outcome, row.is_removed) == ("keep", removed)


def test_post_without_flags_rejects_its_file(spark):
    rows = [
        ("posts", POST, "good"),
        ("posts", {**without(POST, "is_robot_indexable"), "promoted": True}, "bad"),
        ("posts", {**POST, "id": "p2"}, "bad"),
        ("posts", {**without(POST, "is_robot_indexable"), "id": "p3", "author": "[deleted]"}, "good"),
    ]
    classified = classify(lines(spark, rows))
    assert [r.file for r in rejected_files(classified).collect()] == ["bad"]
    assert sorted(r.id for r in kept_items(classified).collect()) == ["p1", "p3"]


@pytest.mark.parametrize(
    "kind, record, outcome, reason",
    [
        ("comments", "{not json", "quarantine", "malformed"),
        ("comments", without(COMMENT, "body"), "quarantine", "no body"),
        ("comments", {**without(COMMENT, "author"), "body": "[removed]"}, "quarantine", "no author"),
        ("comments", without(COMMENT, "author"), "keep", None),
        ("posts", without(POST, "author"), "quarantine", "no author"),
        ("comments", without(COMMENT, "score"), "quarantine", "no score"),
        ("comments", without(COMMENT, "subreddit"), "quarantine", "missing key"),
        ("posts", {**without(POST, "subreddit"), "promoted": True}, "ignore", "ignorable"),
        ("posts", {**without(POST, "subreddit"), "promoted": False}, "quarantine", "missing key"),
        ("posts", {**without(POST, "subreddit"), "permalink": "/comments/x/y/"}, "ignore", "ignorable"),
        ("posts", {**without(POST, "subreddit"), "permalink": "/r/u_someone/comments/x"}, "ignore", "ignorable"),
        ("posts", {**without(POST, "subreddit"), "permalink": "/r/u_other/comments/x"}, "quarantine", "missing key"),
        # A record with all keys is an item, advert or not.
        ("posts", {**POST, "promoted": True}, "keep", None),
        ("comments", {**COMMENT, "subreddit": None}, "quarantine", "bad value"),
        ("comments", {**COMMENT, "created_utc": "soon"}, "quarantine", "bad value"),
        ("comments", {**COMMENT, "id": "a b"}, "quarantine", "bad value"),
    ],
)
def test_outcomes(spark, kind, record, outcome, reason):
    row = one(spark, kind, record)
    assert (row.outcome, row.reason) == (outcome, reason)


def test_values(spark):
    rows = [
        ("comments", {**COMMENT, "score": None}),
        ("comments", {**COMMENT, "score": "-7", "created_utc": "1500000001"}),
        ("comments", {**COMMENT, "subreddit": "null", "score": 0}),
    ]
    got = [(r.created_utc, r.subreddit, r.score) for r in kept_items(classify(lines(spark, rows))).orderBy("pos").collect()]
    assert got == [(1500000000, "Abc", 1), (1500000001, "Abc", -7), (1500000000, "null", 0)]


def test_quarantine_keeps_the_line(spark):
    bad = quarantined(classify(lines(spark, [("comments", COMMENT), ("comments", "oops")])))
    assert [(r.raw, r.reason) for r in bad.collect()] == [("oops", "malformed")]


def test_strict_mode_fails(spark):
    classified = classify(lines(spark, [("comments", COMMENT), ("comments", "oops")]))
    assert kept_items(classified).count() == 1
    with pytest.raises(Exception, match="unexpected line: malformed"):
        kept_items(classified, strict=True).collect()
