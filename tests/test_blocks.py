import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from modtally.operators.blocks import aggregate_blocks, keep_last, number_blocks
from modtally.schemas import BLOCK_COLUMNS

SCHEMA = "type string, month string, id string, created_utc bigint, subreddit string, score bigint, is_removed boolean, pos bigint"


def base36(n):
    digits = ""
    while n:
        n, r = divmod(n, 36)
        digits = "0123456789abcdefghijklmnopqrstuvwxyz"[r] + digits
    return digits or "0"


def expected_blocks(rows, n_rows, dropna=True):
    """The definition over plain lists. rows: (month, id number, time, community, score, removed)."""
    last = {}
    for row in rows:
        last[(row[0], row[1])] = row
    groups = {}
    for row in last.values():
        groups.setdefault((row[0], row[3]), []).append(row)
    result = []
    for (month, community), members in groups.items():
        members.sort(key=lambda r: (r[2], r[1]))
        for start in range(0, len(members), n_rows):
            block = members[start : start + n_rows]
            positive = sum(r[4] for r in block if r[4] > 0)
            removed = [r for r in block if r[5] and r[4] > 1]
            if not removed and dropna:
                continue
            top = max(removed, key=lambda r: r[4], default=None)
            total = sum(r[4] for r in removed)
            result.append(
                ("comments", month, community, positive, len(block), block[-1][2], base36(block[-1][1]), total / positive if removed else 0.0,
                 total, len(removed), top[4] if top else 0, base36(top[1]) if top else "")
            )
    return sorted(result)


def frame(spark, rows):
    data = [("comments", m, base36(i), t, c, s, r, n) for n, (m, i, t, c, s, r) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def actual(spark, rows, n_rows, **options):
    df = aggregate_blocks(frame(spark, rows), n_rows, **options)
    return sorted(tuple(r) for r in df.select("type", "month", *BLOCK_COLUMNS).collect())


def random_rows(seed, count, communities=("A", "b", "null")):
    rnd = random.Random(seed)
    return [
        (rnd.choice(["2018-01", "2018-02"]), rnd.randrange(1, count), 1500000000 + rnd.randrange(count // 4 + 1), rnd.choice(communities), rnd.randrange(-3, 6), rnd.random() < 0.3)
        for _ in range(count)
    ]


@pytest.mark.parametrize("dropna", [True, False])
@pytest.mark.parametrize("n_rows", [1, 7, 50])
def test_blocks_equal_the_definition(spark, n_rows, dropna):
    rows = random_rows(n_rows, 600)
    assert actual(spark, rows, n_rows, dropna=dropna) == expected_blocks(rows, n_rows, dropna)


@pytest.mark.parametrize("limit", [1, 40, 150])
def test_large_communities_take_the_other_path_with_the_same_result(spark, limit):
    rows = random_rows(3, 900, communities=("hot",) * 8 + ("cold", "tiny"))
    assert actual(spark, rows, 10, max_group_rows=limit) == expected_blocks(rows, 10)


def test_one_moment_holds_every_item(spark):
    rows = [("2018-01", i, 1500000000, "hot", i % 5, i % 3 == 0) for i in range(1, 500)]
    assert actual(spark, rows, 20, max_group_rows=10) == expected_blocks(rows, 20)


item = st.tuples(
    st.just("2018-01"), st.integers(1, 12), st.integers(0, 4), st.sampled_from(["a", "B"]), st.integers(-2, 4), st.booleans()
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(item, min_size=1, max_size=30), st.integers(1, 5))
def test_blocks_property(spark, rows, n_rows):
    assert actual(spark, rows, n_rows, max_group_rows=None) == expected_blocks(rows, n_rows)


def test_ids_are_ordered_as_numbers(spark):
    rows = [("m", int(i, 36), 5, "a", 2, True) for i in ("zz", "100", "9", "z")]
    positions = {r.id: r.position for r in number_blocks(frame(spark, rows).drop("pos"), 10).collect()}
    assert positions == {"9": 0, "z": 1, "zz": 2, "100": 3}


def test_keep_last_is_per_month(spark):
    rows = [("2018-01", 1, 5, "a", 1, False), ("2018-01", 1, 5, "b", 2, False), ("2018-02", 1, 5, "c", 3, False)]
    kept = keep_last(frame(spark, rows)).collect()
    assert sorted((r.month, r.subreddit, r.score) for r in kept) == [("2018-01", "b", 2), ("2018-02", "c", 3)]


def test_no_items(spark):
    assert actual(spark, [], 10) == []


def test_plan_shuffles_twice_and_aggregates_by_hash(spark):
    plan = aggregate_blocks(frame(spark, random_rows(1, 50)), 10, max_group_rows=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
