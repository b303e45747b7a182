"""Embedding near-duplicates against brute force."""

import brute
import numpy as np

from modtally.llm import flat_graph


def exact(rows, least):
    good = {i: np.array(v, float) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in good.items()}
    links = [(a, b) for a in unit for b in unit if a < b and unit[a] @ unit[b] >= least]
    component = brute.components([i for i, _ in rows], links)
    degree = {i: sum(i in pair for pair in links) for i, _ in rows}
    return {(i, degree[i], component[i], component[i] == i) for i, _ in rows}


def test_links_and_groups(spark):
    rng = np.random.default_rng(0)
    rows = []
    for c in rng.normal(size=(25, 8)):
        rows += [(c + rng.normal(size=8) * s).astype(np.float32).tolist() for s in rng.uniform(0, 0.4, 12)]
    rows += [rows[3]] * 20 + [[0.0] * 8, None, [1.0] * 7 + [None], [float("nan")] * 8, [float("inf")] + [1.0] * 7, [-0.0] * 8]
    rows += [(np.array(rows[0]) * 1e-20).tolist(), (np.array(rows[0]) * 1e18).tolist()]
    rows = [(int(i) * 7, v) for i, v in zip(rng.permutation(len(rows)), rows, strict=True)]
    table = spark.createDataFrame([(i, v, 1, "k") for i, v in rows], "vec_id long, embedding array<float>, id int, key string")
    result, recall = flat_graph.near_vectors(table, 0.95)
    assert recall >= 0.99
    assert {tuple(r) for r in result.collect()} == exact(rows, 0.95)


def test_shards_and_recall(spark, monkeypatch):
    """Many small shards: the audit still sees nearly every link."""
    monkeypatch.setattr(flat_graph, "SHARD", 20)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(60, 16))
    rows = [(i, (centres[i % 60] + rng.normal(size=16) * 0.15).tolist()) for i in range(900)]
    result, recall = flat_graph.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.95)
    want = {r[0]: r[1] for r in exact(rows, 0.95)}
    found = sum(r.n_links for r in result.collect())
    assert recall >= 0.9 and 0.97 * sum(want.values()) <= found <= sum(want.values()) and found > 0


def test_odd_tables(spark):
    nothing = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert flat_graph.near_vectors(nothing)[0].collect() == []
    rows = [(5, [1.0, 0.0]), (5, [1.0, 0.0]), (None, [1.0, 0.0]), (6, None)]
    got = flat_graph.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))[0].collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(5, 1, 5, True), (5, 1, 5, True), (None, 0, None, True), (6, 0, 6, True)]))


def blob(rng, n, size, others):
    """A dense group that no shard holds, and rows that link with nothing."""
    centre = rng.normal(size=size)
    rows = [centre / np.linalg.norm(centre) + rng.normal(size=size) * 0.2 / np.sqrt(size) for _ in range(n)]
    rows += [rng.normal(size=size) for _ in range(others)]
    return [(i, rows[j].tolist()) for i, j in enumerate(rng.permutation(len(rows)))]


def check_blob(spark, rows, share=1.0, **options):
    rows = [*rows, *rows[:9]]
    result, recall = flat_graph.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.95, **options)
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.95).sum(axis=1) - 1
    want = {i: n for (i, _), n in zip(rows, links.tolist(), strict=True)}
    got = result.collect()
    assert recall >= 0.99 and all(r.n_links <= want[r.vec_id] for r in got) and sum(r.n_links for r in got) >= share * links.sum()
    assert {r.component_id for r in got if r.n_links > 20} == {min(i for i, n in want.items() if n > 20)}


def test_dense_group_over_many_shards(spark, monkeypatch):
    """The overlap never reaches all shards of the group; short shards are compared exactly."""
    for name, value in {"SHARD": 4, "LISTED": 10**9, "ASKED": 150, "AUDIT_EVERY": 1}.items():
        monkeypatch.setattr(flat_graph, name, value, raising=False)
    check_blob(spark, blob(np.random.default_rng(2), 600, 32, 300), 0.99, overlap=12)


def test_dense_group_is_not_listed(spark, monkeypatch):
    """Shards of many links are compared before any list of pairs is made."""
    for name, value in {"SHARD": 30, "AUDIT_EVERY": 1}.items():
        monkeypatch.setattr(flat_graph, name, value)
    listed, find = [], flat_graph.links_of
    monkeypatch.setattr(flat_graph, "links_of", lambda *a: listed.append(find(*a)) or listed[-1])
    check_blob(spark, blob(np.random.default_rng(3), 600, 32, 300))
    assert all(links.count() < 2_000 for links in listed)
