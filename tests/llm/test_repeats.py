"""Near-duplicates, repeated windows and repeated bytes against brute force."""

import brute
import numpy as np
import pytest
from texts import corpus, frame

from modtally.llm import suffix_array, superkmers, superminhash, winnow
from modtally.llm.components import connected_components


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, k, percent):
    docs = corpus()
    got = {tuple(r) for r in superminhash.near_duplicates(frame(spark, docs).repartition(5), k, percent).collect()}
    assert got == brute.near_duplicates(docs, k, percent)
    assert sum(not r[3] for r in got) >= 10


def test_near_duplicates_over_blocks(spark, monkeypatch):
    """Families larger than a block give the same groups."""
    monkeypatch.setattr(superminhash, "BLOCK", 3)
    docs = corpus(1)
    got = {tuple(r) for r in superminhash.near_duplicates(frame(spark, docs), 3, 85).collect()}
    assert got == brute.near_duplicates(docs, 3, 85)


def test_near_duplicates_odd_tables(spark):
    assert superminhash.near_duplicates(empty(spark)).collect() == []
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "a b c d"), (3, None)]
    got = sorted((tuple(r) for r in superminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 2, 1, True), (3, 0, 3, True)], key=repr)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    common, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 200, 200))
    both = np.concatenate((common, a, common, b))
    registers = superminhash.signatures(both, np.array([0, 800, 1600]), 1024)
    assert abs((registers[0] == registers[1]).mean() - 0.6) < 0.05
    # Every register of a full row has been offered a place.
    assert (registers < np.uint64(1024 << 32)).all()


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1100)] + [(5, 7), (5, 5)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(path + star, "a long, b long")).collect()))
    assert got == {i: 100 for i in range(100, 161)} | {i: 5 for i in [5, 7, *range(1000, 1100)]}


@pytest.mark.parametrize("common", [64, 3])
def test_repeated_windows(spark, monkeypatch, common):
    """With and without frequent k-grams, spread over few and many tasks."""
    monkeypatch.setattr(winnow, "COMMON_LEAST", common)
    docs = corpus(2)
    want = brute.repeated_windows(docs, 20)
    assert sum(x[1] for x in want.values()) > 1000
    for parts in (1, 9):
        rows = superkmers.remove_repeats(frame(spark, docs).repartition(parts), 20).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == want


def test_repeated_windows_of_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (1, text), (2, text + " z"), (None, text), (3, None)]
    got = superkmers.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 20).collect()
    # The row without an id comes first; both rows of id 1 repeat it, document 2 keeps its last word.
    assert sorted((r.doc_id or 0, r.n_removed, r.kept.split()[-1:]) for r in got) == [(0, 0, ["w29"]), (1, 30, []), (1, 30, []), (2, 30, ["z"]), (3, 0, [])]
    assert superkmers.remove_repeats(empty(spark)).collect() == []


@pytest.mark.parametrize("common", [64, 3])
def test_repeated_bytes(spark, monkeypatch, common):
    monkeypatch.setattr(winnow, "COMMON_LEAST", common)
    docs = corpus(3)
    want = brute.repeated_bytes(docs, 200)
    assert sum(x[1] for x in want.values()) > 5000
    for parts in (1, 9):
        rows = suffix_array.remove_repeated_bytes(frame(spark, docs).repartition(parts), 200).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want


def test_repeated_bytes_odd_tables(spark):
    assert suffix_array.remove_repeated_bytes(empty(spark)).collect() == []
    text = "".join(chr(97 + i * i % 23) for i in range(150)) + "".join(chr(97 + i * i % 19) for i in range(150))
    rows = [(1, text), (1, text), (None, "y" + text), (4, "short")]
    got = suffix_array.remove_repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 200).collect()
    assert sorted((r.doc_id or 0, r.n_removed, r.n_spans) for r in got) == [(0, 300, 1), (1, 300, 1), (1, 300, 1), (4, 0, 0)]


def test_multikey_order_is_lexicographic():
    rng = np.random.default_rng(1)
    table = rng.integers(0, 3, (500, 6)).astype(np.uint64)
    order = superminhash.np.asarray(suffix_array.multikey_order(table))
    assert [tuple(r) for r in table[order]] == sorted(map(tuple, table))
    assert sorted(order.tolist()) == list(range(500))
