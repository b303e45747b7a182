"""Merkle manifest against a plain recursive version, on awkward tables and small bands."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from modtally.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, rank string, tree binary, root int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Root and, per node, its siblings from below."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = range(i // 3 * 3, min(i // 3 * 3 + 3, len(nodes)))
            paths[k].append([nodes[j] for j in run if j != i])
        nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        at = [i // 3 for i in at]
    return nodes[0], paths


def plain(rows):
    """Sorted result rows: doc_id, leaf, subroot, root, all siblings."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r[:5]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names]
    root, upper = tree([t[0] for t in trees])
    out = []
    for name, (subroot, paths), up in zip(names, trees, upper, strict=True):
        for x, path in zip(sorted(groups[name], key=lambda x: x[:3]), paths, strict=True):
            out.append((x[3][0], x[2], subroot, root, "".join(sum(path + up, []))))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", b"y", 2) for r in rows], SCHEMA)


def got(spark, rows, where=None):
    df = table(spark, rows)
    where = F.lit(False) if where is None else where
    found = merkle.tamper_proofs(df, FIELDS, "source", "doc_id", {"text": F.replace("text", F.lit("\n"), F.lit(""))}, where)
    return found.select("doc_id", "leaf", "subroot", "root", merkle.siblings(F.col("proof")).alias("passed"), "folded_root", "verified").collect()


def rows_of(sizes):
    out, i = [], 0
    for name, n in sizes.items():
        for _ in range(n):
            i += 1
            out.append((i * 7 % 1009, name, "en" if i % 3 else None, i, f"text {i}\nline" if i % 4 else ""))
    return out


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 2, None: 1}, {"a": 81, "b": 82, "c": 80, "": 4}, {None: 250, "é": 9, "z": 1, "Z": 3}])
def test_plain(spark, sizes):
    rows = rows_of(sizes)
    found = got(spark, rows)
    assert sorted((tuple(r)[:5] for r in found), key=repr) == plain(rows)
    assert all(r.verified and r.folded_root == r.root for r in found)


def test_many_groups_and_a_hot_one(spark):
    """A hot group lies in several range partitions."""
    rows = rows_of({**{f"s{i}": 1 + i % 2 for i in range(120)}, "hot": 900})
    assert sorted((tuple(r)[:5] for r in got(spark, rows)), key=repr) == plain(rows)


def test_repeated_rows_null_ids_and_one_id_for_many(spark):
    same = (5, "a", "en", 3, "abc")
    rows = [same] * 90 + [(None, "a", None, None, None)] * 3 + [(5, "a", "en", i, f"t{i}") for i in range(40)] + [(None, None, None, None, None)]
    assert sorted((tuple(r)[:5] for r in got(spark, rows)), key=repr) == plain(rows)


def test_tampering_is_found(spark):
    rows = rows_of({"a": 30, "b": 5})
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    texts = {r[0]: r[4] for r in rows}
    for r in got(spark, rows, even):
        hit = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in texts[r.doc_id]
        assert r.verified != hit and (r.folded_root == r.root) != hit


def test_no_rows_and_long_texts(spark):
    assert got(spark, []) == []
    rows = [(i, "s", "en", 1, "x" * (300_000 * (i % 2))) for i in range(6)]
    assert sorted((tuple(r)[:5] for r in got(spark, rows)), key=repr) == plain(rows)


def test_some_leaves_only(spark):
    """Requests for a few leaves get their proofs and nothing else."""
    rows = rows_of({"a": 200, "b": 3})
    made = merkle.build_manifest(table(spark, rows), merkle.leaf_digest(*map(F.col, FIELDS)), F.col("source"), F.col("doc_id"), [F.col("doc_id").alias("id")])
    some = made.leaves.where("id % 10 = 3")
    found = merkle.prove(made, some, ["id"]).withColumn("passed", merkle.siblings(F.col("proof"))).select("id", "leaf", "subroot", "root", "passed")
    want = [x for x in plain(rows) if x[0] % 10 == 3]
    assert sorted(map(tuple, found.collect()), key=repr) == want and want
