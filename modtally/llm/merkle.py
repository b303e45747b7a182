"""Merkle manifest of a dataset: a content-addressed tree of digests, with a proof for every leaf.

``H`` is the lowercase hex sha256 of its inputs put together, digests as hex text. A row is a
leaf: ``H`` of its fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value.
The leaves of one group, ordered by the order column, form a tree: while several nodes remain,
every ``FAN`` consecutive ones become their ``H``, the last run with fewer, even one. What remains is the group's
root; the roots of all groups, ordered by group (null first, by bytes), form the upper tree.

The store keeps digest-to-children records. ``BAND`` levels are packed into one row under the
digest at their top, so that a tree of any height takes few rounds, each a hash join. Leaf
requests descend from the root by the digits of their rank and collect the children they do not
take; these path segments, reversed, are the proof from the leaf up.

A group of any size is ranked without a task of its own (``ranked``) and cut into runs
of ``FAN ** BAND`` nodes; no run is larger, and equal digests are stored once. Nothing is
collected. Null groups and null order values come first; rows of equal order go by leaf digest,
equal rows are leaves of their own next to each other. Null and empty texts differ (``-``,
``0:``). An empty table has no roots, no leaves and no proofs. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .frames import discard, write_shared

FAN = 3
# Levels of one stored record, and the nodes below its top at most.
BAND = 4
WIDTH = FAN**BAND
# Rows turned into Python objects at a time: each holds up to WIDTH requests and their record.
_ROWS = 256

_RECORDS = "array<struct<digest:binary,children:array<binary>>>"
_LEVEL = "struct<place:int,others:array<string>>"
PROOF = f"array<{_LEVEL}>"


def h(*inputs: Column) -> Column:
    return F.sha2(F.concat(*inputs).cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*fields: Column) -> Column:
    return h(*map(field, fields))


def tree_name(group: Column) -> Column:
    """A key that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def _digest(children: Sequence[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def raise_run(nodes: list[bytes], whole: bool) -> tuple[bytes, int, list[tuple[bytes, list[bytes]]]]:
    """Top digest, levels and records of one run. ``whole``: the run is all there is of its tree, and stops at one node."""
    records: list[tuple[bytes, list[bytes]]] = []
    levels = 0
    while len(nodes) > 1 if whole else levels < BAND:
        runs = [nodes[i : i + FAN] for i in range(0, len(nodes), FAN)]
        nodes = [_digest(r) for r in runs]
        records += zip(nodes, runs, strict=True)
        levels += 1
    return nodes[0], levels, records


@dataclass
class Tree:
    """``stores``, lowest levels first, and ``roots``: ``tree, digest``."""

    stores: list[DataFrame]
    roots: DataFrame


@dataclass
class Manifest:
    """``leaves``: the columns asked for, ``tree, rank, leaf``; ``groups``: ``tree, rank, digest`` of every group."""

    leaves: DataFrame
    lower: Tree
    groups: DataFrame
    upper: Tree


def grow(nodes: DataFrame) -> Tree:
    """Trees over ``tree, rank, digest``; ranks of a tree run from 0 without a gap."""
    rise, rows = raise_run, _ROWS

    def build(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                part = batch.slice(low, rows)
                # A run that starts at rank 0 and is not full is its whole tree; a full one gives the same either way.
                made = [
                    rise([n["digest"] for n in run], at == 0 and len(run) < WIDTH)
                    for at, run in zip(part["idx"].to_pylist(), part["nodes"].to_pylist(), strict=True)
                ]
                kept = [[{"digest": d, "children": c} for d, c in records] for _, _, records in made]
                kind = pa.list_(pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))]))
                yield pa.RecordBatch.from_arrays(
                    [part["tree"], part["idx"], pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made], pa.int32()), pa.array(kept, kind)],
                    ["tree", "idx", "digest", "levels", "records"],
                )

    stores = []
    while True:
        runs = nodes.groupBy("tree", F.expr(f"rank div {WIDTH}").alias("idx")).agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("nodes"))
        made = write_shared(runs.mapInArrow(build, f"tree string, idx long, digest binary, levels int, records {_RECORDS}"), "merkle-store")
        stores.append(made)
        if made.where("idx > 0").isEmpty():
            return Tree(stores, made.select("tree", "digest"))
        nodes = made.select("tree", F.col("idx").alias("rank"), "digest")


def _upper_name() -> Column:
    return F.left("tree", F.lit(0))


def ranked(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Add ``rank``, the place of a row in its ``tree`` from 0 on; written, and no tree is the work of one task.

    Rows are range-partitioned on tree and order; a row's rank is its place in its partition plus
    what the partitions before hold of the tree.
    """
    by = [F.col("tree"), *order]
    cut = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = write_shared(cut.withColumns({"_part": F.spark_partition_id(), "_place": place}), "merkle-placed")
    shares = placed.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("tree").orderBy("_part")) - F.col("_n")
    shifts = shares.select("tree", "_part", (before - F.col("_first")).alias("_shift"))
    out = placed.join(shifts, ["tree", "_part"]).withColumn("rank", F.col("_place") + F.col("_shift")).select(*rows.columns, "rank")
    found = write_shared(out, "merkle-ranked")
    discard(placed)
    return found


def build_manifest(docs: DataFrame, leaf: Column, group: Column, order: Column, keep: Sequence[Column] = ()) -> Manifest:
    """Manifest of ``docs``; ``leaf`` is the digest of a row, ``keep`` are further columns of the leaves."""
    # Written once: texts are read and hashed once, and equal rows keep one order.
    rows = write_shared(
        docs.select(*keep, order.alias("_order"), F.unhex(leaf).alias("leaf"), tree_name(group).alias("tree"), F.monotonically_increasing_id().alias("_row")),
        "merkle-leaves",
    )
    by = [F.col("_order").asc_nulls_first(), F.col("leaf"), F.col("_row")]
    leaves = ranked(rows, by)
    discard(rows)
    lower = grow(leaves.select("tree", "rank", F.col("leaf").alias("digest")))
    # The upper tree's name is a column, not a literal: joins on it stay hash joins.
    roots = lower.roots.select(_upper_name().alias("tree"), F.col("tree").alias("name"), "digest")
    placed = ranked(roots, [F.col("name")])
    groups = placed.select(F.col("name").alias("tree"), "rank", "digest")
    groups.shared_path = placed.shared_path
    upper = grow(groups.select(_upper_name().alias("tree"), "rank", "digest"))
    return Manifest(leaves, lower, groups, upper)


def _descend(asked: DataFrame, store: DataFrame, picks: str, payload: str, final: bool) -> DataFrame:
    """One round down: requests ``tree, idx, digest, path, picks`` with the record of their digest.

    Gives ``tree, idx, digest, path`` of every node picked, or with ``final`` its ``payload`` and proof.
    """
    rows = _ROWS

    def down(records, levels, digest, offset):
        """Follow the digits of ``offset``, highest first; the children not taken, per level."""
        taken, segment = digest, []
        for power in range(levels - 1, -1, -1):
            children = records[taken]
            place = offset // FAN**power % FAN
            segment.append((place, children[:place] + children[place + 1 :]))
            taken = children[place]
        return taken, segment

    def pack(segment):
        return b"".join(bytes((place, len(others))) + b"".join(others) for place, others in segment)

    def unpack(path):
        at, levels = 0, []
        while at < len(path):
            place, n = path[at], path[at + 1]
            levels.append((place, [path[at + 2 + 32 * i : at + 34 + 32 * i] for i in range(n)]))
            at += 2 + 32 * n
        return levels

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                out = []
                for r in batch.slice(low, rows).to_pylist():
                    records = {x["digest"]: x["children"] for x in r["records"] or ()}
                    for pick in r["picks"]:
                        taken, segment = down(records, r["levels"] or 0, r["digest"], pick["offset"])
                        if final:
                            if taken != pick["leaf"]:
                                raise ValueError("the store does not lead to the leaf that was asked for")
                            proof = [{"place": p, "others": [o.hex() for o in others]} for p, others in reversed(unpack(r["path"]) + segment)]
                            out.append({"who": pick["who"], "digest": taken, "proof": proof, "subroot": r["subroot"], "root": r["root"]})
                        else:
                            idx = r["idx"] * WIDTH + pick["offset"]
                            out.append({"tree": r["tree"], "idx": idx, "digest": taken, "path": r["path"] + pack(segment), "subroot": r["subroot"], "root": r["root"]})
                yield pa.RecordBatch.from_pylist(out, schema)

    given = "subroot binary, root binary"
    if final:
        out_schema = f"who {payload}, digest binary, proof {PROOF}, {given}"
    else:
        out_schema = f"tree string, idx long, digest binary, path binary, {given}"
    schema = to_arrow_schema(T.StructType.fromDDL(out_schema))
    # Content-addressed: equal digests have equal records, one is kept.
    records = store.where("levels > 0").dropDuplicates(["digest"]).select("digest", "levels", "records")
    joined = asked.join(records, "digest", "left").select("tree", "idx", "digest", "path", "subroot", "root", "picks", "levels", "records")
    return joined.mapInArrow(run, out_schema)


def _tree_paths(tree: Tree, starts: DataFrame, requests: DataFrame, payload: str) -> DataFrame:
    """From ``starts`` (``tree, digest, path, subroot, root``) down to ``requests`` (``tree, rank, leaf, who``)."""
    pick = F.struct(F.expr(f"int(rank % {WIDTH})").alias("offset"), "leaf", "who")
    here = F.expr(f"rank div {WIDTH}").alias("idx")
    wanted = [requests.groupBy("tree", here).agg(F.collect_list(pick).alias("picks"))]
    ranks = requests.select("tree", here)
    for _ in tree.stores[1:]:
        # Requests below one node are one request from here up.
        ranks = ranks.distinct().withColumnRenamed("idx", "rank")
        offset = F.struct(F.expr(f"int(rank % {WIDTH})").alias("offset"))
        wanted.append(ranks.groupBy("tree", here).agg(F.collect_list(offset).alias("picks")))
        ranks = ranks.select("tree", here)
    nodes = starts.withColumn("idx", F.lit(0).cast("long"))
    written = [starts] if hasattr(starts, "shared_path") else []
    for depth in range(len(tree.stores) - 1, -1, -1):
        asked = nodes.join(wanted[depth], ["tree", "idx"])
        nodes = _descend(asked, tree.stores[depth], "picks", payload, depth == 0)
        if depth:
            nodes = write_shared(nodes, "merkle-paths")
            discard(*written)
            written = [nodes]
    return nodes


def prove(made: Manifest, requests: DataFrame, who: Sequence[str]) -> DataFrame:
    """Proofs of leaf requests (rows of ``made.leaves``): columns ``who``, ``leaf, subroot, root, proof``.

    ``proof`` goes from the leaf up: per level the place of the own digest in its run, and the others' digests.
    """
    groups = requests.select("tree").distinct().join(made.groups, "tree")
    top = made.upper.roots.select("tree", "digest", F.lit(b"").alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    asked = groups.select(_upper_name().alias("tree"), "rank", F.col("digest").alias("leaf"), F.struct(F.col("tree").alias("name")).alias("who"))
    found = _tree_paths(made.upper, top, asked, "struct<name:string>")
    # The upper part of a path goes on top-down, as one packed segment.
    starts = write_shared(
        found.select(F.col("who.name").alias("tree"), "digest", _packed(F.col("proof")).alias("path"), F.col("digest").alias("subroot"), "root"), "merkle-starts"
    )
    rows = requests.select("tree", "rank", "leaf", F.struct(*who).alias("who"))
    paths = _tree_paths(made.lower, starts, rows, rows.schema["who"].dataType.simpleString())
    text = lambda name: F.lower(F.hex(name)).alias(name)
    return paths.select("who.*", text("digest").alias("leaf"), text("subroot"), text("root"), "proof")


def _packed(proof: Column) -> Column:
    byte = lambda n: F.lpad(F.hex(n), 2, "0")
    level = lambda p: F.concat(byte(p["place"]), byte(F.size(p["others"])), F.array_join(p["others"], ""))
    return F.unhex(F.array_join(F.transform(F.reverse(proof), level), ""))


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level from the leaf up, each level left to right, as one text."""
    return F.array_join(F.flatten(F.transform(proof, lambda p: p["others"])), "")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf digest and its proof lead to."""

    def up(acc, p):
        before = F.array_join(F.slice(p["others"], F.lit(1), p["place"]), "")
        after = F.array_join(F.slice(p["others"], p["place"] + 1, F.size(p["others"])), "")
        return h(before, acc, after)

    return F.aggregate(proof, leaf, up)


def discard_upper(made: Manifest) -> None:
    """Delete what proofs that ``prove`` has returned no longer read: all but the leaves and the lowest store."""
    discard(made.groups, *made.upper.stores, *made.lower.stores[1:])


def tamper_proofs(docs: DataFrame, fields: Sequence[str], group_col: str, order_col: str, altered: dict[str, Column], where: Column) -> DataFrame:
    """Proofs of all rows, each folded from the leaf of its altered fields where ``where`` holds.

    Columns: ``order_col, leaf, subroot, root, proof, folded_root, verified``.
    """
    changed = F.when(where, F.unhex(leaf_digest(*(altered.get(f, F.col(f)) for f in fields))))
    keep = [F.col(order_col).alias("_id"), changed.alias("_changed")]
    made = build_manifest(docs, leaf_digest(*(F.col(f) for f in fields)), F.col(group_col), F.col(order_col), keep)
    proofs = prove(made, made.leaves, ["_id", "_changed"])
    discard_upper(made)
    start = F.coalesce(F.lower(F.hex("_changed")), F.col("leaf"))
    folded = proofs.withColumn("folded_root", fold(start, F.col("proof")))
    return folded.select(F.col("_id").alias(order_col), "leaf", "subroot", "root", "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
