"""Embedding near-duplicates over a robust-pruned flat graph.

1. Equal vectors become one class (smallest id, number of copies); links of a class count
   its copies. Vectors that are null, zero or hold null or non-finite parts link with nothing.
2. Centroids fitted on a bounded sample (``SAMPLE`` classes of least hashed id) make shards;
   every class goes to its ``overlap`` nearest ones.
3. Each shard builds a flat graph: candidates are near shard mates, and robust pruning drops
   a neighbour that another chosen neighbour reaches closer. The adjacency lists of a class
   over all its shards are united.
4. Every class is searched in each of its shards: greedily from the shard's medoid over the
   united lists, then the range is expanded over neighbours of what is in range until no
   new one is. Cosines are computed in double precision; only pairs at ``least`` or above
   are links, seen from either end.
5. The audit counts the links of every class whose id is divisible by ``AUDIT_EVERY`` by brute
   force, ``ASKED`` of them at a time (of every hashed id so divisible if no id is, of every id if
   that is none either). Below ``recall`` the search is repeated with twice the overlap and beam,
   up to ``MOST_OVERLAP``.
6. Shards that stay short, and from the start those whose audited classes have more than
   ``LISTED`` links on average, are compared exactly instead: their classes, ``ASKED`` at a time,
   with every class that the triangle inequality leaves within reach of their shards. That
   gives counts per class and a spanning forest, no list of pairs; the graph keeps the links
   between all other classes. A recall still below ``recall`` is an error.

Rows that repeat an id count as copies. A null id links with nothing.
"""

from __future__ import annotations

import heapq
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .frames import write_shared

SAMPLE = 16_384
SHARD = 600
MOST_SHARDS = 1_024
DEGREE, ALPHA, CANDIDATES = 24, 1.2, 96
BEAM = 24
AUDIT_EVERY, ASKED = 50, 8_192
MOST_OVERLAP, LISTED = 12, 256
# Rows that are compared with ``ASKED`` classes at a time.
ROWS = 512
# Nodes this much below the range are still expanded.
SLACK = 0.05
BLOCK = 2_048


def column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a column of equally long double lists, as unit vectors."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(vectors), -1)
    # Two steps, so that neither very small nor very large parts leave the range of squares.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vector: str) -> str:
    """SQL condition: no null or non-finite part, and some part is not zero."""
    finite = f"forall({vector}, p -> p is not null and not isnan(p) and abs(p) < double('Infinity'))"
    return f"coalesce({vector} is not null and {finite} and exists({vector}, p -> p <> 0), false)"


def centroids(x: np.ndarray, shards: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means on the sample."""
    rng = np.random.default_rng(0)
    c = x[np.sort(rng.choice(len(x), shards, replace=False))]
    for _ in range(rounds):
        own = np.concatenate([(x[i : i + BLOCK] @ c.T).argmax(axis=1) for i in range(0, len(x), BLOCK)])
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        norm = np.sqrt((total**2).sum(axis=1, keepdims=True))
        c = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), c)
    return c


def _assign(batch: pa.RecordBatch, c: np.ndarray, overlap: int) -> pa.RecordBatch:
    x = matrix(column(batch, "vector"))
    near = x @ c.T
    take = min(overlap, len(c))
    shards = np.argpartition(-near, take - 1, axis=1)[:, :take] if take < len(c) else np.tile(np.arange(len(c)), (len(x), 1))
    rows = pa.array(np.repeat(np.arange(len(x)), take))
    return pa.RecordBatch.from_arrays([pa.array(shards.reshape(-1).astype(np.int64)), column(batch, "id").take(rows), column(batch, "vector").take(rows)], ["shard", "id", "vector"])


def robust_prune(x: np.ndarray, node: int, near: np.ndarray, sims: np.ndarray) -> list[int]:
    """Nearest first; a chosen neighbour removes candidates that lie ``ALPHA`` times closer to it than to the node."""
    chosen: list[int] = []
    far = 1 - sims
    alive = np.ones(len(near), bool)
    between = 1 - x[near] @ x[near].T
    for i in range(len(near)):
        if alive[i]:
            chosen.append(int(near[i]))
            if len(chosen) == DEGREE:
                break
            alive &= ALPHA * between[i] > far
            alive[: i + 1] = False
    return chosen


def build_graph(x: np.ndarray) -> list[list[int]]:
    """Flat graph of a shard: pruned nearest mates both ways, and a path from the medoid to everything."""
    n = len(x)
    out: list[set[int]] = [set() for _ in range(n)]
    take = min(CANDIDATES, n - 1)
    if take < 1:
        return [[] for _ in range(n)]
    rng = np.random.default_rng(n)
    for first in range(0, n, BLOCK):
        sims = x[first : first + BLOCK] @ x.T
        sims[np.arange(len(sims)), np.arange(first, first + len(sims))] = -2
        best = np.argpartition(-sims, take - 1, axis=1)[:, :take]
        for r in range(len(sims)):
            # A few mates drawn from anywhere give long steps.
            near = np.unique(np.concatenate((best[r], rng.integers(0, n, 8))))
            near = near[near != first + r]
            near = near[np.argsort(-sims[r, near], kind="stable")]
            for j in robust_prune(x, first + r, near, sims[r, near]):
                out[first + r].add(j)
                out[j].add(first + r)
    root = medoid(x)
    reached, stack = {root}, [root]
    for node in range(n):
        while stack:
            for j in out[stack.pop()]:
                if j not in reached:
                    reached.add(j)
                    stack.append(j)
        if node not in reached:
            out[root].add(node)
            out[node].add(root)
            reached.add(node)
            stack.append(node)
    return [sorted(s) for s in out]


def medoid(x: np.ndarray) -> int:
    return int((x @ x.mean(axis=0)).argmax())


def _graph(shard: pa.Table) -> pa.Table:
    shard = shard.combine_chunks()
    ids = shard.column("id").to_numpy()
    adjacency = build_graph(matrix(shard.column("vector").combine_chunks()))
    return pa.table({"id": ids, "near": pa.array([[int(ids[j]) for j in a] for a in adjacency], pa.list_(pa.int64()))})


def search(x: np.ndarray, near: list[np.ndarray], root: int, query: int, least: float, beam: int) -> list[int]:
    """In-range nodes: greedy from the root until the beam stands still, then expansion of what is in range."""
    q = x[query]
    seen = {root}
    s = float(x[root] @ q)
    todo, best, found = [(-s, root)], [s], [(s, root)]
    while todo:
        s, node = heapq.heappop(todo)
        if len(best) == beam and -s < best[0]:
            break
        new = [j for j in near[node].tolist() if j not in seen]
        if not new:
            continue
        seen.update(new)
        for t, j in zip((x[new] @ q).tolist(), new, strict=True):
            found.append((t, j))
            if len(best) < beam or t > best[0]:
                heapq.heappush(todo, (-t, j))
                (heapq.heappush if len(best) < beam else heapq.heapreplace)(best, t)
    stack = [j for t, j in found if t >= least - SLACK]
    inside = [j for t, j in found if t >= least]
    while stack:
        new = [j for j in near[stack.pop()].tolist() if j not in seen]
        if new:
            seen.update(new)
            for t, j in zip((x[new] @ q).tolist(), new, strict=True):
                if t >= least - SLACK:
                    stack.append(j)
                    if t >= least:
                        inside.append(j)
    return [j for j in inside if j != query]


def _search(shard: pa.Table, least: float, beam: int) -> pa.Table:
    shard = shard.combine_chunks()
    ids = shard.column("id").to_numpy()
    x = matrix(shard.column("vector").combine_chunks())
    order = np.argsort(ids)
    lists = shard.column("near").combine_chunks()
    cuts = lists.offsets.to_numpy()
    flat = lists.flatten().to_numpy()
    at = np.minimum(np.searchsorted(ids[order], flat), len(ids) - 1)
    held = ids[order][at] == flat
    local = order[at]
    near = [local[i:j][held[i:j]] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    root = medoid(x)
    a, b = [], []
    for i in range(len(ids)):
        for j in search(x, near, root, i, least, beam):
            a.append(min(ids[i], ids[j]))
            b.append(max(ids[i], ids[j]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def fitted(classes: DataFrame) -> np.ndarray:
    """Centroids of the shards."""
    shards = int(min(MOST_SHARDS, max(1, classes.count() // SHARD)))
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    x = matrix(sample.column("vector").combine_chunks())
    return centroids(x, min(shards, len(x)))


def links_of(classes: DataFrame, c: np.ndarray, least: float, overlap: int, beam: int) -> DataFrame:
    """Distinct links ``a < b`` between the rows of ``id, vector``."""
    assign, graph, find = partial(_assign, c=c, overlap=overlap), _graph, partial(_search, least=least, beam=beam)

    def deal(batches):
        for batch in batches:
            if batch.num_rows:
                yield assign(batch)

    dealt = write_shared(classes.select("id", "vector").mapInArrow(deal, "shard long, id long, vector array<double>"), "shards")
    lists = dealt.groupBy("shard").applyInArrow(lambda key, rows: graph(rows), "id long, near array<long>")
    united = lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    nodes = dealt.join(united, "id").select("shard", "id", "vector", "near")
    return nodes.groupBy("shard").applyInArrow(lambda key, rows: find(rows), "a long, b long").distinct()


def own_shard(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x @ c.T).argmax(axis=1)


def _owners(batches, c: np.ndarray):
    """``id, shard`` and the cosine with the shard's centroid, of the nearest shard."""
    for batch in batches:
        if batch.num_rows:
            near = matrix(column(batch, "vector")) @ c.T
            yield pa.RecordBatch.from_arrays([column(batch, "id"), pa.array(near.argmax(axis=1)), pa.array(near.max(axis=1))], ["id", "shard", "cosine"])


def tied(near: np.ndarray, parent: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Unite the asked classes ``cols`` that a row of ``near`` (every row has a hit) links with; the rows' roots."""
    none = len(parent)
    while True:
        root = parent[cols]
        rows = np.where(near, root, none).min(axis=1)
        least = np.where(near, rows[:, None], none).min(axis=0)
        if (least == root).all():
            return rows
        np.minimum.at(parent, root, least)
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]


def _against(batches, asked: pa.Table, least: float, reach: tuple | None):
    """Counts of links of the asked classes: ``id, more`` (copies counted), ``degree`` (classes).

    With ``reach`` (all centroids, the exact shards, the asked classes' shards, least cosine
    with each of those) rows out of reach are passed over, rows of other shards get their
    counts as well, and ``id, other`` ties up what is linked.
    """
    asked = asked.sort_by("id").combine_chunks()
    names, copies = asked.column("id").to_numpy(), asked.column("n").to_numpy()
    q = matrix(asked.column("vector").combine_chunks())
    more, degree, parent = np.zeros(len(q)), np.zeros(len(q), np.int64), np.arange(len(q))

    def told(ids, more, degree, other=None):
        other = pa.nulls(len(ids), pa.int64()) if other is None else pa.array(other)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.asarray(more, np.int64)), pa.array(np.asarray(degree, np.int64)), other], ["id", "more", "degree", "other"])

    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            part = batch.slice(first, ROWS)
            ids, n = column(part, "id").to_numpy(), column(part, "n").to_numpy()
            x = matrix(column(part, "vector"))
            listed = np.zeros(len(x), bool)
            if reach:
                c, exact, shards, bound = reach
                near = x @ c.T
                listed = ~np.isin(near.argmax(axis=1), exact)
                some = (near[:, shards] >= bound).any(axis=1)
                ids, n, x, listed = ids[some], n[some], x[some], listed[some]
            near = x @ q.T >= least
            at = np.minimum(np.searchsorted(names, ids), len(names) - 1)
            same = names[at] == ids
            near[np.flatnonzero(same), at[same]] = False
            rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
            if not len(rows):
                continue
            near, ids, listed = near[np.ix_(rows, cols)], ids[rows], listed[rows]
            degree[cols] += near.sum(axis=0)
            more[cols] += n[rows].astype(np.float64) @ near
            if reach:
                yield told(ids[listed], near[listed] @ copies[cols].astype(np.float64), near[listed].sum(axis=1))
                zero = np.zeros(len(ids), np.int64)
                yield told(ids, zero, zero, names[tied(near, parent, cols)])
    hit = np.flatnonzero(degree)
    yield told(names[hit], more[hit], degree[hit])
    if reach:
        hit = np.flatnonzero(parent != np.arange(len(parent)))
        zero = np.zeros(len(hit), np.int64)
        yield told(names[hit], zero, zero, names[parent[hit]])


COUNTED = "id long, more long, degree long, other long"


class Audit:
    """True links of the audited classes, counted by brute force."""

    def __init__(self, classes: DataFrame, c: np.ndarray, least: float):
        hashed = F.xxhash64("id")
        for self.asked in (F.col("id") % AUDIT_EVERY == 0, F.pmod(hashed, F.lit(AUDIT_EVERY)) == 0, F.lit(True)):
            n = classes.where(self.asked).count()
            if n:
                break
        ids, shards, true = [], [], {}
        groups = -(-n // ASKED)
        for g in range(groups):
            asked = classes.where(self.asked).where(F.pmod(F.hash("id"), F.lit(groups)) == g).select("id", "n", "vector").toArrow()
            if asked.num_rows:
                ids.append(asked.column("id").to_numpy())
                shards.append(own_shard(matrix(asked.column("vector").combine_chunks()), c))
                work = partial(_against, asked=asked, least=least, reach=None)
                counted = classes.select("id", "n", "vector").mapInArrow(work, COUNTED).groupBy("id").agg(F.sum("degree").alias("degree"))
                true |= {r.id: r.degree for r in counted.collect()}
        self.ids, self.shard = np.concatenate(ids), np.concatenate(shards)
        self.true = np.array([true.get(i, 0) for i in self.ids.tolist()], np.int64)
        self.width = len(c)

    def sums(self, counts: np.ndarray) -> np.ndarray:
        return np.bincount(self.shard, weights=counts, minlength=self.width)

    def dense(self) -> np.ndarray:
        return np.flatnonzero(self.sums(self.true) > LISTED * self.sums(np.ones(len(self.ids))))

    def judge(self, counts: DataFrame, recall: float) -> tuple[float, np.ndarray]:
        """(share of the true links that ``counts`` (``id, degree``) holds, the shards below ``recall``)."""
        held = {r.id: r.degree for r in counts.where(self.asked).groupBy("id").agg(F.sum("degree").alias("degree")).collect()}
        found = np.minimum([held.get(i, 0) for i in self.ids.tolist()], self.true)
        total = int(self.true.sum())
        return (int(found.sum()) / total if total else 1.0), np.flatnonzero(self.sums(found) < recall * self.sums(self.true))


def compared(classes: DataFrame, c: np.ndarray, exact: np.ndarray, least: float) -> tuple[DataFrame, DataFrame]:
    """(the classes of all shards but ``exact``; counts and ties of all links with a class of an exact shard)."""
    owners, work = _owners, partial
    owned = classes.select("id", "vector").mapInArrow(work(owners, c=c), "id long, shard long, cosine double")
    asked = write_shared(owned.where(F.col("shard").isin(exact.tolist())), "exact")
    rest = write_shared(classes.join(asked.select("id"), "id", "left_anti").select("id", "n", "vector"), "listed")
    wide = write_shared(classes.select("id", "n", "vector").repartition(max(classes.sparkSession.sparkContext.defaultParallelism, 1)), "wide")
    sizes = {r.shard: (r.n, r.cosine) for r in asked.groupBy("shard").agg(F.count("*").alias("n"), F.min("cosine").alias("cosine")).collect()}
    # Shards side by side in one group lie near one another; a shard beyond the bound is cut by hashed id.
    groups: list[tuple[list[int], int, int]] = []
    left, held = [], 0
    for shard in beside(c, sorted(sizes)):
        n = sizes[shard][0]
        if n > ASKED:
            parts = -(-2 * n // ASKED)
            groups += [([shard], parts, g) for g in range(parts)]
            continue
        if held + n > ASKED:
            groups.append((left, 1, 0))
            left, held = [], 0
        left, held = [*left, shard], held + n
    if left:
        groups.append((left, 1, 0))
    out = None
    for shards, parts, g in groups:
        members = asked.where(F.col("shard").isin(shards)).where(F.pmod(F.hash("id"), F.lit(parts)) == g)
        rows = wide.join(members.select("id"), "id", "left_semi").select("id", "n", "vector").toArrow()
        if not rows.num_rows:
            continue
        # A link's ends are at most the angle of ``least`` apart; a little more makes up for rounding.
        angle = np.arccos(np.clip([sizes[s][1] for s in shards], -1, 1)) + np.arccos(min(least, 1.0)) + 1e-6
        bound = np.where(angle < np.pi, np.cos(np.minimum(angle, np.pi)), -2.0)
        counted = write_shared(wide.mapInArrow(work(_against, asked=rows, least=least, reach=(c, exact, np.array(shards), bound)), COUNTED), "compared")
        out = counted if out is None else out.unionAll(counted)
    return rest, out if out is not None else classes.sparkSession.createDataFrame([], COUNTED)


def beside(c: np.ndarray, shards: list[int]) -> list[int]:
    """The shards, each followed by the nearest one left."""
    out, left = shards[:1], shards[1:]
    while left:
        out.append(left.pop(int((c[left] @ c[out[-1]]).argmax())))
    return out


def both_ends(links: DataFrame, size: DataFrame) -> DataFrame:
    """``id, more, degree`` of both ends of every link."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = both.join(size, both.b == size.other).groupBy(F.col("a").alias("id"))
    return counts.agg(F.sum("n").alias("more"), F.count("*").alias("degree"))


def near_vectors(
    vectors: DataFrame, least: float = 0.95, recall: float = 0.99, overlap: int = 3, beam: int = BEAM, id_col: str = "vec_id", vector_col: str = "embedding"
) -> tuple[DataFrame, float]:
    """(one row per row of ``vectors``: ``vec_id, n_links, component_id, kept``; audited recall)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    keyed = rows.withColumn("key", F.when(F.expr(usable("vector")) & F.col("vec_id").isNotNull(), F.sha2(F.to_json("vector").cast("binary"), 256)))
    keyed = write_shared(keyed, "vectors")
    # Copies are counted before the shuffle; one of them carries the vector.
    counted = keyed.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))
    classes = write_shared(
        keyed.where("key is not null").join(counted, "key").where("vec_id = id").dropDuplicates(["key"]).select("key", "id", "n", "vector"), "classes"
    )
    size = classes.select(F.col("id").alias("other"), "n")
    if classes.isEmpty():
        counts, ties, reached = classes.selectExpr("id", "n as more"), classes.selectExpr("id as a", "id as b"), 1.0
    else:
        c = fitted(classes)
        told = Audit(classes, c, least)
        exact, rest, counted = told.dense(), classes.select("id", "n", "vector"), vectors.sparkSession.createDataFrame([], COUNTED)
        if len(exact):
            rest, counted = compared(classes, c, exact, least)
        while True:
            links = write_shared(links_of(rest, c, least, overlap, beam), "links")
            counts = both_ends(links, size).unionAll(counted.select("id", "more", "degree"))
            reached, short = told.judge(counts, recall)
            if reached >= recall or overlap >= MOST_OVERLAP:
                break
            overlap, beam = overlap * 2, beam * 2
        if reached < recall:
            rest, counted = compared(classes, c, np.union1d(exact, short), least)
            for end in ("a", "b"):
                links = links.join(rest.select(F.col("id").alias(end)), end, "left_semi").select("a", "b")
            counts = both_ends(links, size).unionAll(counted.select("id", "more", "degree"))
            reached = told.judge(counts, recall)[0]
            if reached < recall:
                raise RuntimeError(f"audited recall {reached:.4f} is below {recall}")
        ties = links.select("a", "b").unionAll(counted.where("other is not null and id <> other").select(F.col("id").alias("a"), F.col("other").alias("b")))
    more = counts.groupBy("id").agg(F.sum("more").alias("more"))
    groups = connected_components(ties)
    told = classes.select("key", "id", "n").join(more, "id", "left").join(groups, "id", "left")
    told = told.select("key", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("component"))
    component_id = F.coalesce("component", "vec_id")
    result = keyed.join(told, "key", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        F.coalesce(F.col("vec_id") == component_id, F.lit(True)).alias("kept"),
    )
    return result, reached
