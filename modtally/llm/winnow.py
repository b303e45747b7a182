"""Anchors of windows: every window of ``size`` symbols names one of its ``k``-grams, by content alone.

Equal windows name equal k-grams at equal places, so all windows that name a k-gram can be
compared in the bucket of that k-gram. The least-ranked k-gram is named (leftmost on ties).
K-grams that fill the corpus rank last: their windows then gather around rarer k-grams, so
that a passage held by a third of all documents makes no hot bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import mix, rolling

# Frequent k-grams: those seen in at least one of every COMMON_SHARE symbols, hence at most
# COMMON_SHARE of them; a piece of text reports k-grams seen REPORTED times in it.
COMMON_SHARE = 100_000
COMMON_LEAST = 64
REPORTED = 4
# Bits of a rank; the rest hold the position, which makes the leftmost least k-gram win.
PLACE_BITS = np.uint64(28)


class Common:
    """Membership in a sorted list of frequent k-grams; a bitmap answers most questions."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(np.uint64))
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        if len(self.hashes):
            maybe = np.flatnonzero(self.bitmap[(x >> np.uint64(44)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, x[maybe]), len(self.hashes) - 1)
            out[maybe] = self.hashes[at] == x[maybe]
        return out


def frequent(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """K-grams that a piece reports, with their counts."""
    grams = np.sort(grams)
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))) if len(grams) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(grams)))
    often = counts >= REPORTED
    return grams[first[often]], counts[often]


def common_of(reports: DataFrame, symbols: int) -> Common:
    """The frequent k-grams of the corpus from all pieces' reports (columns ``gram, n``): a list of proven size."""
    least = max(COMMON_LEAST, symbols // COMMON_SHARE)
    kept = reports.where("gram is not null").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("gram")
    return Common(kept.toArrow().column("gram").to_numpy().astype(np.int64).view(np.uint64))


def valid_starts(counts: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows that lie within a row, and a mask over symbols."""
    mask = np.zeros(int(offsets[-1]) + 1, np.int32)
    has = counts >= size
    np.add.at(mask, offsets[:-1][has], 1)
    np.add.at(mask, offsets[1:][has] - size + 1, -1)
    inside = np.cumsum(mask[:-1]) > 0
    return np.flatnonzero(inside), inside


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values, by doubling."""
    n = len(x) - width + 1
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    return np.minimum(x[:n], x[width - have : width - have + n])


def anchors(symbols: np.ndarray, starts: np.ndarray, size: int, k: int, common: Common) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per window start: position of the named k-gram, its hash, and whether it is a frequent one."""
    grams = rolling(symbols, k)
    often = common.holds(grams)
    rank = (mix(grams ^ np.uint64(0x5851F42D4C957F2D)) >> (PLACE_BITS + np.uint64(1))) | (often.astype(np.uint64) << (np.uint64(63) - PLACE_BITS))
    rank = (rank << PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    place = (sliding_min(rank, size - k + 1)[starts] & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
    return place, grams[place], often[place]


def runs(starts: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Consecutive windows with one anchor: index of the first window of each run, and the run's length."""
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) != 1) | (np.diff(place) != 0)
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(starts)))


def merged(starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of spans within each owner: (owner, start, end), touching spans joined."""
    if not len(starts):
        return owner, starts, ends
    order = np.lexsort((starts, owner))
    starts, ends, owner = starts[order], ends[order], owner[order]
    # Owners are set apart on one line, so that a running maximum never crosses them.
    apart = np.concatenate(([0], np.cumsum(np.diff(owner) != 0))) * (int(ends.max()) + 1)
    reach = np.maximum.accumulate(ends + apart)
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] + apart[1:] > reach[:-1]) | (np.diff(owner) != 0)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return owner[first], starts[first], (reach - apart)[last]


def record_bytes(records: np.ndarray) -> np.ndarray:
    """Records as byte planes: the high bytes of a field, mostly zero, lie together and pack well."""
    return np.ascontiguousarray(records.view(np.uint8).reshape(len(records), -1).T).reshape(-1)


def records(raw: np.ndarray, n: int, kind: np.dtype) -> np.ndarray:
    return np.ascontiguousarray(raw[: n * kind.itemsize].reshape(-1, n).T).reshape(-1).view(kind)


def spans_batch(keys: list[tuple[int, int]], owner: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch | None:
    """Merged spans as one row per owner: ``id, th, begins, ends``. ``owner`` indexes ``keys``."""
    owner, starts, ends = merged(starts, ends, owner)
    if not len(owner):
        return None
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    cuts = pa.array(np.append(first, len(owner)), pa.int32())
    whose = [keys[i] for i in owner[first]]
    lists = [pa.ListArray.from_arrays(cuts, pa.array(x, pa.int64())) for x in (starts, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array([w[0] for w in whose], pa.int64()), pa.array([w[1] for w in whose], pa.int64()), *lists], ["id", "th", "begins", "ends"]
    )


SPANS = "id long, th long, begins array<long>, ends array<long>"
SPANS_ARROW = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("begins", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])


def keyed(texts: DataFrame) -> DataFrame:
    """Add the key of a row: ``id`` (a null id goes first) and ``th``, a hash that parts rows of one id."""
    return texts.select("doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.xxhash64("text").bitwiseAND(0x7FFFFFFF).alias("th"))


def with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """All spans of a row next to its text. The spans are the built side, so texts are not sorted."""
    lists = spans.groupBy("id", "th").agg(F.flatten(F.collect_list("begins")).alias("begins"), F.flatten(F.collect_list("ends")).alias("ends"))
    return texts.join(lists.hint("shuffle_hash"), ["id", "th"], "left")


def covered(length: int, rows: np.ndarray, begins: pa.Array, ends: pa.Array) -> np.ndarray:
    """Mask over the symbols of all rows of a batch: those inside any of their row's spans."""
    edge = np.zeros(length + 1, np.int32)
    for lists, sign in ((begins, 1), (ends, -1)):
        lists = lists.fill_null([])
        sizes = np.diff(lists.offsets.to_numpy())
        at = lists.flatten().to_numpy() + np.repeat(rows[:-1], sizes)
        np.add.at(edge, np.minimum(at, np.repeat(rows[1:], sizes)), sign)
    return np.cumsum(edge[:-1]) > 0
