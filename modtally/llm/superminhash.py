"""MinHash near-duplicates with SuperMinHash signatures (Ertl, 2017).

A document's set holds the distinct k-word shingles of its lower-cased (A-Z) words; a
shorter document is one shingle; a document without words has the empty set and links with
nothing. Two documents link when ``100 * |intersection| >= percent * |union|``.

1. Signatures: every element ranks the registers by a random permutation of its own and
   offers ``place + fraction``; ranks of one element are correlated (no two registers get
   the same place), which lowers the variance, and a document stops at the first place
   that cannot lower any register.
2. Documents of equal sets become one class. Registers of a class are cut into bands; the
   classes of a bucket are tied to its smallest, and the tied classes form families.
3. Verification compares full sets within families, in blocks of at most ``BLOCK`` by
   ``BLOCK`` classes, exactly. A block emits a spanning forest of its links.
4. Components of those links, by contraction, give the groups.

Families are the candidates: every pair that shares a band is in one family, and all pairs
of a family are compared, so that links are lost only where no chain of shared bands exists.
Bands and rows are chosen for a chance of at most ``MISS`` that a pair at the threshold
shares none.

Texts may be null (empty). Rows that repeat an id are texts of one document, which links
through any of them. A row without an id links with nothing, is kept, and has no component.
"""

from __future__ import annotations

import hashlib
import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BASE, lowered, mix, ranges, rolling, word_bounds, word_hashes
from .components import connected_components
from .frames import id_and_text, over_texts, text_bytes, write_shared

MISS = 1e-6
MOST_REGISTERS = 160
BLOCK = 1024
# Members of small families that share a verification task's group.
GROUP = 2048
STEP_ELEMENTS = 1 << 17
PIECE = 2 << 20
COLUMNS = 4096


def bands_for(percent: int) -> tuple[int, int]:
    """(bands, rows): as many rows as the register limit allows while pairs at the threshold are not missed."""
    best = (1, 1)
    for rows in range(1, 17):
        bands = math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** rows))) if percent < 100 else 1
        if bands * rows <= MOST_REGISTERS:
            best = (bands, rows)
    return best


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows, in word order with repeats, and each row's offsets among them."""
    raw = lowered()[raw]
    starts, ends, rows = word_bounds(raw, offsets)
    words = word_hashes(raw, starts, ends)
    counts = np.diff(rows)
    sizes = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    rolled = rolling(words, k)
    out = np.zeros(int(sizes.sum()), np.uint64)
    at = np.concatenate(([0], np.cumsum(sizes)))
    long = counts >= k
    out[ranges(at[:-1][long], sizes[long])] = rolled[ranges(rows[:-1][long], sizes[long])]
    for i in np.flatnonzero((counts > 0) & ~long):
        part = words[rows[i] : rows[i + 1]]
        out[at[i]] = rolling(part, len(part))[0] + np.uint64(len(part))
    return out, at


def signatures(elements: np.ndarray, at: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash registers of every row: ``place << 32 | fraction``, the least over the row's elements."""
    n = len(at) - 1
    registers = np.full((n, m), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + STEP_ELEMENTS, side="right")) - 1)
        for low in range(int(at[first]), int(at[last]), STEP_ELEMENTS * 8):
            high = min(int(at[last]), low + STEP_ELEMENTS * 8)
            owner = np.searchsorted(at, np.arange(low, high), side="right") - 1
            _offer(registers, elements[low:high], owner, m)
        first = last
    return registers


def _offer(registers: np.ndarray, x: np.ndarray, owner: np.ndarray, m: int) -> None:
    flat = registers.reshape(-1)
    order = None
    for place in range(m):
        z = mix(x + np.uint64((place + 1) * BASE & 0xFFFFFFFFFFFFFFFF))
        fraction = z >> np.uint64(32)
        pick = place + (((z & np.uint64(0xFFFFFFFF)) * np.uint64(m - place)) >> np.uint64(32)).astype(np.int64)
        if place == 0:
            register = pick
        else:
            row = np.arange(len(x))
            register = order[row, pick].astype(np.int64)
            order[row, pick] = order[:, place]
        np.minimum.at(flat, owner * m + register, np.uint64(place << 32) | fraction)
        # A row whose largest register is below the next place is done.
        rows = np.unique(owner)
        open_rows = rows[registers[rows].max(axis=1) >= np.uint64((place + 1) << 32)]
        if not len(open_rows) or place == m - 1:
            return
        stays = np.isin(owner, open_rows, assume_unique=False)
        if place == 0:
            x, owner, pick = x[stays], owner[stays], pick[stays]
            order = np.tile(np.arange(m, dtype=np.uint16 if m > 256 else np.uint8), (len(x), 1))
            order[np.arange(len(x)), pick] = 0
        elif not stays.all():
            x, owner, order = x[stays], owner[stays], order[stays]


def band_keys(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, distinct between bands."""
    keys = np.zeros((len(registers), bands), np.uint64)
    for b in range(bands):
        for r in range(rows):
            keys[:, b] = mix(keys[:, b] * np.uint64(BASE) + registers[:, b * rows + r] + np.uint64(b + 1))
    return keys


def _sign(piece: pa.RecordBatch, k: int, bands: int, rows: int) -> pa.RecordBatch:
    raw, offsets = text_bytes(piece)
    elements, at = shingle_sets(raw, offsets, k)
    keys = band_keys(signatures(elements, at, bands * rows), bands, rows)
    sizes, digests = [], []
    for i in range(len(at) - 1):
        own = np.unique(elements[at[i] : at[i + 1]])
        sizes.append(len(own))
        digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
    full = np.array(sizes) > 0
    flat = pa.array(keys[full].astype(np.int64, copy=False).reshape(-1), pa.int64())
    held = np.concatenate(([0], np.cumsum(np.where(full, bands, 0))))
    lists = pa.ListArray.from_arrays(pa.array(held, pa.int32()), flat)
    ids = piece.column(piece.schema.get_field_index("doc_id"))
    return pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists], ["doc_id", "n_shingles", "digest", "bands"])


def block_links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between two lists of sets (or within one, when ``right`` is None)."""
    both = left + (right or [])
    sizes = np.array([len(s) for s in both])
    n, a = len(both), len(left)
    _, column = np.unique(np.concatenate(both), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    # Elements of one set alone add nothing to any intersection.
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    column = np.cumsum(np.concatenate(([0], np.diff(column) > 0))) if len(column) else column
    rows, cols = (slice(0, a), slice(a, n)) if right is not None else (slice(0, n), slice(0, n))
    met = np.zeros((rows.stop - rows.start, cols.stop - cols.start), np.float32)
    last = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, last, COLUMNS):
        i, j = np.searchsorted(column, [low, low + COLUMNS])
        matrix = np.zeros((n, min(COLUMNS, last - low)), np.float32)
        matrix[owner[i:j], column[i:j] - low] = 1
        met += matrix[rows] @ matrix[cols].T
    union = sizes[rows][:, None] + sizes[cols][None, :] - met
    linked = 100 * met.astype(np.float64) >= percent * union.astype(np.float64)
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    forest = []
    for i, j in zip(*np.nonzero(linked), strict=True):
        i, j = int(i), int(j) + cols.start
        if i != j and (p := find(i)) != (q := find(j)):
            root[max(p, q)] = min(p, q)
            forest.append((i, j))
    return forest


def _verify(key, members: pa.Table, k: int, percent: int) -> pa.Table:
    members = members.combine_chunks()
    batch = members.to_batches()[0]
    raw, offsets = text_bytes(batch)
    family, low, high, own = (members.column(c).to_numpy() for c in ("family", "low", "high", "block"))
    ids = members.column("doc_id").to_numpy()
    order = np.lexsort((ids, own, high, low, family))
    same = np.ones(len(order), bool)
    same[1:] = np.any([c[order][1:] != c[order][:-1] for c in (family, low, high)], axis=0)
    cuts = [*np.flatnonzero(same), len(order)]
    a, b = [], []
    for first, last in zip(cuts[:-1], cuts[1:], strict=True):
        rows = order[first:last]
        sets = []
        for r in rows:
            elements, _ = shingle_sets(raw[offsets[r] : offsets[r + 1]], np.array([0, offsets[r + 1] - offsets[r]]), k)
            sets.append(np.unique(elements))
        split = int((own[rows] == low[rows]).sum())
        within = low[rows[0]] == high[rows[0]]
        if not within and split in (0, len(rows)):
            continue
        for i, j in block_links(sets, None, percent) if within else block_links(sets[:split], sets[split:], percent):
            a.append(ids[rows[i]])
            b.append(ids[rows[j]])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id reachable over links, the document's own included;
    ``kept`` marks the row whose id it is. An empty table gives an empty result.
    """
    texts = id_and_text(docs, id_col, text_col)
    bands, rows = bands_for(percent)
    signed = over_texts(
        texts, partial(_sign, k=k, bands=bands, rows=rows), "doc_id long, n_shingles long, digest binary, bands array<long>", PIECE
    )
    signed = write_shared(signed, "signatures")
    some = signed.where("digest is not null and doc_id is not null")
    classes = some.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    # Equal sets have equal bands: any member can speak for the class.
    speaks = some.join(classes, "digest").where("doc_id = rep").dropDuplicates(["digest"])
    buckets = speaks.select("rep", F.explode("bands").alias("bucket"))
    first = buckets.groupBy("bucket").agg(F.min("rep").alias("first"), F.count("*").alias("n")).where("n > 1")
    ties = buckets.join(first, "bucket").where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b"))
    family = connected_components(ties)

    # A family of n classes is compared as blocks x blocks; small families share a group.
    sizes = family.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = family.join(sizes, "component").select(
        F.col("id").alias("doc_id"), F.col("component").alias("family"), "blocks", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block")
    )
    placed = write_shared(placed, "families")
    groups = max(1, placed.count() // GROUP)
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "doc_id", "family", "blocks", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    group = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("family"), F.lit(groups))).otherwise(F.xxhash64("family", "low", "high"))
    members = texts.join(paired.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "family", "block", "low", "high", group.alias("group"))
    verify = partial(_verify, k=k, percent=percent)
    links = members.groupBy("group").applyInArrow(lambda key, part: verify(key, part), "a long, b long")
    component = connected_components(links).select(F.col("id").alias("rep"), "component")

    found = signed.join(classes, "digest", "left").join(component, "rep", "left")
    component_id = F.coalesce("component", "rep", "doc_id")
    return found.select("doc_id", "n_shingles", component_id.alias("component_id"), F.coalesce(F.col("doc_id") == component_id, F.lit(True)).alias("kept"))
