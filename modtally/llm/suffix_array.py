"""Suffix-array dedup over UTF-8 bytes.

A byte goes when a ``size``-byte string that covers it also starts anywhere else, in the
same document or another. Every such string names one of its k-grams by content
(``winnow.anchors``), and the suffixes that start at named k-grams are the ones that are
sorted: about one in ``size / 2`` bytes. Sampled splitters range-partition them by their
leading ``K`` bytes; each bucket sorts its suffixes by multikey quicksort, eight bytes at a
time and ties only, and likewise the reversed text before them. Two strings are equal just
when their suffixes share the bytes after the anchor and the bytes before it, so that common
prefixes of neighbours in both orders decide every string exactly. Equal strings start with
equal leading bytes after their anchor, so none lies across a bucket boundary: the splitters
cut between leading byte strings, never inside one.

A task ships one copy of a packed stretch and marks its repetitions itself; k-grams that
fill the corpus are named last (see ``winnow``).

Null texts are empty; rows that repeat an id and text count as two places of each string.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import winnow
from .arrays import mix, ranges, rolling, word_hashes
from .frames import discard, id_and_text, over_texts, pieces, text_bytes, write_shared

K = 16
PIECE = 2 << 20
BUCKET_BYTES = 2 << 20
LEAST_BUCKETS = 64
# Leading strings a piece offers as splitters, and how many are looked at in all.
OFFERED, SPLITTER_SAMPLE = 64, 50_000
REMEMBERED = 200_000
META = np.dtype([("id", "<i8"), ("th", "<i4"), ("start", "<i8"), ("anchor", "<i4"), ("windows", "<i4"), ("many", "<i4")])


def column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def leading(raw: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The ``K`` bytes at every place, as byte strings that order like the text."""
    if not len(place):
        return np.zeros(0, f"S{K}")
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, K)[place]).view(f"S{K}").reshape(-1)


def _report(piece: pa.RecordBatch) -> pa.RecordBatch:
    raw, offsets = text_bytes(piece)
    inside, _ = winnow.valid_starts(np.diff(offsets), offsets, K)
    grams = rolling(raw, K)[inside] if len(inside) else np.zeros(0, np.uint64)
    often, counts = winnow.frequent(grams)
    rank = mix(grams ^ np.uint64(0xD6E8FEB86659FD93))
    least = np.argpartition(rank, OFFERED)[:OFFERED] if len(rank) > OFFERED else np.arange(len(rank))
    leads = leading(raw, inside[least]).tolist()
    n = len(often)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([None, *often.view(np.int64), *([None] * len(leads))], pa.int64()),
            pa.array([0, *counts, *([0] * len(leads))], pa.int64()),
            pa.array([len(raw), *([0] * (n + len(leads)))], pa.int64()),
            pa.array([*([None] * (n + 1)), *leads], pa.binary()),
            pa.array([*([None] * (n + 1)), *rank[least].view(np.int64)], pa.int64()),
        ],
        ["gram", "n", "bytes", "lead", "rank"],
    )


def _ship(piece: pa.RecordBatch, size: int, common: winnow.Common, splitters: np.ndarray, seen: dict):
    """Packed stretches by bucket, and the spans already known to repeat."""
    raw, offsets = text_bytes(piece)
    at, _ = winnow.valid_starts(np.diff(offsets), offsets, size)
    if not len(at):
        return None, None
    place, _, often = winnow.anchors(raw, at, size, K, common)
    first, n = winnow.runs(at, place)
    begin, place, often = at[first], place[first], often[first]
    width = n + size - 1
    row = np.searchsorted(offsets, begin, side="right") - 1
    ids, ths = column(piece, "id").to_numpy(), column(piece, "th").to_numpy()
    start = begin - offsets[row]
    whole = rolling(raw, size)
    # Two windows cover a whole stretch, as it has fewer than ``size`` windows.
    code = mix(whole[begin] + mix(whole[begin + n - 1]) + n.astype(np.uint64))
    order = np.argsort(code, kind="stable")
    leads = np.concatenate(([True], code[order][1:] != code[order][:-1]))
    alone = np.concatenate((leads[1:], [True])) & leads & ~often[order]
    ship, many = order[alone].tolist(), [0] * int(alone.sum())
    repeat: list[tuple[int, int, int, int]] = []
    key = lambda i: (int(ids[row[i]]), int(ths[row[i]]), int(start[i]), int(start[i] + width[i]))
    groups: dict[bytes, list[int]] = {}
    for i in order[~alone].tolist():
        groups.setdefault(raw[begin[i] : begin[i] + width[i]].tobytes(), []).append(i)
    for text, own in groups.items():
        if len(own) > 1:
            repeat.extend(map(key, own))
        if often[own[0]]:
            if len(seen) >= REMEMBERED:
                seen.clear()
            if text in seen:
                # The task has shipped it; now both places are known.
                repeat.extend([] if seen[text] is None else [seen[text]])
                repeat.extend(map(key, own[:1]) if len(own) == 1 else [])
                seen[text] = None
                continue
            seen[text] = key(own[0]) if len(own) == 1 else None
        ship.append(own[0])
        many.append(int(len(own) > 1))
    spans = None
    if repeat:
        named: dict[tuple[int, int], int] = {}
        owner = np.array([named.setdefault(r[:2], len(named)) for r in repeat])
        spans = winnow.spans_batch(list(named), owner, np.array([r[2] for r in repeat]), np.array([r[3] for r in repeat]))
    if not ship:
        return None, spans
    in_text = np.argsort(np.array(ship))
    ship, many = np.array(ship)[in_text], np.array(many)[in_text]
    bucket = np.searchsorted(splitters, leading(raw, place[ship]), side="right")
    order = np.argsort(bucket, kind="stable")
    ship, many, bucket = ship[order], many[order], bucket[order]
    meta = np.zeros(len(ship), META)
    meta["id"], meta["th"], meta["start"] = ids[row[ship]], ths[row[ship]], start[ship]
    meta["anchor"], meta["windows"], meta["many"] = place[ship] - begin[ship], n[ship], many
    body = raw[ranges(begin[ship], width[ship])]
    body_at = np.concatenate(([0], np.cumsum(width[ship])))
    cuts = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), len(bucket))
    codec = pa.Codec("zstd", compression_level=5)
    rows = []
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        block = np.concatenate((winnow.record_bytes(meta[i:j]), body[body_at[i] : body_at[j]]))
        rows.append((int(bucket[i]), int(j - i), len(block), codec.compress(block, asbytes=True)))
    return tuple(zip(*rows, strict=True)), spans


def multikey_order(table: np.ndarray) -> np.ndarray:
    """Order of the rows by their columns: each column sorts only rows that tied on all before it."""
    order, group = np.arange(len(table)), np.zeros(len(table), np.int64)
    tied = np.arange(len(table)) if len(table) > 1 else np.zeros(0, np.int64)
    for c in range(table.shape[1]):
        if not len(tied):
            break
        rows = order[tied]
        by = np.lexsort((table[rows, c], group[tied]))
        order[tied] = rows = rows[by]
        old, value = group[tied], table[rows, c]
        new = np.concatenate(([True], (old[1:] != old[:-1]) | (value[1:] != value[:-1])))
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(tied)))
        group[tied] = np.repeat(tied[head], size)
        tied = tied[np.repeat(size > 1, size)]
    return order


def stretches(raw: np.ndarray, at: np.ndarray, count: np.ndarray, width: int, back: bool) -> np.ndarray:
    """Rows of ``width`` bytes forward from ``at`` (or backward before it), zero beyond ``count``."""
    step = np.arange(width)
    index = at[:, None] - 1 - step if back else at[:, None] + step
    out = raw[np.clip(index, 0, len(raw) - 1)]
    out[step >= count[:, None]] = 0
    return out


def common_prefixes(table: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row with the one before it in the order; 0 for the first."""
    differ = table[order[1:]] != table[order[:-1]]
    return np.concatenate(([0], np.where(differ.any(axis=1), differ.argmax(axis=1), table.shape[1])))


def _sorted_spans(blocks: pa.Table, size: int) -> pa.RecordBatch | None:
    """Spans of the strings of a bucket that start in two places."""
    codec = pa.Codec("zstd")
    metas, bodies = [], []
    for n, total, blob in zip(*(blocks.column(c).to_pylist() for c in ("n", "total", "blob")), strict=True):
        block = np.frombuffer(codec.decompress(blob, total, asbytes=True), np.uint8)
        metas.append(winnow.records(block, n, META))
        bodies.append(block[n * META.itemsize :])
    meta, raw = np.concatenate(metas), np.concatenate(bodies)
    width = meta["windows"].astype(np.int64) + size - 1
    at = np.concatenate(([0], np.cumsum(width)))[:-1]
    place = at + meta["anchor"]
    # Equal stretches first: all their strings repeat, and one of them stands for all.
    code = word_hashes(raw, at, at + width)
    _, lead, number = np.unique(code, return_index=True, return_inverse=True)
    equal = (width[lead][number] == width).all() and (raw[ranges(at, width)] == raw[ranges(at[lead][number], width)]).all()
    if not equal:
        names: dict[bytes, int] = {}
        number = np.array([names.setdefault(raw[a : a + w].tobytes(), len(names)) for a, w in zip(at, width, strict=True)])
        _, lead = np.unique(number, return_index=True)
    full = (np.bincount(number, weights=1 + meta["many"]) > 1)[number]
    starts, ends, owner = [meta["start"][full]], [meta["start"][full] + width[full]], [np.flatnonzero(full)]

    leads = leading(raw, place[lead])
    _, kind, counts = np.unique(leads, return_inverse=True, return_counts=True)
    rows = lead[counts[kind] > 1]
    if len(rows):
        anchor, windows = meta["anchor"][rows].astype(np.int64), meta["windows"][rows].astype(np.int64)
        after = stretches(raw, place[rows], width[rows] - anchor, (size + 7) // 8 * 8, False)
        before = stretches(raw, place[rows], anchor, (size + 7) // 8 * 8, True)
        orders = [multikey_order(np.ascontiguousarray(t).view(">u8").astype(np.uint64)) for t in (after, before)]
        shared = [common_prefixes(t, o) for t, o in zip((after, before), orders, strict=True)]
        ranks = [np.empty(len(rows), np.int64) for _ in orders]
        for rank, order in zip(ranks, orders, strict=True):
            rank[order] = np.arange(len(rows))
        near = [np.maximum(s, np.append(s[1:], 0))[r] for s, r in zip(shared, ranks, strict=True)]
        low = np.maximum(anchor - windows + 1, size - near[0])
        high = np.minimum(anchor, near[1])
        # One pass per distance of the anchor from the string's start.
        for d in range(int(low.min()), int(high.max()) + 1):
            own = np.flatnonzero((low <= d) & (d <= high))
            if len(own) < 2:
                continue
            right = np.cumsum(shared[0] < size - d)[ranks[0][own]]
            left = np.cumsum(shared[1] < d)[ranks[1][own]]
            both = right * (len(rows) + 1) + left
            by = np.argsort(both)
            tie = both[by][1:] == both[by][:-1]
            hit = own[by[np.concatenate(([False], tie)) | np.concatenate((tie, [False]))]]
            starts.append(meta["start"][rows[hit]] + anchor[hit] - d)
            ends.append(starts[-1] + size)
            owner.append(rows[hit])
    starts, ends, owner = map(np.concatenate, (starts, ends, owner))
    if not len(starts):
        return None
    keys, which = np.unique(np.stack((meta["id"][owner], meta["th"][owner]), 1), axis=0, return_inverse=True)
    return winnow.spans_batch([tuple(k) for k in keys.tolist()], which.reshape(-1), starts, ends)


def _remove(piece: pa.RecordBatch) -> pa.RecordBatch:
    raw, offsets = text_bytes(piece)
    gone = winnow.covered(len(raw), offsets, column(piece, "begins"), column(piece, "ends"))
    row_start = np.zeros(len(raw) + 1, bool)
    row_start[offsets] = True
    opens = gone.copy()
    opens[1:] &= ~gone[:-1] | row_start[1 : len(raw)]
    removed = np.concatenate(([0], np.cumsum(gone)))[offsets]
    spans = np.concatenate(([0], np.cumsum(opens)))[offsets]
    kept, at = raw[~gone], offsets - removed
    texts = [kept[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            column(piece, "doc_id"),
            pa.array(np.diff(offsets), pa.int64()),
            pa.array(np.diff(removed), pa.int64()),
            pa.array(np.diff(spans), pa.int64()),
            pa.array(texts, pa.binary()),
            pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
        ],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
    )


def remove_repeated_bytes(docs: DataFrame, size: int = 200, keep_bytes: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256``.

    ``kept`` holds the remaining bytes (they may cut a character) and is left out when
    ``keep_bytes`` is False. ``n_spans`` counts maximal removed runs.
    """
    texts = winnow.keyed(id_and_text(docs, id_col, text_col))
    reports = write_shared(over_texts(texts.select("text"), _report, "gram long, n long, bytes long, lead binary, rank long", PIECE), "grams")
    total = reports.agg(F.sum("bytes").alias("bytes")).first().bytes or 0
    common = winnow.common_of(reports, total)
    buckets = max(LEAST_BUCKETS, total // BUCKET_BYTES)
    # Least ranks are an even sample of the k-grams; its size is fixed.
    sample = sorted(r.lead for r in reports.where("lead is not null").orderBy("rank").limit(SPLITTER_SAMPLE).select("lead").collect())
    splitters = np.unique(np.array([sample[i * len(sample) // buckets] for i in range(1, buckets)] if sample else [], dtype=f"S{K}"))
    discard(reports)
    shared = docs.sparkSession.sparkContext.broadcast((common.hashes, splitters))
    ship, cut, listed, ordered, schema, limit = _ship, pieces, winnow.Common, _sorted_spans, winnow.SPANS_ARROW, PIECE
    kinds = {"bucket": pa.int64(), "n": pa.int64(), "total": pa.int64(), "blob": pa.binary()}

    def rows_of(given: dict, n: int) -> pa.RecordBatch:
        fields = {**kinds, **{f.name: f.type for f in schema}}
        return pa.RecordBatch.from_arrays([pa.array(given[c], k) if c in given else pa.nulls(n, k) for c, k in fields.items()], list(fields))

    def pack(batches):
        hashes, splitters = shared.value
        common, seen = listed(hashes), {}
        for piece in cut(batches, limit):
            blocks, spans = ship(piece, size, common, splitters, seen)
            if blocks:
                yield rows_of(dict(zip(kinds, blocks, strict=True)), len(blocks[0]))
            if spans is not None:
                given = dict(zip(spans.schema.names, spans.columns, strict=True))
                yield rows_of({"bucket": [i % buckets for i in given["id"].to_pylist()], **given}, spans.num_rows)

    def sort_bucket(key, rows):
        blocks = rows.filter(pc.is_valid(rows.column("blob"))).combine_chunks()
        known = rows.filter(pc.is_null(rows.column("blob"))).select(schema.names).cast(schema)
        found = ordered(blocks, size) if blocks.num_rows else None
        return pa.concat_tables([known, *([pa.Table.from_batches([found]).cast(schema)] if found is not None else [])])

    packs = texts.select("id", "th", "text").mapInArrow(pack, f"bucket long, n long, total long, blob binary, {winnow.SPANS}")
    spans = packs.groupBy("bucket").applyInArrow(sort_bucket, winnow.SPANS)
    out = over_texts(
        winnow.with_spans(texts, spans), _remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string", PIECE
    )
    return out if keep_bytes else out.drop("kept")
