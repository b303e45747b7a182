"""Substring dedup by super-k-mer partitioning.

A window is ``size`` consecutive words of one document. Consecutive windows that share a
minimiser (their least-ranked word k-gram) travel as one packed string to the minimiser's
bucket; there, sorting counts the windows exactly. Every word covered by a window whose word
sequence also starts earlier (smaller id, or same document and earlier start) is removed;
windows are judged on the input.

Three passes over the texts: frequent k-grams (they rank last as minimisers, so that common
passages do not make hot buckets), packed strings, and the removal itself. A task ships a
string once and marks its later copies right away, so that a string reaches its bucket at
most a few times a task, however many copies the corpus holds.

Null texts have no words; rows that repeat an id and text are treated alike; a null id goes
before all others.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import winnow
from .arrays import mix, ranges, rolling, word_bounds, word_hashes
from .frames import discard, id_and_text, over_texts, pieces, text_bytes, write_shared

K = 2
BUCKET_BYTES = 2 << 20
LEAST_BUCKETS = 64
# Distinct strings of frequent minimisers that a task remembers.
REMEMBERED = 200_000
META = np.dtype([("id", "<i8"), ("th", "<i4"), ("start", "<i8"), ("words", "<i4"), ("bytes", "<i4")])


def packed(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words, each followed by one space, and the offsets of the words."""
    at = np.concatenate(([0], np.cumsum(ends - starts + 1)))
    out = np.append(raw, np.uint8(32))[ranges(starts, ends - starts + 1)]
    out[at[1:] - 1] = 32
    return out, at


def column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def _report(piece: pa.RecordBatch) -> pa.RecordBatch:
    raw, offsets = text_bytes(piece)
    starts, ends, rows = word_bounds(raw, offsets)
    words = word_hashes(raw, starts, ends)
    inside, _ = winnow.valid_starts(np.diff(rows), rows, K)
    grams, counts = winnow.frequent(rolling(words, K)[inside] if len(inside) else np.zeros(0, np.uint64))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([None, *grams.view(np.int64)], pa.int64()),
            pa.array([len(words), *counts], pa.int64()),
            pa.array([len(raw), *([0] * len(grams))], pa.int64()),
        ],
        ["gram", "n", "bytes"],
    )


def _ship(piece: pa.RecordBatch, size: int, common: winnow.Common, buckets: int, seen: dict):
    """Packed strings by bucket, and the spans that are known to repeat an earlier window."""
    raw, offsets = text_bytes(piece)
    starts, ends, rows = word_bounds(raw, offsets)
    counts = np.diff(rows)
    at, _ = winnow.valid_starts(counts, rows, size)
    if not len(at):
        return None, None
    words = word_hashes(raw, starts, ends)
    place, gram, often = winnow.anchors(words, at, size, K, common)
    first, n = winnow.runs(at, place)
    norm, norm_at = packed(raw, starts, ends)
    begin = at[first]
    width = n + size - 1
    row = np.searchsorted(rows, begin, side="right") - 1
    ids, ths = column(piece, "id").to_numpy(), column(piece, "th").to_numpy()
    start = begin - rows[row]
    # Copies of a string within the piece: the earliest is shipped.
    code = mix(rolling(words, size)[begin] + mix(rolling(words, size)[begin + n - 1]) + n.astype(np.uint64))
    order = np.lexsort((start, ths[row], ids[row], code))
    order_code = code[order]
    leads = np.concatenate(([True], order_code[1:] != order_code[:-1]))
    ship, repeat = [], []
    lead_text = b""
    text_of = lambda i: norm[norm_at[begin[i]] : norm_at[begin[i] + width[i]]].tobytes()
    alone = np.concatenate((leads[1:], [True])) & leads & ~often[first][order]
    ship.extend(order[alone].tolist())
    for i, lead in zip(order[~alone].tolist(), leads[~alone].tolist(), strict=True):
        text = text_of(i)
        key = (int(ids[row[i]]), int(ths[row[i]]), int(start[i]))
        if lead or text != lead_text:
            lead_text, lead_key = text, key
            if not often[first[i]]:
                ship.append(i)
                continue
            if len(seen) >= REMEMBERED:
                seen.clear()
            known = seen.get(text)
            if known is None or key < known:
                seen[text] = key
                ship.append(i)
            elif key > known:
                repeat.append(i)
        elif key > lead_key:
            repeat.append(i)
    spans = None
    if repeat:
        repeat = np.array(repeat)
        keys = list(zip(ids.tolist(), ths.tolist(), strict=True))
        spans = winnow.spans_batch(keys, row[repeat], start[repeat], start[repeat] + width[repeat])
    # In the order of the texts, so that neighbours in a bucket have near ids.
    ship = np.sort(np.array(ship))
    bucket = (mix(gram[first[ship]]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ship, bucket = ship[order], bucket[order]
    meta = np.zeros(len(ship), META)
    meta["id"], meta["th"], meta["start"], meta["words"] = ids[row[ship]], ths[row[ship]], start[ship], width[ship]
    low, high = norm_at[begin[ship]], norm_at[begin[ship] + width[ship]]
    meta["bytes"] = high - low
    body = norm[ranges(low, high - low)]
    body_at = np.concatenate(([0], np.cumsum(high - low)))
    cuts = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), len(bucket))
    codec = pa.Codec("zstd", compression_level=5)
    blobs = []
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        whole = np.concatenate((winnow.record_bytes(meta[i:j]), body[body_at[i] : body_at[j]]))
        blobs.append((int(bucket[i]), int(j - i), len(whole), codec.compress(whole, asbytes=True)))
    b, n, total, blob = zip(*blobs, strict=True)
    return (b, n, total, blob), spans


def _count(strings: pa.Table, size: int) -> pa.RecordBatch | None:
    """Sort the windows of a bucket; spans of those that repeat an earlier one."""
    codec = pa.Codec("zstd")
    metas, bodies = [], []
    for n, total, blob in zip(*(strings.column(c).to_pylist() for c in ("n", "total", "blob")), strict=True):
        whole = np.frombuffer(codec.decompress(blob, total, asbytes=True), np.uint8)
        metas.append(winnow.records(whole, n, META))
        bodies.append(whole[n * META.itemsize :])
    meta, raw = np.concatenate(metas), np.concatenate(bodies)
    offsets = np.concatenate(([0], np.cumsum(meta["bytes"], dtype=np.int64)))
    starts, ends, rows = word_bounds(raw, offsets)
    # Words become numbers; equal hashes are compared byte by byte with their first word.
    hashes = word_hashes(raw, starts, ends)
    _, lead, number = np.unique(hashes, return_index=True, return_inverse=True)
    length = ends - starts
    same = (length[lead][number] == length).all() and (raw[ranges(starts, length)] == raw[ranges(starts[lead][number], length)]).all()
    if not same:
        names: dict[bytes, int] = {}
        number = np.array([names.setdefault(raw[s:e].tobytes(), len(names)) for s, e in zip(starts, ends, strict=True)])
    windows = meta["words"] - size + 1
    at = ranges(rows[:-1], windows)
    owner = np.repeat(np.arange(len(meta)), windows)
    start = meta["start"][owner] + ranges(np.zeros(len(meta), np.int64), windows)
    code = rolling(number.astype(np.uint64), size)[at]
    order = np.argsort(code)
    new = np.concatenate(([True], code[order][1:] != code[order][:-1]))
    group = np.cumsum(new) - 1
    many = np.bincount(group)[group] > 1
    order, group = order[many], group[many]
    if not len(order):
        return None
    first_of = order[np.concatenate(([True], group[1:] != group[:-1]))]
    lead_at = at[first_of][np.cumsum(np.concatenate(([0], np.diff(group) != 0)))]
    if not all((number[at[order] + j] == number[lead_at + j]).all() for j in range(size)):
        # Two sequences share a code: sort by the words themselves.
        table = np.lib.stride_tricks.sliding_window_view(number, size)[at[order]]
        _, group = np.unique(table, axis=0, return_inverse=True)
    ids, ths, pos = meta["id"][owner[order]], meta["th"][owner[order]], start[order]
    by_key = np.lexsort((pos, ths, ids, group))
    order, group, ids, ths, pos = order[by_key], group[by_key], ids[by_key], ths[by_key], pos[by_key]
    head = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    lead = np.repeat(head, np.diff(np.append(head, len(group))))
    later = (ids != ids[lead]) | (ths != ths[lead]) | (pos != pos[lead])
    docs, which = np.unique(np.stack((ids[later], ths[later]), 1), axis=0, return_inverse=True)
    return winnow.spans_batch([tuple(d) for d in docs.tolist()], which.reshape(-1), pos[later], pos[later] + size)


def _remove(piece: pa.RecordBatch) -> pa.RecordBatch:
    raw, offsets = text_bytes(piece)
    starts, ends, rows = word_bounds(raw, offsets)
    gone = winnow.covered(len(starts), rows, column(piece, "begins"), column(piece, "ends"))
    norm, norm_at = packed(raw, starts, ends)
    kept = norm[np.repeat(~gone, np.diff(norm_at))]
    size = np.concatenate(([0], np.cumsum(np.where(gone, 0, np.diff(norm_at)))))[rows]
    removed = np.concatenate(([0], np.cumsum(gone)))[rows]
    texts = [kept[i : max(i, j - 1)].tobytes() for i, j in zip(size[:-1], size[1:], strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            column(piece, "doc_id"),
            pa.array(np.diff(rows), pa.int64()),
            pa.array(np.diff(removed), pa.int64()),
            pa.array(texts, pa.binary()),
            pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
        ],
        ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
    )


def remove_repeats(docs: DataFrame, size: int = 20, keep_text: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept, kept_sha256``.

    ``kept`` (left out when ``keep_text`` is False) joins the kept words by one space.
    """
    texts = winnow.keyed(id_and_text(docs, id_col, text_col))
    reports = write_shared(over_texts(texts.select("text"), _report, "gram long, n long, bytes long"), "grams")
    totals = reports.where("gram is null").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    common = winnow.common_of(reports, totals.n or 0)
    discard(reports)
    shared = docs.sparkSession.sparkContext.broadcast(common.hashes)
    buckets = max(LEAST_BUCKETS, (totals.bytes or 0) // BUCKET_BYTES)
    ship, cut, listed, count, spans_schema = _ship, pieces, winnow.Common, _count, winnow.SPANS_ARROW
    kinds = {"bucket": pa.int64(), "n": pa.int64(), "total": pa.int64(), "blob": pa.binary()}

    def rows_of(given: dict, n: int) -> pa.RecordBatch:
        fields = {**kinds, **{f.name: f.type for f in spans_schema}}
        return pa.RecordBatch.from_arrays([pa.array(given[c], k) if c in given else pa.nulls(n, k) for c, k in fields.items()], list(fields))

    def pack(batches):
        common, seen = listed(shared.value), {}
        for piece in cut(batches):
            strings, spans = ship(piece, size, common, buckets, seen)
            if strings:
                yield rows_of(dict(zip(kinds, strings, strict=True)), len(strings[0]))
            if spans is not None:
                # Known spans travel with any bucket, whose task hands them on.
                given = dict(zip(spans.schema.names, spans.columns, strict=True))
                yield rows_of({"bucket": [i % buckets for i in given["id"].to_pylist()], **given}, spans.num_rows)

    def sort_bucket(key, rows):
        strings = rows.filter(pc.is_valid(rows.column("blob"))).combine_chunks()
        known = rows.filter(pc.is_null(rows.column("blob"))).select(spans_schema.names).cast(spans_schema)
        found = count(strings, size) if strings.num_rows else None
        return pa.concat_tables([known, *([pa.Table.from_batches([found]).cast(spans_schema)] if found is not None else [])])

    packs = texts.select("id", "th", "text").mapInArrow(pack, f"bucket long, n long, total long, blob binary, {winnow.SPANS}")
    spans = packs.groupBy("bucket").applyInArrow(sort_bucket, winnow.SPANS)
    out = over_texts(winnow.with_spans(texts, spans), _remove, "doc_id long, n_words long, n_removed long, kept binary, kept_sha256 string")
    return out.withColumn("kept", F.col("kept").cast("string")) if keep_text else out.drop("kept")
