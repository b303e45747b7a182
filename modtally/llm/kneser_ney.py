"""Interpolated modified Kneser-Ney bigram model, counted in Spark, scored from memory-mapped arrays.

Tokens are the words of the lower-cased (A-Z) text and one end token a document; a start
symbol is context only. The model keeps, in files of the shared folder,

* the vocabulary as sorted 64-bit word hashes with counts, in ranges of the hash,
* every bigram as a sorted 64-bit hash (an invertible mix of both words' numbers, so that
  two bigrams never meet) with its count, in ranges of the hash,
* per word: distinct left neighbours, tokens after it, and how many of its bigrams were seen
  once, twice and more often.

Counting happens per piece of text, travels as compressed arrays, one per range, and is
summed per range: a frequent word or bigram is one entry a piece. Workers map the files; on
a store that cannot be mapped they fetch a file once into their own temporary folder.

``P(w|v) = (c(vw) - D) / c(v.) + (D1 n1 + D2 n2 + D3 n3) / c(v.) * Pc(w)``; ``Pc`` is the same
over distinct left neighbours, interpolated with ``1 / (V + 1)``. The chances of all known
words and one unknown word sum to one. Null texts are empty: their only token is the end.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modtally.session import scratch_path

from .arrays import lowered, mix, word_bounds, word_hashes
from .frames import id_and_text, over_texts, pieces, text_bytes

# Hashes of the end token; the number of the start symbol follows the words'.
END = np.uint64(0xA0761D6478BD642F)
RANGE_BYTES = 8 << 20
STATS_BITS = 18
STATS = np.dtype([("left", "<i8"), ("after", "<i8"), ("n1", "<i8"), ("n2", "<i8"), ("n3", "<i8")])
# Discounts where the corpus is too small to estimate them.
FALLBACK = (0.5, 1.0, 1.5)
BASE_ADDED = 0.1


def column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


# --- files ---------------------------------------------------------------------------


def _system(folder: str):
    from pyarrow import fs

    local = re.sub("^file:/+", "/", folder)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(folder)


def put(folder: str, name: str, array: np.ndarray) -> None:
    """Write an array under its final name in one step, so that a repeated task leaves the same file."""
    system, base = _system(folder)
    system.create_dir(base, recursive=True)
    draft = f"{base}/{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as f:
        f.write(array.tobytes())
    system.move(draft, f"{base}/{name}")


class Files:
    """Arrays of a model folder, mapped on first use."""

    def __init__(self, folder: str):
        self.system, self.base = _system(folder)
        self.open: dict[str, np.ndarray] = {}
        self.own: tempfile.TemporaryDirectory | None = None

    def get(self, name: str, kind) -> np.ndarray:
        if name not in self.open:
            path = f"{self.base}/{name}"
            if self.system.type_name != "local":
                self.own = self.own or tempfile.TemporaryDirectory()
                path = os.path.join(self.own.name, name)
                with self.system.open_input_stream(f"{self.base}/{name}") as f, open(path, "wb") as out:
                    while block := f.read(1 << 23):
                        out.write(block)
            self.open[name] = np.memmap(path, dtype=kind, mode="r")
        return self.open[name]


# --- counting ------------------------------------------------------------------------


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows, each row closed by the end token, and the rows' offsets."""
    raw = lowered()[raw]
    starts, ends, rows = word_bounds(raw, offsets)
    out = np.full(len(starts) + len(rows) - 1, END, np.uint64)
    at = rows + np.arange(len(rows))
    inner = np.ones(len(out), bool)
    inner[at[1:] - 1] = False
    out[inner] = word_hashes(raw, starts, ends)
    return out, at


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with the sums of their values (one column or several), in 64 bits."""
    order = np.argsort(keys)
    keys, values = keys[order], values[order].astype(np.int64)
    head = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[head], np.add.reduceat(values, head, axis=0) if len(head) else values


def shelves(keys: np.ndarray, parts: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch | None:
    """Sorted keys and columns as one compressed blob per part (``parts`` does not fall)."""
    if not len(keys):
        return None
    cuts = np.append(np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1]))), len(keys))
    codec, rows = pa.Codec("zstd", compression_level=1), []
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        gaps = np.diff(keys[i:j], prepend=np.zeros(1, keys.dtype))
        # Bytes of one weight lie together: the high ones of gaps and counts are mostly zero.
        planes = [np.ascontiguousarray(x).view(np.uint8).reshape(j - i, -1).T.tobytes() for x in (gaps, *(c[i:j] for c in columns))]
        whole = b"".join(planes)
        rows.append((int(parts[i]), int(j - i), len(whole), codec.compress(whole, asbytes=True)))
    arrays = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["part", "n", "total", "blob"])


def unshelve(rows: pa.Table, kinds: list) -> list[np.ndarray]:
    """Keys and columns of all blobs of a part."""
    codec, out = pa.Codec("zstd"), [[] for _ in kinds]
    for n, total, blob in zip(*(rows.column(c).to_pylist() for c in ("n", "total", "blob")), strict=True):
        whole, at = np.frombuffer(codec.decompress(blob, total, asbytes=True), np.uint8), 0
        for i, kind in enumerate(kinds):
            width = np.dtype(kind).itemsize
            x = np.ascontiguousarray(whole[at : at + n * width].reshape(width, n).T).view(kind).reshape(-1)
            out[i].append(np.cumsum(x, dtype=kind) if i == 0 else x)
            at += n * width
    return [np.concatenate(x) for x in out]


SHELF = "part long, n long, total long, blob binary"


def _words(piece: pa.RecordBatch, bits: int) -> pa.RecordBatch | None:
    raw, offsets = text_bytes(piece)
    keys, counts = np.unique(tokens(raw, offsets)[0], return_counts=True)
    return shelves(keys, (keys >> np.uint64(64 - bits)).astype(np.int64), [counts.astype(np.uint32)])


def _store_words(key, rows: pa.Table, folder: str) -> pa.Table:
    keys, counts = summed(*unshelve(rows, [np.uint64, np.uint32]))
    part = key[0].as_py()
    put(folder, f"words-{part}", keys)
    put(folder, f"counts-{part}", counts)
    return pa.table({"part": [part], "n": [len(keys)], "total": [int(counts.sum())]})


class Vocabulary:
    """Numbers of words: the place of their hash among all sorted hashes, -1 if unknown."""

    def __init__(self, files: Files, sizes: dict[int, int], bits: int):
        self.files, self.sizes, self.bits = files, sizes, bits
        self.first, total = {}, 0
        for part in sorted(sizes):
            self.first[part] = total
            total += sizes[part]
        self.total = total

    def numbers(self, keys: np.ndarray, counts: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """For sorted hashes: number and (if asked) count of each."""
        number, count = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        part = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        cuts = np.append(np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))), len(keys)) if len(keys) else [0]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            p = int(part[i])
            if p not in self.sizes:
                continue
            held = self.files.get(f"words-{p}", np.uint64)
            at = np.minimum(np.searchsorted(held, keys[i:j]), len(held) - 1)
            known = held[at] == keys[i:j]
            number[i:j] = np.where(known, at + self.first[p], -1)
            if counts:
                count[i:j] = np.where(known, self.files.get(f"counts-{p}", np.int64)[at], 0)
        return number, count


def pairs(raw: np.ndarray, offsets: np.ndarray, words: Vocabulary, counts: bool = False):
    """Numbers of every token and of the one before it; the first follows the start symbol."""
    token, at = tokens(raw, offsets)
    keys, back = np.unique(token, return_inverse=True)
    number, count = words.numbers(keys, counts)
    now = number[back]
    before = np.concatenate(([words.total], now[:-1]))
    before[at[:-1]] = words.total
    return before, now, at, count[back]


def pair_hash(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    return mix((before.astype(np.uint64) << np.uint64(32)) | now.astype(np.uint64))


def _bigrams(piece: pa.RecordBatch, words: Vocabulary, bits: int) -> pa.RecordBatch | None:
    raw, offsets = text_bytes(piece)
    before, now, _, _ = pairs(raw, offsets, words)
    keys, counts = np.unique((before.astype(np.uint64) << np.uint64(32)) | now.astype(np.uint64), return_counts=True)
    part = (mix(keys) >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return shelves(keys[order], part[order], [counts[order].astype(np.uint32)])


def _store_bigrams(key, rows: pa.Table, folder: str) -> pa.RecordBatch | None:
    """Write a range of bigrams; per-word statistics go on as blobs, in ranges of the word's number."""
    keys, counts = summed(*unshelve(rows, [np.uint64, np.uint32]))
    part = key[0].as_py()
    hashed = mix(keys)
    order = np.argsort(hashed)
    put(folder, f"pairs-{part}", hashed[order])
    # Four bytes a count unless one of the range needs eight.
    put(folder, f"seen-{part}", counts[order].astype(np.uint32 if counts.max() < 1 << 32 else np.int64))
    before, now = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
    table = np.zeros((2 * len(keys), 5), np.int64)
    n = len(keys)
    table[:n, 1] = counts
    for i in (1, 2):
        table[:n, 1 + i] = counts == i
    table[:n, 4] = counts > 2
    table[n:, 0] = 1
    word, table = summed(np.concatenate((before, now)), table)
    tallied = [int((counts == i).sum()) for i in (1, 2, 3, 4)]
    out = shelves(word, (word >> np.uint64(STATS_BITS)).astype(np.int64), [np.ascontiguousarray(table[:, c]) for c in range(5)])
    tally = pa.array([tallied] + [None] * (out.num_rows - 1), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([*out.columns, tally], [*out.schema.names, "tally"])


def _store_stats(key, rows: pa.Table, folder: str) -> pa.Table:
    word, *columns = unshelve(rows, [np.uint64] + [np.int64] * 5)
    part = key[0].as_py()
    table = np.zeros(1 << STATS_BITS, STATS)
    at = (word - np.uint64(part << STATS_BITS)).astype(np.int64)
    for name, c in zip(STATS.names, columns, strict=True):
        table[name] = np.bincount(at, weights=c, minlength=len(table)).astype(np.int64)
    put(folder, f"stats-{part}", table)
    left = table["left"]
    tally = [int((left == i).sum()) for i in (1, 2, 3, 4)] + [int((left > 2).sum()), int(left.sum())]
    given = [t for t in rows.column("tally").to_pylist() if t]
    return pa.table({"part": [part], "left": [tally], "seen": [[sum(t) for t in zip(*given, strict=True)] if given else [0] * 4]})


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    if not min(n1, n2, n3, n4):
        return FALLBACK
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(d if 0 < d < i else f for i, (d, f) in enumerate(zip(found, FALLBACK, strict=True), 1))


def by_count(values: tuple[float, float, float], counts: np.ndarray) -> np.ndarray:
    return np.array([0.0, *values])[np.minimum(counts, 3)]


class Model:
    """What a worker needs to score: a folder and a few numbers, one per range at most."""

    def __init__(self, folder: str, bits: int, words: dict[int, int], n: int, stats: set[int], seen, left):
        self.folder, self.bits, self.words, self.n, self.stats = folder, bits, words, n, stats
        self.v = sum(words.values())
        self.pair_discount, self.left_discount = discounts(*seen), discounts(*left[:4])
        self.kinds = left[5]
        spare = sum(d * k for d, k in zip(self.left_discount, (left[0], left[1], left[4]), strict=True))
        self.left_spare = spare / self.kinds if self.kinds else 1.0

    def of_words(self, files: Files, number: np.ndarray) -> np.ndarray:
        """Statistics of sorted distinct word numbers (-1: none)."""
        out = np.zeros(len(number), STATS)
        part = np.where(number >= 0, number >> STATS_BITS, -1)
        for p in np.unique(part):
            if int(p) in self.stats:
                own = part == p
                out[own] = files.get(f"stats-{p}", STATS)[number[own] - (int(p) << STATS_BITS)]
        return out

    def of_pairs(self, files: Files, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct bigram hashes."""
        out = np.zeros(len(keys), np.int64)
        part = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        cuts = np.append(np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))), len(keys)) if len(keys) else [0]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            try:
                held = files.get(f"pairs-{part[i]}", np.uint64)
            except (FileNotFoundError, ValueError):
                continue
            at = np.minimum(np.searchsorted(held, keys[i:j]), len(held) - 1)
            seen = files.get(f"seen-{part[i]}", np.uint8)
            seen = seen.view(np.uint32 if len(seen) == 4 * len(held) else np.int64)
            out[i:j] = np.where(held[at] == keys[i:j], seen[at], 0)
        return out

    def log10(self, files: Files, before: np.ndarray, now: np.ndarray) -> np.ndarray:
        """log10 P(now | before) per token; -1 stands for an unknown word."""
        number, back = np.unique(np.concatenate((before, now)), return_inverse=True)
        stats = self.of_words(files, number)
        context, word = stats[back[: len(before)]], stats[back[len(before) :]]
        left = word["left"]
        p = np.maximum(left - by_count(self.left_discount, left), 0) / max(self.kinds, 1) + self.left_spare / (self.v + 1)
        known = (before >= 0) & (now >= 0)
        keys, back = np.unique(pair_hash(before[known], now[known]), return_inverse=True)
        count = np.zeros(len(now), np.int64)
        count[known] = self.of_pairs(files, keys)[back]
        after = context["after"]
        spare = sum(d * context[n] for d, n in zip(self.pair_discount, ("n1", "n2", "n3"), strict=True))
        some = after > 0
        p[some] = (np.maximum(count - by_count(self.pair_discount, count), 0)[some] + spare[some] * p[some]) / after[some]
        return np.log10(p)


def is_held_out(doc_id: Column, parts: int = 10, part: int = 0) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def train(texts: DataFrame) -> Model:
    """Count a model over the rows of ``doc_id, text``; files go to the shared folder."""
    spark = texts.sparkSession
    folder = scratch_path(spark, "bigrams")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(4, (size // RANGE_BYTES).bit_length())
    store_words, store_bigrams, store_stats = _store_words, _store_bigrams, _store_stats

    shelf = over_texts(texts.select("text"), partial(_words, bits=bits), SHELF)
    stored = shelf.groupBy("part").applyInArrow(lambda key, rows: store_words(key, rows, folder), "part long, n long, total long").collect()
    words, n = {r.part: r.n for r in stored}, sum(r.total for r in stored)
    cut, count, files, vocabulary = pieces, _bigrams, Files, Vocabulary

    def count_pairs(batches):
        known = vocabulary(files(folder), words, bits)
        for piece in cut(batches):
            out = count(piece, known, bits)
            if out is not None:
                yield out

    pairs_ = texts.select("text").mapInArrow(count_pairs, SHELF)
    stats = pairs_.groupBy("part").applyInArrow(lambda key, rows: pa.Table.from_batches([store_bigrams(key, rows, folder)]), SHELF + ", tally array<long>")
    done = stats.groupBy("part").applyInArrow(lambda key, rows: store_stats(key, rows, folder), "part long, left array<long>, seen array<long>").collect()
    total = lambda lists, n: [sum(x) for x in zip(*lists, strict=True)] if lists else [0] * n
    return Model(folder, bits, words, n, {r.part for r in done}, total([r.seen for r in done], 4), total([r.left for r in done], 6))


def _score(piece: pa.RecordBatch, model: Model, words: Vocabulary, files: Files) -> pa.RecordBatch:
    raw, offsets = text_bytes(piece)
    before, now, at, count = pairs(raw, offsets, words, counts=True)
    sums = lambda x: np.add.reduceat(x, at[:-1])
    base = np.log10((count + BASE_ADDED) / (model.n + BASE_ADDED * (model.v + 1)))
    n = np.diff(at)
    score = sums(model.log10(files, before, now))
    values = [n, sums((now >= 0).astype(np.int64)), sums(base), score, 10.0 ** np.minimum(-score / n, 300)]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [column(piece, "doc_id"), *(pa.array(v, k) for v, k in zip(values, kinds, strict=True))],
        ["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"],
    )


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score, perplexity`` of every row; scores are log10 chances of the text."""
    cut, work, files, vocabulary = pieces, _score, Files, Vocabulary

    def run(batches):
        held = files(model.folder)
        words = vocabulary(held, model.words, model.bits)
        for piece in cut(batches):
            yield work(piece, model, words, held)

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, base_score double, score double, perplexity double"
    )
