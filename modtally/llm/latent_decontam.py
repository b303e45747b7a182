"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed terms over all documents give the TF-IDF weights.
2. A distributed randomised SVD of the TF-IDF passages of all documents and of the benchmark gives
   the latent space: tasks sum ``Y = A'(A W)`` for a random ``W`` in one pass, and ``Y (W'Y)^-1 Y'``
   stands for ``A'A``, whose eigenvectors it gives (Nystrom). What reaches the driver is
   ``TERMS x RANK`` numbers.
3. Every word of every document is projected; differences of running totals are windows of
   any length. Passages are searched in classes of length a factor ``CLASS`` apart, with windows of the
   class's length that start at every eighth of it (every ``STEP`` words at least), by cosine in the
   whitened latent space. The gate lies below what confirmation accepts: a window a tenth too long
   or short costs about 5 % of the cosine, one that starts a sixteenth off about 6 %.
4. Candidates are confirmed on words: the longest common subsequence of the item and the
   window's surroundings must cover ``COPIED`` of the item, or ``PARAPHRASED`` of it together
   with the item's answer (what follows its last question mark, else its last words). A passage
   of a longer item is confirmed by ``COPIED`` of its own words as well, and ``RUN`` words in a
   row of an item confirm it without a candidate. The share told is the item's.

The benchmark is the stated query set: it is searched in groups of at most ``GROUP``
passages, each against all documents, so what is broadcast has a fixed bound.

Words are lower-cased (Unicode), ASCII punctuation parts them. Null texts are empty. Items
without words match nothing. Repeated rows are judged each.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import mix, ranges, rolling, word_bounds, word_hashes
from .frames import id_and_text, over_rows, over_texts, pieces, text_bytes

TERMS = 1 << 15
RANK, SPARE = 128, 8
BLOCK = 8
# Windows start at every so many words at least, or an eighth of their length; lengths of a class differ by
# this factor; so many words of a text are held as vectors at a time.
STEP, CLASS, HELD = 2, 1.2, 2_048
# Words are added up in runs of so many, those of all runs at once.
SUMMED = 32
# Longest passage of a benchmark item, in blocks; longer items become several passages.
LONGEST = 8
GROUP = 16_384
COSINE = 0.35
COPIED, PARAPHRASED = 0.7, 0.5
RUN = 13
ANSWER_SHARE, ANSWER_WORDS = 0.8, 5
CHUNK = 512
# Passages that are multiplied at a time, as a dense matrix over the terms that they have.
TOGETHER = 16
PIECE = 2 << 20
# Each task sends a matrix of the whole vocabulary; so many are added up at a time.
TASKS = 64
# Eigenvalues below this share of the largest are noise of single precision.
NOISE = 1e-6
# Words of candidate regions that are looked up at a time.
LOOKED_UP = 1 << 17


def column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def plain() -> np.ndarray:
    """Byte table that turns ASCII punctuation into spaces."""
    t = np.arange(256, dtype=np.uint8)
    for low, high in ((33, 48), (58, 65), (91, 97), (123, 128)):
        t[low:high] = 32
    return t


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows and the rows' offsets."""
    raw, offsets = text_bytes(pa.RecordBatch.from_arrays([pc.utf8_lower(texts)], ["text"]))
    raw = np.frombuffer(raw.tobytes().translate(plain().tobytes()), np.uint8)
    starts, ends, rows = word_bounds(raw, offsets)
    return word_hashes(raw, starts, ends), rows


def terms(words: np.ndarray) -> np.ndarray:
    return (mix(words) >> np.uint64(64 - 15)).astype(np.int64)


def _frequencies(piece: pa.RecordBatch) -> pa.RecordBatch:
    words, rows = words_of(column(piece, "text"))
    owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    pairs = np.sort(owner * TERMS + terms(words))
    new = np.concatenate(([True], pairs[1:] != pairs[:-1])) if len(pairs) else np.zeros(0, bool)
    df = np.bincount(pairs[new] % TERMS, minlength=TERMS)
    some = np.flatnonzero(df)
    return pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(df[some], piece.num_rows))], ["term", "n"])


def passages(words: np.ndarray, rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit TF-IDF passages of ``LONGEST`` blocks: passage, term and weight of every entry."""
    size = LONGEST * BLOCK
    counts = np.diff(rows)
    many = -(-counts // size)
    base = np.concatenate(([0], np.cumsum(many)))
    owner = np.repeat(base[:-1], counts) + (np.arange(len(words)) - np.repeat(rows[:-1], counts)) // size
    key, tf = np.unique(owner * TERMS + terms(words), return_counts=True)
    owner, term = key // TERMS, key % TERMS
    value = tf * weight[term]
    norm = np.sqrt(np.bincount(owner, weights=value**2, minlength=int(base[-1])))
    return owner, term, value / np.maximum(norm[owner], 1e-12)


def add_products(total: np.ndarray, w: np.ndarray, owner: np.ndarray, term: np.ndarray, value: np.ndarray) -> None:
    """``total += A'(A w)`` for the entries of ``A``, which are sorted by owner: dense products of ``TOGETHER`` passages and their terms."""
    group = owner // TOGETHER
    key = group * TERMS + term
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    heads = key[new]
    # Columns of a group: its terms, ascending.
    cuts = np.searchsorted(heads, np.arange(int(group[-1]) + 2) * TERMS)
    column = np.empty(len(key), np.int64)
    column[order] = np.cumsum(new) - 1
    ends = np.searchsorted(owner, np.arange(int(group[-1]) + 2) * TOGETHER).tolist()
    for k, (first, last) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        here = slice(ends[k], ends[k + 1])
        terms = heads[first:last] - k * TERMS
        a = np.zeros((TOGETHER, len(terms)), np.float32)
        a[owner[here] - k * TOGETHER, column[here] - first] = value[here]
        total[terms] = total.take(terms, axis=0) + a.T @ (a @ w.take(terms, axis=0))


def random_directions() -> np.ndarray:
    return np.random.default_rng(1).standard_normal((TERMS, RANK + SPARE), np.float32)


def _sketch(batches, weight: np.ndarray):
    """This task's share of ``A'(A W)``, in chunks of terms."""
    w = random_directions()
    total, any_words = np.zeros_like(w), False
    for piece in batches:
        owner, term, value = passages(*words_of(column(piece, "text")), weight)
        if len(owner):
            any_words = True
            add_products(total, w, owner, term, value)
    if any_words:
        for low in range(0, TERMS, CHUNK):
            yield low // CHUNK, total[low : low + CHUNK]


def _summed(df: DataFrame, work) -> dict[int, np.ndarray]:
    """Sum of the arrays that the tasks yield as ``part, array``; one array a part reaches the driver."""
    per = TASKS

    def run(batches):
        from pyspark import TaskContext

        slot = TaskContext.get().partitionId() // per
        for part, array in work(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([slot], pa.int64()), pa.array([array.astype(np.float32).tobytes()], pa.binary())], ["part", "slot", "blob"]
            )

    def add(key, rows):
        total = sum(np.frombuffer(b, np.float32).astype(np.float64) for b in rows.column("blob").to_pylist())
        return pa.table({"part": [key[0].as_py()], "blob": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    some = df.mapInArrow(run, "part long, slot long, blob binary").groupBy("part", "slot").applyInArrow(add, "part long, blob binary")
    rows = some.groupBy("part").applyInArrow(add, "part long, blob binary").collect()
    return {r.part: np.frombuffer(r.blob, np.float32) for r in rows}


def latent_space(texts: DataFrame, items: DataFrame) -> np.ndarray:
    """Table of ``(TERMS + 1) x RANK``: what a word adds to the whitened latent vector of its passage; the last row is zero."""
    counted = over_texts(texts.select("text"), _frequencies, "term long, n long", PIECE).groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = counted.column("term").to_numpy(), counted.column("n").to_numpy()
    docs = int(n[term < 0].sum())
    df = np.zeros(TERMS)
    df[term[term >= 0]] = n[term >= 0]
    weight = np.log((docs + 1) / (df + 1)) + 0.1
    sketch, cut = _sketch, pieces
    width = RANK + SPARE
    y = np.zeros((TERMS, width))
    every = texts.select("text").unionByName(items.select("text"))
    for part, block in _summed(every, lambda batches: sketch(cut(batches, PIECE), weight)).items():
        y[part * CHUNK : (part + 1) * CHUNK] = block.reshape(-1, width)
    table = np.zeros((TERMS + 1, RANK), np.float32)
    if not y.any():
        return table
    core = random_directions().T @ y
    side, half = np.linalg.eigh((core + core.T) / 2)
    side = np.where(side > NOISE * side[-1], 1 / np.sqrt(np.maximum(side, 1e-300)), 0)
    # The eigenvectors of B B' are those of B, by the small matrix B'B.
    b = y @ (half * side)
    del y
    value, vector = np.linalg.eigh(b.T @ b)
    top = np.argsort(-value)[:RANK]
    # Whitening weighs all latent directions alike, so that a shared language is no likeness. Columns of B V
    # have the eigenvalue's root as their length.
    scale = np.where(value[top] > NOISE * value[top[0]], 1 / np.maximum(value[top], 1e-300), 0)
    np.multiply((b @ (vector[:, top] * scale)).astype(np.float32), weight[:, None], out=table[:-1], casting="same_kind")
    return table


def places(item: list[int]) -> dict[int, int]:
    """Bit mask of the places of every word of an item."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def lcs(masks: dict[int, int], length: int, other: list[int]) -> int:
    """Length of the longest common subsequence of an item (its places) and other words, bit-parallel."""
    row = full = (1 << length) - 1
    for w in other:
        if mask := masks.get(w):
            u = row & mask
            row = ((row + u) | (row - u)) & full
    return length - row.bit_count()


def length_class(length: int) -> int:
    """The length that a passage is searched in: the nearest of a geometric series, ``LONGEST`` blocks at most."""
    return min(round(CLASS ** round(np.log(max(length, 1)) / np.log(CLASS))), LONGEST * BLOCK)


def of_item(at, words: np.ndarray) -> np.ndarray:
    """A hash of every item's number and word."""
    return words ^ mix(np.atleast_1d(at).astype(np.uint64) + np.uint64(1))


class Marked:
    """A set of hashes as marked places of their leading bits: it may hold more than were put in, never less."""

    def __init__(self, hashes: np.ndarray):
        bits = max(12, (16 * len(hashes)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.marks = np.zeros(1 << bits, bool)
        self.marks[hashes >> self.shift] = True

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        return self.marks[hashes >> self.shift]


class Passages:
    """Benchmark passages of a group, ready to search."""

    def __init__(self, items: list[tuple[int, str]], table: np.ndarray):
        self.ids, self.words, self.answer, self.parts, self.span, self.need = [], [], [], [], {}, []
        runs: list[np.ndarray] = []
        vectors: dict[int, list] = {}
        for item_id, text in items:
            words, _ = words_of(pa.array([text], pa.large_string()))
            if not len(words):
                continue
            at = len(self.ids)
            answer, _ = words_of(pa.array([text.rpartition("?")[2] if "?" in text else ""], pa.large_string()))
            self.ids.append(item_id)
            answer = answer.tolist() or words[-ANSWER_WORDS:].tolist()
            self.words.append((places(words.tolist()), len(words)))
            self.answer.append((places(answer), len(answer)))
            size = LONGEST * BLOCK
            self.parts.append([])
            runs.append(np.unique(rolling(words, RUN)))
            for low in range(0, max(1, len(words) - size // 2), size // 2):
                part = words[low : low + size]
                if len(part) < len(words):
                    self.parts[at].append((places(part.tolist()), len(part)))
                vector = table[terms(part)].sum(axis=0, dtype=np.float64)
                norm = np.sqrt(vector @ vector)
                if norm > 0:
                    vectors.setdefault(length_class(len(part)), []).append((at, vector / norm))
            self.need.append(min([PARAPHRASED * len(words), *(COPIED * n for _, n in self.parts[at])]))
        for size, found in vectors.items():
            self.span[size] = (np.array([a for a, _ in found]), np.array([v for _, v in found], np.float32))

        whose = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
        run = np.concatenate([*runs, np.zeros(0, np.uint64)])
        order = np.argsort(run, kind="stable")
        self.run, self.run_of = run[order], whose[order]
        self.runs = Marked(self.run)
        self.lengths = np.array([n for _, n in self.words], np.int64)
        self.least = np.array(self.need)
        self.has = Marked(np.concatenate([of_item(at, np.fromiter(masks, np.uint64)) for at, (masks, _) in enumerate(self.words)] or [self.run]))

    def possible(self, at: np.ndarray, words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether the words from ``begin`` to ``end`` can hold what confirms item ``at``: no subsequence is longer than
        the number of words that occur in the item at all. Some that cannot are let through, none that can is lost."""
        out = np.zeros(len(at), bool)
        size = end - begin
        upto = np.cumsum(size)
        low = 0
        while low < len(at):
            high = max(low + 1, int(np.searchsorted(upto, upto[low] - size[low] + LOOKED_UP, side="right")))
            here = slice(low, high)
            found = self.has.may_hold(of_item(np.repeat(at[here], size[here]), words[ranges(begin[here], size[here])]))
            sums = np.concatenate(([0], np.cumsum(found)))
            last = upto[here] - (upto[low] - size[low])
            out[here] = sums[last] - sums[last - size[here]] >= self.least[at[here]]
            low = high
        return out

    def confirm(self, at: int, around: list[int], run: bool = False) -> tuple[bool, float]:
        item = self.words[at]
        # No subsequence is longer than the number of words that occur in the item at all, nor than that of the item's places they have.
        if not run and (sum(item[0][w].bit_count() for w in item[0].keys() & around) < self.need[at] or sum(map(item[0].__contains__, around)) < self.need[at]):
            return False, 0.0
        share = lcs(*item, around) / item[1]
        if run or share >= COPIED or any(lcs(*part, around) >= COPIED * part[1] for part in self.parts[at]):
            return True, share
        answer = self.answer[at]
        return share >= PARAPHRASED and lcs(*answer, around) >= ANSWER_SHARE * answer[1], share


def copied_runs(words: np.ndarray, rows: np.ndarray, known: Passages) -> tuple[np.ndarray, ...]:
    """Every ``RUN`` words in a row of an item: row, item, first word and end."""
    run = rolling(words, RUN)
    some = np.flatnonzero(known.runs.may_hold(run))
    left = np.searchsorted(known.run, run[some])
    same = known.run[np.minimum(left, len(known.run) - 1)] == run[some] if len(known.run) else np.zeros(len(some), bool)
    some, left = some[same], left[same]
    row = np.searchsorted(rows, some, side="right") - 1
    within = some + RUN <= rows[row + 1] if len(some) else np.zeros(0, bool)
    some, row, left = some[within], row[within], left[within]
    many = np.searchsorted(known.run, run[some], side="right") - left
    begin = np.repeat(some, many)
    return np.repeat(row, many), known.run_of[ranges(left, many)], begin, begin + RUN


def running_totals(table: np.ndarray, term: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Sums of the vectors of the first words, none to all but one; ``term`` has whole runs of ``SUMMED``, ``before`` tells the
    runs before each. The words of the same place of all runs are added at once: numpy's cumsum goes down columns."""
    first = np.concatenate(([TERMS], term[:-1])).reshape(-1, SUMMED).T
    sums = table.take(first.ravel(), axis=0).reshape(SUMMED, -1)
    for i in range(1, SUMMED):
        np.add(sums[i], sums[i - 1], out=sums[i])
    sums = sums.reshape(*first.shape, -1)
    out = np.empty((first.shape[1], SUMMED, table.shape[1]), np.float32)
    np.add(sums.transpose(1, 0, 2), (before @ sums[-1])[:, None], out=out)
    return out.reshape(-1, table.shape[1])


def windows(rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of so many words: row, start and stop. A row's windows start at its first word and every so many words on."""
    step = max(STEP, size // 8)
    many = -(-np.diff(rows) // step)
    row = np.repeat(np.arange(len(many)), many)
    start = rows[row] + step * (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many))
    return row, start, np.minimum(start + size, rows[row + 1])


def candidates(words: np.ndarray, rows: np.ndarray, table: np.ndarray, known: Passages) -> tuple[np.ndarray, ...]:
    """Windows near a passage: row, item, first word, end and cosine of each."""
    hits: list[tuple[np.ndarray, ...]] = []
    runs = -(-(HELD + LONGEST * BLOCK + 1) // SUMMED)
    lows = np.arange(0, len(words), HELD)
    term = np.concatenate((terms(words), np.full(runs * SUMMED, TERMS)))
    before = np.tri(runs, k=-1, dtype=np.float32)
    searched = []
    for size, (whose, vectors) in known.span.items():
        row, start, stop = windows(rows, size)
        searched.append((size, whose, np.ascontiguousarray(vectors.T), row, start, stop, np.append(np.searchsorted(start, lows), len(start)).tolist()))
    for k, low in enumerate(lows.tolist()):
        total = running_totals(table, term[low : low + runs * SUMMED], before)
        # Classes of one step start at the same words.
        upto: dict[int, np.ndarray] = {}
        for size, whose, vectors, row, start, stop, cuts in searched:
            a, b = cuts[k], cuts[k + 1]
            step = max(STEP, size // 8)
            if step not in upto:
                upto[step] = total.take(start[a:b] - low, axis=0)
            window = total.take(stop[a:b] - low, axis=0)
            window -= upto[step]
            norm = np.sqrt(np.vecdot(window, window))
            dot = window @ vectors
            near = np.flatnonzero(dot >= COSINE * np.maximum(norm, 1e-6)[:, None])
            if len(near):
                i, j = np.divmod(near, len(whose))
                hits.append((row[a + i], whose[j], start[a + i], stop[a + i], dot[i, j] / norm[i]))
    if not hits:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(part) for part in zip(*hits, strict=True))


def search(words: np.ndarray, rows: np.ndarray, table: np.ndarray, known: Passages) -> list[tuple[int, int, float, float | None]]:
    """Confirmed (row, item id, share, cosine), the best of each row; no cosine where no window came near."""
    near, copied = candidates(words, rows, table, known), copied_runs(words, rows, known)
    row, item, begin, end = (np.concatenate((a, b)) for a, b in zip(near[:4], copied, strict=True))
    cosine = np.concatenate((near[4], np.full(len(copied[0]), -1.0)))
    run = np.arange(len(row)) >= len(near[0])
    if not len(row):
        return []
    order = np.argsort((row * len(known.ids) + item) * (len(words) + 1) + begin, kind="stable")
    row, item, begin, end, cosine, run = (part[order] for part in (row, item, begin, end, cosine, run))
    # Windows of one item that touch one another are one region.
    new = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (begin[1:] > end[:-1])
    head = np.flatnonzero(np.concatenate(([True], new)))
    row, item, begin, end, cosine, run = row[head], item[head], begin[head], np.maximum.reduceat(end, head), np.maximum.reduceat(cosine, head), np.logical_or.reduceat(run, head)
    begin, end = np.maximum(rows[row], begin - BLOCK), np.minimum(rows[row + 1], end + 2 * BLOCK)
    # A region longer than the item is confirmed in overlapping stretches of twice its length.
    half = np.maximum(known.lengths[item], BLOCK) + BLOCK
    many = np.maximum(1, -(-(end - begin - half) // half))
    region = np.repeat(np.arange(len(row)), many)
    begin = ranges(np.zeros_like(many), many) * half[region] + begin[region]
    end = np.minimum(begin + 2 * half[region], end[region])
    row, item, cosine, run = (part[region] for part in (row, item, cosine, run))
    some = np.flatnonzero(run | known.possible(item, words, begin, end))
    out: dict[int, tuple[float, int, float]] = {}
    for r, at, low, high, cos, sure in zip(*(part[some].tolist() for part in (row, item, begin, end, cosine, run)), strict=True):
        yes, share = known.confirm(at, words[low:high].tolist(), sure)
        if yes and (r not in out or (share, -known.ids[at]) > (out[r][0], -out[r][1])):
            out[r] = (share, known.ids[at], cos if cos >= 0 else None)
    return [(r, found, share, cos) for r, (share, found, cos) in out.items()]


def _judge(piece: pa.RecordBatch, table: np.ndarray, known: Passages) -> pa.RecordBatch:
    words, rows = words_of(column(piece, "text"))
    item, share, cosine = [None] * piece.num_rows, [0.0] * piece.num_rows, [None] * piece.num_rows
    for row, i, s, c in search(words, rows, table, known):
        item[row], share[row], cosine[row] = i, s, c
    return pa.RecordBatch.from_arrays(
        [column(piece, "doc_id"), pa.array(item, pa.int64()), pa.array(share, pa.float64()), pa.array(cosine, pa.float64())],
        ["doc_id", "item_id", "lcs_share", "cosine"],
    )


JUDGED = "item_id long, lcs_share double, cosine double"


def _groups(items: DataFrame) -> list[list[tuple[int, str]]]:
    rows = [(r.item_id, r.text) for r in items.orderBy("item_id", "text").collect()]
    return [rows[i : i + GROUP] for i in range(0, len(rows), GROUP)] or [[]]


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    return benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).where("item_id is not null").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, contaminated, item_id, lcs_share, cosine`` of every row: the best confirmed item, if any."""
    texts, items = id_and_text(docs, id_col, text_col), benchmark_items(benchmark)
    table = latent_space(texts, items)
    out = None
    for group in _groups(items):
        found = over_texts(texts, partial(_judge, table=table, known=Passages(group, table)), f"doc_id long, {JUDGED}", PIECE)
        if out is None:
            out = found
        else:
            best = lambda c: F.max_by(c, F.struct("lcs_share", -F.col("item_id")))
            out = out.unionByName(found).groupBy("doc_id").agg(*(best(c).alias(c) for c in ("item_id", "lcs_share", "cosine")))
    return out.select("doc_id", F.col("item_id").isNotNull().alias("contaminated"), "item_id", "lcs_share", "cosine")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a confirmed item, with all their columns."""
    items = benchmark_items(benchmark)
    table = latent_space(id_and_text(docs, text_col=text_col), items)
    for group in _groups(items):
        known, find, split = Passages(group, table), search, words_of

        def clean(piece, known=known):
            keep = np.ones(piece.num_rows, bool)
            keep[[row for row, *_ in find(*split(piece.column(piece.schema.get_field_index(text_col))), table, known)]] = False
            return piece.filter(pa.array(keep))

        docs = over_rows(docs, clean, text_col, PIECE)
    return docs
