"""Quality classifier by positive-unlabelled learning.

A linear model on whole-text features minimises the non-negative unbiased risk (Kiryo et
al., 2017) with logistic loss: ``pi * E_p[l(f)] + max(0, E_u[l(-f)] - pi * E_p[l(-f)])``. The
positives are trusted documents, the unlabelled ones any documents of the training part, and
the class prior ``pi`` is estimated from the two alone: a first model tells positives from
unlabelled text on one half, and on the other half ``pi`` is the least bounded ratio of
unlabelled to positive mass above a threshold (Garg et al., 2021).

Fitting takes a bounded sample: at most ``SAMPLE`` positives and ``SAMPLE`` unlabelled rows,
those of least hashed id. Scoring is one pass over all whole texts.

Null texts are empty and get the score of the empty text. Repeated rows are scored each.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import ranges, rolling, word_bounds, word_hashes
from .frames import id_and_text, over_rows, over_texts, text_bytes

SAMPLE = 4_096
# Features take about a hundred bytes a byte of text.
PIECE = 2 << 20
STEPS, RATE, DECAY = 400, 0.05, 1e-3
SHAPES = 14
FEATURES = 256 + SHAPES


def in_part(doc_id: Column, parts: int = 3, part: int = 1) -> Column:
    """True where crc32 of the id's decimal text leaves ``part``. A null id is never in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def _per_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))[rows])


def _distinct(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Distinct keys within each row."""
    owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=len(rows) - 1).astype(float)


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte shares and shape figures of every row: how its words, lines and marks are made up."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    owner = np.repeat(np.arange(n), size)
    shares = np.bincount(owner * 256 + raw, minlength=n * 256).reshape(n, 256) / np.maximum(size, 1)[:, None]
    starts, ends, rows = word_bounds(raw, offsets)
    words = np.diff(rows)
    length = (ends - starts).astype(float)
    hashes = word_hashes(raw, starts, ends)
    some = np.maximum(words, 1)
    mean = _per_row(length, rows) / some
    upper = (raw >= 65) & (raw <= 90)
    letter = upper | ((raw >= 97) & (raw <= 122)) | (raw >= 128)
    upper_words = np.concatenate(([0], np.cumsum(upper)))
    last = raw[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    odd_end = ~letter[ends - 1] & ~np.isin(last, np.frombuffer(b".,?;:0123456789", np.uint8)) if len(ends) else np.zeros(0, bool)
    all_upper = (upper_words[ends] - upper_words[starts]) * 2 > ends - starts
    no_letter = np.diff(np.concatenate(([0], np.cumsum(letter)))[np.stack((starts, ends))], axis=0)[0] == 0 if len(starts) else np.zeros(0, bool)
    pairs = rolling(hashes, 3) if len(hashes) >= 3 else np.zeros(0, np.uint64)
    triples = np.maximum(words - 2, 0)
    triple_rows = np.concatenate(([0], np.cumsum(triples)))
    kept = pairs[ranges(rows[:-1], triples)]
    inner = np.ones(len(hashes), bool)
    inner[rows[:-1][words > 0]] = False
    again = inner & np.concatenate(([False], hashes[1:] == hashes[:-1])) if len(hashes) else inner
    # Chance that two words drawn from the row are equal: high where few words fill the text.
    word_owner = np.repeat(np.arange(n), words)
    _, first, count = np.unique(hashes ^ (word_owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_counts=True)
    focus = np.bincount(word_owner[first], weights=count.astype(float) ** 2, minlength=n) / some**2
    shape = np.stack(
        [
            np.log1p(size),
            np.log1p(words),
            mean,
            np.sqrt(np.maximum(_per_row(length**2, rows) / some - mean**2, 0)),
            _distinct(hashes, rows) / some,
            _distinct(kept, triple_rows) / np.maximum(triples, 1),
            _per_row(odd_end, rows) / some,
            _per_row(all_upper, rows) / some,
            _per_row(no_letter, rows) / some,
            _per_row(letter, offsets) / np.maximum(size, 1),
            (words == 0).astype(float),
            _per_row((length > 25), rows) / some,
            _per_row(again, rows) / some,
            focus,
        ],
        axis=1,
    )
    return np.concatenate((np.log1p(1000 * shares), shape), axis=1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


class Model:
    def __init__(self, weights: np.ndarray, bias: float, mean: np.ndarray, scale: np.ndarray, prior: float):
        self.weights, self.bias, self.mean, self.scale, self.prior = weights, bias, mean, scale, prior

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(x))


def _descend(p: np.ndarray, u: np.ndarray, gradient, prior: float) -> Model:
    """Adam on standardised features; ``gradient`` gives the slopes at the margins of p and u."""
    mean, scale = u.mean(axis=0, dtype=np.float64), u.std(axis=0, dtype=np.float64)
    scale[scale < 1e-6] = 1.0
    both = np.concatenate((p, u))
    both = np.clip((both - mean.astype(both.dtype)) / scale.astype(both.dtype), -8, 8)
    w = np.zeros(both.shape[1] + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        f = both @ w[:-1] + w[-1]
        slope = gradient(f[: len(p)], f[len(p) :])
        g = np.append(both.T @ slope + DECAY * w[:-1], slope.sum())
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(w[:-1], float(w[-1]), mean, scale, prior)


def estimate_prior(p: np.ndarray, u: np.ndarray, sure: float = 0.1) -> float:
    """Share of positives in the unlabelled rows, from a positive-unlabelled split alone."""
    if len(p) < 4 or len(u) < 4:
        return 0.5
    slopes = lambda fp, fu: np.concatenate((-_sigmoid(-fp) / len(fp), _sigmoid(fu) / len(fu)))
    model = _descend(p[::2], u[::2], slopes, 0.5)
    sp, su = np.sort(model.margin(p[1::2])), np.sort(model.margin(u[1::2]))
    above = lambda s, c: 1 - np.searchsorted(s, c) / len(s)
    qp, qu = above(sp, sp), above(su, sp)
    slack = np.sqrt(np.log(4 / sure) / 2) * (1 / np.sqrt(len(sp)) + 1 / np.sqrt(len(su)))
    best = int(np.argmin((qu + slack) / np.maximum(qp, 1e-9)))
    return float(np.clip(qu[best] / qp[best], 0.01, 0.99))


def fit(p: np.ndarray, u: np.ndarray, prior: float | None = None) -> Model:
    """Minimise the non-negative risk; a negative part that falls below zero is pushed back up."""
    if not len(p) or not len(u):
        width = FEATURES
        return Model(np.zeros(width), 0.0, np.zeros(width), np.ones(width), prior or 0.5)
    pi = estimate_prior(p, u) if prior is None else prior

    def slopes(fp, fu):
        positive = -pi * _sigmoid(-fp) / len(fp)
        negative_p, negative_u = -pi * _sigmoid(fp) / len(fp), _sigmoid(fu) / len(fu)
        negative_risk = np.logaddexp(0, fu).mean() - pi * np.logaddexp(0, fp).mean()
        if negative_risk < 0:
            return np.concatenate((-negative_p, -negative_u))
        return np.concatenate((positive + negative_p, negative_u))

    return _descend(p, u, slopes, pi)


def column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def _features(piece: pa.RecordBatch) -> pa.RecordBatch:
    x = features(*text_bytes(piece)).astype(np.float32)
    lists = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.float32()))
    return pa.RecordBatch.from_arrays([column(piece, "doc_id"), lists], ["doc_id", "x"])


def train(docs: DataFrame, positives: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on rows of ``docs`` for which ``usable`` (over ``doc_id``) holds. ``positives`` has the trusted ``doc_id``."""
    texts = id_and_text(docs, id_col, text_col).where("doc_id is not null")
    usable = F.lit(True) if usable is None else usable
    rank = lambda seed: F.xxhash64("doc_id", F.lit(seed))
    pick = lambda ids, seed: ids.select("doc_id").where(usable).distinct().orderBy(rank(seed), "doc_id").limit(SAMPLE)
    trusted = pick(positives.select(F.col("doc_id").cast("long").alias("doc_id")).join(texts.select("doc_id").distinct(), "doc_id", "left_semi"), 1)
    chosen = pick(texts, 2).withColumn("unlabelled", F.lit(1)).join(trusted.withColumn("trusted", F.lit(1)), "doc_id", "full")
    # At most 2 * SAMPLE rows.
    chosen = chosen.select("doc_id", F.col("trusted").isNotNull().alias("trusted"), F.col("unlabelled").isNotNull().alias("unlabelled"))
    held = over_texts(texts.join(F.broadcast(chosen.select("doc_id")), "doc_id").dropDuplicates(["doc_id"]), _features, "doc_id long, x array<float>", PIECE)
    rows = held.join(F.broadcast(chosen), "doc_id").orderBy("doc_id").toArrow()
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1) if rows.num_rows else np.zeros((0, FEATURES))
    flags = [np.array(rows.column(c).to_pylist(), bool) for c in ("trusted", "unlabelled")]
    return fit(x[flags[0]], x[flags[1]])


def _score(piece: pa.RecordBatch, model: Model) -> pa.RecordBatch:
    score = model.score(features(*text_bytes(piece)))
    return pa.RecordBatch.from_arrays(
        [column(piece, "doc_id"), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32), pa.int32())], ["doc_id", "score", "predicted"]
    )


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of every row; the score is the chance of a good text."""
    return over_texts(id_and_text(docs, id_col, text_col), partial(_score, model=model), "doc_id long, score double, predicted int", PIECE)


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    measure, raw = features, text_bytes
    return over_rows(docs, lambda piece: piece.filter(pa.array(model.score(measure(*raw(piece, text_col))) >= 0.5)), text_col, PIECE)
