"""What the latent search spares gives the same: hashes by stretches, products of several passages, running totals, hopeless regions."""

import numpy as np
import pyarrow as pa

from modtally.llm import arrays
from modtally.llm import latent_decontam as L


def some_table(rng):
    table = rng.standard_normal((L.TERMS + 1, L.RANK), np.float32)
    table[-1] = 0
    return table


def test_hashes_do_not_depend_on_the_stretch(monkeypatch):
    texts = pa.array(["a bc  def", "", "x" * 500 + " \t\n y\x0b\x0cz \x1fé", *(f"word{k} " * 9 for k in range(50))], pa.large_string())
    whole = L.words_of(texts)
    monkeypatch.setattr(arrays, "AT_A_TIME", 16)
    parts = L.words_of(texts)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    alone = [L.words_of(pa.array([t], pa.large_string()))[0].tolist() for t in texts.to_pylist()]
    assert [h for t in alone for h in t] == whole[0].tolist()


def test_products_of_passages():
    """Passages are multiplied several at a time; the sum is ``A'(A W)``."""
    rng = np.random.default_rng(0)
    owner, term = np.divmod(np.unique(rng.integers(0, 100 * L.TERMS, 4_000)), L.TERMS)
    value = rng.random(len(owner))
    w, total = L.random_directions(), np.zeros((L.TERMS, L.RANK + L.SPARE), np.float32)
    L.add_products(total, w, owner, term, value)
    a = np.zeros((100, L.TERMS))
    a[owner, term] = value
    assert np.allclose(total, a.T @ (a @ w), atol=1e-3)


def test_running_totals():
    rng = np.random.default_rng(1)
    table, runs = some_table(rng), 5
    term = rng.integers(0, L.TERMS, runs * L.SUMMED)
    want = np.cumsum(np.concatenate((np.zeros((1, L.RANK)), table[term[:-1]])), axis=0)
    assert np.allclose(L.running_totals(table, term, np.tri(runs, k=-1, dtype=np.float32)), want, atol=1e-3)


def test_hopeless_regions_are_not_confirmed(monkeypatch):
    """Regions near an item that hold too few of its words cost no confirmation; the others are all found."""
    rng = np.random.default_rng(2)
    items = [(i, " ".join(f"item{i}w{k}" for k in range(40))) for i in range(20)]
    texts = []
    for i in range(400):
        words = [f"other{k}" for k in rng.integers(0, 10_000, 60)]
        kept = np.sort(rng.choice(40, 32 if i % 20 == 0 else 15, replace=False))
        words[10 : 10 + len(kept)] = [f"item{i // 20}w{k}" for k in kept]
        texts.append(" ".join(words))
    table = some_table(rng)
    known = L.Passages(items, table)
    words, rows = L.words_of(pa.array(texts, pa.large_string()))
    near = L.candidates(words, rows, table, known)
    assert len(set(near[0].tolist())) > 200
    calls, confirm = [], known.confirm
    monkeypatch.setattr(known, "confirm", lambda *a: calls.append(a) or confirm(*a), raising=False)
    found = {row: (item, share) for row, item, share, _ in L.search(words, rows, table, known)}
    assert found == {i: (i // 20, 0.8) for i in range(0, 400, 20)}
    assert len(calls) < 100
