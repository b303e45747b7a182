"""A small corpus with every awkward case: copies, near copies, shared passages, odd characters."""

from __future__ import annotations

import random

VOCABULARY = [a + b for a in ("ka", "lo", "mi", "nu", "Pe", "Ša", "tü") for b in ("n", "ra", "se", "ti", "vo.", "x,")]


def corpus(seed: int = 0, n: int = 60) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    prose = lambda k: " ".join(rng.choice(VOCABULARY) for _ in range(k))
    passage, line = prose(70), prose(25)
    docs: list[tuple[int | None, str | None]] = []
    for i in range(n):
        text = prose(rng.randint(1, 120))
        if i % 3 == 0:
            text = f"{prose(rng.randint(0, 9))} {passage} {text}"
        if i % 4 == 1:
            text += "\n" + line + "\n" + line
        docs.append((i, text))
    base = prose(150).split()
    for i in range(n, n + 12):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
        docs.append((i, " ".join(words)))
    for i in range(n + 12, n + 20):
        docs.append((i, docs[5][1]))
    odd = [None, "", " \n\t\x0b", "one", "two words", "a b c", "   é\u0000 z", "x" * 900, "ab" * 700, "ab" * 700 + "c", "w " * 300, prose(4000)]
    docs += list(enumerate(odd, n + 20))
    rng.shuffle(docs)
    return docs


def frame(spark, docs, **extra):
    """Documents with more columns than needed, some named like the operators' own."""
    rows = [(i, t, 1, "en", b"blob", [1], "kept") for i, t in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, id int, lang string, blob binary, bands array<int>, component string")
