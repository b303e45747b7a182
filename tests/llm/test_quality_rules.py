"""Quality rules against a plain version over awkward texts."""

import math
import re
import zlib

import texts
from brute import words

from modtally.llm import quality_rules
from modtally.llm.frames import id_and_text


def buckets(w):
    codes = [zlib.crc32(x.encode()) for x in w]
    return [c % quality_rules.BUCKETS for c in codes] + [(a * quality_rules.MIX + b) % quality_rules.BUCKETS for a, b in zip(codes, codes[1:])]


def base(text):
    text = text or ""
    w = words(text)
    wins = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    hit = {j for i, x in enumerate(wins) if wins.count(x) > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed


def plain(docs, good):
    raw, target = {}, {}
    for i, t in docs:
        for b in buckets(words(t)):
            raw[b] = raw.get(b, 0) + 1
            target[b] = target.get(b, 0) + (i in good)
    r, t = max(sum(raw.values()), 1), sum(target.values())
    weight = {b: math.log((target[b] + quality_rules.PRIOR) / (raw[b] * t / r + quality_rules.PRIOR)) * 1e6 for b in raw}
    out = []
    for i, text in docs:
        figures = base(text)
        own = [weight[b] for b in buckets(words(text))]
        out.append((i, *figures, sum(int(math.copysign(math.floor(abs(x) + 0.5), x)) for x in own), len(own)))
    return sorted(out, key=repr)


def judged(spark, docs, good, **kw):
    df = texts.frame(spark, docs)
    ids = spark.createDataFrame([(i,) for i in good], "doc_id long")
    found = quality_rules.judge(df, quality_rules.weigh(id_and_text(df), ids), **kw)
    return found.collect()


def rows(found):
    return sorted(
        ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.ratio, r.n_features) for r in found), key=repr
    )


def test_plain(spark):
    docs = texts.corpus(4)
    docs += [(900, "a b c d e f g h " * 3 + "x"), (901, "#a | b\n#a | b\n\n \n#a | b\r\n<%>"), (None, "null id"), (902, "w " * 40), (902, "w " * 40), (903, "é " * 25)]
    good = [i for i, _ in docs if i is not None and i % 3 == 0]
    found = judged(spark, docs, [*good, None, good[0]])
    assert rows(found) == plain(docs, set(good))
    assert all(r.kept == (not r.base_failed and r.ratio >= quality_rules.THRESHOLD * r.n_features) for r in found)


def test_no_trusted_text_no_rows_and_thresholds(spark):
    docs = [(1, "a b " * 20), (2, None)]
    assert rows(judged(spark, docs, [])) == plain(docs, set())
    assert judged(spark, [], []) == []
    long_text = [(1, " ".join(f"w{i}" for i in range(30)))]
    assert [r.kept for t in (-(10**9), 10**9) for r in judged(spark, long_text, [1], threshold=t)] == [True, False]


def test_trusted_ids_are_bounded(spark):
    ids = spark.range(1000).selectExpr("id % 500 as doc_id")
    some = {r.doc_id for r in quality_rules.trusted_ids(ids, 10).collect()}
    assert len(some) == 10 and some == {r.doc_id for r in quality_rules.trusted_ids(ids.repartition(7), 10).collect()}


def test_main_path_has_no_python(spark):
    df = texts.frame(spark, texts.corpus(1))
    plan = quality_rules.judge(df, quality_rules.weigh(id_and_text(df), df.select("doc_id")))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
