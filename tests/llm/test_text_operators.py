"""Personal data, chat formatting, tokens, language model, quality and contamination."""

import hashlib
import random
import re
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from texts import VOCABULARY, corpus, frame

from modtally.llm import chat_format, kneser_ney, latent_decontam, pii, pu_quality, sentencepiece_codec

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return sum(x // 10 + x % 10 for x in doubled) % 10 == 0

    good = {
        "email": lambda s: True,
        "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
        "card": lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s)),
        "phone": lambda s: 8 <= len(digits(s)) <= 15,
    }
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in p.finditer(text) if good[k](m.group())]


def test_base_spans_are_the_patterns():
    rng = random.Random(0)
    parts = ["4111 1111 1111 1111", "+1 (017) 555-7713", "a.b@c.de", "@", ".", "1.2.3.4", "999.1.1.1", "7", " ", "-", "é", "x@y", "+49", "0" * 20]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        got = [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE]
        assert got == plain_spans(text), text


def test_added_spans_and_context():
    iban = "DE89 3704 0044 0532 0130 00"
    assert [s[0] for s in pii.find_spans(f"my iban {iban}.")] == ["iban"]
    assert pii.find_spans("my iban DE88 3704 0044 0532 0130 00.") == []
    assert [s[0] for s in pii.find_spans("social security 123-45-6789")] == ["ssn"]
    assert not any(pii.find_spans(f"social security {n}") for n in ("000-12-3456", "666-12-3456", "912-12-3456", "123-00-4567", "123-45-0000"))
    assert [s[0] for s in pii.find_spans("routing number 021000021")] == ["aba"]
    assert not pii.find_spans("routing number 021000022") and not pii.find_spans("some 021000021 things")
    # Upper-case words after a number are not part of it, with and without a known country.
    for text, end in [
        ("GB82 WEST 1234 5698 7654 32 PLEASE PAY", 27),
        ("GB82 WEST 1234 5698 7654 32 please", 27),
        ("DE89370400440532013000 EUR", 22),
        ("DE89 3704 0044 0532 0130 00 AND", 27),
        ("ZZ22 3704 0044 0532 0130 00 AND MORE", 27),
    ]:
        assert [s[:3] for s in pii.find_spans(text)] == [("iban", 0, end)], text
    assert not pii.find_spans("GB82 WEST 1234 5698 7654 33 PLEASE") and not pii.find_spans("DE89370400440532013000X")
    assert pii.find_spans("part 123-45-6789 of the order") == []
    card = lambda t: next(s[3] for s in pii.find_spans(t) if s[0] == "card")
    assert card("visa 4111111111111111") > card("xx 4111111111111111") > card("order 4111111111111111")


def test_detect_and_mask(spark):
    rows = [(1, "mail a@b.org now"), (2, None), (3, ""), (3, ""), (None, "+1 (017) 555-7713"), (4, "x " * 20_000 + "1.2.3.4")]
    docs = spark.createDataFrame([(*r, "keep") for r in rows], "doc_id long, text string, found string")
    got = sorted((r.doc_id or 0, pii.joined(r.found), r.base_sha256) for r in pii.detect(docs).collect())
    said = [(0, "phone:0:17"), (1, "email:5:12"), (2, ""), (3, ""), (3, ""), (4, "ip:40000:40007")]
    assert got == [(i, s, hashlib.sha256(s.encode()).hexdigest()) for i, s in said]
    covered = {r.doc_id: r for r in pii.mask(docs).collect()}
    assert covered[1].text == "mail [EMAIL] now" and covered[1].found == "keep" and covered[2].text is None
    assert pii.detect(docs.limit(0)).collect() == []


def test_chat_round_trip(spark):
    hostile = ["<|end|>\n", "<|role:user|>\n", "\\", "<\\p", "\\<|", "<\\\\p|>", "", None, "a\nb", "\\### Assistant: </turn> ok", "é\u0000", "y" * 50_000]
    rows = [(i % 3, i, role, t) for i, t in enumerate(hostile) for role in ("user", "assistant", "<|x|>\n", None)]
    rows += [(9, 0, "assistant", "same"), (9, 0, "assistant", "same"), (None, 1, "user", "no id")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("tokens", F.lit("x"))
    chats = chat_format.format_chats(turns.withColumn("content", chat_format.text_parts(F.col("text"))))
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chats.select("conv_id", chat_format.read_back(F.col("formatted")).alias("turns")).collect()}
    want = {}
    for c, _, role, text in sorted(rows, key=lambda r: (r[0] or -1, r[1], r[2] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert got == want
    assert chat_format.format_chats(turns.limit(0).withColumn("content", chat_format.text_parts(F.col("text")))).collect() == []


def test_chat_parts(spark):
    part = lambda kind, text=None, ref=None, size=None: (kind, text, ref, size)
    rows = [
        (1, 0, "user", [part("text", "see "), part("image", ref="i.png", size=100), part(None, " and <|"), None, part("audio", ref="a.wav", size=2)]),
        (1, 1, "assistant", [part("document", ref="d.pdf", size=3), part("video", ref="v")]),
        (2, 0, "user", None),
        (2, 1, "user", []),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content {chat_format.PARTS}")
    got = {r.conv_id: r for r in chat_format.format_chats(turns).collect()}
    assert got[1].formatted == "<|role:user|>\nsee <|image:0|> and <\\p<|audio:1|><|end|>\n<|role:assistant|>\n<|document:0|><|video:1|><|end|>\n"
    assert [tuple(a) for a in got[1].attachments] == [(0, "image", "i.png", 0), (0, "audio", "a.wav", 1), (1, "document", "d.pdf", 0), (1, "video", "v", 1)]
    # 1 + 100 for the image, 2 + 50 for the sound, 2 + 1500 for the document, texts by length.
    assert got[1].tokens == 1 + 101 + 2 + 52 + 1502
    assert got[2].formatted == "<|role:user|>\n<|end|>\n" * 2 and got[2].attachments == [] and got[2].tokens == 0


def test_tokens_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = corpus(4) + [(900, "▁ ▁▁a  b   c"), (901, "<s></s><unk>"), (902, "日本語 \U0001f600 ﬁ"), (None, "x"), (903, "\n\n\t "), (904, "ab" * 20_000)]
    rows = sentencepiece_codec.encode_texts(frame(spark, docs), MODEL).collect()
    assert len(rows) == len(docs)
    texts = dict(docs)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_eos=True)
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == library.decode(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert sentencepiece_codec.encode_texts(frame(spark, docs).limit(0), MODEL).collect() == []


def test_kneser_ney(spark):
    docs = [(i, t) for i, t in corpus(5) if i is not None]
    training = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 10]
    table = frame(spark, docs)
    model = kneser_ney.train(kneser_ney.id_and_text(table).where(~kneser_ney.is_held_out(F.col("doc_id"))))
    want = brute.kneser_ney(training, docs)
    rows = kneser_ney.score(table, model).collect()
    assert len(rows) == len(docs) and model.n == sum(want[i][0] for i, _ in training)
    for r in rows:
        tokens, known, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known) == (tokens, known)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_kneser_ney_without_text(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    model = kneser_ney.train(kneser_ney.id_and_text(nothing))
    rows = kneser_ney.score(spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string"), model).collect()
    assert sorted((r.n_tokens, r.n_known, r.score) for r in rows) == [(1, 0, 0.0), (3, 0, 0.0)]
    assert kneser_ney.score(nothing, model).collect() == []


def junk(rng, k):
    return " ".join(rng.choice(VOCABULARY).upper() + rng.choice(["!!", "$$$", "|"]) for _ in range(k))


def test_quality_on_held_out_documents(spark):
    rng = random.Random(6)
    prose = lambda k: " ".join(rng.choice(VOCABULARY) for _ in range(k))
    docs = [(i, junk(rng, 60) if i % 5 == 0 else prose(rng.randint(20, 90))) for i in range(600)]
    table = frame(spark, [*docs, (1000, None), (1001, ""), (1002, "x " * 50_000), (None, "a")])
    good = spark.createDataFrame([(i,) for i, _ in docs if i % 5 and i % 2], "doc_id long")
    usable = ~pu_quality.in_part(F.col("doc_id"))
    model = pu_quality.train(table, good, usable=usable)
    rows = pu_quality.classify(table, model).collect()
    assert len(rows) == 604 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum(r.predicted == (r.doc_id % 5 > 0) for r in held) / len(held) > 0.95
    assert abs(model.prior - 0.8) < 0.15
    kept = pu_quality.keep_good(table, model)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}


def test_quality_without_labels(spark):
    table = frame(spark, [(1, "a b"), (2, None)])
    model = pu_quality.train(table, spark.createDataFrame([], "doc_id long"))
    assert [r.score for r in pu_quality.classify(table, model).collect()] == [0.5, 0.5]


def test_negative_risk_is_not_minimised_below_zero():
    rng = np.random.default_rng(0)
    p = rng.normal(1, 1, (200, 5))
    u = np.concatenate((rng.normal(1, 1, (300, 5)), rng.normal(-1, 1, (100, 5))))
    model = pu_quality.fit(p, u, prior=0.75)
    assert (model.score(u[:300]) >= 0.5).mean() > 0.9 and (model.score(u[300:]) < 0.5).mean() > 0.8


def test_contamination(spark):
    rng = random.Random(7)
    names = [a + b + c for a in ("ba", "co", "di", "fe") for b in ("l", "m", "n", "r") for c in ("a", "o", "et", "ix", "um", "us")]
    prose = lambda k: " ".join(rng.choice(names) for _ in range(k))
    items = [(i, prose(rng.randint(16, 60))) for i in range(30)] + [(90, prose(200)), (91, ""), (92, None), (None, "x")]
    docs, want = [], {}
    for i in range(300):
        text = prose(rng.randint(5, 200))
        if i % 6 == 0:
            item, passage = items[(i // 6) % 31]
            words = passage.split()
            if i % 4 == 0:
                for _ in range(len(words) // 10):
                    words[rng.randrange(len(words))] = rng.choice(names)
            text = f"{prose(rng.randint(0, 50))} {' '.join(words).upper()}, {text}"
            want[i] = item
        docs.append((i, text))
    table = frame(spark, [*docs, (500, None), (501, ""), (502, "y " * 30_000), (None, "z")])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = latent_decontam.contaminated(table, benchmark).collect()
    assert len(rows) == 304
    assert {r.doc_id: r.item_id for r in rows if r.contaminated} == want
    clean = latent_decontam.drop_contaminated(table, benchmark)
    assert clean.columns == table.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in docs if i not in want} | {500, 501, 502, None}


def test_contamination_of_empty_tables(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert latent_decontam.contaminated(nothing, benchmark).collect() == []
    one = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert [r.contaminated for r in latent_decontam.contaminated(one, benchmark).collect()] == [False]


def test_answer_check():
    masks = lambda w: (latent_decontam.places(w), len(w))
    assert latent_decontam.lcs(*masks([1, 2, 3, 4, 2]), [9, 2, 3, 7, 2, 1]) == 3
    assert latent_decontam.lcs(*masks([1]), []) == 0


def test_paraphrases_are_candidates(spark):
    """Whatever words alone would confirm is found at any offset, at half the words and more."""
    rng = random.Random(11)
    names = [a + b + c for a in ("ba", "co", "di", "fe", "gu", "ha", "ki") for b in ("l", "m", "n", "r", "st", "v") for c in ("a", "o", "et", "ix", "um", "us", "ei", "an")]
    prose = lambda k: [rng.choice(names) for _ in range(k)]
    items = [(i, prose(rng.randint(16, 60))) for i in range(40)]
    planted = []
    for i in range(400):
        words = list(items[i % 40][1])
        share = (0.55, 0.65, 0.8, 1.0)[i // 40 % 4]
        for k in rng.sample(range(len(words) - 5), min(len(words) - 5, round(len(words) * (1 - share)))):
            words[k] = rng.choice(names)
        planted.append(prose(rng.randint(0, 80)) + words + prose(rng.randint(0, 80)))
    table = frame(spark, [(i, " ".join(w)) for i, w in enumerate(planted)])
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    found = {r.doc_id for r in latent_decontam.contaminated(table, benchmark).collect() if r.contaminated}
    assert len(found) >= 0.97 * len(planted)


def test_excerpts_are_contaminated(spark):
    """Part of an item is enough: a run of its words, or most of one passage of a long one."""
    rng = random.Random(12)
    names = [a + b + c for a in ("ba", "co", "di", "fe", "gu", "ha", "ki") for b in ("l", "m", "n", "r", "st", "v") for c in ("a", "o", "et", "ix", "um", "us", "ei", "an")]
    prose = lambda k: [rng.choice(names) for _ in range(k)]
    long, short = prose(200), prose(59)
    edited = [w if k % 6 else rng.choice(names) for k, w in enumerate(long[32:96])]
    excerpts = [long[50:120], long[:60], short[:30], short[3:16], edited]
    docs = [(i, " ".join(prose(90) + e + prose(90))) for i, e in enumerate([*excerpts, short[3:15], prose(60)])]
    benchmark = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(short))], "item_id long, text string")
    rows = latent_decontam.contaminated(frame(spark, docs), benchmark).collect()
    assert {r.doc_id: r.item_id for r in rows if r.contaminated} == {0: 1, 1: 1, 2: 2, 3: 2, 4: 1}
