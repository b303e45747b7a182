"""The registered queries and the pipeline over a whole driver table, against brute force."""

import hashlib
import os
import random
import re
import zlib

import brute
import public_tokenizers
import pytest
import sentencepiece
from test_text_operators import plain_spans
from test_vectors import exact

import corpus_pipeline
from __spark_entry__ import queries
from contract.compare import compare, connect
from modtally.llm import pii, pu_quality
from modtally.llm.queries import ORACLES, QUERIES

DIR, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver tables")
sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]


def test_one_query_per_operator():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and {*QUERIES, "pipeline"} <= set(queries())


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    assert compare(spark, connect(DIR), DIR, name) == ""


def test_op1(spark, docs):
    # The smallest table has one held-out document of bad quality only.
    rows = QUERIES["op1_pu_quality"](spark, LARGER).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95


def test_op12(spark):
    """The verdict on documents whose labels no count has used."""
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op12_quality_rules"](spark, LARGER).collect() if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    judged = [r for r in rows if not r.base_failed]
    assert sum(r.kept == truth[r.doc_id] for r in judged) / len(judged) > 0.9


def test_op2(spark, docs):
    rows = {r.doc_id: r for r in QUERIES["op2_pii"](spark, DIR).collect()}
    for i, text in docs:
        spans = plain_spans(text)
        assert [rows[i][f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE]
        assert rows[i].base_sha256 == sha(",".join("%s:%d:%d" % s for s in spans))
        assert {"%s:%d:%d" % s for s in spans} <= set(rows[i].spans.split(","))


def test_op4(spark, docs):
    assert {tuple(r) for r in QUERIES["op4_superminhash"](spark, DIR).collect()} == brute.near_duplicates(docs, 3, 85)


def leaks(spark, docs, words=8):
    """Documents that hold so many words in a row of a benchmark item."""
    plain = lambda t: re.findall(r"\w+", t.lower())
    runs = lambda w: {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}
    items = set().union(*(runs(plain(r.text)) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()))
    return {i for i, t in docs if runs(plain(t)) & items}


def test_op5(spark, docs):
    rows = QUERIES["op5_latent_decontam"](spark, DIR).collect()
    assert len(rows) == len(docs) and {r.doc_id for r in rows if r.contaminated} == leaks(spark, docs)


def test_op6(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DIR}/embeddings.parquet").collect()]
    got = QUERIES["op6_flat_graph"](spark, DIR).collect()
    assert {tuple(r)[:4] for r in got} == exact(rows, 0.95) and got[0].audited_recall >= 0.9


def test_op7(spark, docs):
    rows = QUERIES["op7_superkmers"](spark, DIR).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == brute.repeated_windows(docs, 20)


def test_op8(spark, docs):
    want = brute.kneser_ney([d for d in docs if zlib.crc32(str(d[0]).encode()) % 10], docs)
    for r in QUERIES["op8_kneser_ney"](spark, DIR).collect():
        assert (r.n_tokens, r.n_known) == want[r.doc_id][:2] and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert (r.base_score, r.score) == pytest.approx(want[r.doc_id][2:], rel=1e-9)


def test_op9(spark, docs):
    rows = QUERIES["op9_suffix_array"](spark, DIR).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == brute.repeated_bytes(docs, 200)


def test_op10(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = {r.doc_id: tuple(r)[1:] for r in QUERIES["op10_sentencepiece"](spark, DIR).collect()}
    for i, text in docs:
        ids = library.encode(text, add_eos=True)
        assert rows[i] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))


def test_pipeline(spark, docs):
    """Each stage on what the one before it kept."""
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    table = spark.read.parquet(f"{DIR}/documents.parquet")
    held_out = pu_quality.in_part(pu_quality.F.col("doc_id"))
    good = spark.read.parquet(f"{DIR}/labels.parquet").where("quality = 1").select("doc_id")
    scored = pu_quality.classify(table, pu_quality.train(table, good, usable=~held_out)).collect()
    left = [(i, t) for i, t in docs if i in {r.doc_id for r in scored if r.predicted}]
    kept = {r[0] for r in brute.near_duplicates(left, 5, 80) if r[3]}
    left = [(i, t) for i, t in left if i in kept]
    dropped = leaks(spark, left)
    left = [(i, pii.masked(t, pii.find_spans(t))) for i, t in left if i not in dropped]
    want = {i: [*library.encode(t), library.eos_id()] for i, t in left}
    rows = corpus_pipeline.run(spark, DIR).collect()
    assert {r.doc_id: r.ids for r in rows} == want and len(rows) == len(want) < len(docs)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    wider = docs.selectExpr("*", "nullif(1, 2) as score", "nullif('x', 'y') as digest")
    rows = [(None, None, None, None, None, 2, None), (7, None, "en", "s", 0, 3, "y"), (7, None, "en", "s", 0, 3, "y")]
    odd = wider.limit(40).unionByName(spark.createDataFrame(rows, wider.schema))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, DIR)
        assert out.schema.names == odd.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in odd.schema]
        assert out.count() <= odd.count()
        assert stage(spark, odd.limit(0), DIR).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, odd, DIR).count() == odd.count()


def test_texts_of_one_id_are_not_lost(spark):
    """A third of all rows share one id, some have none: every text stays that is near no other, and the same ones in two runs."""
    rng = random.Random(3)
    prose = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    one = prose(40)
    rows = [(7, prose(30), "a") for _ in range(20)] + [(7, one, x) for x in "cba"] + [(None, prose(30), "a") for _ in range(5)] + [(None, None, "n")]
    rows += [(100 + i, prose(30), "a") for i in range(20)] + [(90, one + " end", "z")]
    stages = dict(corpus_pipeline.STAGES)
    runs = []
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        runs.append(sorted(map(tuple, stages["near_duplicates"](spark, docs, DIR).collect()), key=repr))
    # The copies under id 7 are near the document 90, which has an id of its own.
    assert runs[0] == runs[1] == sorted([r for r in rows if r[1] != one], key=repr)
