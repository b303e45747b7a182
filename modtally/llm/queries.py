"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, flat_graph, kneser_ney, latent_decontam, merkle, pii, pu_quality, quality_rules, sentencepiece_codec, suffix_array, superkmers, superminhash, turn_repair
from .frames import id_and_text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PIECE_MODEL = "piece_bpe_32k.model"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    shown = F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return found.select("doc_id", *map(count, pii.BASE), "base_sha256", F.array_join(shown, ",").alias("spans"))


# The conversation that the contract adds.
PLANTED = r"\### Assistant: </turn> ok"


@query
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], turns.schema)
    chats = chat_format.format_chats(turns.unionByName(added).withColumn("content", chat_format.text_parts(F.col("text"))))
    read = chats.select("conv_id", "formatted", chat_format.read_back(F.col("formatted")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat_format.loss_text(F.col("turns"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLES["op3_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length(replace(replace(role, '\', '\\'), '<|', '<\p')) + length(replace(replace(text, '\', '\\'), '<|', '<\p')) + 18) AS chars
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(chars AS BIGINT) AS formatted_chars
FROM c
"""


@query
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("n_tokens", "ids_sha256", "decoded_sha256")
    return sentencepiece_codec.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL), columns)


@query
def op4_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


@query
def op7_superkmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmers.remove_repeats(table(spark, sf_dir, "documents"), size=20, keep_text=False)


@query
def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.remove_repeated_bytes(table(spark, sf_dir, "documents"), size=200, keep_bytes=False)


@query
def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = kneser_ney.is_held_out(F.col("doc_id"))
    model = kneser_ney.train(kneser_ney.id_and_text(docs).where(~held_out))
    scored = kneser_ney.score(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score", "perplexity"
    )


@query
def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = pu_quality.in_part(F.col("doc_id"))
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    model = pu_quality.train(docs, good, usable=~held_out)
    return pu_quality.classify(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op6_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    result, recall = flat_graph.near_vectors(table(spark, sf_dir, "embeddings"), least=0.95)
    return result.withColumn("audited_recall", F.lit(recall))


@query
def op5_latent_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent_decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def crc32_sql(text: str) -> str:
    """DuckDB expression for the unsigned CRC-32 of a text: each byte is mixed in, then shifted out bit by bit."""
    code = f"hex(encode({text}))"
    byte = f"CAST('0x' || substr({code}, 2 * i - 1, 2) AS BIGINT)"
    steps = f"flatten(list_transform(range(1, strlen({text}) + 1), lambda i: [{byte}, -1, -1, -1, -1, -1, -1, -1, -1]))"
    mixed = "CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, x: {mixed}), 4294967295)"


MANIFEST = ("doc_id", "source", "lang", "n_chars", "text")


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*MANIFEST)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    altered = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    proofs = merkle.tamper_proofs(docs, MANIFEST, "source", "doc_id", altered, tampered)
    proof = F.sha2(merkle.siblings(F.col("proof")).cast("binary"), 256).alias("proof_sha256")
    return proofs.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


def _leaf_sql(text: str) -> str:
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    return "sha256(" + " || ".join(field(c) for c in (*MANIFEST[:-1], text)) + ")"


ORACLES["op11_merkle"] = f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM (SELECT doc_id, source, {_leaf_sql('text')} AS leaf,
    CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS changed FROM documents)
), low AS (
  SELECT source, 0 AS level, pos AS idx, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT source, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3
  FROM low WHERE n > 1 GROUP BY source, level, idx // 3, n
), subroots AS (
  SELECT source, level AS height, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM low WHERE n = 1
), high AS (
  SELECT 0 AS level, place AS idx, subroot AS digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM high WHERE n > 1 GROUP BY level, idx // 3, n
), nodes AS (
  SELECT 's' || coalesce('=' || source, '') AS tree, level, idx, digest FROM low WHERE n > 1
  UNION ALL SELECT '', level, idx, digest FROM high WHERE n > 1
), runs AS (
  SELECT tree, level, idx // 3 AS run, list(digest ORDER BY idx) AS digests FROM nodes GROUP BY tree, level, idx // 3
), steps AS (
  SELECT l.*, s.subroot, s.height, s.place FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
), fold AS (
  SELECT doc_id, leaf, subroot, height, place, source, CASE WHEN height = 0 THEN place ELSE pos END AS idx, 0 AS level, coalesce(changed, leaf) AS digest, '' AS passed FROM steps
  UNION ALL
  SELECT f.doc_id, f.leaf, f.subroot, f.height, f.place, f.source,
    CASE WHEN f.level + 1 = f.height THEN f.place ELSE f.idx // 3 END, f.level + 1,
    sha256(array_to_string(list_transform(r.digests, lambda d, i: CASE WHEN i = f.idx % 3 + 1 THEN f.digest ELSE d END), '')),
    f.passed || array_to_string(list_filter(r.digests, lambda d, i: i <> f.idx % 3 + 1), '')
  FROM fold f JOIN runs r ON r.tree = CASE WHEN f.level < f.height THEN 's' || coalesce('=' || f.source, '') ELSE '' END
    AND r.level = CASE WHEN f.level < f.height THEN f.level ELSE f.level - f.height END AND r.run = f.idx // 3
)
SELECT doc_id, leaf, subroot, (SELECT digest FROM high WHERE n = 1) AS root, sha256(passed) AS proof_sha256, digest AS folded_root,
  digest = (SELECT digest FROM high WHERE n = 1) AS verified
FROM fold WHERE level = height + (SELECT max(level) FROM high)
"""


def damaged(turns: DataFrame) -> DataFrame:
    """Rows as the contract damages them; a dropped row stays with ``present`` false, so that its conversation does."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    role = F.when(code == 4, "user").otherwise(text("role"))
    said = F.when(code == 1, "").when(code == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text"))
    copies = F.array_repeat(code != 0, F.when(code == 3, 2).otherwise(1))
    return turns.select("conv_id", "turn", role.alias("role"), said.alias("text"), F.explode(copies).alias("present"))


@query
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(damaged(table(spark, sf_dir, "conversations")))


def _repair_sql() -> str:
    """The dynamic program as a recursive query: per row the least of all ways into each of four positions."""
    far = 1_000_000_000

    def way(p: str, edits: str, cost: str, *lines: str) -> str:
        said = " || ".join(f"chr(10) || {x}" for x in lines)
        return f"{{c: {p}.c + {cost}, s: {p}.s || '{edits}', t: {p}.t{' || ' + said if said else ''}}}"

    stays = f"CASE WHEN gone THEN {far} ELSE cut END"
    keeps = lambda i: f"CASE WHEN gone OR initial <> '{i}' THEN {far} ELSE cut END"
    named, user, assistant = "role || ':' || text", "'user:' || text", "'assistant:' || text"
    deleted = lambda p: way(p, "D", "3")
    u = [deleted("su")]
    a = [deleted("sa")]
    for p in ("s0", "s1", "sa"):
        u += [way(p, "K", keeps("u"), named), way(p, "R", f"2 + {stays}", user)]
        a += [way(p, "IK", f"2 + {keeps('a')}", "'user:'", named), way(p, "IR", f"4 + {stays}", "'user:'", assistant)]
    a += [way("su", "K", keeps("a"), named), way("su", "R", f"2 + {stays}", assistant)]
    u += [way("su", "IK", f"2 + {keeps('u')}", "'assistant:'", named), way("su", "IR", f"4 + {stays}", "'assistant:'", user)]
    least = lambda ways: f"list_min([{', '.join(ways)}])"
    system = least([deleted("s1"), way("s0", "K", keeps("s"), named)])
    ends = least([way("s0", "", "0"), way("s1", "II", "4", "'user:'", "'assistant:'"), way("su", "I", "2", "'assistant:'"), way("sa", "", "0")])
    unreached = f"{{c: {far}::BIGINT, s: '', t: ''}}"
    space = r"[^\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS code
  FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT * FROM given WHERE code <> 0 UNION ALL SELECT * FROM given WHERE code = 3)
), placed AS (
  SELECT *, substr(role, 1, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM hurt
), judged AS (
  SELECT *, NOT blank AND NOT repeated AND NOT regexp_matches(text, '[.!?][ 	-
]*$') AS truncated
  FROM (SELECT *, NOT regexp_matches(text, '{space}') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS repeated,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS former FROM placed)
), steps AS (
  SELECT conv_id, i, role, text, initial, blank OR repeated AS gone, CASE WHEN truncated THEN 1 ELSE 0 END AS cut FROM judged
), walk AS (
  SELECT conv_id, 0::BIGINT AS i, {{c: 0::BIGINT, s: '', t: ''}} AS s0, {unreached} AS s1, {unreached} AS su, {unreached} AS sa
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT w.conv_id, w.i + 1, {deleted("s0")}, {system}, {least(u)}, {least(a)}
  FROM walk w JOIN steps x ON w.conv_id IS NOT DISTINCT FROM x.conv_id AND x.i = w.i + 1
), ended AS (
  SELECT conv_id, {ends} AS best FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND repeated) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (former || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, best.c AS cost, best.s AS audit, sha256(substr(best.t, 2)) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


ORACLES["op13_turn_repair"] = _repair_sql()


@query
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # The held-out third of the labels is not used, as in op1.
    good = table(spark, sf_dir, "labels").where((F.col("quality") == 1) & ~pu_quality.in_part(F.col("doc_id"))).select("doc_id")
    judged = quality_rules.judge(docs, quality_rules.weigh(id_and_text(docs), good))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "n_features")


_B = quality_rules

ORACLES["op12_quality_rules"] = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS MATERIALIZED (
  SELECT row, doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d
), v AS MATERIALIZED (
  SELECT word, {crc32_sql('word')} AS h FROM (SELECT DISTINCT word FROM w)
), hashed AS (
  SELECT row, doc_id, i, h, lead(h) OVER (PARTITION BY row ORDER BY i) AS later FROM w JOIN v USING (word)
), f AS MATERIALIZED (
  SELECT row, doc_id, h % {_B.BUCKETS} AS bucket FROM hashed
  UNION ALL SELECT row, doc_id, (h * {_B.MIX} + later) % {_B.BUCKETS} FROM hashed WHERE later IS NOT NULL
), good AS (
  SELECT DISTINCT doc_id, TRUE AS trusted FROM labels WHERE quality = 1 AND {crc32_sql('CAST(doc_id AS VARCHAR)')} % 3 <> 1
), counts AS (
  SELECT bucket, count(*) AS raw, count(trusted) AS target FROM f LEFT JOIN good USING (doc_id) GROUP BY bucket
), weights AS (
  SELECT bucket, CAST(round({_B.MILLION} * ln((target + {_B.PRIOR}::DOUBLE) / (raw::DOUBLE * (sum(target) OVER ())::DOUBLE / (sum(raw) OVER ())::DOUBLE + {_B.PRIOR}::DOUBLE))) AS BIGINT) AS weight FROM counts
), sums AS (
  SELECT row, sum(weight) AS ratio, count(*) AS n_features FROM f JOIN weights USING (bucket) GROUP BY row
), wins AS (
  SELECT row, i, array_to_string(list_slice(words, i, i + {_B.WINDOW - 1}), ' ') AS win
  FROM (SELECT row, words, unnest(range(1, len(words) - {_B.WINDOW - 2})) AS i FROM d)
), twice AS (
  SELECT row, i FROM wins QUALIFY count(*) OVER (PARTITION BY row, win) > 1
), covered AS (
  SELECT row, sum(least({_B.WINDOW}, coalesce(following - i, {_B.WINDOW}))) AS n
  FROM (SELECT row, i, lead(i) OVER (PARTITION BY row ORDER BY i) AS following FROM twice) GROUP BY row
), base AS (
  SELECT row, doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered USING (row)
), ruled AS (
  SELECT *, n_words < {_B.LEAST_WORDS} OR 100 * n_repeat_words > {_B.MOST_REPEATED} * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(ratio, 0) >= {_B.THRESHOLD} * coalesce(n_features, 0) AS kept, CAST(coalesce(ratio, 0) AS BIGINT) AS ratio, coalesce(n_features, 0) AS n_features
FROM ruled LEFT JOIN sums USING (row)
"""
