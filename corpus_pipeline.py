"""A training-data pipeline over ``documents``: quality, near-duplicates, contamination, personal data, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each
result as Parquet in the cluster's shared folder and reads it back as the next stage's
``docs``. A stage works on all rows its predecessor kept. All but the last keep the columns
of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modtally.llm import latent_decontam, pii, pu_quality, sentencepiece_codec, superminhash
from modtally.llm.frames import write_shared
from modtally.llm.queries import PIECE_MODEL, table

# Near-duplicates: words of a shingle and least similarity in percent.
SHINGLE, SIMILAR = 5, 80
# Keys of documents without an id of their own begin here.
KEY = 1 << 62


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the positive-unlabelled classifier rejects. Labels of the held-out third are not used."""
    held_out = pu_quality.in_part(F.col("doc_id"))
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return pu_quality.keep_good(docs, pu_quality.train(docs, good, usable=~held_out))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of least id of every near-duplicate group.

    Rows that share an id, or have none, are documents of their own by their texts: each text stays
    unless it is near another one, and of rows with equal id and text the least by all columns stays.
    """
    repeated = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").select("doc_id")
    if repeated.isEmpty():
        return _least_of_groups(docs, "doc_id")
    repeated = write_shared(repeated, "repeated-ids")
    odd = F.coalesce("_odd", F.lit(False)) | F.col("doc_id").isNull()
    # Above all ids: of a group with plain documents one of these stays.
    own = F.xxhash64("doc_id", "text").bitwiseAND(KEY - 1).bitwiseOR(KEY)
    marked = docs.join(repeated.withColumn("_odd", F.lit(True)).hint("shuffle_hash"), "doc_id", "left").select(
        *docs.columns, odd.alias("_odd"), F.when(odd, own).otherwise(F.col("doc_id")).alias("_key")
    )
    keyed = write_shared(marked, "keyed")
    plain = keyed.where("not _odd").drop("_odd")
    # A copied row is one group however often it occurs, and combines before the shuffle.
    least = keyed.where("_odd").groupBy("_key").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*", "_key")
    return _least_of_groups(plain.unionByName(least), "_key").select(docs.columns)


def _least_of_groups(docs: DataFrame, key: str) -> DataFrame:
    found = superminhash.near_duplicates(docs, SHINGLE, SIMILAR, id_col=key).where("not kept").select(F.col("doc_id").alias(key))
    return docs.join(found.hint("shuffle_hash"), key, "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item or a paraphrase of one."""
    return latent_decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data in every text; ``n_chars`` follows the text."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text; the decoded text goes along as a digest."""
    return sentencepiece_codec.encode_texts(docs, public_tokenizers.path(PIECE_MODEL), ("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

# The classifier, the latent search and the tokenizer are not SQL; tests hold every stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
