"""The latent space is fitted on every passage of every document."""

import numpy as np
import pyarrow as pa
from modtally.llm import latent_decontam as L
from pyspark.sql import functions as F


def test_every_passage_counts(spark):
    """Whitened by all passages, all passages together have the variance 1 in every latent direction."""
    word = lambda k: F.concat(F.lit("word"), F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(30) + F.col("doc_id") % 3 * 10).cast("string"))
    texts = spark.range(45_000).withColumnRenamed("id", "doc_id").withColumn("text", F.concat_ws(" ", *(word(k) for k in range(7))))
    items = spark.createDataFrame([(1, "word1 word2 word3")], "item_id long, text string")
    table = L.latent_space(texts, items)
    rows = [r.text for r in texts.collect()]
    words, offsets = L.words_of(pa.array([*rows, "word1 word2 word3"], pa.large_string()))
    df = np.zeros(L.TERMS)
    for row in rows:
        own, _ = L.words_of(pa.array([row], pa.large_string()))
        df[np.unique(L.terms(own))] += 1
    weight = np.log((len(rows) + 1) / (df + 1)) + 0.1
    owner, term, value = L.passages(words, offsets, weight)
    z = np.zeros((len(rows) + 1, L.RANK))
    np.add.at(z, owner, table[term] * (value / weight[term])[:, None])
    found = np.linalg.eigvalsh(z.T @ z)
    found = found[found > 1e-3]
    # The documents have 50 different words.
    assert len(found) == 50 and np.allclose(found, 1, atol=0.01)
