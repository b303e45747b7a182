"""Quality rules with a learned verdict, in DataFrame functions only.

Base rules count what a text is made of: words, their code points, marks, repeated lines, and
words inside windows that occur twice or more. The verdict is a hashed n-gram log-likelihood
ratio: trusted texts and the raw corpus are two multinomials over ``BUCKETS`` hashed one- and
two-word features; a feature weighs ``ln((t + PRIOR) / (r * T / R + PRIOR))``, with its counts ``t`` and
``r`` and the totals ``T`` and ``R``, so a feature neither has seen often weighs nothing. The sum over a text, divided by its number
of features, must reach a threshold. Weights are whole millionths, so sums are exact and the
verdict of every document is the same in any order of rows and tasks.

Null texts are empty; an empty text has no features and a ratio of 0. Repeated rows are judged each.
Null ids are never trusted; all rows of a trusted id are. With no trusted text every weight is 0 or less.
An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import discard, id_and_text, write_shared

# White space between words, marks, and the bounds of the base rules.
SPACE = r"[\x20\x09-\x0D]+"
VISIBLE = r"[^\x20\x09-\x0D]"
MARKS = r"[#*$%&|<>]+"
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30

BUCKETS = 1 << 16
MIX = 31_337
MILLION = 1_000_000
# Trusted ids at most, those of least hash: they are broadcast, eight bytes each.
MOST_TRUSTED = 50_000
# Added to both counts: a feature seen a few times says little.
PRIOR = 10.0
# Mean weight of a feature, in millionths, from which a text is kept. Good texts outside the counts score
# somewhat below those counted: of labelled documents left out, good ones begin at -92,000 in a corpus of
# 1,000 (-50,000 in 10,000) and bad ones end at -219,000 (-107,000).
THRESHOLD = -100_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _pairs(name: str, apart: int, f) -> Column:
    """``f`` of every value of an array column and the one ``apart`` places after it.

    The array is named, never an expression: it stands here three times, and an expression would be worked out each time.
    """
    later = F.slice(name, apart + 1, F.size(name))
    return F.slice(F.zip_with(name, later, f), 1, F.greatest(F.size(name) - apart, F.lit(0)))


def with_windows(docs: DataFrame) -> DataFrame:
    """Add ``_hashes``, the hash of every window of ``WINDOW`` of the column ``words``, by doubling."""
    docs = docs.withColumn("_hashes", F.transform("words", lambda w: F.xxhash64(w)))
    apart = 1
    while apart < WINDOW:
        docs = docs.withColumn("_hashes", _pairs("_hashes", apart, lambda a, b: F.xxhash64(a, b)))
        apart *= 2
    return docs


def with_repeat_places(docs: DataFrame) -> DataFrame:
    """Add ``_again``: starts of the windows whose words occur at another place of the text too, in order."""
    repeated = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    placed = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    docs = docs.withColumn("_placed", F.when(repeated, placed))
    said = lambda at: F.slice("words", at + 1, F.lit(WINDOW))
    # Equal hashes lie side by side; the words themselves decide.
    twins = _pairs("_placed", 1, lambda a, b: F.when((a["h"] == b["h"]) & (said(a["i"]) == said(b["i"])), F.array(a["i"], b["i"])))
    return docs.withColumn("_again", F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda x: x.isNotNull())))))


def covered(starts: Column) -> Column:
    """Words under the windows that begin at ``starts``, which are in order; 0 for null."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = lambda acc, s: F.struct((s + WINDOW).alias("end"), (acc["n"] + s + WINDOW - F.greatest(acc["end"], s)).alias("n"))
    return F.coalesce(F.aggregate(starts, zero, step, lambda acc: acc["n"]), F.lit(0))


def with_features(docs: DataFrame) -> DataFrame:
    """Add ``_features``, the buckets of all one- and two-word features of the column ``words``."""
    docs = docs.withColumn("_codes", F.transform("words", lambda w: F.crc32(w.cast("binary"))))
    one = F.transform("_codes", lambda a: (a % BUCKETS).cast("int"))
    return docs.withColumn("_features", F.concat(one, _pairs("_codes", 1, lambda a, b: ((a * MIX + b) % BUCKETS).cast("int")))).drop("_codes")


def base_rules(docs: DataFrame) -> DataFrame:
    """``doc_id, words`` with the base figures of every row of ``doc_id, text``."""
    split = with_repeat_places(with_windows(docs.withColumn("words", words(F.col("text")))))
    split = split.withColumn("_lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(VISIBLE)))
    long = lambda c: c.cast("long")
    counted = split.select(
        "doc_id",
        "words",
        long(F.size("words")).alias("n_words"),
        long(F.char_length(F.array_join("words", ""))).alias("word_chars"),
        long(F.char_length("text") - F.char_length(F.regexp_replace("text", MARKS, ""))).alias("n_symbols"),
        long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        long(covered(F.col("_again"))).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def trusted_ids(ids: DataFrame, most: int = MOST_TRUSTED) -> DataFrame:
    """At most ``most`` distinct ids, those of least hash, with ``trusted``."""
    known = ids.select(F.col(ids.columns[0]).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).withColumn("trusted", F.lit(True))


def weigh(docs: DataFrame, good: DataFrame, most_trusted: int = MOST_TRUSTED) -> DataFrame:
    """``bucket, weight`` from all rows of ``docs`` (``doc_id, text``) and the trusted ids ``good``; at most ``BUCKETS`` rows."""
    flagged = docs.join(F.broadcast(trusted_ids(good, most_trusted)), "doc_id", "left")
    seen = with_features(flagged.select("trusted", words(F.col("text")).alias("words"))).select("trusted", F.explode("_features").alias("bucket"))
    counts = seen.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("trusted").alias("target"))
    counts = write_shared(counts, "rule-counts")
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("target"), F.lit(0)).alias("target")).first()
    expected = F.col("raw").cast("double") * float(total.target) / float(max(total.raw, 1))
    weight = F.round(MILLION * F.ln((F.col("target") + PRIOR) / (expected + PRIOR))).cast("long")
    table = write_shared(counts.select("bucket", weight.alias("weight")), "rule-weights")
    discard(counts)
    return table


def judge(docs: DataFrame, weights: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: base figures, ``base_failed``, ``ratio`` (sum of weights), ``n_features`` and ``kept``."""
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    figures = with_features(base_rules(id_and_text(docs, id_col, text_col))).withColumn("_row", F.monotonically_increasing_id())
    rows = figures.select("_row", *base, F.explode_outer("_features").alias("bucket"))
    # The features of a row are summed in the task that made them; one short row per document is shuffled.
    summed = (
        rows.join(F.broadcast(weights), "bucket", "left")
        .groupBy("_row", *base)
        .agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("ratio"), F.count("bucket").alias("n_features"))
    )
    return summed.drop("_row").withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold * F.col("n_features")))
