"""Raw JSON lines -> slim items with the removed flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import is_placeholder
from ..functions.text import DELETED, REMOVED
from ..schemas import RAW_KEYS, SLIM, TEXT_KEYS

_RAW = T.StructType([T.StructField(k, T.StringType()) for k in (*RAW_KEYS, "_bad")])

# Score of an item whose score is an explicit null.
NULL_SCORE = 1


def _value(key: str) -> Column:
    return F.col(f"x.{key}")


def _present(key: str) -> Column:
    """Whether the key occurs at all. A null value and a missing key parse alike, so only
    lines without a value look at the object's keys."""
    return F.when(_value(key).isNotNull(), True).otherwise(
        F.coalesce(F.array_contains(F.json_object_keys("value"), key), F.lit(False))
    )


def _truthy(key: str) -> Column:
    """Truth of a JSON value that was read as text. A quoted text is true unless it is empty."""
    quoted = F.col("value").rlike(f'"{key}"\\s*:\\s*"')
    return F.coalesce(F.when(_value(key).isin("false", "0", "0.0", "[]", "{}"), quoted).otherwise(_value(key) != ""), F.lit(False))


def _whole(key: str) -> Column:
    """A whole number, however the dump writes it: ``5``, ``"5"``, ``5.0`` or ``5e0``."""
    number = _value(key).try_cast("decimal(38,9)")
    return F.coalesce(_value(key).try_cast("long"), F.when(number == F.floor(number), number.try_cast("long")))


# Largest id in base 36; ids are compared by their value, so leading zeros do not count.
_MOST_ID = "1y2p0ij32e8e7"


def _is_id(text: Column) -> Column:
    plain = F.lower(F.ltrim(text, F.lit("0")))
    fits = (F.length(plain) < len(_MOST_ID)) | ((F.length(plain) == len(_MOST_ID)) & (plain <= _MOST_ID))
    return F.coalesce(text.rlike("^[0-9A-Za-z]+$") & fits, F.lit(False))


def classify(lines: DataFrame) -> DataFrame:
    """Parse lines (``value, type`` and any further columns) and decide what becomes of each.

    A row with an ``error`` stands for a file that could not be read to its end.

    Adds the slim columns, the text keys as they stand, ``outcome`` and ``reason``:

    ``keep``        a slim item
    ``ignore``      an advert or profile record without the usual keys
    ``reject_file`` a post without either removal flag: its whole file is unusable
    ``broken_file`` the whole file is damaged or cut short
    ``quarantine``  not an item; ``reason`` tells why
    """
    error = F.col("error") if "error" in lines.columns else F.lit(None).cast("string")
    # Exploding the one parsed object keeps the parse below later filters: each line is
    # parsed once, however many conditions look at the result.
    parsed_line = F.from_json("value", _RAW, {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    parsed = lines.select("*", F.explode(F.array(parsed_line)).alias("x")).withColumns(
        {
            "_body_removed": is_placeholder(_value("body"), REMOVED),
            "_author_deleted": is_placeholder(_value("author"), DELETED),
            "_created": _whole("created_utc"),
            "_score": _whole("score"),
        }
    )
    comment = F.col("type") == "comments"
    body_removed, author_deleted = F.col("_body_removed"), F.col("_author_deleted")
    no_flag = ~author_deleted & ~_present("is_robot_indexable") & ~_present("is_crosspostable")
    removed = F.when(comment, body_removed & author_deleted).otherwise(
        ~author_deleted
        & F.when(_present("is_robot_indexable"), ~_truthy("is_robot_indexable")).otherwise(~_truthy("is_crosspostable"))
    )
    complete = _present("id") & _present("created_utc") & _present("subreddit")
    ignorable = F.coalesce(
        F.startswith(_value("permalink"), F.lit("/comments/"))
        | F.startswith(_value("permalink"), F.concat(F.lit("/r/u_"), _value("author"), F.lit("/"))),
        F.lit(False),
    ) | _truthy("promoted")
    created, score = F.col("_created"), F.col("_score")
    bad_value = (
        ~_is_id(_value("id"))
        | _value("subreddit").isNull()
        | created.isNull()
        | (_value("score").isNotNull() & score.isNull())
    )
    reason = (
        F.when(error.isNotNull(), error)
        .when(F.col("x").isNull() | _value("_bad").isNotNull(), "malformed")
        .when(comment & _value("body").isNull(), "no body")
        .when((~comment | body_removed) & _value("author").isNull(), "no author")
        .when(~comment & no_flag, "no removal flag")
        .when(~_present("score"), "no score")
        .when(~complete, F.when(ignorable, "ignorable").otherwise("missing key"))
        .when(bad_value, "bad value")
    )
    outcome = (
        F.when(error.isNotNull(), "broken_file")
        .when(F.col("reason").isNull(), "keep")
        .when(F.col("reason") == "ignorable", "ignore")
        .when(F.col("reason") == "no removal flag", "reject_file")
        .otherwise("quarantine")
    )
    rest = [c for c in lines.columns if c not in ("value", "error")]
    return (
        parsed.withColumn("reason", reason)
        .select(
            *rest,
            _value("id").alias("id"),
            created.alias("created_utc"),
            _value("subreddit").alias("subreddit"),
            F.coalesce(score, F.lit(NULL_SCORE).cast("long")).alias("score"),
            F.coalesce(removed, F.lit(False)).alias("is_removed"),
            *(_value(k).alias(k) for k in TEXT_KEYS),
            outcome.alias("outcome"),
            "reason",
            F.when(F.col("reason").isNotNull(), F.col("value")).alias("raw"),
        )
    )


def rejected_files(classified: DataFrame) -> DataFrame:
    """Files with at least one post that makes the whole file unusable."""
    return classified.where("type = 'posts' AND outcome = 'reject_file'").select("file").distinct()


def broken_files(classified: DataFrame) -> DataFrame:
    """Files that could not be read to their end, with the reason: ``file, type, month, reason``."""
    return classified.where("outcome = 'broken_file'").groupBy("file", "type", "month").agg(F.min("reason").alias("reason"))


def unusable_files(classified: DataFrame) -> DataFrame:
    """Files of which nothing is used: rejected and broken ones."""
    return rejected_files(classified).union(broken_files(classified).select("file"))


def kept_items(classified: DataFrame, strict: bool = False) -> DataFrame:
    """Slim items of the files that are neither rejected nor broken.

    ``strict`` fails the job on the first quarantined line instead of leaving it out.
    """
    if strict:
        message = F.concat(F.lit("unexpected line: "), F.col("reason"), F.lit(" in "), F.col("file"))
        classified = classified.withColumn(
            "outcome", F.when(F.col("outcome") == "quarantine", F.raise_error(message)).otherwise(F.col("outcome"))
        )
    # At most one row per dump file, so the names always fit every executor.
    usable = classified.join(F.broadcast(unusable_files(classified)), "file", "left_anti")
    return usable.where("outcome = 'keep'").select(*SLIM.fieldNames(), "type", "month", "pos")


def quarantined(classified: DataFrame) -> DataFrame:
    """Lines that are no items, with the reason and the raw text."""
    return classified.where("outcome = 'quarantine'").select("file", "type", "month", "pos", "reason", "raw")
