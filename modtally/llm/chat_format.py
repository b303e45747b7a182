"""Chat formatting with typed content parts, in DataFrame expressions only.

A turn's content is a list of parts ``{type, text, ref, size}``. A visitor flattens text,
image, audio and document parts in order: text stays, every attachment becomes a numbered
placeholder, its reference is recorded, and its placeholder counts as ``expanded`` tokens.

The template marks a turn as ``<|role:NAME|>\\n…<|end|>\\n`` and a placeholder as ``<|TYPE:N|>``.
Inside texts and names ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\p`` (in names also ``|>``
becomes ``|\\q``), so that no text can forge a mark, and ``unescape`` restores it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,size:int>"
PARTS = f"array<{PART}>"
END = "<|end|>\n"

# Expanded tokens of an attachment: a fixed part and so many per unit of size (image: 1,000
# pixels, audio: seconds, document: pages). Characters per text token.
EXPANDED = {"image": (1, 1), "audio": (2, 25), "document": (2, 500)}
CHARS_PER_TOKEN = 4


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\p"))


def escape_name(name: Column) -> Column:
    """A name must not close its mark either: ``|>`` becomes ``|\\q``."""
    return F.replace(escape(name), F.lit("|>"), F.lit("|\\q"))


def unescape_name(name: Column) -> Column:
    return unescape(F.replace(name, F.lit("|\\q"), F.lit("|>")))


def unescape(text: Column) -> Column:
    """Single backslashes stand only in ``<\\p``; all others come in pairs."""
    return F.replace(F.replace(text, F.lit("<\\p"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def text_parts(text: Column) -> Column:
    """Content of a plain text: one text part. Null is the empty text."""
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            F.coalesce(text, F.lit("")).alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("int").alias("size"),
        )
    ).cast(PARTS)


def is_attachment(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) != "text"


def visit(part: Column, number: Column) -> Column:
    """Formatted form of one part; ``number`` counts the attachments of its turn before it."""
    kind = F.coalesce(part["type"], F.lit("text"))
    return F.when(
        is_attachment(part), F.concat(F.lit("<|"), escape_name(kind), F.lit(":"), number.cast("string"), F.lit("|>"))
    ).otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def expanded_tokens(part: Column) -> Column:
    size = F.greatest(F.coalesce(part["size"], F.lit(0)), F.lit(0))
    text_tokens = F.ceil(F.char_length(F.coalesce(part["text"], F.lit(""))) / CHARS_PER_TOKEN).cast("long")
    out = text_tokens
    for kind, (fixed, each) in EXPANDED.items():
        out = F.when(part["type"] == kind, (F.lit(fixed) + F.lit(each) * size).cast("long")).otherwise(out)
    return out


def flatten_parts(turns: DataFrame, content_col: str = "content") -> DataFrame:
    """Add ``flat`` (formatted content), ``attachments`` (type, ref, number) and ``tokens`` to every turn.

    Null content and null parts are empty; a part without a type is text; an unknown type is kept as an attachment.
    """
    parts = F.filter(F.coalesce(F.col(content_col), F.array().cast(PARTS)), lambda p: p.isNotNull())
    kept = turns.withColumn("_parts", parts)
    start = F.struct(F.lit("").alias("flat"), F.lit(0).alias("n"))
    folded = F.aggregate(
        "_parts",
        start,
        lambda acc, p: F.struct(
            F.concat(acc["flat"], visit(p, acc["n"])).alias("flat"), (acc["n"] + F.when(is_attachment(p), 1).otherwise(0)).alias("n")
        ),
        lambda acc: acc["flat"],
    )
    # Plain texts, by far the most turns, need no fold.
    plain = (F.size("_parts") == 1) & ~is_attachment(F.col("_parts")[0])
    files = F.transform(F.filter("_parts", is_attachment), lambda p, i: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), i.alias("number")))
    return (
        kept.withColumn("flat", F.when(plain, visit(F.col("_parts")[0], F.lit(0))).otherwise(folded))
        .withColumn("attachments", files)
        .withColumn("tokens", F.aggregate("_parts", F.lit(0).cast("long"), lambda acc, p: acc + expanded_tokens(p)))
        .drop("_parts")
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of turns ``conv_id, turn, role, content``: formatted text, attachments, tokens.

    Turns go by number, equal numbers by role, then by formatted content; null numbers come
    first; a null role is the empty name. Repeated rows are turns of their own. Rows with a
    null ``conv_id`` form one conversation. Columns: ``conv_id, formatted, attachments
    (turn position, type, ref, number), tokens``.
    """
    one = flatten_parts(turns.select("conv_id", "turn", "role", "content")).select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), "flat", "attachments", "tokens").alias("t")
    )
    chats = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    shown = F.transform("turns", lambda t: F.concat(F.lit("<|role:"), escape_name(t["role"]), F.lit("|>\n"), t["flat"], F.lit(END)))
    files = F.flatten(
        F.transform(
            "turns",
            lambda t, i: F.transform(
                t["attachments"], lambda a: F.struct(i.alias("position"), a["type"].alias("type"), a["ref"].alias("ref"), a["number"].alias("number"))
            ),
        )
    )
    return chats.select(
        "conv_id",
        F.array_join(shown, "").alias("formatted"),
        files.alias("attachments"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda acc, t: acc + t["tokens"]).alias("tokens"),
    )


def read_back(formatted: Column) -> Column:
    """Turns of a formatted text as ``array<struct<role, text>>``, unescaped; placeholders stay in the text."""
    marked = F.filter(F.split(formatted, r"<\|role:"), lambda x: x != "")
    return F.transform(
        marked,
        lambda x: F.struct(
            unescape_name(F.substring_index(x, "|>\n", 1)).alias("role"),
            unescape(
                F.substring(
                    x,
                    F.locate("|>\n", x) + 3,
                    F.char_length(x) - F.locate("|>\n", x) - 2 - len(END),
                )
            ).alias("text"),
        ),
    )


def loss_text(turns: Column) -> Column:
    """All text under the loss mask: the assistant's texts in order, nothing between."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
